"""The audit of a whole namespace as one findings DataFrame."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.findings import FINDING, finding, labelled
from driftmend.functions.frames import stacked
from driftmend.functions.names import cols
from driftmend.functions.sides import align
from driftmend.functions.types import family
from driftmend.operators import schema_audit
from driftmend.operators.keys import key_presence, orphan_keys
from driftmend.operators.mapping import map_schema
from driftmend.operators.rows import STATUSES, bag_counts, compared_keys, status_counts
from driftmend.plans.facts import with_affected
from driftmend.sources.catalog import Catalog, load_catalog
from driftmend.sources.contract import Namespace, Reference
from driftmend.sources.sinks import staged

# The checks a plain audit runs, and those that can be added.
CHECKS = ("schema", "rows", "dependencies")
FURTHER_CHECKS = ("affected", "keys", "extra", "changed", "orphans", "casts")


def audit(
    target: Namespace,
    given: Namespace,
    run_id: str = "audit",
    checks: Collection[str] = CHECKS,
    compare_types: str = "family",
    include_same_schema: bool = False,
    exclude: Sequence[str] = (),
    others: Sequence[Namespace] = (),
    catalogs: tuple[Catalog, Catalog] | None = None,
) -> DataFrame:
    """Everything given lacks or has differently, as findings.

    * ``schema``: missing tables and columns, differing types and nullability, colliding names
    * ``rows``: keys of target that given lacks
    * ``dependencies``: references that lead nowhere in given or in ``others``, the further schemas next to it
    * ``affected``: count on target's data how many rows each schema finding concerns
    * ``keys``: repeated keys and NULL keys, on either side
    * ``extra``, ``changed``: keys only given has; rows that differ beyond their key
    * ``orphans``: rows of given whose reference has no parent there
    * ``casts``: values of target that given's column type cannot hold

    Tables of target whose names differ only in case are all compared, each with the table of its very name in given or else
    the last that matches. Where the sides have nothing to compare there are no findings.
    A table that cannot be compared or read is a finding itself and the others go on: the checks of some tables at a
    time are one job whose findings are written to the shared work folder, and those of a job that fails are run again
    table by table. All counts of a table that concern its key come from one pass over it. ``catalogs`` replaces the catalogs of target and given, where
    a database has its own (``read_jdbc``): with these ``compare_types="source"`` compares its type names.
    """
    unknown = set(checks) - {*CHECKS, *FURTHER_CHECKS}
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}; there are {[*CHECKS, *FURTHER_CHECKS]}")
    spark = _session(target, given)
    failures = [(name, "load_error", text) for space in (target, given) for name, text in sorted(space.errors.items())]
    parts: list[tuple[str, list[DataFrame]]] = []
    if target.tables or given.tables:
        ours, theirs = catalogs or (load_catalog(spark, target), load_catalog(spark, given, *others))
        schema, here = target.schema, given.schema
        about_schema: list[DataFrame] = []
        if "schema" in checks:
            about_schema += [
                schema_audit.missing_tables(ours, theirs, schema, [*exclude, *given.errors], here),
                schema_audit.column_deviations(ours, theirs, schema, compare_types, here),
                schema_audit.name_collisions(ours, schema).union(schema_audit.name_collisions(theirs, here)).distinct(),
            ]
        if "dependencies" in checks:
            about_schema.append(schema_audit.missing_dependencies(ours, theirs, schema, include_same_schema, here))
        if about_schema:
            plain = stacked(about_schema)
            if "affected" in checks:
                counted, broken = evaluated([("schema", [with_affected(plain, target, given)])], "findings")
                parts += [("schema", counted or [plain])]
                failures += [(name, "table_error", text) for name, text in broken]
            else:
                parts.append(("schema", [plain]))
    for name in target.names():
        other = given.find(name)
        if other is None:
            continue
        for part in (_orphan_findings, _cast_findings, _key_findings):
            try:
                if found := part(name, other, target, given, others, checks):
                    parts.append((name, found))
            except (ValueError, AnalysisException) as error:
                failures.append((name, "table_error", str(error)))
    if not parts and not failures and not (target.tables or given.tables):
        raise ValueError("neither side has a table")
    found, broken = evaluated(parts, "findings")
    failures += [(name, "table_error", text) for name, text in broken]
    if failures:
        found.append(_failures(spark, failures))
    if not found:
        found.append(spark.createDataFrame([], FINDING))
    return labelled(stacked(found), run_id).orderBy("table", "kind", "column", "message")


def evaluated(parts: Sequence[tuple[str, list[DataFrame]]], purpose: str, together: int = 16) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """(written results, what failed): named frames of one schema, ``together`` of them a job.

    The frames of a job that fails are run one by one, so that only those that fail themselves are missing.
    """
    done: list[DataFrame] = []
    failed: list[tuple[str, str]] = []
    for i in range(0, len(parts), together):
        group = parts[i : i + together]
        try:
            done.append(staged(stacked([f for _, frames in group for f in frames]), purpose))
        except (PySparkException, Py4JJavaError) as error:
            if len(group) == 1:
                failed.append((group[0][0], _first_line(error)))
                continue
            for one in group:
                good, bad = evaluated([one], purpose)
                done += good
                failed += bad
    return done, failed


def _first_line(error: Exception) -> str:
    cause = getattr(error, "java_exception", None)
    lines = str(cause.toString() if cause is not None else error).strip().splitlines()
    return (lines[0] if lines else type(error).__name__)[:500]


def reverse_check(target: Namespace, given: Namespace, **options) -> DataFrame:
    """What given has and target lacks: the audit with the sides swapped."""
    return audit(given, target, **options)


def audit_metrics(
    target: Namespace, given: Namespace, others: Sequence[Namespace] = (), primary_key: bool = False
) -> DataFrame:
    """One row per table on both sides: its rows on each, keys by status, and orphaned rows of given.

    A table without a key is compared as a bag: there ``changed``, ``same`` and ``duplicate_key`` are NULL,
    and the others count rows. A table that cannot be compared or read has NULL in all of them.
    """
    frames: list[tuple[str, list[DataFrame]]] = []
    unread: list[str] = []
    for name in target.names():
        other = given.find(name)
        if other is None:
            continue
        left, right = target.tables[name], given.tables[other]
        keys = target.contract(name).keys
        try:
            counted = status_counts(left, right, keys, primary_key) if keys else _bag_counts(left, right)
            orphans = _orphan_total(name, target, given, others)
            frames.append((name, [counted.select(F.lit(name).alias("table"), *cols(counted.columns), orphans)]))
        except (ValueError, AnalysisException):
            unread.append(name)
    if not frames and not unread:
        raise ValueError("the two sides share no table")
    done, broken = evaluated(frames, "metrics")
    unread += [name for name, _ in broken]
    counts = ("rows_target", "rows_given", *STATUSES, "orphan_rows")
    if unread:
        names = F.explode(F.array(*[F.lit(name) for name in unread])).alias("table")
        empty = _session(target, given).range(1).select(names)
        done.append(empty.select("table", *[F.lit(None).cast("bigint").alias(c) for c in counts]))
    return stacked(done)


def _orphan_findings(
    name: str, other: str, target: Namespace, given: Namespace, others: Sequence[Namespace], checks: Collection[str]
) -> list[DataFrame]:
    found = []
    for reference in target.contract(name).references if "orphans" in checks else ():
        parent = _parent(reference, given, others)
        if parent is None:
            continue
        orphans = orphan_keys(given.tables[other], parent, reference.columns, reference.ref_columns)
        shown, n = F.lit(", ".join(reference.columns)), F.col("n")
        total = orphans.agg(F.sum("n_rows").alias("n")).where(n > 0)
        found.append(total.select(*finding("orphan_rows", F.lit(name), shown, n, F.lit(name), n, shown)))
    return found


def _cast_findings(
    name: str, other: str, target: Namespace, given: Namespace, others: Sequence[Namespace], checks: Collection[str]
) -> list[DataFrame]:
    left = target.tables[name]
    theirs = {f.name.lower(): f.dataType for f in given.tables[other].schema.fields}
    wanted = T.StructType(
        [
            T.StructField(f.name, theirs[f.name.lower()])
            for f in left.schema.fields
            if f.name.lower() in theirs and family(theirs[f.name.lower()]) != family(f.dataType)
        ]
    )
    if "casts" not in checks or not wanted.fields:
        return []
    _, loss = map_schema(left, wanted)
    type_of = F.create_map(*[F.lit(x) for f in wanted.fields for x in (f.name, f.dataType.simpleString())])
    table, column, n = F.lit(name), F.col("column"), F.col("n_lost")
    return [loss.where(n > 0).select(*finding("cast_loss", table, column, n, table, column, n, type_of[column]))]


def _key_findings(
    name: str, other: str, target: Namespace, given: Namespace, others: Sequence[Namespace], checks: Collection[str]
) -> list[DataFrame]:
    """All findings about the key and the rows of one table, from one pass over it."""
    if not {"rows", "keys", "extra", "changed"} & set(checks):
        return []
    left, right, keys = target.tables[name], given.tables[other], target.contract(name).keys
    if not keys:
        raise ValueError(f"table {target.schema}.{name} has no primary key")
    if "changed" in checks:
        sides = align(left, right, keys)
        one_each = (F.col("n_target") == 1) & (F.col("n_given") == 1)
        pairs, changed = compared_keys(sides, primary_key=False), F.count_if(one_each & F.array_contains("_changed", True))
    else:
        pairs, changed = key_presence(left, right, keys), F.lit(0).cast("bigint")
    in_target, in_given = F.col("n_target"), F.col("n_given")
    null_key = reduce(Column.__or__, [c.isNull() for c in cols(pairs.columns[: len(keys)])])
    counts = pairs.agg(
        F.count_if((in_target > 0) & (in_given == 0)).alias("unsynced_rows"),
        F.count_if((in_target == 0) & (in_given > 0)).alias("extra_rows"),
        changed.alias("changed_rows"),
        F.count_if(in_target > 1).alias("duplicate_key_target"),
        F.count_if(in_given > 1).alias("duplicate_key_given"),
        F.coalesce(F.sum(F.when(null_key, in_target)), F.lit(0)).alias("null_key_target"),
        F.coalesce(F.sum(F.when(null_key, in_given)), F.lit(0)).alias("null_key_given"),
    )
    table = F.lit(name)
    facts: list[list[Column]] = []
    for check, kind in (("rows", "unsynced_rows"), ("extra", "extra_rows"), ("changed", "changed_rows")):
        if check in checks:
            facts.append(finding(kind, table, None, F.col(kind), table, F.col(kind)))
    for kind in ("duplicate_key", "null_key") if "keys" in checks else ():
        for side in ("target", "given"):
            n = F.col(f"{kind}_{side}")
            facts.append(finding(kind, table, None, n, table, n, F.lit(side)))
    return [counts.select(F.inline(F.array(*[F.struct(*fact) for fact in facts]))).where(F.col("n") > 0)]


def _bag_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """The counts of a table without a key, all from one pass over both sides."""
    balance = F.col("n_target") - F.col("n_given")
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    return bag_counts(left, right).agg(
        total(F.col("n_target")).alias("rows_target"),
        total(F.col("n_given")).alias("rows_given"),
        total(F.when(balance > 0, balance)).alias("missing_in_given"),
        total(F.when(balance < 0, -balance)).alias("only_in_given"),
        *[F.first(F.lit(None).cast("bigint")).alias(s) for s in STATUSES[2:]],
    )


def _orphan_total(name: str, target: Namespace, given: Namespace, others: Sequence[Namespace]) -> Column:
    """Orphaned rows of given over all references declared for the table, as a scalar subquery."""
    child = given.tables[given.find(name)]
    total = F.lit(0).cast("bigint")
    for reference in target.contract(name).references:
        parent = _parent(reference, given, others)
        if parent is not None:
            orphans = orphan_keys(child, parent, reference.columns, reference.ref_columns)
            total = total + orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar()
    return total.alias("orphan_rows")


def _parent(reference: Reference, given: Namespace, others: Sequence[Namespace]) -> DataFrame | None:
    """The referenced table on the given side; None if it is not there, which the dependency check reports."""
    for space in (given, *others):
        if reference.schema in (None, space.schema) and space.find(reference.table) is not None:
            table = space.tables[space.find(reference.table)]
            known = {c.lower() for c in table.columns}
            return table if all(c.lower() in known for c in reference.ref_columns) else None
    return None


def _failures(spark: SparkSession, failures: list[tuple[str, str, str]]) -> DataFrame:
    names, kinds, texts = (pa.array(list(c), type=pa.string()) for c in zip(*failures, strict=True))
    rows = spark.createDataFrame(pa.table({"table": names, "kind": kinds, "text": texts}))
    frames = [
        rows.where(F.col("kind") == kind).select(
            *finding(kind, F.col("table"), None, None, F.col("table"), F.col("text"))
        )
        for kind in ("load_error", "table_error")
    ]
    return frames[0].unionByName(frames[1])


def _session(*spaces: Namespace) -> SparkSession:
    for space in spaces:
        for table in space.tables.values():
            return table.sparkSession
    active = SparkSession.getActiveSession()
    if active is None:
        raise ValueError("neither side has a table")
    return active


__all__ = ["CHECKS", "FURTHER_CHECKS", "audit", "audit_metrics", "reverse_check"]
