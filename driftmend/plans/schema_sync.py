"""A sync of all tables of a schema that leaves no row without its parent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.functions.display import key_text
from driftmend.functions.frames import stacked
from driftmend.functions.names import col, cols, resolve
from driftmend.functions.sides import Sides, keep_by_key
from driftmend.functions.types import common_key_type
from driftmend.operators.sync import MODES, same_shape
from driftmend.operators.three_way import key_changes
from driftmend.sources.contract import Namespace, Reference
from driftmend.sources.sinks import staged

REFUSED = "table string, op string, key string, reference string"


@dataclass(frozen=True)
class SchemaSync:
    """What a sync of a schema does.

    ``steps`` are (table, operation) in the order in which they can be carried out without ever leaving a row without its
    parent; ``changes`` has per table the keys and their ``_op``; ``refused`` lists what was not done as ``table``, ``op``,
    ``key`` and the ``reference`` it would have broken.
    """

    steps: tuple[tuple[str, str], ...]
    changes: Mapping[str, DataFrame]
    refused: DataFrame
    _tables: Mapping[str, _Table] = field(repr=False)

    def rows(self, table: str, op: str) -> DataFrame:
        """The rows of target that an insert or update brings, or the rows of given that a delete removes."""
        sides = self._tables[table].sides
        wanted = self.changes[table].where(F.col("_op") == op)
        return keep_by_key(sides.given if op == "delete" else sides.target, wanted, sides.keys, "left_semi")

    def state(self, table: str) -> DataFrame:
        """All rows of the table afterwards."""
        sides, changed = self._tables[table].sides, self.changes[table]
        kept = keep_by_key(sides.given, changed.where("_op <> 'insert'"), sides.keys, "left_anti")
        return kept.unionByName(keep_by_key(sides.target, changed.where("_op <> 'delete'"), sides.keys, "left_semi"))


@dataclass
class _Table:
    name: str
    sides: Sides
    #: Pairs of a reference and the table of this sync that it points at.
    parents: list[tuple[Reference, str]]
    changes: DataFrame | None = None


def layers(tables: Sequence[str], pointing: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """The tables in groups, parents first; tables that point at each other in a circle are one group.

    ``pointing`` has for each table those it points at. Names only: as many as a schema has tables.
    """
    order: list[str] = []
    seen: set[str] = set()
    for start in tables:
        trail = [] if start in seen else [(start, iter(pointing.get(start, ())))]
        seen.add(start)
        while trail:
            table, rest = trail[-1]
            after = next((p for p in rest if p not in seen), None)
            if after is None:
                order.append(table)
                trail.pop()
            else:
                seen.add(after)
                trail.append((after, iter(pointing.get(after, ()))))
    children: dict[str, list[str]] = {}
    for table, parents in pointing.items():
        for parent in parents:
            children.setdefault(parent, []).append(table)
    # A table finished last is reached, against the direction of references, by its own circle only.
    groups: list[list[str]] = []
    taken: set[str] = set()
    for start in reversed(order):
        if start in taken:
            continue
        group, waiting = [], [start]
        taken.add(start)
        while waiting:
            table = waiting.pop()
            group.append(table)
            for child in children.get(table, ()):
                if child not in taken:
                    taken.add(child)
                    waiting.append(child)
        groups.append(sorted(group))
    return groups[::-1]


def sync_schema(target: Namespace, given: Namespace, mode: str = "insert_missing") -> SchemaSync:
    """Bring all tables of ``given`` that have a key up to ``target``, in the order of their references.

    Per table the ``mode`` is that of :func:`~driftmend.operators.sync.sync`; a table that given lacks is empty there.
    Parents are dealt with first: a row to insert or update whose reference has no parent, neither in given nor among what
    is inserted, is refused, and so are then the rows that point at it. Children come first for deletions: a row that some
    row left over still points at is not deleted, nor then what it points at itself. Tables that point
    at each other, or at themselves, are settled together, round by round over what the round before
    refused, until nothing more follows.

    Rows of given that had no parent before are left alone. Tables without a key, and those only given has, stay as they
    are, and what their rows point at is not deleted. References must point at the key of a table; those to tables
    of other schemas, or that neither side has, are not looked at. The keys of changes are written to the shared work
    folder, and rows are compared by digests (128 bits and their number).
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    tables, others = _tables(target, given)
    if not tables:
        raise ValueError("target has no table with a key")
    groups = layers(list(tables), {name: [p for _, p in t.parents] for name, t in tables.items()})
    refused: list[DataFrame] = []
    for group in groups:
        candidates = {n: staged(key_changes(tables[n].sides.target, tables[n].sides.given, tables[n].sides.keys, mode), "changes") for n in group}
        for name in group:
            tables[name].changes = candidates[name]
        refused += _refuse_orphans(tables, group)
    if mode == "mirror":
        for group in reversed(groups):
            refused += _keep_parents(tables, group, others)
    empty = target.tables[next(iter(target.tables))].sparkSession.createDataFrame([], REFUSED)
    forward = [(name, op) for group in groups for name in group for op in ("insert", "update")]
    backward = [(name, "delete") for group in reversed(groups) for name in reversed(group)]
    steps = [*forward, *backward] if mode == "mirror" else [s for s in forward if mode == "upsert" or s[1] == "insert"]
    return SchemaSync(tuple(steps), {n: t.changes for n, t in tables.items()}, stacked([empty, *refused]), tables)


def consequent_orphans(space: Namespace) -> DataFrame:
    """The rows that have no parent, or lose it once such rows are gone, and so on to any depth: ``table``, ``key`` and each
    ``reference`` it breaks.

    Each round joins only what the round before found. Rows that hold each other up in a circle stay. Tables
    without a key, and references to tables that are not there, are not looked at; ``orphan_rows`` tells the former's.
    """
    empty = Namespace(space.schema, {name: table.limit(0) for name, table in space.tables.items()}, space.contracts)
    return sync_schema(space, empty).refused.drop("op").distinct()


def run_schema_sync(target: Namespace, given: Namespace, out: str, mode: str = "insert_missing") -> SchemaSync:
    """Carry out :func:`sync_schema` into the new folder ``out``: per table ``state`` and the rows of each operation,
    in the order of its steps, and ``refused`` last."""
    plan = sync_schema(target, given, mode)
    for table, op in plan.steps:
        plan.rows(table, op).write.mode("errorifexists").parquet(f"{out}/{table}/{op}")
    for table in plan.changes:
        plan.state(table).write.mode("errorifexists").parquet(f"{out}/{table}/state")
    plan.refused.write.mode("errorifexists").parquet(f"{out}/refused")
    return plan


def _tables(target: Namespace, given: Namespace) -> tuple[dict[str, _Table], list[tuple[str, DataFrame, Reference, str]]]:
    """The tables to sync, and (name, rows, reference, parent) for each reference of the others."""
    found: dict[str, _Table] = {}
    others: list[tuple[str, DataFrame, Reference, str]] = []
    spelt = {name.lower(): name for name in target.names() if target.find(name) == name}

    def parents(space: Namespace, name: str) -> list[tuple[Reference, str]]:
        out = []
        for reference in space.contract(name).references:
            parent = spelt.get(reference.table.lower())
            if reference.schema not in (None, space.schema) or parent is None or not target.contract(parent).keys:
                continue
            if {c.lower() for c in reference.ref_columns} != {k.lower() for k in target.contract(parent).keys}:
                raise ValueError(f"{name}{reference.columns} points at {parent}{reference.ref_columns}, which is not its key")
            out.append((reference, parent))
        return out

    for name in spelt.values():
        other = given.find(name)
        if target.contract(name).keys:
            ours = target.tables[name]
            theirs = given.tables[other] if other is not None else ours.limit(0)
            found[name] = _Table(name, same_shape(ours, theirs, target.contract(name).keys), parents(target, name))
        elif other is not None:
            others += [(name, given.tables[other], *pair) for pair in parents(target, name)]
    for name in given.names():
        if name.lower() not in spelt:
            others += [(name, given.tables[name], *pair) for pair in parents(given, name)]
    return found, others


def _pointing(rows: DataFrame, keys: Sequence[str], reference: Reference, parent: _Table) -> DataFrame:
    """``keys`` of ``rows`` and, under ``_ref_i``, the parent's key they point at; only complete references point anywhere."""
    own = resolve(rows, reference.columns)
    at = {r.lower(): c for r, c in zip(reference.ref_columns, own, strict=True)}
    refs = []
    for i, key in enumerate(parent.sides.keys):
        child = at[key.lower()]
        dtype = common_key_type(rows.schema[child].dataType, parent.sides.types[key])
        refs.append(col(child).cast(dtype).alias(f"_ref_{i}"))
    complete = reduce(lambda a, b: a & b, [col(c).isNotNull() for c in own])
    return rows.where(complete).select(*cols(keys), *refs)


def _as_refs(keys: DataFrame, parent: _Table) -> DataFrame:
    return keys.select(*[col(k).alias(f"_ref_{i}") for i, k in enumerate(parent.sides.keys)])


def _ref_names(parent: _Table) -> list[str]:
    return [f"_ref_{i}" for i in range(len(parent.sides.keys))]


def _told(keys: DataFrame, table: _Table, op: str, reference: Reference, parent: str) -> DataFrame:
    shown = f"{', '.join(reference.columns)} -> {parent}"
    return keys.select(F.lit(table.name).alias("table"), F.lit(op).alias("op"), key_text(keys, table.sides.keys).alias("key"), F.lit(shown).alias("reference"))


def _refuse_orphans(tables: dict[str, _Table], group: list[str]) -> list[DataFrame]:
    """Take the changes that would leave a row without its parent out of those of ``group``; returns what they were."""
    told: list[DataFrame] = []
    pointing: list[tuple[_Table, Reference, _Table, DataFrame]] = []
    lost: dict[str, list[DataFrame]] = {}
    for name in group:
        table = tables[name]
        come = table.changes.where("_op <> 'delete'")
        for reference, parent in table.parents:
            to = tables[parent]
            rows = keep_by_key(table.sides.target, come, table.sides.keys, "left_semi")
            refs = staged(_pointing(rows, table.sides.keys, reference, to), "references")
            pointing.append((table, reference, to, refs))
            there = _as_refs(to.sides.given.select(*cols(to.sides.keys)), to)
            new = _as_refs(to.changes.where("_op = 'insert'"), to)
            absent = keep_by_key(keep_by_key(refs, new, _ref_names(to), "left_anti"), there, _ref_names(to), "left_anti")
            bad = staged(absent.select(*cols(table.sides.keys)).distinct(), "refused")
            lost.setdefault(name, []).append(bad)
            told.append(_named(bad, table, reference, parent))
    latest = {name: _inserts(tables[name], stacked(parts)) for name, parts in lost.items()}
    settled = {name: stacked(parts).distinct() for name, parts in lost.items()}
    inside = [p for p in pointing if p[2].name in group]
    while inside and any(not keys.isEmpty() for keys in latest.values()):
        following: dict[str, list[DataFrame]] = {}
        for table, reference, to, refs in inside:
            if to.name not in latest:
                continue
            hit = keep_by_key(refs, _as_refs(latest[to.name], to), _ref_names(to), "left_semi").select(*cols(table.sides.keys)).distinct()
            fresh = staged(keep_by_key(hit, settled[table.name], table.sides.keys, "left_anti"), "refused")
            following.setdefault(table.name, []).append(fresh)
            told.append(_named(fresh, table, reference, to.name))
        latest = {name: _inserts(tables[name], stacked(parts)) for name, parts in following.items()}
        settled |= {name: staged(settled[name].unionByName(stacked(parts)).distinct(), "refused") for name, parts in following.items()}
    for name, keys in settled.items():
        tables[name].changes = staged(keep_by_key(tables[name].changes, keys, tables[name].sides.keys, "left_anti"), "changes")
    return told


def _inserts(table: _Table, keys: DataFrame) -> DataFrame:
    """Of refused keys those that were to be inserted: a refused update leaves given's row to point at."""
    return staged(keep_by_key(keys.distinct(), table.changes.where("_op = 'insert'"), table.sides.keys, "left_semi"), "refused")


def _named(keys: DataFrame, table: _Table, reference: Reference, parent: str) -> DataFrame:
    """What is refused, as insert or update."""
    inserts = keep_by_key(keys, table.changes.where("_op = 'insert'"), table.sides.keys, "left_semi")
    updates = keep_by_key(keys, table.changes.where("_op = 'update'"), table.sides.keys, "left_semi")
    return _told(inserts, table, "insert", reference, parent).unionByName(_told(updates, table, "update", reference, parent))


def _keep_parents(tables: dict[str, _Table], group: list[str], others: Sequence[tuple[str, DataFrame, Reference, str]]) -> list[DataFrame]:
    """Take the deletions of rows that others still point at out of those of ``group``; returns what they were."""
    told: list[DataFrame] = []
    doomed = {name: tables[name].changes.where("_op = 'delete'") for name in group}
    held: dict[str, list[DataFrame]] = {name: [] for name in group}
    inside: list[tuple[_Table, Reference, _Table, DataFrame]] = []
    for child in tables.values():
        for reference, parent in child.parents:
            if parent not in group:
                continue
            to = tables[parent]
            wanted = _as_refs(doomed[parent], to)
            own = keep_by_key(_pointing(child.sides.given, child.sides.keys, reference, to), wanted, _ref_names(to), "left_semi")
            own = staged(own, "references")
            stay = keep_by_key(own, child.changes.where("_op <> 'insert'"), child.sides.keys, "left_anti")
            come = keep_by_key(child.sides.target, child.changes.where("_op <> 'delete'"), child.sides.keys, "left_semi")
            new = keep_by_key(_pointing(come, child.sides.keys, reference, to), wanted, _ref_names(to), "left_semi")
            held[parent].append(_pointed_at(stay.unionByName(new), to, told, reference, child.name))
            if child.name in group:
                inside.append((child, reference, to, own))
    for name, rows, reference, parent in others:
        if parent in group:
            to = tables[parent]
            refs = keep_by_key(_pointing(rows, [], reference, to), _as_refs(doomed[parent], to), _ref_names(to), "left_semi")
            held[parent].append(_pointed_at(refs, to, told, reference, name))
    latest = {name: stacked(parts).distinct() for name, parts in held.items() if parts}
    settled = dict(latest)
    while inside and any(not keys.isEmpty() for keys in latest.values()):
        following: dict[str, list[DataFrame]] = {}
        for child, reference, to, own in inside:
            if child.name not in latest:
                continue
            kept = keep_by_key(own, latest[child.name], child.sides.keys, "left_semi")
            if to.name in settled:
                kept = keep_by_key(kept, _as_refs(settled[to.name], to), _ref_names(to), "left_anti")
            following.setdefault(to.name, []).append(_pointed_at(kept, to, told, reference, child.name))
        latest = {name: stacked(parts).distinct() for name, parts in following.items()}
        settled |= {name: staged(stacked([k for k in (settled.get(name), keys) if k is not None]).distinct(), "kept") for name, keys in latest.items()}
    for name, keys in settled.items():
        table = tables[name]
        left = keep_by_key(table.changes.where("_op = 'delete'"), keys, table.sides.keys, "left_anti")
        table.changes = staged(table.changes.where("_op <> 'delete'").unionByName(left), "changes")
    return told


def _pointed_at(refs: DataFrame, parent: _Table, told: list[DataFrame], reference: Reference, child: str) -> DataFrame:
    """The distinct keys of ``parent`` that ``refs`` point at, also told as deletions refused."""
    keys = refs.select(*[F.col(f"_ref_{i}").cast(parent.sides.types[k]).alias(k) for i, k in enumerate(parent.sides.keys)]).distinct()
    keys = staged(keys, "kept")
    shown = f"{child}.{', '.join(reference.columns)} -> {parent.name}"
    told.append(keys.select(F.lit(parent.name).alias("table"), F.lit("delete").alias("op"), key_text(keys, parent.sides.keys).alias("key"), F.lit(shown).alias("reference")))
    return keys
