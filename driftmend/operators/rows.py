"""Operators that compare whole rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.digest import row_digest
from driftmend.functions.display import cell_text
from driftmend.functions.names import col, cols, reserve
from driftmend.functions.sides import Sides, align, keep_by_key
from driftmend.functions.types import FIXED_WIDTH, comparable, has_map

# What can be said of a key.
STATUSES = ("missing_in_given", "only_in_given", "changed", "same", "duplicate_key")


def row_pairs(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    primary_key: bool = False,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key of either side: ``n_target``, ``n_given`` and the rows' other columns as structs
    ``target_row``, ``given_row`` (NULL where a side has no row or, as there is no telling which to pair, several).

    Both sides go through one aggregation on the key, as in :func:`~driftmend.operators.keys.key_presence`:
    rows of a repeated key fold to one per task before the shuffle, and no pairs of them are ever formed.
    With ``primary_key`` the key is known to be unique and free of NULL on both sides (see ``key_profile``):
    a full outer join, about half the work, and no shuffle at all for tables bucketed on the key.
    """
    sides = align(target, given, keys, values)
    return pair_sides(sides, primary_key).select(
        *cols(sides.keys),
        "n_target",
        "n_given",
        F.when(F.col("n_target") == 1, F.col("target_row")).alias("target_row"),
        F.when(F.col("n_given") == 1, F.col("given_row")).alias("given_row"),
    )


def pair_sides(sides: Sides, primary_key: bool) -> DataFrame:
    """:func:`row_pairs` of sides already aligned, but with some row of a key that has several."""
    reserve(sides.keys, "n_target", "n_given", "target_row", "given_row")
    packed = F.struct(*cols(sides.values)) if sides.values else F.struct(F.lit(True).alias("present"))
    if primary_key:
        ours = sides.target.select(*cols(sides.keys), packed.alias("target_row"), F.lit(1).alias("n_target"))
        theirs = sides.given.select(*cols(sides.keys), packed.alias("given_row"), F.lit(1).alias("n_given"))
        return ours.join(theirs, on=sides.keys, how="full_outer").select(
            *cols(sides.keys),
            *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("n_target", "n_given")],
            "target_row",
            "given_row",
        )
    both = sides.target.select("*", F.lit(True).alias("_ours")).unionByName(
        sides.given.select("*", F.lit(False).alias("_ours"))
    )
    ours = F.col("_ours")
    return both.groupBy(*cols(sides.keys)).agg(
        F.count_if(ours).alias("n_target"),
        F.count_if(~ours).alias("n_given"),
        F.any_value(F.when(ours, packed), ignoreNulls=True).alias("target_row"),
        F.any_value(F.when(~ours, packed), ignoreNulls=True).alias("given_row"),
    )


def compared_keys(sides: Sides, primary_key: bool) -> DataFrame:
    """One row per key: ``n_target``, ``n_given`` and ``_changed``, for each value column whether its two cells differ.

    Like :func:`pair_sides`, but without rows, so that it is one hash aggregation of fixed-width numbers: cells of fixed width are
    compared as they are, text and nested ones by two 64-bit digests, which alone are shuffled. Where a key has
    several rows on a side ``_changed`` says nothing.
    """
    if primary_key:
        pairs = pair_sides(sides, primary_key)
        return pairs.select(*cols(sides.keys), "n_target", "n_given", F.array(*[_differs(sides, v) for v in sides.values]).cast("array<boolean>").alias("_changed"))
    reserve(sides.keys, "n_target", "n_given", "_ours", "_changed")
    plain = {v: isinstance(sides.types[v], FIXED_WIDTH) for v in sides.values}

    def cells(side: DataFrame, ours: bool) -> DataFrame:
        found = []
        for i, v in enumerate(sides.values):
            found += [col(v).alias(f"_{i}_0")] if plain[v] else [row_digest(side, [v], seed).alias(f"_{i}_{seed}") for seed in (0, 1)]
        return side.select(*cols(sides.keys), F.lit(ours).alias("_ours"), *found)

    both = cells(sides.target, True).unionByName(cells(sides.given, False))
    ours = F.col("_ours")
    facts, changed = [], []
    for i, v in enumerate(sides.values):
        parts = range(1 if plain[v] else 2)
        for part in parts:
            cell = F.col(f"_{i}_{part}")
            facts.append(F.any_value(F.when(ours, cell), ignoreNulls=True).alias(f"_t_{i}_{part}"))
            facts.append(F.any_value(F.when(~ours, cell), ignoreNulls=True).alias(f"_g_{i}_{part}"))
        changed.append(reduce(Column.__or__, [~F.col(f"_t_{i}_{part}").eqNullSafe(F.col(f"_g_{i}_{part}")) for part in parts]))
    counts = (F.count_if(ours).alias("n_target"), F.count_if(~ours).alias("n_given"))
    judged = both.groupBy(*cols(sides.keys)).agg(*counts, *facts)
    return judged.select(*cols(sides.keys), "n_target", "n_given", F.array(*changed).cast("array<boolean>").alias("_changed"))


def _differs(sides: Sides, name: str) -> Column:
    ours, theirs = (comparable(F.col(row).getField(name), sides.types[name]) for row in ("target_row", "given_row"))
    return ~ours.eqNullSafe(theirs)


def rows_differ(sides: Sides) -> Column:
    """Whether the two rows of :func:`pair_sides` differ in any column."""
    if any(has_map(sides.types[v]) for v in sides.values):
        return reduce(Column.__or__, [_differs(sides, v) for v in sides.values])
    return ~F.col("target_row").eqNullSafe(F.col("given_row"))


def key_status(changed: Column) -> Column:
    """The status of a key, given whether its two rows differ if it has one on each side."""
    return (
        F.when(F.greatest("n_target", "n_given") > 1, "duplicate_key")
        .when(F.col("n_given") == 0, "missing_in_given")
        .when(F.col("n_target") == 0, "only_in_given")
        .when(changed, "changed")
        .otherwise("same")
    )


def _not_same(sides: Sides) -> Column:
    return (F.col("n_target") != 1) | (F.col("n_given") != 1) | rows_differ(sides)


def row_diff(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    primary_key: bool = False,
    include_same: bool = True,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: its ``status`` (see ``STATUSES``) and, if changed, the ``changed_cols``.

    Columns are compared null-safe, text and nested ones by 128-bit digests; those on one side only are not
    (``missing_columns`` reports them). With ``primary_key`` all are compared as they are.
    A key with several rows on a side is ``duplicate_key``: use :func:`bag_diff` for such tables.
    """
    sides = align(target, given, keys, values)
    reserve(sides.keys, "status", "changed_cols")
    found = compared_keys(sides, primary_key)
    one_each = (F.col("n_target") == 1) & (F.col("n_given") == 1)
    if not include_same:
        found = found.where(~one_each | F.array_contains("_changed", True))
    names = F.array(*[F.when(F.get("_changed", F.lit(i)), F.lit(v)) for i, v in enumerate(sides.values)]).cast("array<string>")
    nothing = F.array().cast("array<string>")
    told = found.withColumn("changed_cols", F.when(one_each, F.array_compact(names)).otherwise(nothing))
    return told.select(*cols(sides.keys), key_status(F.size("changed_cols") > 0).alias("status"), "changed_cols")


def status_counts(target: DataFrame, given: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """One row: rows on each side and keys of each status. No status is left out when it is zero."""
    sides = align(target, given, keys)
    found = compared_keys(sides, primary_key)
    judged = found.select("n_target", "n_given", key_status(F.array_contains("_changed", True)).alias("status"))
    return judged.agg(
        F.coalesce(F.sum("n_target"), F.lit(0)).alias("rows_target"),
        F.coalesce(F.sum("n_given"), F.lit(0)).alias("rows_given"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
    )


def conflicts(target: DataFrame, given: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """One row per differing cell of the keys on both sides: ``column``, ``target_value``, ``given_value`` as text.

    A key on both sides with several rows on one has no cells to pair: it comes as one row without a ``column``,
    its values being the numbers of rows. :func:`bag_diff` and :func:`change_log` tell which rows differ.
    """
    sides = align(target, given, keys)
    reserve(sides.keys, "column", "target_value", "given_value")
    if not sides.values:
        raise ValueError("the two sides share no columns besides the key")
    one_each = (F.col("n_target") == 1) & (F.col("n_given") == 1)
    repeated = (F.col("n_target") > 0) & (F.col("n_given") > 0) & ~one_each
    pairs = pair_sides(sides, primary_key).where(repeated | (one_each & rows_differ(sides)))
    n_rows = lambda n: F.concat(F.col(n).cast("string"), F.lit(" rows"))
    numbers = F.struct(F.lit(None).cast("string").alias("column"), n_rows("n_target").alias("target_value"), n_rows("n_given").alias("given_value"))
    cells = [F.when(repeated, numbers)] + [
        F.when(
            one_each & _differs(sides, v),
            F.struct(
                F.lit(v).alias("column"),
                cell_text(F.col("target_row").getField(v), sides.types[v]).alias("target_value"),
                cell_text(F.col("given_row").getField(v), sides.types[v]).alias("given_value"),
            ),
        )
        for v in sides.values
    ]
    return pairs.select(*cols(sides.keys), F.inline(F.array_compact(F.array(*cells))))


def change_log(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    primary_key: bool = False,
    ops: Sequence[str] = ("insert", "update", "delete"),
) -> DataFrame:
    """What makes given equal target, row by row: ``op``, the row ``before`` (given) and ``after`` (target).

    A key with several rows on a side has no single before and after: its surplus rows of given are
    deletes and its surplus rows of target inserts, each as often as it is surplus. So applying the log
    to given gives target whatever the keys. With some ``ops`` only, keys of target that given lacks are
    ``insert``, keys on both sides ``update`` and keys only given has ``delete``.
    """
    sides = align(target, given, keys)
    reserve(sides.keys, "op", "before", "after")
    pairs = pair_sides(sides, primary_key).where(_not_same(sides))
    single = paired_changes(sides, pairs.where(F.greatest("n_target", "n_given") <= 1)).where(F.col("op").isin(*ops))
    if primary_key:
        return single
    ours = sides.target.select(*cols(sides.keys), F.lit(1).alias("n_target"), F.lit(0).alias("n_given"))
    theirs = sides.given.select(*cols(sides.keys), F.lit(0).alias("n_target"), F.lit(1).alias("n_given"))
    counts = ours.unionByName(theirs).groupBy(*cols(sides.keys)).agg(F.sum("n_target").alias("n_target"), F.sum("n_given").alias("n_given"))
    return single.unionByName(surplus_rows(sides, counts.where(F.greatest("n_target", "n_given") > 1), ops))


def paired_changes(sides: Sides, pairs: DataFrame) -> DataFrame:
    """The log of keys with at most one row on each side, given those of :func:`pair_sides` that differ."""
    # The operation each status calls for.
    op = F.when(F.col("n_given") == 0, "insert").when(F.col("n_target") == 0, "delete").otherwise("update")
    return pairs.select(*cols(sides.keys), op.alias("op"), F.col("given_row").alias("before"), F.col("target_row").alias("after"))


def surplus_rows(sides: Sides, repeated: DataFrame, ops: Sequence[str]) -> DataFrame:
    """The log of the keys ``repeated`` (keys, n_target, n_given): rows that one side has more often than the other."""
    allowed = F.when(F.col("n_given") == 0, "insert").when(F.col("n_target") == 0, "delete").otherwise("update").isin(*ops)
    wanted = repeated.where(allowed)
    packed = F.struct(*cols(sides.values)) if sides.values else F.struct(F.lit(True).alias("present"))
    both = sides.target.select(*cols(sides.keys), packed.alias("_row"), F.lit(1).alias("_balance")).unionByName(
        sides.given.select(*cols(sides.keys), packed.alias("_row"), F.lit(-1).alias("_balance"))
    )
    rows = keep_by_key(both, wanted, sides.keys, "left_semi")
    forms = [comparable(F.col("_row").getField(v), sides.types[v]).alias(f"_form_{i}") for i, v in enumerate(sides.values)]
    counted = rows.groupBy(*cols(sides.keys), *forms).agg(F.sum("_balance").alias("_balance"), F.any_value("_row").alias("_row"))
    surplus = counted.where("_balance <> 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_balance"))))
    inserted = F.col("_balance") > 0
    return surplus.select(
        *cols(sides.keys),
        F.when(inserted, "insert").otherwise("delete").alias("op"),
        F.when(~inserted, F.col("_row")).alias("before"),
        F.when(inserted, F.col("_row")).alias("after"),
    )


def bag_diff(target: DataFrame, given: DataFrame) -> DataFrame:
    """Rows whose number differs between the sides, with ``n_target`` and ``n_given``. For tables without a key.

    Equal rows are counted per task before the shuffle on the whole row.
    """
    return bag_counts(target, given).where(F.col("n_target") != F.col("n_given"))


def bag_counts(target: DataFrame, given: DataFrame) -> DataFrame:
    """Every distinct row of either side with ``n_target`` and ``n_given``."""
    sides = align(target, given, target.columns)
    if len(given.columns) != len(sides.keys):
        extra = sorted({c.lower() for c in given.columns} - {c.lower() for c in sides.keys})
        raise ValueError(f"the given table has further columns {extra}; map the schema first")
    reserve(sides.keys, "n_target", "n_given")
    both = sides.target.select("*", F.lit(1).alias("n_target"), F.lit(0).alias("n_given")).unionByName(
        sides.given.select("*", F.lit(0).alias("n_target"), F.lit(1).alias("n_given"))
    )
    return both.groupBy(*cols(sides.keys)).agg(F.sum("n_target").alias("n_target"), F.sum("n_given").alias("n_given"))


def observed_nullability(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``n_rows`` and ``null_count``, in one pass over the table.

    Plain counts, so that a source able to answer them from its file footers does.
    """
    names = list(columns if columns is not None else df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(f"_n{i}") for i, c in enumerate(names)]
    )
    facts = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("n_rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            )
            for i, c in enumerate(names)
        ]
    )
    return counted.select(F.inline(facts))


__all__ = [
    "STATUSES",
    "bag_counts",
    "bag_diff",
    "change_log",
    "compared_keys",
    "conflicts",
    "key_status",
    "observed_nullability",
    "pair_sides",
    "paired_changes",
    "row_diff",
    "row_pairs",
    "rows_differ",
    "status_counts",
    "surplus_rows",
]
