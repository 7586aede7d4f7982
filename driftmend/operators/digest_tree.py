"""Digests of a table in nested buckets: kept, brought up to date from a change log, and compared from the root down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmend.functions.digest import key_bucket, row_digest
from driftmend.functions.frames import stacked
from driftmend.functions.names import col, cols, reserve, resolve
from driftmend.functions.sides import align
from driftmend.operators.rows import row_diff
from driftmend.sources.sinks import staged

SUMS = ("n_rows", "digest_1", "digest_2")
#: Bits of the number that a key's buckets are the leading bits of.
BITS = 30
BRANCH = "_branch"


def digest_tree(df: DataFrame, keys: Sequence[str], levels: Sequence[int] = (6, 16)) -> DataFrame:
    """One row per bucket that has rows, on every level: ``level``, ``bucket``, ``n_rows`` and two sums of row digests.

    A bucket of a level is the first so many bits of a hash of the key; level 0 is the root, with all rows. ``shape``
    (in the root only) names the columns and types and the levels, which trees must share to be compared or updated. The
    table is read once and its rows fold per task into at most as many sums as there are leaves. Keep the tree, written
    by ``level``: comparing it does not take the table.
    """
    levels = _checked(levels)
    keys = resolve(df, keys, "key column")
    leaves = staged(_folded(_hashed(df, keys, levels[-1], F.lit(1))), "leaves")
    rows = stacked([_on_level(leaves, levels, i) for i in range(len(levels) + 1)])
    root = df.sparkSession.range(1).select(F.lit(0).alias("level"), F.lit(0).cast("long").alias("bucket"), F.lit(_shape(df, keys, levels)).alias("_shape"))
    # The root is there for a table without rows too.
    return _summed(rows, root)


def update_tree(tree: DataFrame, log: DataFrame, keys: Sequence[str], levels: Sequence[int] = (6, 16)) -> DataFrame:
    """The tree of a table after the changes of ``log`` (a :func:`~driftmend.operators.rows.change_log`), without the table.

    Rows before are taken off and rows after added, so that the result is the tree built anew, whatever the keys.
    """
    levels = _checked(levels)
    keys = resolve(log, keys, "key column")
    deltas = []
    for side, sign in (("before", -1), ("after", 1)):
        rows = log.where(col(side).isNotNull()).select(*cols(keys), f"{side}.*")
        deltas.append(_hashed(rows, keys, levels[-1], F.lit(sign)))
    told = tree.where("level = 0").select("shape").first()
    if told is None or told.shape != _shape(rows, keys, levels):
        raise ValueError(f"the tree was built of {told and told.shape}; the log has {_shape(rows, keys, levels)}")
    leaves = staged(_folded(deltas[0].unionByName(deltas[1])), "leaves")
    changes = stacked([_on_level(leaves, levels, i) for i in range(len(levels) + 1)])
    root = tree.where("level = 0").select("level", "bucket", F.col("shape").alias("_shape"))
    return _summed(tree.select("level", "bucket", *SUMS).unionByName(changes), root)


def differing_leaves(target: DataFrame, given: DataFrame, levels: Sequence[int] = (6, 16)) -> DataFrame:
    """``bucket`` of the leaves in which two trees differ, found from the root down.

    On each level only the buckets below those that differ on the level above are read; where the roots agree
    nothing else is. A bucket differs if the number of its rows or either sum does.
    """
    levels = _checked(levels)
    shapes = [tree.where("level = 0").select("shape").first() for tree in (target, given)]
    if shapes[0] != shapes[1]:
        raise ValueError(f"the trees were built of unlike tables: {shapes[0]} and {shapes[1]}")
    differ: DataFrame | None = None
    for i in range(len(levels) + 1):
        ours, theirs = (_below(tree, i, levels, differ) for tree in (target, given))
        negated = theirs.select("bucket", *[(-F.col(c)).alias(c) for c in SUMS])
        balance = ours.select("bucket", *SUMS).unionByName(negated).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in SUMS])
        differ = staged(balance.where(" OR ".join(f"{c} <> 0" for c in SUMS)).select("bucket"), "differing")
        if differ.isEmpty():
            break
    return differ if i == len(levels) else differ.limit(0)


def save_branches(df: DataFrame, keys: Sequence[str], path: str, levels: Sequence[int] = (6, 16)) -> None:
    """Write a table with one folder per bucket of the first level, so that :func:`tree_diff` reads only those that differ."""
    levels = _checked(levels)
    reserve(df.columns, BRANCH)
    df.withColumn(BRANCH, _bucket(df, resolve(df, keys, "key column"), levels[0])).repartition(BRANCH).write.partitionBy(BRANCH).parquet(path)


def read_branches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tree_diff(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    trees: tuple[DataFrame, DataFrame],
    levels: Sequence[int] = (6, 16),
) -> DataFrame:
    """The rows :func:`~driftmend.operators.rows.row_diff` finds to differ, from tables and their kept ``trees``.

    Only rows of leaves that differ are compared. Of a table read by :func:`read_branches` only the folders with such leaves are
    read; their names, at most two to the bits of the first level, are known to the planner. Equal digests (128 bits and the
    number of rows of a leaf) are taken for equal rows.
    """
    levels = _checked(levels)
    leaves = differing_leaves(*trees, levels)
    shift = levels[-1] - levels[0]
    branches = [r[0] for r in leaves.select(F.shiftright("bucket", shift).cast("int")).distinct().collect()]

    def near(df: DataFrame) -> DataFrame:
        own = resolve(df, keys, "key column")
        if BRANCH in df.columns:
            df = df.where(F.col(BRANCH).isin(branches)).drop(BRANCH)
        return df.withColumn("_leaf", _bucket(df, own, levels[-1])).join(leaves.withColumnRenamed("bucket", "_leaf"), "_leaf", "left_semi").drop("_leaf")

    plain = [df.drop(BRANCH) if BRANCH in df.columns else df for df in (target, given)]
    sides = align(*plain, keys)
    for df, side in zip(plain, (sides.target, sides.given), strict=True):
        if any(df.schema[a].dataType != side.schema[b].dataType for a, b in zip(resolve(df, sides.keys), sides.keys, strict=True)):
            raise ValueError("the keys of the two sides have unlike types, and so unlike buckets; map the schema first")
    return row_diff(near(target), near(given), keys, include_same=False)


def _checked(levels: Sequence[int]) -> list[int]:
    levels = list(levels)
    if not levels or levels != sorted(set(levels)) or levels[0] < 1 or levels[-1] > BITS:
        raise ValueError(f"levels are rising numbers of bits from 1 to {BITS}, not {levels}")
    return levels


def _shape(df: DataFrame, keys: Sequence[str], levels: Sequence[int]) -> str:
    named = sorted((f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields)
    return f"{', '.join(f'{n} {t}' for n, t in named)} by {', '.join(k.lower() for k in keys)} in {', '.join(map(str, levels))} bits"


def _bucket(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    return F.shiftright(key_bucket(df, keys, 1 << BITS), BITS - bits)


def _hashed(df: DataFrame, keys: Sequence[str], bits: int, sign: Column) -> DataFrame:
    """(bucket, n_rows, digests) of each row; columns are taken in the order of their names."""
    names = sorted(df.columns, key=str.lower)
    digests = [(row_digest(df, names, seed).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias(f"digest_{seed}") for seed in (1, 2)]
    return df.select(_bucket(df, keys, bits).cast("long").alias("bucket"), sign.cast("long").alias("n_rows"), *digests)


def _folded(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in SUMS])


def _on_level(leaves: DataFrame, levels: Sequence[int], level: int) -> DataFrame:
    bits = levels[level - 1] if level else 0
    return leaves.select(F.lit(level).alias("level"), F.shiftright("bucket", levels[-1] - bits).alias("bucket"), *SUMS)


def _summed(rows: DataFrame, root: DataFrame) -> DataFrame:
    zero = root.select("level", "bucket", *[F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in SUMS], "_shape")
    every = rows.withColumn("_shape", F.lit(None).cast("string")).unionByName(zero)
    total = every.groupBy("level", "bucket").agg(*[F.sum(c).cast("long" if c == "n_rows" else "decimal(38,0)").alias(c) for c in SUMS], F.max("_shape").alias("shape"))
    # A bucket without rows has no row, but for the root.
    return total.where("level = 0 OR n_rows <> 0 OR digest_1 <> 0 OR digest_2 <> 0")


def _below(tree: DataFrame, level: int, levels: Sequence[int], above: DataFrame | None) -> DataFrame:
    """The rows of ``level`` below the buckets ``above`` that differ on the level before."""
    rows = tree.where(F.col("level") == level)
    if above is None or level == 1:
        return rows
    step = levels[level - 1] - levels[level - 2]
    parent = above.select(F.col("bucket").alias("_parent"))
    return rows.withColumn("_parent", F.shiftright("bucket", step)).join(parent, "_parent", "left_semi")
