"""Comparing digests of key buckets first, and only the rows of differing buckets in full."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.functions.digest import key_bucket, row_digest
from driftmend.functions.names import cols, reserve, resolve
from driftmend.functions.sides import Sides, align
from driftmend.operators.rows import key_status, row_diff


def bucket_digest(df: DataFrame, keys: Sequence[str], n: int = 1 << 16) -> DataFrame:
    """At most ``n`` rows: ``bucket``, its ``n_rows`` and two sums of 64-bit row digests.

    Sums, so that rows are counted with their multiplicity and folded per task before the shuffle,
    whatever share of the rows one bucket holds; as decimals, so that they cannot overflow. The
    result is small enough to keep, for comparing a side later without reading it again.
    """
    _check(n)
    keys = resolve(df, keys, "key column")
    hashed = df.select(
        key_bucket(df, keys, n).alias("bucket"),
        row_digest(df, df.columns, 1).alias("_first"),
        row_digest(df, df.columns, 2).alias("_second"),
    )
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("_first").cast("decimal(38,0)")).alias("digest_1"),
        F.sum(F.col("_second").cast("decimal(38,0)")).alias("digest_2"),
    )


def differing_buckets(target: DataFrame, given: DataFrame) -> DataFrame:
    """Buckets whose digests differ, from two :func:`bucket_digest` results of the same columns and ``n``."""
    sums = ("n_rows", "digest_1", "digest_2")
    negated = given.select("bucket", *[(-F.col(c)).alias(c) for c in sums])
    balance = target.select("bucket", *sums).unionByName(negated).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums])
    unequal = (F.col("n_rows") != 0) | (F.col("digest_1") != 0) | (F.col("digest_2") != 0)
    return balance.where(unequal).select("bucket")


def bucket_diff(
    target: DataFrame, given: DataFrame, keys: Sequence[str], n: int = 1 << 16, primary_key: bool = False
) -> DataFrame:
    """The rows :func:`~driftmend.operators.rows.row_diff` finds to differ, shuffling only rows of differing buckets.

    The digests of each side shrink to ``n`` rows before they are shuffled; the list of differing
    buckets has at most ``n`` numbers, and where it turns out small it is broadcast to filter both tables
    where they are read. Worth it when few buckets differ; size ``n`` so that a bucket has some thousand rows. Equal digests (128 bits and a row count) are taken for equal rows.
    """
    _check(n)
    sides = align(target, given, keys)
    digests = [bucket_digest(side, sides.keys, n) for side in (sides.target, sides.given)]
    differ = differing_buckets(*digests)
    ours, theirs = (_in_buckets(sides, side, differ, n) for side in (sides.target, sides.given))
    return row_diff(ours, theirs, sides.keys, primary_key=primary_key, include_same=False)


def digest_diff(target: DataFrame, given: DataFrame, keys: Sequence[str], include_same: bool = False) -> DataFrame:
    """One row per key with its ``status`` as in :func:`~driftmend.operators.rows.row_diff`, comparing row digests.

    Whole rows are read but only keys and two 64-bit digests are shuffled, through one hash aggregation
    of numbers: for wide rows, such as documents, a small part of what comparing them takes. Equal digests
    (128 bits) are taken for equal rows; ``row_diff`` on the keys found tells which columns changed.
    """
    sides = align(target, given, keys)
    reserve(sides.keys, "status")

    def hashed(side: DataFrame, ours: bool) -> DataFrame:
        digests = [row_digest(side, sides.values, seed).alias(f"_digest_{seed}") for seed in (1, 2)]
        return side.select(*cols(sides.keys), F.lit(ours).alias("_ours"), *digests)

    both = hashed(sides.target, True).unionByName(hashed(sides.given, False))
    ours = F.col("_ours")
    compared = both.groupBy(*cols(sides.keys)).agg(
        F.count_if(ours).alias("n_target"),
        F.count_if(~ours).alias("n_given"),
        *[
            (F.min(f"_digest_{seed}") != F.max(f"_digest_{seed}")).alias(f"_differs_{seed}")
            for seed in (1, 2)
        ],
    )
    judged = compared.select(
        *cols(sides.keys), key_status(F.col("_differs_1") | F.col("_differs_2")).alias("status")
    )
    return judged if include_same else judged.where(F.col("status") != "same")


def _in_buckets(sides: Sides, side: DataFrame, buckets: DataFrame, n: int) -> DataFrame:
    keyed = side.withColumn("_bucket", key_bucket(side, sides.keys, n))
    return keyed.join(buckets.withColumnRenamed("bucket", "_bucket"), on="_bucket", how="left_semi").drop("_bucket")


def _check(n: int) -> None:
    if n < 1:
        raise ValueError(f"the number of buckets is at least 1, not {n}")
