"""One key holding a third of all rows must neither multiply rows nor end up whole in one task."""

import pytest
from pyspark.sql import functions as F

import driftmend as dm

ROWS = 300_000
HOT = 100_000


@pytest.fixture(scope="module")
def sides(spark):
    key = F.when(F.col("id") < HOT, F.lit(-1)).otherwise(F.col("id"))
    target = spark.range(ROWS).select(key.alias("k"), F.col("id").alias("v"))
    given = spark.range(ROWS).where("id % 10 != 3 or id < 1000").select(key.alias("k"), (F.col("id") * 2).alias("v"))
    return target, given


@pytest.fixture(scope="module")
def counts():
    tail = ROWS - HOT
    return {"tail": tail, "missing": tail // 10, "hot_given": HOT - (HOT - 1000) // 10}


def test_pairs_of_a_hot_key_are_never_formed(sides, counts):
    target, given = sides
    found = dm.status_counts(target, given, ["k"]).first()
    assert (found["duplicate_key"], found["missing_in_given"]) == (1, counts["missing"])
    assert found["changed"] == counts["tail"] - counts["missing"]
    assert (found["rows_target"], found["rows_given"]) == (ROWS, counts["tail"] - counts["missing"] + counts["hot_given"])
    log = dm.change_log(target, given, ["k"]).where("k = -1").groupBy("op").count().collect()
    values = set(range(HOT)), {2 * i for i in range(HOT) if i % 10 != 3 or i < 1000}
    assert {r["op"]: r["count"] for r in log} == {"insert": len(values[0] - values[1]), "delete": len(values[1] - values[0])}


def test_syncs_keep_every_row_of_a_hot_key(sides, counts):
    target, given = sides
    n_given = counts["tail"] - counts["missing"] + counts["hot_given"]
    assert dm.sync(target, given, ["k"]).count() == n_given + counts["missing"]
    assert dm.sync(target, given, ["k"], "upsert").count() == ROWS
    without = given.where("k >= 0")
    assert dm.sync(target, without, ["k"]).count() == without.count() + HOT + counts["missing"]
    assert dm.merge_bidirectional(target, given, ["k"], "latest", version="v").where("k = -1").count() == counts["hot_given"]
    assert dm.merge_bidirectional(target, given, ["k"], "fill_nulls").where("k = -1").count() == HOT


def test_hot_null_keys(spark, sides):
    target, given = (side.select(F.when(F.col("k") >= 0, F.col("k")).alias("k"), "v") for side in sides)
    assert dm.missing_keys(target, given, ["k"]).where("k is null").isEmpty()
    assert dm.sync(target, given.where("k is not null"), ["k"]).where("k is null").count() == HOT


def test_hot_references(spark, sides):
    target, _ = sides
    parent = target.where("k >= 0").select(F.col("k").alias("id"))
    repeated = parent.unionAll(spark.range(HOT).select(F.lit(ROWS - 1).cast("long").alias("id")))
    assert dm.orphan_rows(target, repeated, ["k"], ["id"]).count() == HOT
    assert [tuple(r) for r in dm.orphan_keys(target, repeated, ["k"], ["id"]).collect()] == [(-1, HOT)]


def test_rows_of_a_hot_key_fold_before_the_shuffle(sides):
    target, given = sides
    for result in (
        dm.missing_keys(target, given, ["k"]),
        dm.key_profile(target, ["k"]),
        dm.row_diff(target, given, ["k"]),
        dm.bag_diff(target, given),
        dm.bucket_digest(target, ["k"], 16),
        dm.orphan_keys(target, given, ["k"], ["k"]),
    ):
        plan = result._jdf.queryExecution().executedPlan().toString()
        below = plan.rsplit("Exchange hashpartitioning", 1)[1]
        assert "Aggregate" in below


def test_a_hot_bucket(sides):
    target, given = sides
    found = dm.bucket_diff(target, given, ["k"], n=4).groupBy("status").count().collect()
    expected = dm.row_diff(target, given, ["k"], include_same=False).groupBy("status").count().collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_adaptive_execution_splits_the_rows_of_a_hot_key(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    wide = F.sha2(F.col("id").cast("string"), 256).alias("s")
    spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.col("id").alias("v"), wide).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    given = target.where("k % 5 != 4 and k <> -1")
    blanked = target.withColumn("s", F.when(F.col("v") % 2 == 0, F.col("s")))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for result in (
            dm.rows_to_insert(target, given, ["k"]),
            dm.orphan_rows(target, given, ["k"], ["k"]),
            dm.merge_bidirectional(blanked, target, ["k"], "fill_nulls"),
        ):
            result.collect()
            assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
