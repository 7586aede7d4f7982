"""Digest trees: kept, updated from logs, compared from the root down."""

import random

import pytest

import driftmend as dm
from driftmend.operators import digest_tree as trees
from driftmend.sources.sinks import work_folder
from fixtures import GIVEN, KEYS, SCHEMA, TARGET

LEVELS = (2, 5, 9)


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def sides(spark, seed, n=300):
    pick = random.Random(seed)
    ours = [(i, pick.randrange(5), pick.choice("ab")) for i in range(n)]
    theirs = [(i, v, s if pick.random() > 0.01 else "c") for i, v, s in ours if pick.random() > 0.01] + [(n + i, 0, "z") for i in range(3)]
    return [spark.createDataFrame(r, "k int, v int, s string") for r in (ours, theirs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_full_comparison(spark, seed):
    target, given = sides(spark, seed)
    both = tuple(dm.digest_tree(df, ["k"], LEVELS) for df in (target, given))
    assert rows(dm.tree_diff(target, given, ["k"], both, LEVELS)) == rows(dm.row_diff(target, given, ["k"], include_same=False))


def test_any_number_of_changes(spark):
    target = spark.createDataFrame([(i, "x") for i in range(200)], "k int, s string")
    for given in (target, target.limit(0), target.selectExpr("k", "concat(s, 'y') AS s"), target.where("k <> 77")):
        both = tuple(dm.digest_tree(df, ["k"], LEVELS) for df in (target, given))
        assert rows(dm.tree_diff(target, given, ["k"], both, LEVELS)) == rows(dm.row_diff(target, given, ["k"], include_same=False))


def test_levels_add_up(spark):
    target, _ = sides(spark, 3)
    found = dm.digest_tree(target, ["k"], LEVELS).groupBy("level").sum("n_rows", "digest_1").collect()
    assert {r.level for r in found} == {0, 1, 2, 3} and len({(r[1], r[2]) for r in found}) == 1 and found[0][1] == 300


def test_an_updated_tree_is_one_built_anew(spark):
    """NULL and repeated keys, and rows that are NULL beyond their key."""
    target, given = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(GIVEN, SCHEMA)
    log = dm.change_log(target, given, KEYS)
    updated = dm.update_tree(dm.digest_tree(given, KEYS, LEVELS), log, KEYS, LEVELS)
    assert rows(updated) == rows(dm.digest_tree(target, KEYS, LEVELS))
    emptied = dm.update_tree(dm.digest_tree(given, KEYS, LEVELS), dm.change_log(given.limit(0), given, KEYS), KEYS, LEVELS)
    assert rows(emptied) == rows(dm.digest_tree(given.limit(0), KEYS, LEVELS)) and emptied.count() == 1


def test_only_differing_branches_are_read(spark):
    target = spark.createDataFrame([(i, "x") for i in range(400)], "k int, s string")
    given = target.selectExpr("k", "CASE WHEN k = 123 THEN 'y' ELSE s END AS s")
    folder = work_folder(spark, "branches")
    for name, df in (("ours", target), ("theirs", given)):
        dm.save_branches(df, ["k"], f"{folder}/{name}", LEVELS)
        dm.digest_tree(df, ["k"], LEVELS).write.partitionBy("level").parquet(f"{folder}/{name}-tree")
    ours, theirs = (dm.read_branches(spark, f"{folder}/{name}") for name in ("ours", "theirs"))
    both = tuple(spark.read.parquet(f"{folder}/{name}-tree") for name in ("ours", "theirs"))
    found = dm.tree_diff(ours, theirs, ["k"], both, LEVELS)
    assert [(r.k, r.status, r.changed_cols) for r in found.collect()] == [(123, "changed", ["s"])]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(_branch") + plan.count("PartitionFilters: [(_branch") >= 2
    read = ours.where(f"_branch = {ours.where('k = 123').first()[trees.BRANCH]}").count()
    assert 0 < read < 200


def test_descends_into_differing_buckets_only(spark, monkeypatch):
    """Below a level on which one bucket differs, the rows of its children are all that is compared."""
    target = spark.createDataFrame([(i, "x") for i in range(400)], "k int, s string")
    given = target.where("k <> 5")
    both = [dm.digest_tree(df, ["k"], LEVELS) for df in (target, given)]
    seen = []
    below = trees._below
    monkeypatch.setattr(trees, "_below", lambda *a: seen.append((a[1], below(*a).count())) or below(*a))
    assert trees.differing_leaves(*both, LEVELS).count() == 1
    widths = {level: n for level, n in seen}
    assert widths[0] == 1 and widths[1] <= 4 and widths[2] <= 8 and widths[3] <= 16
    seen.clear()
    assert trees.differing_leaves(both[0], both[0], LEVELS).isEmpty() and {level for level, _ in seen} == {0}


def test_unlike_trees_are_refused(spark):
    target, _ = sides(spark, 4, 10)
    one, other = dm.digest_tree(target, ["k"], LEVELS), dm.digest_tree(target.selectExpr("k", "cast(v AS long) AS v", "s"), ["k"], LEVELS)
    with pytest.raises(ValueError, match="unlike tables"):
        dm.tree_diff(target, target, ["k"], (one, other), LEVELS)
    with pytest.raises(ValueError, match="the tree was built of"):
        dm.update_tree(one, dm.change_log(target.drop("s"), target.drop("s"), ["k"]), ["k"], LEVELS)
    with pytest.raises(ValueError, match="levels"):
        dm.digest_tree(target, ["k"], (5, 2))
