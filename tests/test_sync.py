import datetime

import pytest
from pyspark.sql import types as T

import driftmend as dm
from fixtures import GIVEN, KEYS, SCHEMA, TARGET, bag, by_key

UNIQUE_TARGET = [r for r in TARGET if r[0] != "twice"]
UNIQUE_GIVEN = [r for r in GIVEN if r[0] not in ("twice", "extra")] + [("extra", "e", 11, "z")]


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(GIVEN, SCHEMA)


@pytest.fixture(scope="module")
def unique(spark):
    return spark.createDataFrame(UNIQUE_TARGET, SCHEMA), spark.createDataFrame(UNIQUE_GIVEN, SCHEMA)


def rows(df):
    return bag(tuple(r) for r in df.collect())


def union(first, second):
    """All of ``first`` and those of ``second`` whose key it has not."""
    known = by_key(first)
    return bag([*first, *[r for r in second if r[:2] not in known]])


def test_modes(sides):
    target, given = sides
    assert rows(dm.sync(target, given, KEYS)) == union(GIVEN, TARGET)
    assert rows(dm.sync(target, given, KEYS, "upsert")) == union(TARGET, GIVEN)
    assert rows(dm.sync(target, given, KEYS, "mirror")) == bag(TARGET)
    with pytest.raises(ValueError, match="mode"):
        dm.sync(target, given, KEYS, "merge")


def test_laws_of_sync(sides):
    target, given = sides
    inserted = dm.sync(target, given, KEYS)
    assert dm.missing_keys(target, inserted, KEYS).isEmpty()
    assert rows(dm.sync(target, inserted, KEYS)) == rows(inserted)
    upserted = dm.sync(target, given, KEYS, "upsert")
    assert not {"missing_in_given", "changed"} & {r["status"] for r in dm.row_diff(target, upserted, KEYS).collect()}
    assert rows(dm.sync(target, upserted, KEYS, "upsert")) == rows(upserted)


def test_empty_sides(sides, spark):
    target, given = sides
    nothing = spark.createDataFrame([], SCHEMA)
    assert rows(dm.sync(target, nothing, KEYS)) == bag(TARGET)
    assert rows(dm.sync(nothing, given, KEYS, "upsert")) == bag(GIVEN)
    assert dm.rows_to_insert(nothing, given, KEYS).isEmpty()
    assert rows(dm.rows_to_delete(nothing, given, KEYS)) == bag(GIVEN)


def test_unlike_tables_are_refused(sides):
    target, given = sides
    with pytest.raises(ValueError, match=r"only in target \['s'\]"):
        dm.sync(target, given.drop("s"), KEYS)
    with pytest.raises(ValueError, match="column n is int in target and string in given"):
        dm.sync(target, given.selectExpr("k1", "k2", "cast(n as string) n", "s"), KEYS)


@pytest.mark.parametrize("mode", ["insert_missing", "upsert", "mirror"])
def test_run_sync_writes_state_and_changes(sides, unique, spark, tmp_path, mode):
    for name, (target, given) in {"repeated": sides, "unique": unique}.items():
        out = str(tmp_path / name)
        run = dm.run_sync(target, given, KEYS, out, mode)
        assert rows(spark.read.parquet(run.state)) == rows(dm.sync(target, given, KEYS, mode))
        wanted = {"insert_missing": ("insert",), "upsert": ("insert", "update"), "mirror": ("insert", "update", "delete")}
        expected = dm.change_log(target, given, KEYS, ops=wanted[mode]).collect()
        assert sorted(map(repr, spark.read.parquet(run.changes).collect())) == sorted(map(repr, expected))
        assert not run.primary_key  # the target has keys with a NULL part


def test_run_sync_on_a_proven_key(spark, tmp_path):
    target, given = spark.range(0, 100).selectExpr("id", "id % 7 as v"), spark.range(50, 120).selectExpr("id", "id % 5 as v")
    run = dm.run_sync(target, given, ["id"], str(tmp_path / "out"), "upsert")
    assert run.primary_key
    assert rows(spark.read.parquet(run.state)) == rows(dm.sync(target, given, ["id"], "upsert"))


def test_merge_policies_on_unique_keys(unique):
    target, given = unique
    ours, theirs = by_key(UNIQUE_TARGET), by_key(UNIQUE_GIVEN)
    both = set(ours) & set(theirs)

    def settled(pick):
        return bag(pick(ours[k][0], theirs[k][0]) if k in both else (ours.get(k) or theirs.get(k))[0] for k in {*ours, *theirs})

    def latest(t, g):
        if g[2] is None:
            return t
        return g if t[2] is None or g[2] > t[2] else t

    def filled(t, g):
        return tuple(a if a is not None else b for a, b in zip(t, g, strict=True))

    for policy, pick in {
        "target_wins": lambda t, g: t,
        "given_wins": lambda t, g: g,
        "latest": latest,
        "fill_nulls": filled,
    }.items():
        for a, b, choose in ((target, given, pick), (given, target, lambda t, g, pick=pick: pick(g, t))):
            merged = dm.merge_bidirectional(a, b, KEYS, policy, version="n")
            if a is target:
                assert rows(merged) == settled(choose), policy
            keys = {tuple(r) for r in merged.select(*KEYS).collect()}
            assert keys == {*ours, *theirs}


def test_merge_on_a_proven_key_agrees(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", None), (4, None, None)], "k int, s string, v int")
    given = spark.createDataFrame([(2, "b", 5), (3, "x", None), (4, "d", 4), (5, "e", 5)], "k int, s string, v int")
    for policy in ("target_wins", "given_wins", "latest", "fill_nulls"):
        ways = [rows(dm.merge_bidirectional(target, given, ["k"], policy, "v", primary_key=p)) for p in (False, True)]
        assert ways[0] == ways[1], policy
    assert ways[0] == bag([(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", 4), (5, "e", 5)])


def test_merge_keeps_every_row_of_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, None, 1), (2, "q", 2)], "k int, s string, v int")
    given = spark.createDataFrame([(1, "x", 2), (1, "y", 2), (2, "n", 9), (2, "m", 0), (3, "z", 0), (3, "z", 0)], "k int, s string, v int")
    latest = rows(dm.merge_bidirectional(target, given, ["k"], "latest", version="v"))
    assert latest == bag([(1, "a", 3), (1, "b", 1), (2, "n", 9), (2, "m", 0), (3, "z", 0), (3, "z", 0)])
    filled = rows(dm.merge_bidirectional(target, given, ["k"], "fill_nulls"))
    assert filled == bag([(1, "a", 3), (1, "b", 1), (2, "m", 1), (2, "q", 2), (3, "z", 0), (3, "z", 0)])


def test_merge_arguments(unique):
    target, given = unique
    with pytest.raises(ValueError, match="version"):
        dm.merge_bidirectional(target, given, KEYS, "latest")
    with pytest.raises(ValueError, match="policy"):
        dm.merge_bidirectional(target, given, KEYS, "newest")


def at(day):
    return datetime.datetime(2024, 1, day)


EVENTS = "id int, ts timestamp_ntz, v string"
SOURCE = [(1, at(1), "a"), (2, at(5), "b"), (3, at(9), "late"), (4, at(10), "tie"), (5, at(11), "new"), (6, None, "untimed")]
SEEN = [(1, at(1), "a"), (2, at(10), "moved")]


def test_incremental_sync(spark):
    target, given = spark.createDataFrame(SOURCE, EVENTS), spark.createDataFrame(SEEN, EVENTS)
    assert rows(dm.incremental_sync(target, given, ["id"], "ts")) == bag([*SEEN, SOURCE[3], SOURCE[4]])
    day = datetime.timedelta(days=1)
    assert rows(dm.incremental_sync(target, given, ["id"], "TS", day)) == bag([*SEEN, *SOURCE[2:5]])
    upserted = rows(dm.incremental_sync(target, given, ["id"], "ts", datetime.timedelta(days=5), mode="upsert"))
    assert upserted == bag([SEEN[0], *SOURCE[1:5]])


def test_incremental_sync_into_an_empty_table_copies_everything(spark):
    target, given = spark.createDataFrame(SOURCE, EVENTS), spark.createDataFrame([], EVENTS)
    assert rows(dm.incremental_sync(target, given, ["id"], "ts", datetime.timedelta(days=1))) == bag(SOURCE)
    assert rows(dm.incremental_sync(target, given, ["id"], "ts", fixed_progress=True)) == bag(SOURCE)


def test_incremental_sync_by_number(spark):
    target, given = spark.range(10).selectExpr("id", "id * 10 as seq"), spark.range(5).selectExpr("id", "id * 10 as seq")
    assert dm.incremental_sync(target, given, ["id"], "seq").count() == 10
    assert dm.sync_candidates(target, given, "seq", 20).count() == 8


def test_the_mark_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(SOURCE, EVENTS).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = dm.sync_candidates(target, spark.createDataFrame(SEEN, EVENTS), "ts")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_without_a_mark_nothing_is_left_out(spark):
    early = [(1, datetime.date(1, 1, 1), "a"), (2, None, "b")]
    target = spark.createDataFrame(early, "id int, d date, v string").unionAll(spark.sql("select 3, date'-0044-03-15', 'old'"))
    given = spark.createDataFrame([], "id int, d date, v string")
    assert dm.incremental_sync(target, given, ["id"], "d").count() == 3
    words = spark.createDataFrame([(1, "a"), (2, "b")], "id int, w string")
    assert dm.incremental_sync(words, words.limit(0), ["id"], "w").count() == 2
    assert dm.incremental_sync(words, words.where("id = 1"), ["id"], "w").count() == 2


def test_incremental_upsert_with_fixed_progress(spark):
    target, given = spark.createDataFrame(SOURCE, EVENTS), spark.createDataFrame([*SEEN, (9, None, "x")], EVENTS)
    for fixed in (False, True):
        found = rows(dm.incremental_sync(target, given, ["id"], "ts", datetime.timedelta(days=1), mode="upsert", fixed_progress=fixed))
        # Key 2 moved its progress, so only a full comparison finds it.
        assert found == bag([SEEN[0], SEEN[1], (9, None, "x"), *SOURCE[2:5]])


def test_a_small_increment_does_not_shuffle_given(spark, tmp_path):
    for name, df in (("t", spark.range(100_000)), ("g", spark.range(99_990))):
        df.selectExpr("id", "id as seq", "uuid() as v").write.parquet(str(tmp_path / name))
    target, given = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "g"))
    result = dm.incremental_sync(target, given, ["id"], "seq", 5, mode="upsert")
    assert result.count() == 100_000
    result.write.format("noop").mode("overwrite").save()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_map_schema(spark):
    df = spark.createDataFrame([("1", 1.5, True, "x"), ("one", 2.5, None, "y"), (None, 3.5, False, "z")], "ID string, Price double, ok boolean, more string")
    wanted = spark.createDataFrame([], "id int, amount decimal(10,1), ok boolean, kind string, note string").schema
    mapped, loss = dm.map_schema(df, wanted, renames={"price": "amount"}, defaults={"KIND": "k"})
    assert mapped.schema.simpleString() == wanted.simpleString()
    assert [(r["id"], float(r["amount"]), r["ok"], r["kind"], r["note"]) for r in mapped.collect()] == [
        (1, 1.5, True, "k", None),
        (None, 2.5, None, "k", None),
        (None, 3.5, False, "k", None),
    ]
    assert {r["column"]: (r["n_values"], r["n_lost"]) for r in loss.collect()} == {"id": (2, 1), "amount": (3, 0), "ok": (2, 0)}
    numbers = spark.createDataFrame([(1.9, 2.0), (-0.5, 3.0)], "a double, b double")
    whole = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert {r["column"]: r["n_changed"] for r in dm.map_schema(numbers, whole)[1].collect()} == {"a": 2, "b": 0}
    with pytest.raises(ValueError, match="both become"):
        dm.map_schema(df, wanted, renames={"more": "id"})


def test_drifted_tables_sync_after_mapping(spark):
    target = spark.createDataFrame([(1, "5"), (2, "6")], "ID bigint, v string")
    given = spark.createDataFrame([(1, 5)], "id int, v int")
    mapped, _ = dm.map_schema(target, given.schema)
    assert rows(dm.sync(mapped, given, ["id"])) == bag([(1, 5), (2, 6)])
