import pytest

import driftmend as dm
from fixtures import GIVEN, KEYS, SCHEMA, TARGET, by_key


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(GIVEN, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_keys_compares_typed_parts_null_safe(sides):
    target, given = sides
    ours, theirs = by_key(TARGET), by_key(GIVEN)
    assert rows(dm.missing_keys(target, given, KEYS)) == sorted(set(ours) - set(theirs), key=repr)
    assert rows(dm.missing_keys(given, target, KEYS)) == sorted(set(theirs) - set(ours), key=repr)


def test_missing_keys_plus_common_keys_is_target(sides):
    target, given = sides
    presence = dm.key_presence(target, given, KEYS)
    common = presence.where("n_target > 0 and n_given > 0").count()
    distinct = target.select(*KEYS).distinct().count()
    assert dm.unsynced_count(target, given, KEYS).first()["unsynced"] + common == distinct


def test_nothing_is_missing_from_itself_or_for_an_empty_target(sides, spark):
    target, given = sides
    nothing = spark.createDataFrame([], SCHEMA)
    assert dm.missing_keys(target, target, KEYS).isEmpty()
    assert dm.missing_keys(nothing, given, KEYS).isEmpty()
    assert dm.missing_keys(target, nothing, KEYS).count() == len(by_key(TARGET))


def test_key_names_match_ignoring_case_and_types_widen(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "Id bigint, v string")
    given = spark.createDataFrame([(2, "b")], "ID int, v string")
    assert rows(dm.missing_keys(target, given, ["id"])) == [(1,)]


def test_unlike_key_types_and_absent_keys_are_refused(spark):
    target = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError, match="no lossless common type"):
        dm.missing_keys(target, spark.createDataFrame([("1",)], "id string"), ["id"])
    with pytest.raises(ValueError, match="'nope'"):
        dm.missing_keys(target, target, ["nope"])


def test_column_names_with_dots(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "`my.key` int, `a``b` string")
    given = spark.createDataFrame([(1, "x")], "`my.key` int, `a``b` string")
    assert rows(dm.missing_keys(target, given, ["my.key"])) == [(2,)]
    diff = {r[0]: (r["status"], r["changed_cols"]) for r in dm.row_diff(target, given, ["my.key"]).collect()}
    assert diff == {1: ("changed", ["a`b"]), 2: ("missing_in_given", [])}


def test_key_profile(sides):
    target, _ = sides
    assert dm.key_profile(target, KEYS).first().asDict() == {
        "rows": 11,
        "distinct_keys": 10,
        "duplicate_keys": 1,
        "duplicate_rows": 2,
        "null_key_rows": 2,
    }
    estimate = dm.key_profile(target, KEYS, approximate=True).first()
    assert (estimate["rows"], estimate["distinct_keys"], estimate["null_key_rows"]) == (11, 10, 2)


def test_key_profile_of_an_empty_table(spark):
    profile = dm.key_profile(spark.createDataFrame([], SCHEMA), KEYS).first()
    assert list(profile) == [0, 0, 0, 0, 0]


def test_primary_key_holds(sides, spark):
    target, given = sides
    assert not dm.primary_key_holds(target, given, KEYS).first()["holds"]
    unique = spark.createDataFrame([("a", "b"), ("a", "c")], "k1 string, k2 string")
    assert dm.primary_key_holds(unique, unique, KEYS).first()["holds"]
    with_null = spark.createDataFrame([("a", None)], "k1 string, k2 string")
    assert not dm.primary_key_holds(unique, with_null, KEYS).first()["holds"]


def test_orphans_follow_match_simple(spark):
    child = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 2), (3, None, 1), (4, "z", None), (5, "z", 9), (6, "z", 9)], "id int, p string, q int"
    )
    parent = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 2)], "x string, y bigint")
    assert rows(dm.orphan_rows(child, parent, ["p", "q"], ["x", "y"])) == [(2, "a", 2), (5, "z", 9), (6, "z", 9)]
    assert rows(dm.orphan_keys(child, parent, ["p", "q"], ["x", "y"])) == [("a", 2, 1), ("z", 9, 2)]


def test_scan_keys_reads_key_columns_only(spark, tmp_path):
    spark.createDataFrame(TARGET, SCHEMA).write.parquet(str(tmp_path / "t"))
    plan = dm.scan_keys(spark.read.parquet(str(tmp_path / "t")), ["K1"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<k1:string>" in plan


def test_references_found_in_the_data(spark):
    tables = {
        "p": spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 1.0)], "id int, code string, x double"),
        "c": spark.createDataFrame([(10, 1, "a", 7), (11, 1, None, 1), (12, 3, "b", None), (13, None, "a", 2)], "`c.id` long, p short, code string, other int"),
        "e": spark.createDataFrame([], "id int"),
    }
    space = dm.Namespace("main", tables)
    found = {tuple(r) for r in dm.propose_references(space).collect()}
    assert found == {("c", "p", "p", "id", 2), ("c", "code", "p", "code", 2)}
    assert {tuple(r) for r in dm.key_columns(space).collect()} == {("p", "id", 3), ("p", "code", 3), ("c", "c.id", 4)}
    assert {tuple(r)[:4] for r in dm.propose_references(space, {"p": ["ID"], "c": ["p", "other"]}).collect()} == {("c", "p", "p", "id")}
