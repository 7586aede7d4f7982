import pytest

import driftmend as dm
from fixtures import GIVEN, KEYS, SCHEMA, TARGET, bag, statuses


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(GIVEN, SCHEMA)


def test_row_diff_agrees_with_brute_force(sides):
    target, given = sides
    found = {(r["k1"], r["k2"]): (r["status"], tuple(r["changed_cols"])) for r in dm.row_diff(target, given, KEYS).collect()}
    assert found == statuses(TARGET, GIVEN)
    back = {(r["k1"], r["k2"]): r["status"] for r in dm.row_diff(given, target, KEYS).collect()}
    assert back == {key: status for key, (status, _) in statuses(GIVEN, TARGET).items()}


def test_row_diff_without_same_and_of_a_table_with_itself(sides):
    target, given = sides
    expected = {k: v for k, v in statuses(TARGET, GIVEN).items() if v[0] != "same"}
    found = dm.row_diff(target, given, KEYS, include_same=False).collect()
    assert {(r["k1"], r["k2"]): (r["status"], tuple(r["changed_cols"])) for r in found} == expected
    itself = {r["status"] for r in dm.row_diff(target, target, KEYS).collect()}
    assert itself == {"same", "duplicate_key"}


def test_join_and_aggregation_agree_on_a_proven_key(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", float("nan")), (3, None, 0.0), (4, None, None)], "k int, s string, d double")
    given = spark.createDataFrame([(1, "a", 1.0), (2, "b", float("nan")), (3, None, -0.0), (5, None, None)], "k int, s string, d double")
    for primary_key in (False, True):
        found = {r["k"]: r["status"] for r in dm.row_diff(target, given, ["k"], primary_key=primary_key).collect()}
        assert found == {1: "same", 2: "same", 3: "same", 4: "missing_in_given", 5: "only_in_given"}


def test_status_counts_agree_with_row_diff(sides):
    target, given = sides
    counts = dm.status_counts(target, given, KEYS).first().asDict()
    assert (counts.pop("rows_target"), counts.pop("rows_given")) == (len(TARGET), len(GIVEN))
    expected = bag((status,) for status, _ in statuses(TARGET, GIVEN).values())
    assert counts == {s: expected.get((s,), 0) for s in counts}


def test_status_counts_of_empty_sides(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert set(dm.status_counts(nothing, nothing, KEYS).first()) == {0}


def test_conflicts_are_the_differing_cells(sides):
    target, given = sides
    found = {tuple(r) for r in dm.conflicts(target, given, KEYS).collect()}
    cells = {r for r in found if r[2] is not None}
    assert cells == {("changed", "c", "s", "old", "new"), ("nulled", "n", "n", "8", None)}
    assert {r[:2] for r in found - cells} <= {k for k, (s, _) in statuses(TARGET, GIVEN).items() if s == "duplicate_key"}


def applied(log, given):
    """Given after its deletes and updates took rows away and its inserts and updates brought rows."""
    state = bag(given)
    for r in log:
        key = (r["k1"], r["k2"])
        for row, change in ((r["before"], -1), (r["after"], 1)):
            if row is not None:
                state[(*key, *row)] = state.get((*key, *row), 0) + change
    assert all(n >= 0 for n in state.values())
    return {row: n for row, n in state.items() if n}


def test_change_log_turns_given_into_target(sides):
    target, given = sides
    log = dm.change_log(target, given, KEYS).collect()
    assert applied(log, GIVEN) == bag(TARGET)
    ops = {(r["k1"], r["k2"]): r["op"] for r in log}
    meaning = {"missing_in_given": "insert", "only_in_given": "delete", "changed": "update"}
    single = {k: meaning[s] for k, (s, _) in statuses(TARGET, GIVEN).items() if s in meaning}
    assert {k: ops[k] for k in single} == single
    update = next(r for r in log if r["op"] == "update" and r["k1"] == "changed")
    assert (update["before"]["s"], update["after"]["s"]) == ("new", "old")
    blank = next(r for r in log if r["k1"] == "blank")
    assert blank["before"] is None and blank["after"].asDict() == {"n": None, "s": None}
    assert {r["op"] for r in dm.change_log(target, given, KEYS, ops=("insert",)).collect()} == {"insert"}


def test_a_log_of_equal_sides_is_empty(sides):
    target, _ = sides
    assert dm.change_log(target, target, KEYS).isEmpty()


def test_log_of_repeated_keys_counts_copies(spark):
    target = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (1, None), (2, {"b": 2}), (2, {"b": 2})], "k int, v map<string,int>")
    given = spark.createDataFrame([(1, {"a": 1}), (1, {"c": 3}), (3, None), (3, None)], "k int, v map<string,int>")
    found = sorted((r.k, r.op, str(r.before), str(r.after)) for r in dm.change_log(target, given, ["k"]).collect())
    row = lambda v: f"Row(v={v})"
    assert found == sorted([
        (1, "insert", "None", row({"a": 1})), (1, "insert", "None", row(None)), (1, "delete", row({"c": 3}), "None"),
        (2, "insert", "None", row({"b": 2})), (2, "insert", "None", row({"b": 2})), (3, "delete", row(None), "None"), (3, "delete", row(None), "None"),
    ])
    kinds = lambda ops: sorted((r.k, r.op) for r in dm.change_log(target, given, ["k"], ops=ops).collect())
    assert kinds(("insert",)) == [(2, "insert"), (2, "insert")]
    assert kinds(("update",)) == [(1, "delete"), (1, "insert"), (1, "insert")]


def test_unlike_types_meet_without_loss(spark):
    pairs = [
        ("cast(2 as bigint)", "cast(2 as decimal(30,2))", True),
        ("cast(2 as bigint)", "cast('10000000000000000000000000' as decimal(30,2))", False),
        ("9007199254740993L", "cast(9007199254740992L as double)", False),
        ("9007199254740992L", "cast(9007199254740992L as double)", True),
        ("5L", "cast(5.5 as double)", False),
        ("0L", "cast('-0.0' as double)", True),
        ("7", "cast(7 as double)", True),
        ("cast(5 as decimal(38,0))", "cast(5 as decimal(38,18))", True),
        ("cast('0' as decimal(38,38))", "0L", True),
        ("cast('0.10' as decimal(38,38))", "cast('0.1' as decimal(38,10))", True),
        ("cast('0.10' as decimal(38,38))", "cast('0.11' as decimal(38,10))", False),
        ("cast('100.00' as decimal(38,2))", "cast(100 as decimal(38,0))", True),
        ("date'2024-01-01'", "timestamp'2024-01-01 00:00:00'", True),
        ("date'2024-01-01'", "timestamp_ntz'2024-01-01 00:00:01'", False),
        ("timestamp'2024-01-01 00:00:00'", "timestamp_ntz'2024-01-01 00:00:00'", True),
        ("cast(null as bigint)", "cast(null as double)", True),
        ("cast(null as decimal(38,18))", "0L", False),
    ]
    for a, b, same in pairs:
        left, right = (spark.range(1).selectExpr("id", f"{x} as v") for x in (a, b))
        for one, other in ((left, right), (right, left)):
            found = dm.row_diff(one, other, ["id"]).first()["status"]
            assert (found == "same") == same, (a, b)


def test_conflicts_tell_of_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x"), (3, "t"), (3, "t")], "k int, v string")
    given = spark.createDataFrame([(1, "a"), (2, "y")], "k int, v string")
    found = {tuple(r) for r in dm.conflicts(target, given, ["k"]).collect()}
    assert found == {(1, None, "2 rows", "1 rows"), (2, "v", "x", "y")}


def test_bag_diff_counts_copies(sides):
    target, given = sides
    ours, theirs = bag(TARGET), bag(GIVEN)
    expected = {r: (ours.get(r, 0), theirs.get(r, 0)) for r in {*ours, *theirs} if ours.get(r, 0) != theirs.get(r, 0)}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in dm.bag_diff(target, given).collect()} == expected


def test_bag_diff_refuses_further_columns(sides, spark):
    target, _ = sides
    with pytest.raises(ValueError, match="extra"):
        dm.bag_diff(target, target.selectExpr("*", "1 as extra"))


def test_maps_and_nested_values_are_compared(spark):
    schema = "k int, m map<string,int>, a array<struct<x:int,m:map<string,int>>>"
    target = spark.createDataFrame(
        [(1, {"a": 1, "b": 2}, [(1, {"x": 1, "y": 2})]), (2, {"a": 1}, None), (3, None, [(None, None)])], schema
    )
    given = spark.createDataFrame(
        [(1, {"b": 2, "a": 1}, [(1, {"y": 2, "x": 1})]), (2, {"a": None}, None), (3, None, [None])], schema
    )
    expected = {1: ("same", []), 2: ("changed", ["m"]), 3: ("changed", ["a"])}
    for primary_key in (False, True):
        found = dm.row_diff(target, given, ["k"], primary_key=primary_key).collect()
        assert {r["k"]: (r["status"], r["changed_cols"]) for r in found} == expected
    bucketed = dm.bucket_diff(target, given, ["k"], n=8).collect()
    assert {r["k"]: (r["status"], r["changed_cols"]) for r in bucketed} == {k: expected[k] for k in (2, 3)}
    assert dm.bag_diff(target, given).count() == 4


def test_unlike_types_meet_in_a_common_one(spark):
    target = spark.createDataFrame([(1, 5, 2.5, "7")], "k int, a bigint, b double, c string")
    given = spark.createDataFrame([(1, 5, "x", 7)], "k int, a int, b string, c int").selectExpr(
        "k", "a", "cast(2.5 as decimal(10,2)) as b", "c"
    )
    assert dm.row_diff(target, given, ["k"]).first()["status"] == "same"


def test_a_table_of_keys_only(spark):
    target, given = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    for primary_key in (False, True):
        found = {r["k"]: r["status"] for r in dm.row_diff(target, given, ["k"], primary_key=primary_key).collect()}
        assert found == {1: "missing_in_given", 2: "same", 3: "only_in_given"}


def test_output_names_are_reserved(spark):
    table = spark.createDataFrame([(1, 2)], "status int, v int")
    with pytest.raises(ValueError, match="status"):
        dm.row_diff(table, table, ["status"])


def test_observed_nullability(sides):
    target, _ = sides
    found = {r["column"]: (r["n_rows"], r["null_count"]) for r in dm.observed_nullability(target).collect()}
    assert found == {"k1": (11, 1), "k2": (11, 1), "n": (11, 1), "s": (11, 3)}


def test_counts_come_from_file_footers_where_the_source_can(spark, tmp_path):
    spark.createDataFrame(TARGET, SCHEMA).write.parquet(str(tmp_path / "t"))
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = dm.observed_nullability(spark.read.parquet(str(tmp_path / "t")))
        assert "PushedAggregation: [COUNT(*), COUNT(k1)" in found._jdf.queryExecution().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_bucket_diff_is_row_diff(sides):
    target, given = sides
    expected = {k: v for k, v in statuses(TARGET, GIVEN).items() if v[0] not in ("same", "duplicate_key")}
    for n in (1, 4, 1 << 16):
        found = {(r["k1"], r["k2"]): (r["status"], tuple(r["changed_cols"])) for r in dm.bucket_diff(target, given, KEYS, n).collect()}
        assert {k: v for k, v in found.items() if v[0] != "duplicate_key"} == expected
        assert found[("twice", "t")][0] == found[("extra", "e")][0] == "duplicate_key"


def test_swapped_cells_and_copies_change_the_digest(spark):
    def digests(rows):
        return dm.bucket_digest(spark.createDataFrame(rows, "k int, a int, b int, l array<int>"), ["k"], 1).collect()

    base = digests([(1, None, 1, [1, None])])
    assert base != digests([(1, 1, None, [1, None])])
    assert base != digests([(1, None, 1, [None, 1])])
    assert base != digests([(1, None, 1, [1, None])] * 3)
    with pytest.raises(ValueError, match="buckets"):
        dm.bucket_digest(spark.range(1), ["id"], 0)


def test_bucket_diff_keeps_nothing_of_equal_tables(sides):
    target, _ = sides
    assert dm.bucket_diff(target, target, KEYS).isEmpty()


def test_digest_diff_is_row_diff(sides):
    target, given = sides
    found = {(r["k1"], r["k2"]): r["status"] for r in dm.digest_diff(target, given, KEYS, include_same=True).collect()}
    assert found == {k: status for k, (status, _) in statuses(TARGET, GIVEN).items()}
    changes = {(r["k1"], r["k2"]) for r in dm.digest_diff(target, given, KEYS).collect()}
    assert changes == {k for k, status in found.items() if status != "same"}


def test_digest_diff_of_keys_only(spark):
    target, given = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    found = {r["k"]: r["status"] for r in dm.digest_diff(target, given, ["k"], include_same=True).collect()}
    assert found == {1: "missing_in_given", 2: "same", 3: "only_in_given"}


def test_digests_agree_with_comparison_on_nested_values_and_zeros(spark):
    schema = "k int, d double, a array<double>, s struct<x:float,l:array<string>>, m map<string,double>"
    target = spark.createDataFrame(
        [
            (1, 0.0, [0.0, None], (0.0, ["a", None]), {"a": 0.0, "b": 1.0}),
            (2, float("nan"), [float("nan")], (None, []), {}),
            (3, 1.0, [1.0, None], (1.0, ["ab", "c"]), None),
            (4, 1.0, [], (1.0, None), None),
            (5, None, [None, 1.0], None, None),
        ],
        schema,
    )
    given = spark.createDataFrame(
        [
            (1, -0.0, [-0.0, None], (-0.0, ["a", None]), {"b": 1.0, "a": -0.0}),
            (2, float("nan"), [float("nan")], (None, []), {}),
            (3, 1.0, [None, 1.0], (1.0, ["a", "bc"]), None),
            (4, 1.0, None, (1.0, []), None),
            (5, 1.0, [None, 1.0], (None, None), None),
        ],
        schema,
    )
    exact = {r["k"]: r["status"] for r in dm.row_diff(target, given, ["k"]).collect()}
    assert exact == {1: "same", 2: "same", 3: "changed", 4: "changed", 5: "changed"}
    assert {r["k"]: r["status"] for r in dm.digest_diff(target, given, ["k"], include_same=True).collect()} == exact
    assert {r["k"] for r in dm.bucket_diff(target, given, ["k"]).collect()} == {3, 4, 5}


def test_decimals_meet_floating_point_numbers_exactly(spark):
    texts = ["9007199254740993", "9007199254740992", "0.1", "0.10000000000000000555", "100", "-0.0000001", "0", "123.456"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string").selectExpr("k", "cast(t as decimal(38,20)) AS n")
    given = spark.createDataFrame([(0, 9007199254740992.0), (1, 9007199254740992.0), (2, 0.1), (3, 0.1), (4, 1e2), (5, -1e-7), (6, -0.0), (7, 123.456)], "k int, n double")
    for diff in (dm.row_diff(target, given, ["k"]), dm.row_diff(given, target, ["k"]), dm.digest_diff(target, given, ["k"], include_same=True)):
        assert {r.k: r.status for r in diff.collect()} == {i: "changed" if i in (0, 3) else "same" for i in range(8)}
    wide = spark.createDataFrame([(1, 1e20), (2, 1e300), (3, float("nan"))], "k int, n double")
    digits = spark.sql("SELECT 1 AS k, cast('100000000000000000000' AS decimal(38,0)) AS n UNION ALL SELECT 2, 1 UNION ALL SELECT 3, 1")
    assert {r.k: r.status for r in dm.row_diff(digits, wide, ["k"]).collect()} == {1: "same", 2: "changed", 3: "changed"}


def test_rows_are_compared_without_sorting_them(spark):
    target = spark.createDataFrame([(1, "a", 1.5, ["x"])], "k int, s string, d double, l array<string>")
    for found in (dm.row_diff(target, target, ["k"]), dm.status_counts(target, target, ["k"])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_cells_that_are_null_or_nested(spark):
    schema = "k int, s string, d double, l array<string>, m map<string,int>, b binary"
    rows = [(i, None, None, None, None, None) for i in range(7)]
    given = [(0, None, None, None, None, None), (1, "", None, None, None, None), (2, None, 0.0, None, None, None), (3, None, None, [], None, None),
             (4, None, None, None, {}, None), (5, None, None, None, None, b""), (6, None, None, None, None, None)]
    found = dm.row_diff(spark.createDataFrame(rows, schema), spark.createDataFrame(given, schema), ["k"])
    assert {r.k: r.changed_cols for r in found.collect()} == {0: [], 1: ["s"], 2: ["d"], 3: ["l"], 4: ["m"], 5: ["b"], 6: []}
    same = [(1, "a", -0.0, ["x", None], {"a": 1, "b": 2}, b"q")]
    other = [(1, "a", 0.0, ["x", None], {"b": 2, "a": 1}, b"q")]
    found = dm.row_diff(spark.createDataFrame(same, schema), spark.createDataFrame(other, schema), ["k"])
    assert found.first().status == "same"
