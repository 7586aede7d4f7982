import pytest
from pyspark.sql import functions as F

import driftmend as dm
from driftmend import Namespace, Reference, TableContract
from driftmend.operators import schema_audit
from driftmend.plans.audit import CHECKS, FURTHER_CHECKS
from driftmend.plans.facts import with_affected
from fixtures import GIVEN, KEYS, SCHEMA, TARGET

EVERYTHING = (*CHECKS, *FURTHER_CHECKS)


def space(spark, schema="main", contracts=(), **tables):
    return Namespace(schema, {name: spark.createDataFrame([], ddl) if isinstance(ddl, str) else ddl for name, ddl in tables.items()}, contracts)


def kinds(findings):
    return sorted((r["table"], r["kind"], r["column"], r["n"]) for r in findings.collect())


def named(findings):
    return sorted((r["table"], r["column"]) for r in findings.collect())


@pytest.fixture(scope="module")
def keyed(spark):
    contracts = (TableContract("rows", keys=KEYS),)
    return (
        Namespace("main", {"rows": spark.createDataFrame(TARGET, SCHEMA)}, contracts),
        Namespace("main", {"Rows": spark.createDataFrame(GIVEN, SCHEMA)}, contracts),
    )


def test_names_match_ignoring_case(spark):
    ours = dm.load_catalog(spark, space(spark, Orders="Id int, Total double", lost="a int"))
    theirs = dm.load_catalog(spark, space(spark, ORDERS="ID int, note string", extra="b int"))
    assert named(schema_audit.missing_tables(ours, theirs, "main")) == [("lost", None)]
    assert named(schema_audit.missing_tables(theirs, ours, "main")) == [("extra", None)]
    assert named(schema_audit.missing_columns(ours, theirs, "main")) == [("Orders", "Total")]
    assert schema_audit.missing_tables(ours, theirs, "main", exclude=["LOST"]).isEmpty()


def test_type_comparison_has_three_strictnesses(spark):
    ours = dm.load_catalog(spark, space(spark, t="a decimal(10,2), b array<int>, c string, d int, e timestamp"))
    theirs = dm.load_catalog(spark, space(spark, t="a decimal(12,4), b array<string>, c string, d bigint, e timestamp_ntz"))
    assert [c for _, c in named(schema_audit.type_mismatches(ours, theirs, "main"))] == ["d", "e"]
    assert [c for _, c in named(schema_audit.type_mismatches(ours, theirs, "main", "exact"))] == ["a", "b", "d", "e"]
    with pytest.raises(ValueError, match="compare_types"):
        schema_audit.type_mismatches(ours, theirs, "main", "loose")


def test_one_column_can_differ_in_type_and_nullability(spark):
    ours = dm.load_catalog(spark, space(spark, contracts=(TableContract("t", required=("A",)),), t="a int, b int"))
    theirs = dm.load_catalog(spark, space(spark, t="a string, b int"))
    assert named(schema_audit.type_mismatches(ours, theirs, "main")) == [("t", "a")]
    assert named(schema_audit.nullability_mismatches(ours, theirs, "main")) == [("t", "a")]


def test_colliding_names_are_reported_and_all_tables_compared(spark):
    tables = {"T": spark.createDataFrame([], "a int"), "t": spark.createDataFrame([], "a string, A bigint, b int")}
    ours, theirs = dm.load_catalog(spark, Namespace("main", tables)), dm.load_catalog(spark, space(spark, t="a bigint, b int"))
    collisions = {(r["table"], r["column"]): r["message"] for r in schema_audit.name_collisions(ours, "main").collect()}
    assert set(collisions) == {("t", None), ("t", "A")}
    assert "T, t" in collisions[("t", None)]
    assert [(r["table"], r["column"]) for r in schema_audit.type_mismatches(ours, theirs, "main").collect()] == [("T", "a")]


def test_dependencies(spark):
    contracts = (
        TableContract(
            "child",
            references=(
                Reference("a", "Parent", "ID", "other"),
                Reference("a", "absent", "id", "other"),
                Reference("a", "parent", "nope", "other"),
                Reference("a", "parent", "id", "nowhere"),
                Reference(("a", "b"), "pair", ("x", "z"), "other"),
                Reference("b", "child", "c"),
            ),
        ),
        TableContract("lost", references=(Reference("a", "t", "id", "nowhere"),)),
    )
    ours = dm.load_catalog(spark, space(spark, contracts=contracts, child="a int, b int", lost="a int"))
    theirs = dm.load_catalog(
        spark, space(spark, child="a int, b int"), space(spark, "other", parent="Id int", pair="X int, y int"), space(spark, "empty")
    )
    found = schema_audit.missing_dependencies(ours, theirs, "main").collect()
    assert sorted((r["kind"].removeprefix("missing_dependency_"), r["message"].split("depends on ")[1]) for r in found) == [
        ("column", "column nope in table parent in schema other which is missing"),
        ("column", "column z in table pair in schema other which is missing"),
        ("schema", "schema nowhere which is missing"),
        ("table", "table absent in schema other which is missing"),
    ]
    inside = schema_audit.missing_dependencies(ours, theirs, "main", include_same_schema=True)
    assert inside.where(F.col("message").contains("column c in table child in schema main")).count() == 1


def test_foreign_keys_pair_by_position(spark):
    contract = TableContract("t", references=(Reference(("a", "b"), "p", ("x", "y")),))
    catalog = dm.load_catalog(spark, space(spark, contracts=(contract,), t="a int, b int"))
    assert [(r["position"], r["column"], r["ref_column"], r["ref_schema"]) for r in dm.list_foreign_keys(catalog, "main").collect()] == [
        (1, "a", "x", "main"),
        (2, "b", "y", "main"),
    ]
    with pytest.raises(ValueError, match="pair up"):
        Reference(("a", "b"), "p", ("x",))


def test_the_audit_of_a_namespace_with_itself_is_empty(spark):
    table = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    itself = Namespace("main", {"t": table}, (TableContract("t", keys="id", references=(Reference("id", "t", "id"),)),))
    assert dm.audit(itself, itself, checks=EVERYTHING, include_same_schema=True).isEmpty()


def test_counts_of_keys_and_rows(keyed):
    target, given = keyed
    found = {(r["kind"], r["message"]): r["n"] for r in dm.audit(target, given, checks=("rows", "keys", "extra", "changed")).collect()}
    assert found == {
        ("unsynced_rows", "MISMATCH TABLE rows: 5 unsynced rows"): 5,
        ("extra_rows", "MISMATCH TABLE rows: 4 rows only in the given table"): 4,
        ("changed_rows", "MISMATCH TABLE rows: 2 changed rows"): 2,
        ("duplicate_key", "MISMATCH TABLE rows: 1 duplicated keys in target"): 1,
        ("duplicate_key", "MISMATCH TABLE rows: 1 duplicated keys in given"): 1,
        ("null_key", "MISMATCH TABLE rows: 2 rows with a NULL in the key in target"): 2,
        ("null_key", "MISMATCH TABLE rows: 2 rows with a NULL in the key in given"): 2,
    }
    reverse = {r["kind"]: r["n"] for r in dm.reverse_check(target, given, checks=("rows", "extra")).collect()}
    assert reverse == {"unsynced_rows": 4, "extra_rows": 5}


def test_key_checks_count_the_same_with_and_without_whole_rows(keyed):
    target, given = keyed
    narrow = kinds(dm.audit(target, given, checks=("rows", "keys", "extra")))
    wide = kinds(dm.audit(target, given, checks=("rows", "keys", "extra", "changed")))
    assert narrow == [row for row in wide if row[1] != "changed_rows"]


def test_a_table_that_cannot_be_compared_is_a_finding_and_the_rest_go_on(spark):
    good = spark.createDataFrame([(1,)], "id int")
    target = Namespace(
        "main",
        {"good": good, "keyless": good, "unlike": good},
        (TableContract("good", keys="id"), TableContract("unlike", keys="id", references=(Reference("id", "good", "id"),))),
    )
    given = Namespace(
        "main",
        {"good": good.where("false"), "keyless": good, "unlike": spark.createDataFrame([("1",)], "id string")},
        errors={"broken": "PATH_NOT_FOUND"},
    )
    found = {(r["table"], r["kind"]): (r["type"], r["label"], r["message"]) for r in dm.audit(target, given, checks=("rows", "orphans")).collect()}
    assert set(found) == {("good", "unsynced_rows"), ("keyless", "table_error"), ("unlike", "table_error"), ("broken", "load_error")}
    assert found[("keyless", "table_error")] == (
        "ERROR",
        "ERROR",
        "TABLE ERROR keyless: error comparing rows: table main.keyless has no primary key",
    )
    assert "no lossless common type" in found[("unlike", "table_error")][2]


def test_a_table_that_failed_to_load_is_not_called_missing(spark):
    target = space(spark, broken="id int", gone="id int")
    given = Namespace("main", {"other": spark.range(1)}, errors={"broken": "CORRUPT"})
    found = {(r["table"], r["kind"]) for r in dm.audit(target, given, checks=("schema",)).collect()}
    assert found == {("broken", "load_error"), ("gone", "missing_table")}


def test_orphans_and_casts(spark):
    contracts = (TableContract("child", references=(Reference("p", "parent", "id"), Reference("q", "top", "id", "far"))),)
    child = spark.createDataFrame([(1, 5, "7"), (2, None, "x"), (9, 5, None)], "p int, q int, v string")
    target = Namespace("main", {"child": child}, contracts)
    given = Namespace("main", {"child": child.selectExpr("p", "q", "try_cast(v as int) v"), "parent": spark.range(1, 3)})
    far = Namespace("far", {"TOP": spark.range(1)})
    found = {(r["kind"], r["column"]): r["n"] for r in dm.audit(target, given, checks=("orphans", "casts"), others=[far]).collect()}
    assert found == {("orphan_rows", "p"): 1, ("orphan_rows", "q"): 2, ("cast_loss", "v"): 1}


def test_findings_are_ordered_and_labelled(keyed):
    target, given = keyed
    found = dm.audit(target, given, run_id="r1", checks=("rows", "extra"))
    assert found.columns == ["run_id", "table", "column", "kind", "type", "label", "n", "message"]
    rows = found.collect()
    assert [r["kind"] for r in rows] == ["extra_rows", "unsynced_rows"]
    assert {(r["run_id"], r["type"], r["label"]) for r in rows} == {("r1", "MISMATCH", "WARNING")}


def test_unknown_checks_and_empty_namespaces_are_refused(spark):
    with pytest.raises(ValueError, match="unknown checks"):
        dm.audit(space(spark, t="a int"), space(spark, t="a int"), checks=("everything",))
    with pytest.raises(ValueError, match="neither side"):
        dm.audit(Namespace("main", {}), Namespace("main", {}))


def test_metrics_of_keyed_and_keyless_tables(spark):
    contracts = (TableContract("keyed", keys=KEYS, references=(Reference("n", "numbers", "id"),)),)
    target = Namespace("main", {"keyed": spark.createDataFrame(TARGET, SCHEMA), "bag": spark.createDataFrame([(1,), (1,), (2,)], "v int")}, contracts)
    given = Namespace(
        "main",
        {"keyed": spark.createDataFrame(GIVEN, SCHEMA), "bag": spark.createDataFrame([(1,), (3,)], "v int"), "numbers": spark.range(8)},
    )
    found = {r["table"]: r.asDict() for r in dm.audit_metrics(target, given).collect()}
    keyed = found["keyed"]
    assert (keyed["rows_target"], keyed["rows_given"], keyed["orphan_rows"]) == (11, 10, 3)
    assert (keyed["duplicate_key"], keyed["missing_in_given"], keyed["only_in_given"]) == (2, 5, 3)
    bag = found["bag"]
    assert (bag["rows_target"], bag["rows_given"], bag["missing_in_given"], bag["only_in_given"], bag["changed"]) == (3, 2, 2, 1, None)


def test_affected_rows_are_counted_on_the_columns_in_question_only(spark, tmp_path):
    spark.createDataFrame([(1, "a", None), (2, None, "x")], "id int, v string, w string").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    target = Namespace("main", {"t": table, "gone": spark.range(4)}, (TableContract("t", keys="id"),))
    given = Namespace("main", {"t": table.drop("v")}, (TableContract("t", keys="id"),))
    found = dm.audit(target, given, checks=("schema", "affected"))
    assert kinds(found) == [("gone", "missing_table", None, 4), ("t", "missing_column", "v", 1)]
    ours, theirs = (dm.load_catalog(spark, s) for s in (target, given))
    counted = with_affected(schema_audit.missing_columns(ours, theirs, "main"), target, given)
    assert "ReadSchema: struct<v:string>" in counted._jdf.queryExecution().toString()


def test_a_failing_table_does_not_end_an_audit(spark):
    broken = spark.range(5).withColumn("id", F.raise_error(F.lit("broken file")).cast("bigint"))
    contracts = tuple(TableContract(t, keys="id") for t in ("a", "b", "c"))
    target = Namespace("main", {t: spark.range(5) for t in "abc"}, contracts)
    given = Namespace("main", {"a": spark.range(3), "b": broken, "c": spark.range(4)}, errors={"lost": "no such file"})
    found = {(r["table"], r["kind"], r["n"]) for r in dm.audit(target, given).collect()}
    assert {("a", "unsynced_rows", 2), ("b", "table_error", None), ("c", "unsynced_rows", 1), ("lost", "load_error", None)} <= found
    metrics = {r["table"]: (r["rows_target"], r["missing_in_given"]) for r in dm.audit_metrics(target, given).collect()}
    assert metrics == {"a": (5, 2), "b": (None, None), "c": (5, 1)}


def test_metrics_go_on_after_a_table_of_another_shape(spark):
    target = Namespace("main", {"a": spark.range(5), "b": spark.range(2)}, (TableContract("b", keys="id"),))
    given = Namespace("main", {"a": spark.range(5).selectExpr("id", "1 as more"), "b": spark.range(1)})
    metrics = {r["table"]: (r["rows_target"], r["missing_in_given"]) for r in dm.audit_metrics(target, given).collect()}
    assert metrics == {"a": (None, None), "b": (2, 1)}


def test_loading_errors_are_findings_when_nothing_loads(spark):
    nothing = Namespace("main", {}, errors={"t": "no such file"})
    assert [(r["table"], r["kind"]) for r in dm.audit(nothing, Namespace("main", {})).collect()] == [("t", "load_error")]


def test_colliding_columns_do_not_stop_an_audit(spark):
    odd = spark.createDataFrame([(1, "x", "y")], "id int, v string, V string")
    target = Namespace("main", {"t": odd, "u": spark.range(1)}, (TableContract("t", keys="id"), TableContract("u", keys="id")))
    given = Namespace("main", {"t": odd, "u": spark.range(0)})
    found = {(r["table"], r["kind"]) for r in dm.audit(target, given, checks=("schema", "rows", "changed")).collect()}
    assert {("t", "name_collision"), ("t", "table_error"), ("u", "unsynced_rows")} <= found


def test_tables_whose_names_collide_are_all_compared(spark):
    make = lambda rows, schema="id int, s string": spark.createDataFrame(rows, schema)
    contracts = [dm.TableContract("t", "id")]
    target = dm.Namespace("main", {"T": make([(i, "x") for i in range(5)]), "t": make([(1, "x")], "id int, s string")}, contracts)
    given = dm.Namespace("main", {"t": make([(1,)], "id int")}, contracts)
    found = {(r.table, r.column, r.kind, r.n) for r in dm.audit(target, given).collect()}
    assert found == {("T", None, "unsynced_rows", 4), ("T", "s", "missing_column", None), ("t", "s", "missing_column", None), ("t", None, "name_collision", 2)}
    both = dm.Namespace("main", {"T": make([(i, "x") for i in range(4)]), "t": make([(1, "x")])}, contracts)
    found = {(r.table, r.kind, r.n) for r in dm.audit(target, both).collect()}
    assert found == {("T", "unsynced_rows", 1), ("t", "name_collision", 2)}


def test_nothing_to_compare_gives_no_findings(spark):
    one = dm.Namespace("main", {"a": spark.createDataFrame([(1,)], "id int")}, [dm.TableContract("a", "id")])
    other = dm.Namespace("main", {"b": spark.createDataFrame([(1,)], "id int")}, [dm.TableContract("b", "id")])
    found = dm.audit(one, other, checks=("rows",))
    assert found.collect() == [] and found.columns == dm.audit(one, other).columns
