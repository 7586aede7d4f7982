import pytest

import driftmend as dm
from driftmend import Namespace, Reference, TableContract
from driftmend.sources.information_schema import catalog_from_information_schema, contracts_of, exact_type
from driftmend.sources.readers import Split, bounds_query, hash_predicates, jdbc_options, page_predicates, pages_query
from driftmend.sources.sinks import save_bucketed, staged, work_folder


@pytest.fixture(scope="module")
def database(spark):
    """The relations of a database with a composite reference into another schema, and a view."""

    def frame(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    return catalog_from_information_schema(
        tables=frame([("public", "orders"), ("public", "orders_view"), ("crm", "accounts")], "table_schema string, table_name string"),
        columns=frame(
            [
                ("public", "orders", 1, "id", "bigint", "NO", "nextval('s')"),
                ("public", "orders", 2, "tenant", "uuid", "YES", None),
                ("public", "orders", 3, "account", "integer", "YES", None),
                ("public", "orders_view", 1, "id", "bigint", "YES", None),
                ("crm", "accounts", 1, "tenant", "text", "NO", None),
                ("crm", "accounts", 2, "no", "integer", "NO", None),
            ],
            "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string, column_default string",
        ),
        table_constraints=frame(
            [
                ("public", "pk", "PRIMARY KEY", "public", "orders"),
                ("public", "fk", "FOREIGN KEY", "public", "orders"),
                ("crm", "pk", "PRIMARY KEY", "crm", "accounts"),
            ],
            "constraint_schema string, constraint_name string, constraint_type string, table_schema string, table_name string",
        ),
        key_column_usage=frame(
            [
                ("public", "pk", "public", "orders", "id", 1, None),
                ("public", "fk", "public", "orders", "tenant", 1, 1),
                ("public", "fk", "public", "orders", "account", 2, 2),
                ("crm", "pk", "crm", "accounts", "no", 2, None),
                ("crm", "pk", "crm", "accounts", "tenant", 1, None),
            ],
            "constraint_schema string, constraint_name string, table_schema string, table_name string, column_name string, ordinal_position int, position_in_unique_constraint int",
        ),
        referential_constraints=frame(
            [("public", "fk", "crm", "pk")],
            "constraint_schema string, constraint_name string, unique_constraint_schema string, unique_constraint_name string",
        ),
    )


def test_catalog_of_a_database(database):
    assert [r["table"] for r in dm.list_tables(database, "public").collect()] == ["orders", "orders_view"]
    assert [tuple(r)[1:] for r in dm.list_columns(database, "public", "orders").collect()] == [
        (1, "id", "bigint", False, "nextval('s')"),
        (2, "tenant", "string", True, None),
        (3, "account", "int", True, None),
    ]
    assert [r["column"] for r in dm.list_primary_keys(database, "crm").collect()] == ["tenant", "no"]


def test_references_follow_the_constraint_into_its_schema_by_position(database):
    found = dm.list_foreign_keys(database, "public").collect()
    assert [(r["column"], r["ref_schema"], r["ref_table"], r["ref_column"]) for r in found] == [
        ("tenant", "crm", "accounts", "tenant"),
        ("account", "crm", "accounts", "no"),
    ]


def test_contracts_of_a_database(database):
    assert contracts_of(database, "public") == [
        TableContract("orders", ("id",), (Reference(("tenant", "account"), "accounts", ("tenant", "no"), "crm"),), ("id",))
    ]


def test_source_types_are_compared_by_name(database, spark):
    from driftmend.operators.schema_audit import type_mismatches

    other = dm.load_catalog(spark, Namespace("public", {"orders": spark.createDataFrame([], "id bigint, tenant string, account int")}))
    assert type_mismatches(database, other, "public").isEmpty()
    found = sorted(r["column"] for r in type_mismatches(database, other, "public", "source").collect())
    assert found == ["account", "tenant"]
    space = Namespace("public", {"orders": spark.createDataFrame([], "id bigint, tenant string, account int")})
    audited = dm.audit(space, space, checks=("schema",), compare_types="source", catalogs=(database, other))
    kinds = sorted((r["kind"], r["column"]) for r in audited.where("table = 'orders'").collect())
    assert kinds == [("nullability_mismatch", "id"), ("type_mismatch", "account"), ("type_mismatch", "tenant")]


def test_types_of_a_database_are_spelt_as_spark_spells_them(spark):
    rows = [
        ("numeric", None, 12, 2, "numeric", "decimal(12,2)"), ("numeric", None, None, None, "numeric", "decimal(38,18)"),
        ("character varying", 20, None, None, "varchar", "varchar(20)"), ("character varying", None, None, None, "varchar", "string"),
        ("character", 3, None, None, "bpchar", "char(3)"), ("integer", None, 32, 0, "int4", "int"), ("double precision", None, 53, None, "float8", "double"),
        ("ARRAY", None, None, None, "_int4", "array<int>"), ("ARRAY", None, None, None, "_text", "array<string>"), ("uuid", None, None, None, "uuid", "string"),
    ]
    columns = spark.createDataFrame(rows, "data_type string, character_maximum_length int, numeric_precision int, numeric_scale int, udt_name string, want string")
    assert all(r[0] == r[1] for r in columns.select(exact_type(columns), "want").collect())
    bare = columns.select("data_type", "want")
    assert {r[0] for r in bare.select(exact_type(bare)).where("want like 'array%'").collect()} == {"array"}


def test_tables_are_split_by_pages_whatever_their_key():
    assert page_predicates(0, 1 << 27) == ["ctid >= '(0,0)'::tid"]
    assert page_predicates(40_000, 1 << 27) == [
        "ctid >= '(0,0)'::tid AND ctid < '(13334,0)'::tid", "ctid >= '(13334,0)'::tid AND ctid < '(26668,0)'::tid", "ctid >= '(26668,0)'::tid",
    ]
    # A partitioned table: the same page numbers of all partitions, as far as the longest has them.
    assert len(page_predicates(40_000, 1 << 27, longest=300)) == 3 and page_predicates(40_000, 1 << 27, longest=300)[-1] == "ctid >= '(200,0)'::tid"
    told = pages_query("public")
    assert "relkind IN ('r', 'p', 'm')" in told and "pg_relation_size" in told and "relpages" not in told
    assert hash_predicates(["a", 'b"c'], 2)[1] == """mod(abs(hashtext(concat_ws('|', "a"::text, "b""c"::text))::bigint), 2) = 1"""
    assert "n.nspname = 'o''dd'" in pages_query("o'dd")


def test_jdbc_reads_are_split_and_quoted():
    assert jdbc_options("public", 'odd"name') == {"dbtable": '"public"."odd""name"', "fetchsize": "10000"}
    assert jdbc_options("public", "t", Split("id", "1", "1000000", 64)) == {
        "dbtable": '"public"."t"',
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000000",
        "numPartitions": "64",
    }
    assert bounds_query("s", "t", 'a"b') == '(SELECT min("a""b") AS lower, max("a""b") AS upper FROM "s"."t") AS bounds'


def test_files_that_cannot_be_opened_are_kept_as_errors(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    spark.range(3).write.csv(str(tmp_path / "lines"))
    space = dm.read_files(spark, "main", {"good": str(tmp_path / "good"), "bad": str(tmp_path / "bad")})
    assert space.names() == ["good"] and space.errors == {"bad": "PATH_NOT_FOUND"}
    lines = dm.read_files(spark, "main", {"l": str(tmp_path / "lines")}, format="csv", options={"inferSchema": "true"})
    assert lines.tables["l"].count() == 3


def test_a_spark_database_is_a_namespace(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(5).write.mode("overwrite").saveAsTable("shop.things")
    spark.range(1).createOrReplaceTempView("passing")
    space = dm.read_database(spark, "shop", [TableContract("things", keys="id")])
    assert space.names() == ["things"] and space.schema == "shop"
    assert dm.audit(space, space).isEmpty()


def test_defaults_and_required_columns_come_from_the_contract(spark):
    contract = TableContract("t", keys="a", required=("B",), defaults={"B": "now()"})
    catalog = dm.load_catalog(spark, Namespace("main", {"t": spark.createDataFrame([], "a int, b date, c int")}, (contract,)))
    assert [(r["column"], r["nullable"], r["default"]) for r in dm.list_columns(catalog, "main").collect()] == [
        ("a", False, None),
        ("b", False, "now()"),
        ("c", True, None),
    ]


def test_copy_appends_and_findings_are_kept_per_run(spark, tmp_path):
    dm.copy_table(spark.range(3), str(tmp_path / "copy"))
    dm.copy_table(spark.range(3, 5), str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 5
    target = Namespace("main", {"t": spark.range(1), "u": spark.range(1)})
    for run in ("one", "two"):
        found = dm.audit(target, Namespace("main", {"t": spark.range(1)}), run, checks=("schema",))
        dm.write_findings(found, str(tmp_path / "findings"))
    kept = spark.read.parquet(str(tmp_path / "findings"))
    assert sorted(r["run_id"] for r in kept.collect()) == ["one", "two"]
    assert kept.where("found_at is null").isEmpty()


def test_work_goes_to_the_checkpoint_folder_of_the_session(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_a_staged_table_is_broadcast_by_its_true_size(spark):
    # The planner cannot know how few rows of this join are left, but knows the size of the written table.
    few = spark.range(2_000_000).where("id % 100000 = 0")
    plan = spark.range(2_000_000).join(staged(few, "few"), on="id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_bucketed_tables_are_compared_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, first in (("left_side", 0), ("right_side", 50)):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            save_bucketed(spark.range(first, first + 100).selectExpr("id", "id % 3 as v"), name, ["id"], 4)
        target, given = spark.table("left_side"), spark.table("right_side")
        for result in (
            dm.row_diff(target, given, ["id"], primary_key=True),
            dm.rows_to_insert(target, given, ["id"], primary_key=True),
            dm.merge_bidirectional(target, given, ["id"], "fill_nulls", primary_key=True),
        ):
            assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
        counts = dm.status_counts(target, given, ["id"], primary_key=True).first()
        assert (counts["missing_in_given"], counts["only_in_given"], counts["same"]) == (50, 50, 50)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_a_checkpoint_folder_there_is_no_work_folder(spark):
    class Unset:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Unset(), Context(master)

    for master in ("local[2]", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_folder(Session(master), "x")
    with_folder = Session("local[2]")
    with_folder.sparkContext.setCheckpointDir("/shared/folder")
    assert work_folder(with_folder, "x").startswith("/shared/folder/")


def test_a_copy_keeps_the_shape_of_what_is_there(spark, tmp_path):
    path = str(tmp_path / "copy")
    dm.copy_table(spark.range(2).selectExpr("id", "'a' as v"), path)
    dm.copy_table(spark.range(2).selectExpr("'b' as V", "id"), path)
    assert spark.read.parquet(path).where("v in ('a', 'b')").count() == 4
    with pytest.raises(ValueError, match="shape"):
        dm.copy_table(spark.range(2), path)
    with pytest.raises(ValueError, match="shape"):
        dm.copy_table(spark.range(2).selectExpr("id", "1 as v"), path)
