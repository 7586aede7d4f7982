"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.registry import ORACLES, QUERIES
from checks.tables import TABLES
from compare import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(spark, name, QUERIES[name], ORACLES[name], SF_DIR, connection) is None


def test_no_query_pairs_rows_without_a_key(spark):
    for name, build in QUERIES.items():
        plan = build(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "PythonUDF" not in plan and "MapInPandas" not in plan, name


def test_entry(spark):
    assert not entry_point.entry(spark).isEmpty()


# Counts worked out beforehand for the drifted copies of each scale factor.
EXPECTED = {
    "sf0.001": {"missing_in_given": 215, "only_in_given": 89, "changed": 207, "same": 1078},
    "sf0.01": {"missing_in_given": 2143, "only_in_given": 883, "changed": 2068, "same": 10789},
    "sf0.1": {"missing_in_given": 21429, "only_in_given": 8824, "changed": 20679, "same": 107892},
}


@pytest.mark.parametrize("scale", sorted(EXPECTED))
def test_status_counts_of_drifted_orders(spark, scale):
    folder = f"{os.path.dirname(SF_DIR)}/{scale}"
    if not os.path.isdir(folder):
        pytest.skip(f"no {scale}")
    found = entry_point.queries()["status_counts"](spark, folder).first().asDict()
    assert {k: found[k] for k in EXPECTED[scale]} == EXPECTED[scale]


def test_tables_have_the_declared_columns(spark):
    from driftmend.functions.types import family

    for name, columns in TABLES.items():
        schema = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
        assert [(f.name, family(f.dataType)) for f in schema.fields] == columns
