"""Queries with SQL against that SQL, and the columns that all of them must return."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from driftmend.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")

COLUMNS = {
    "op1_near_duplicates": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op2_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_suffix_tree": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op4_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op5_pattern_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_reshard": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op7_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_hilbert_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_license_digests": {"doc_id": "bigint", "digest": "string", "license": "string"},
    "op11_equal_average_clusters": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    "op12_difference_cover": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op13_filter_audit": {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint"),
}


@pytest.fixture(scope="module")
def connection():
    made = connect(SF_DIR)
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        made.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return made


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(spark, name, entry_point.queries()[name], ORACLES[name], SF_DIR, connection) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name not in ("op5_pattern_packing", "op9_hilbert_neighbours", "op11_equal_average_clusters", "op13_filter_audit"):
        assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
