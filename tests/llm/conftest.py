import os

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang]) as a table with all columns of documents and some whose names clash with results."""

    def build(rows, clashing=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        if clashing:
            docs = docs.selectExpr("*", "'x' AS score", "'x' AS n", "'x' AS kind", "'x' AS digest", "'x' AS node", "'x' AS shard", "'x' AS component")
        return docs

    return build

