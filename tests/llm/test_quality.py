import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftmend.llm.quality import STATISTICS, RuleModel, fitted, learned, remainder, score_quality, statistics_of, with_statistics


def test_statistics_of_known_texts():
    texts = [b"One two TWO two.\nOne two TWO two.", b"", "é!! A".encode()]
    offsets = np.cumsum([0, *map(len, texts)])
    found = statistics_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    first = dict(zip(STATISTICS, found[0], strict=True))
    assert first["repeated_lines"] == 0.5 and first["log_words"] == np.log1p(8)
    assert first["distinct_words"] == 3 / 8 and first["top_word"] == 4 / 8 and first["capital_words"] == 2 / 8
    assert not found[1].any()
    assert found[2][STATISTICS.index("marked_words")] == 0.5


def test_rules_find_a_boundary_and_agree_with_their_expression(spark, documents):
    draw = np.random.default_rng(0)
    x = draw.random((2000, len(STATISTICS)))
    y = ((x[:, 3] > 0.4) & (x[:, 5] <= 0.7)).astype(float)
    model = fitted(x, y)
    assert 0 < len(model.rules) < 200
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x[:300]], list(STATISTICS))
    scores = np.array([r[0] for r in rows.select(model.score()).collect()])
    assert ((scores >= 0.5) == (y[:300] == 1)).mean() > 0.97
    z = np.full(300, model.intercept)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        z += weight * np.all([(x[:300, f] > t) == above for f, above, t in rule], axis=0)
    assert np.allclose(scores, 1 / (1 + np.exp(-z)))


def test_odd_rows(spark, documents):
    model = RuleModel((((0, True, 0.5),),), (2.0,), -1.0)
    docs = documents([(1, "good words here"), (2, None), (3, ""), (3, ""), (None, "x " * 100_000)])
    found = {(r.doc_id, r.predicted) for r in score_quality(docs, model).collect()}
    assert found == {(1, 1), (2, 0), (3, 0), (None, 1)}
    assert score_quality(docs, model).count() == 5
    assert score_quality(documents([]), model).collect() == []


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "a"), (2, "b")])
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert learned(docs, none).rules == ()
    one_kind = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    assert learned(documents([(i, "a") for i in range(100)]), one_kind).rules == ()


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="the test tables are not here")
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = score_quality(docs, learned(docs, labels)).join(labels, "doc_id").where(remainder("doc_id", 3) == 1)
    assert found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9


def test_all_statistics_are_finite(spark, documents):
    rows = with_statistics(documents([(1, "\x00\x01"), (2, "|||| ###"), (3, "A" * 10_000)])).collect()
    assert all(np.isfinite(r[s]) for r in rows for s in STATISTICS)
