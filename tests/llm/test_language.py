import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftmend.llm.language import LONGEST, Direction, Network, _runs, identify, learned, trained


def small(seed=0, h=3, languages=("a", "b", "c")):
    draw = np.random.default_rng(seed)
    return Network(Direction.fresh(h, draw), Direction.fresh(h, draw), draw.normal(size=(2 * h + 1, len(languages))).astype(np.float32), list(languages))


def test_gradients_agree_with_differences():
    network = small()
    for direction in (network.ahead, network.back):
        direction.inputs, direction.states = direction.inputs.astype(np.float64), direction.states.astype(np.float64)
    network.out = network.out.astype(np.float64)
    symbols = np.array([[97, 98, 97, 99], [99, 97, 200, 97]], np.uint8)
    target = np.array([0, 2])
    _, gradients = network.gradients(symbols, target)
    for p, g in zip(network.parameters(), gradients, strict=True):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 40)] + [(97, 1), (200, 2)] * (p.shape[0] == 256):
            kept = p[at]
            p[at] = kept + 1e-3
            above, _ = network.gradients(symbols, target)
            p[at] = kept - 1e-3
            below, _ = network.gradients(symbols, target)
            p[at] = kept
            assert abs((above - below) / 2e-3 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_both_directions_reach_every_position():
    network = small(1)
    symbols = np.frombuffer(b"abcdef", np.uint8)[None]
    p = network.label(symbols)
    assert p.shape == (6, 1, 3) and np.allclose(p.sum(axis=2), 1, atol=1e-5)
    other = symbols.copy()
    other[0, 5] = 122
    assert not np.allclose(network.label(other)[0], p[0])
    other = symbols.copy()
    other[0, 0] = 122
    assert not np.allclose(network.label(other)[5], p[5])


def test_runs_are_cut_and_no_byte_is_lost():
    text = ("Ab" * 50 + " é1ü ").encode()
    words = _runs(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    got = [words.text(i) for i in range(len(words.starts))]
    assert b"".join(got) == ("ab" * 50 + "éü").encode() and max(map(len, got)) == LONGEST


def test_learns_and_identifies(spark, documents):
    draw = np.random.default_rng(2)
    kinds = {"xx": "aeiou", "yy": "bcdfg", "zz": "éèüöñ"}
    rows = []
    for i in range(240):
        lang = list(kinds)[i % 3]
        rows.append((i, " ".join("".join(draw.choice(list(kinds[lang]), draw.integers(2, 9))) for _ in range(30)), lang))
    odd = [(900, None, "xx"), (901, "", "xx"), (902, "12 34 ??", "xx"), (903, "… “”", "xx"), (904, "aeiou " * 30_000, None), (904, "aeiou", None), (None, "bcd fgb", "yy")]
    docs = documents(rows + odd)
    network = learned(docs, F.col("doc_id") % 4 != 2, per_language=50, per_document=20)
    assert network.languages == ["xx", "yy", "zz"]
    found = identify(docs, network).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert np.mean([by_id[i].lang_pred == lang for i, _, lang in rows if i % 4 == 2]) > 0.97
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0) for i in (900, 901, 902, 903))
    assert by_id[904].lang_pred == "xx" and by_id[None].lang_pred == "yy"
    assert by_id[900].digest == "x"


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "text")]).withColumn("lang", F.lit(None).cast("string"))
    assert learned(docs, F.lit(True)) is None
    assert [(r.lang_pred, r.score) for r in identify(docs, None).collect()] == [("und", 0.0)]
    assert identify(documents([]), small()).collect() == []


def test_training_is_repeatable():
    units, labels = [b"abc", b"abd", b"xyz", b"xy"], np.array([0, 0, 1, 1])
    one, other = (trained(units, labels, np.ones(4), ["a", "x"], hidden=4, steps=30, batch=8) for _ in range(2))
    assert one.name() == other.name()


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="the test tables are not here")
def test_held_out_accuracy(spark):
    from driftmend.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    found = QUERIES["op7_language"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_remembered_runs_take_few_bytes():
    from driftmend.llm.language import Memory
    from driftmend.llm.texts import Words

    class Plain:
        languages = ["a", "b"]

        def label(self, symbols):
            return np.stack([symbols.T / 256, 1 - symbols.T / 256], axis=2)

    draw = np.random.default_rng(1)
    one = np.zeros(1, np.int64)
    Words(np.zeros(150_000, np.uint8), one, one + 1, np.array([0, 1])).hashes()  # its tables are not the memory's
    tracemalloc.start()
    memory = Memory(2)
    before = tracemalloc.get_traced_memory()[0]
    for _ in range(4):
        data = draw.integers(97, 123, 150_000).astype(np.uint8)
        starts = np.arange(0, 150_000, 10)
        words = Words(data, starts, starts + 10, np.array([0, 15_000]))
        hashes, first = np.unique(words.hashes(), return_index=True)
        for _ in range(2):  # found anew, then remembered
            found = memory.sums_of(Plain(), words, hashes, first)
            assert np.allclose(found[:, 0], (data.reshape(-1, 10).sum(axis=1) / 256)[first], atol=1e-4)
    del words, hashes, first, found, data, starts
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(memory.at) == 60_000 and kept < 50 * 60_000
