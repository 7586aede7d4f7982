import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from driftmend.llm import substrings
from driftmend.llm.substrings import COVERS, Cover, without_repeats
from driftmend.llm.texts import NOT_BLANK, utf8, words_of


def expected(docs, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in docs]
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        gone = {p for i in range(len(w) - size + 1) if times[tuple(w[i : i + size])] > 1 for p in range(i, i + size)}
        out.append((doc, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def drawn(seed, n):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") * draw.randrange(1, 4) + draw.choice(["", "é", ".", " "])
    passages = [[word() for _ in range(draw.randrange(10, 90))] for _ in range(12)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(draw.randrange(0, 6)):
            part = draw.choice(passages)
            cut = draw.randrange(0, len(part))
            text += draw.choice([part, part[:cut], part[cut:], [word() for _ in range(draw.randrange(60))]])
        docs.append((i, draw.choice(["", " ", "\n"]) + draw.choice([" ", "\t\n", "  "]).join(text) + draw.choice(["", "\r"])))
    return docs


@pytest.mark.parametrize("period", sorted(COVERS))
def test_any_two_places_reach_cover_positions_together(period):
    residues = set(COVERS[period])
    assert all(any((i + s) % period in residues and (j + s) % period in residues for s in range(period)) for i in range(period) for j in range(period))


def test_anchors_fit_into_windows():
    assert [(Cover(s).period, Cover(s).anchor) for s in (1, 2, 35, 50)] == [(1, 1), (1, 2), (21, 15), (31, 20)]


@pytest.mark.parametrize("size", [1, 5, 35])
def test_agrees_with_brute_force(spark, documents, size):
    docs = drawn(size, 120)
    docs += [(500, None), (501, ""), (502, " \n"), (503, "zz " * 100), (504, "x " * size), (505, " ".join(f"w{i}" for i in range(34))), (505, " ".join(f"w{i}" for i in range(34)))]
    docs += [docs[3], docs[3], (None, docs[4][1]), (None, "alone " + " ".join(f"v{i}" for i in range(40)))]
    assert rows(without_repeats(documents(docs), size)) == expected(docs, size)


def test_many_partitions(spark, documents):
    """Anchors at the ends of sorted partitions, whose neighbours are elsewhere."""
    docs = drawn(7, 60)
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(without_repeats(documents(docs), 5)) == expected(docs, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_are_shuffled_once(spark, documents):
    found = without_repeats(documents(drawn(9, 30)), 35)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("ReusedExchange") >= 1


def test_a_text_that_a_third_of_the_rows_have(spark, documents):
    same = " ".join(f"p{i}" for i in range(80))
    docs = [(i, same if i % 3 == 0 else f"own{i} " + " ".join(f"d{i}x{j}" for j in range(36)) + (same[:200] if i % 3 == 1 else "")) for i in range(600)]
    assert rows(without_repeats(documents(docs), 35)) == expected(docs, 35)


def test_small_chunks(spark, documents, monkeypatch):
    docs = drawn(8, 40)
    monkeypatch.setattr(substrings, "CHUNK", 16)
    words = words_of(*utf8(pa.array([t for _, t in docs])), NOT_BLANK)
    places = [(c.first + i, int(c.left[i])) for c in substrings.chunks(words, 35) for i in range(c.starts)]
    n = np.diff(words.bounds)
    assert places == list(enumerate(np.concatenate([np.arange(k, 0, -1) for k in n if k]).tolist()))


def test_a_passage_that_a_third_of_the_rows_have(spark, documents):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"own{i} {passage} end{i}" if i % 3 == 0 else f"own{i} " + " ".join(f"d{i}x{j}" for j in range(36))) for i in range(900)]
    found = without_repeats(documents(docs), 35)
    assert {(r.doc_id % 3 == 0, r.n_removed) for r in found.collect()} == {(True, 40), (False, 0)}


def test_long_texts_and_empty_tables(spark, documents):
    assert without_repeats(documents([])).collect() == []
    assert without_repeats(documents([(1, None)])).first().n_words == 0
    long = " ".join(str(i) for i in range(400_000))
    docs = [(1, long), (2, "x " + " ".join(str(i) for i in range(350_000, 350_100))), (3, "y" * 3_000_000)]
    found = {r.doc_id: (r.n_words, r.n_removed) for r in without_repeats(documents(docs)).collect()}
    assert found == {1: (400_000, 100), 2: (101, 100), 3: (1, 0)}
