import random

import numpy as np

from driftmend.llm.graph import components, joined_components
from driftmend.llm.near_duplicates import SetSketch, near_duplicates
from driftmend.llm.texts import mixed, numbers


def shingles(text, k):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def expected(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def variants(draw, n_groups, copies, words):
    rows, vocabulary = [], [f"w{i}" for i in range(4000)]
    for _ in range(n_groups):
        base = [draw.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(0, 6)):
                own[draw.randrange(words)] = draw.choice(vocabulary)
            rows.append(" ".join(own))
    return rows


def test_agrees_with_all_pairs(spark, documents):
    draw = random.Random(1)
    texts = variants(draw, 6, 25, 100) + variants(draw, 2, 8, 12) + ["", " \n ", "one", "ONE", "one two", "two one", "é É ß", "É é ß"]
    rows = list(enumerate(texts))
    for k, percent, sketch in ((3, 85, None), (5, 80, SetSketch(rows=4))):
        found = near_duplicates(documents(rows), k, percent, sketch)
        assert {tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()} == expected(rows, k, percent)


def test_one_large_group_of_unlike_copies(spark, documents):
    """Copies whose links do not all go through the smallest one."""
    draw = random.Random(2)
    rows = list(enumerate(variants(draw, 1, 300, 60)))
    found = near_duplicates(documents(rows), 3, 85)
    assert {tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()} == expected(rows, 3, 85)


def test_odd_rows(spark, documents):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, None), (8, ""), (9, long), (10, long), (3, "A B  C\td")]
    found = near_duplicates(documents(rows)).orderBy("doc_id", "n_shingles").collect()
    by_id = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found]
    assert by_id == [
        (None, 2, None, True), (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False),
        (7, 0, 7, True), (8, 0, 8, True), (9, 5000, 9, True), (10, 5000, 9, False),
    ]


def test_empty_table(spark, documents):
    assert near_duplicates(documents([])).collect() == []


def test_sketches_merge_and_estimate():
    sketch = SetSketch(rows=8, bands=64)
    all_of = mixed(np.arange(3000, dtype=np.uint64) + numbers(3, 1))
    one, other = all_of[:2000], all_of[1000:]
    a, b = sketch.of(one), sketch.of(other)
    assert (SetSketch.merged(a, b) == sketch.of(all_of)).all()
    args = [np.array([x]) for x in ((a > b).sum(), (a < b).sum(), 2000, 2000)]
    assert abs(sketch.estimate(*args)[0] - 1 / 3) < 0.08
    assert not sketch.plausible(*args, 0.85)[0][0]
    same = [np.array([x]) for x in (0, 0, 2000, 2000)]
    assert sketch.plausible(*same, 0.85)[0][0]


def test_components_of_chains_and_joins(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (None, 3), (7, 7)]
    found = components(spark.createDataFrame(chain, "a long, b long"))
    assert dict(found.collect()) == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    more = joined_components(found, spark.createDataFrame([(40, 101), (200, 201), (5, 201)], "a long, b long"))
    assert dict(more.collect()) == {i: 0 for i in range(41)} | {100: 0, 101: 0, 200: 0, 201: 0}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
