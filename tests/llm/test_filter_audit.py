import random
import re
from itertools import permutations

from driftmend.llm.filter_audit import filter_interactions

LABELS = "doc_id long, quality int, toxic int, part string"


def expected(docs, labels):
    rows = []
    for doc, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and any(i is not None and i < doc and (t or "") == text for i, t, _ in docs),
        }
        said = [(q, t) for i, q, t in labels if i == doc and doc is not None]
        rows.append((source or "", {f for f in fails if fails[f]}, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    out = []
    for part in {r[0] for r in rows}:
        removals = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left, gone = [r for r in rows if r[0] == part], []
            for step, f in enumerate(order, start=1):
                now = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                lines.append((part, "".join(order), step, len(left), len(now), sum(f in r[1] for r in gone), sum(r[1] == {f} for r in rows if r[0] == part), sum(r[2] for r in now), sum(r[3] for r in now)))
                gone += now
                removals[f] += len(now)
        out += [(*line, removals[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def test_agrees_with_brute_force(spark, documents):
    draw = random.Random(13)
    texts = []
    for _ in range(40):
        pool = [draw.choice(["word", "Word", "x#", "WORD", "a|b", "plain", "text"]) + str(i) for i in range(draw.choice([20, 150, 300]))]
        texts.append("\t ".join(draw.choice(pool) for _ in range(draw.choice([10, 199, 200, 260]))))
    texts += ["", None, " \n\x0b", "é" * 300, " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 101}" for i in range(203))]
    docs = [(i, draw.choice(texts), draw.choice(["a", "b", None, ""])) for i in range(150)]
    docs += [(None, texts[0], "a"), (None, texts[0], "a"), (7, texts[1], "a"), (7, texts[1], "a"), (7, texts[2], "b"), docs[3], docs[3]]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame([(i, t, s, "x", "x", 1) for i, t, s in docs], "doc_id long, text string, source string, mask string, part string, n int")
    found = filter_interactions(table, spark.createDataFrame([(*r, "x") for r in labels], LABELS))
    assert sorted(tuple(r) for r in found.collect()) == expected(docs, labels)


def test_a_text_that_most_rows_have(spark):
    docs = [(i, "same text" if i % 3 else f"text {i}", "s") for i in range(3000)]
    found = filter_interactions(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame([], LABELS))
    assert found.where("filter_order = 'EABCD' AND step = 1").first().removed == 1999


def test_empty_tables(spark, documents):
    empty = spark.createDataFrame([], LABELS)
    assert filter_interactions(documents([]), empty).collect() == []
    found = filter_interactions(documents([(1, None)]), empty).collect()
    assert len(found) == 600 and {r.removed for r in found if r.filter_order[r.step - 1] == "A"} == {1}


def test_a_long_text(spark, documents):
    docs = documents([(1, "Aa " * 700_000), (2, "Aa " * 700_000), (3, "x" * 2_000_000)])
    found = filter_interactions(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'EDCBA'").orderBy("step").collect()
    assert [r.removed for r in found] == [1, 0, 1, 0, 1]
