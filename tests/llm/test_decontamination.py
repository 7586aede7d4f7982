import hashlib
import random
import re

from driftmend.llm.decontamination import decontaminated

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def expected(docs, items, size):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(size, len(own))
        for i in range(len(own) - n + 1) if n else ():
            windows.setdefault(tuple(own[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for window, of in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= of
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=str)


def test_agrees_with_brute_force(spark, documents):
    draw = random.Random(4)
    word = lambda: draw.choice("abcdefgh") * draw.randrange(1, 3)
    items = [(i, " ".join(word() for _ in range(draw.randrange(0, 30)))) for i in range(12)]
    items += [(90, "x1"), (91, "X1 é"), (92, ""), (93, None), (94, items[0][1]), (94, "zz " * 40)]
    docs = []
    for i in range(60):
        text = [word() for _ in range(draw.randrange(0, 80))]
        part = draw.choice(items)[1]
        docs.append((i, " ".join(text) + "-" + (part or "") + "; " + " ".join(text[:5])))
    docs += [(100, None), (101, ""), (102, "zz " * 200), (103, "X1É x1é"), (104, "x1 É"), (104, "x1 É"), (None, "x1")]
    benchmark = spark.createDataFrame([(i, t, "?") for i, t in items], "item_id long, text string, n_words string")
    found = decontaminated(documents(docs), benchmark)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(docs, items, 10)


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, "a b")])
    assert [(r.n_words, r.contaminated) for r in decontaminated(docs, benchmark).collect()] == [(2, False)]
    assert decontaminated(documents([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_an_item_without_id_has_no_windows(spark, documents):
    benchmark = spark.createDataFrame([(None, "a b c")], "item_id long, text string")
    assert not decontaminated(documents([(1, "a b c")]), benchmark).first().contaminated
