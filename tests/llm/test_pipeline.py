import importlib
import os
import random
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sentence(draw, letters, n=60):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(3, 8))) for _ in range(n))


@pytest.fixture
def folder(spark, documents, tmp_path):
    draw = random.Random(8)
    rows = []
    for i in range(160):
        letters, lang = ("abcdehiost", "en") if i % 2 else ("éèagnlruvx", "fr")
        rows.append((i, sentence(draw, letters), lang))
    item = sentence(draw, "mnopqrst", 20)
    near = rows[10][1].split(" ")
    near[30] = "changed"
    rows += [(1000, rows[4][1], "fr"), (1001, " ".join(near), "fr"), (1002, "??? 12", "en"), (1003, None, "en"), (1004, rows[7][1] + " " + item, "en")]
    rows += [(1005, sentence(draw, "abcdehiost") + " token = zyxwvut987 end", None), (20, rows[20][1], "fr"), (None, sentence(draw, "abcdehiost"), "en")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_takes_effect_and_clean_documents_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.columns == columns
        kept[name] = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    start = sorted([*map(str, range(160)), "20", "1000", "1001", "1002", "1003", "1004", "1005", "None"])
    without = lambda rows, *gone: [x for x in rows if x not in gone]
    assert kept["language"] == without(start, "1002", "1003")
    assert kept["near_duplicates"] == sorted({*without(kept["language"], "1000", "1001")})
    assert kept["decontamination"] == without(kept["near_duplicates"], "1004")
    assert kept["secrets"] == kept["decontamination"]
    masked = docs.where("doc_id = 1005").first()
    assert masked.text.endswith(" [SECRET] end") and masked.n_chars == len(masked.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted({str(r.doc_id) for r in packed}) == kept["secrets"]


def test_run_gives_the_last_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    assert found.count() == 162


def test_empty_documents(spark, documents, tmp_path):
    documents([], clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_rest_works_without_the_subpackage(tmp_path):
    rest = tmp_path / "repo"
    shutil.copytree(HERE, rest, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'row_diff' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q), sorted(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=rest, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_stages_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))


def test_texts_under_one_id_or_none_are_documents_of_their_own(spark, documents):
    draw = random.Random(9)
    a, b, c, d = (sentence(draw, "abcdehiost") for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (6, c), (7, c), (6, d), (None, d), (None, b + " more"), (None, c[::-1]), (None, c[::-1]), (None, None), (None, None), (8, ""), (8, "")]
    found = corpus_pipeline.drop_near_duplicates(spark, documents(rows), "").collect()
    expected = [(3, a), (5, b), (6, c), (6, d), (None, c[::-1]), (None, None), (None, None), (8, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in found))) == sorted(map(str, expected))
