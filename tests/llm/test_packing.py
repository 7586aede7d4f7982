import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftmend.llm.packing import WordTokens, pack_documents, packed, plan

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n", "Hello, WORLD it's 42 o'clock", "éÉ ßẞ naïve café", "a b\u0085c\x1cd", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
    "İstanbul Σίσυφος ΟΔΟΣ", "é e ́", "日本語 テスト 123", "x" * 300, "we're they'll I'D 's's", "²³¼ ª º × ÷", "  　 ​",
    "word " * 5000, "a.b,c!d?e#f$g%h", "\x00 \x7f",
]


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def test_tokens_round_trip(spark, documents):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "lone")]
    found = pack_documents(documents(rows), PATH).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(TEXTS):
        own = sorted(by_doc[i], key=lambda r: r.start)
        if i != 3:
            assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids_of(text), text
            assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 2048 for r in own[:-1]) or i == 3
    assert len(by_doc[3]) == 2 and len(by_doc[None]) == 1
    check_places(found, 2048)


def check_places(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_up_the_histogram(seed):
    draw = random.Random(seed)
    capacity = draw.choice([64, 500, 2048])
    histogram = {draw.randrange(1, capacity + 1): draw.choice([1, 3, 1000]) for _ in range(draw.choice([1, 5, 200]))}
    chosen = plan(histogram, capacity)
    used = {}
    for pattern, n in chosen:
        assert sum(pattern) <= capacity and n > 0
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    # No worse than first fit, longest first.
    bins = []
    for length in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True)[:3000]:
        at = next((i for i, b in enumerate(bins) if b + length <= capacity), None)
        bins.append(length) if at is None else bins.__setitem__(at, bins[at] + length)
    if sum(histogram.values()) <= 3000:
        assert sum(n for _, n in chosen) <= len(bins) * 1.02 + 1


def test_many_lengths_pack_near_the_bound():
    draw = np.random.default_rng(1)
    lengths, counts = np.unique(draw.integers(1, 2049, 50_000), return_counts=True)
    chosen = plan(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), 2048)
    assert sum(n for _, n in chosen) <= np.ceil((lengths * counts).sum() / 2048) * 1.005


def test_groups_of_a_frequent_length_are_ranked_together(spark, monkeypatch):
    import driftmend.llm.packing as module

    monkeypatch.setattr(module, "GROUP", 50)
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 10).otherwise(F.col("id") % 7 + 1).cast("long").alias("length"))
    found = packed(rows, 32).collect()
    assert sorted(r.id for r in found) == list(range(1000))
    assert check_places(found, 32) == -(-sum(r.length for r in found) // 32)


def test_checksums_of_pieces(spark, documents):
    from driftmend.llm.packing import token_pieces

    rows = token_pieces(documents([(1, "ab " * 3000)]), PATH).withColumn("crc", F.crc32("ids")).collect()
    assert all(zlib.crc32(r.ids) == r.crc for r in rows) and len(rows) == 2


def test_other_tokenizers_get_whole_texts():
    other = WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    data = np.frombuffer(b"Hello world", np.uint8)
    assert [r.tolist() for r in other.rows(data, np.array([0, 11]))] == [other.whole.encode("Hello world", add_special_tokens=False).ids]


def test_empty_table(spark, documents):
    assert pack_documents(documents([]), PATH).collect() == []


def test_remembered_units_take_few_bytes_and_stay_right(monkeypatch):
    tokens = WordTokens(PATH)
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6000)) + " d'été 42" for _ in range(6)]

    def ids(own):
        data = np.frombuffer("".join(own).encode(), np.uint8)
        return list(tokens.rows(data, np.cumsum([0, *(len(t.encode()) for t in own)])))

    ids(["warm up"])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for text in texts:
        ids([text])
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 100 * 36_000
    for size in (WordTokens.KEPT, 5000):  # with the smaller number everything is forgotten again and again
        monkeypatch.setattr(WordTokens, "KEPT", size)
        for found, text in zip(ids(texts[:2]), texts[:2], strict=True):
            assert found.tolist() == ids_of(text)[:-1]


def test_the_plan_reaches_spark_without_python_rows(spark, documents, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a list of rows starts Python workers of its own")

    docs = documents([(1, "a b"), (2, None)])
    monkeypatch.setattr(spark.sparkContext, "parallelize", refuse)
    assert pack_documents(docs, PATH).count() == 2
    assert pack_documents(docs.where("doc_id = 5"), PATH).count() == 0
