import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from driftmend.llm.resharding import cheapest_flow, equal_capacities, moved_bytes, reshard_documents, resharded, rewrite


@pytest.mark.parametrize("seed", range(8))
def test_flows_fill_capacities_at_the_least_cost(seed):
    draw = random.Random(seed)
    sizes = {i: draw.randrange(0, 50) for i in range(draw.randrange(1, 6))}
    capacities = equal_capacities(sum(sizes.values()), draw.randrange(1, 7))
    flow = cheapest_flow(sizes, capacities)
    assert {i: sum(n for (a, _), n in flow.items() if a == i) for i in sizes} == sizes
    assert [sum(n for (_, b), n in flow.items() if b == j) for j in range(len(capacities))] == capacities
    # What exceeds a shard's new capacity must move, and no more.
    assert moved_bytes(flow) == sum(max(0, n - (capacities[i] if i < len(capacities) else 0)) for i, n in sizes.items())


def test_given_costs_agree_with_all_transfers():
    draw = random.Random(9)
    for _ in range(20):
        sizes, capacities = {0: 2, 1: 1, 2: 1}, [1, 2, 1]
        cost = {(i, j): draw.randrange(0, 9) for i in range(3) for j in range(3)}
        flow = cheapest_flow(sizes, capacities, cost)
        best = min(sum(cost[i, j] for i, j in zip((0, 0, 1, 2), order, strict=True)) for order in set(itertools.permutations((0, 1, 1, 2))))
        assert sum(cost[k] * n for k, n in flow.items()) == best


def test_documents_are_placed(spark, documents):
    draw = random.Random(3)
    rows = [(i, "é" * draw.randrange(0, 40)) for i in range(2000)] + [(5000, None), (5001, ""), (None, "x"), (7, "x"), (7, "x")]
    found = reshard_documents(documents(rows), 8, 10).collect()
    assert len(found) == len(rows)
    shards = {}
    for r in found:
        shards.setdefault(r.shard, []).append(r)
    total = sum(r["size"] for r in found)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 10) < 300
    assert sorted(shards) == list(range(10))
    texts = {i: t for i, t in rows if i != 7}
    for r in found:
        if r.doc_id in texts:
            data = (texts[r.doc_id] or "").encode()
            assert (r["size"], r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert r.old_shard == (zlib.crc32(str(r.doc_id).encode()) % 8 if r.doc_id is not None else 0)
    moved = sum(r["size"] for r in found if r.shard != r.old_shard)
    sizes = [sum(r["size"] for r in found if r.old_shard == i) for i in range(8)]
    assert abs(moved - sum(max(0, n - total / 10) for n in sizes)) < 600


def test_only_changed_shards_are_written(spark, tmp_path):
    rows = spark.range(300).select("id", F.when(F.col("id") < 100, 0).when(F.col("id") < 250, 1).otherwise(2).alias("home"), F.lit(1).alias("w"))
    done, flow = resharded(rows, 3, F.col("home"), F.col("w"), ["id"])
    changed = rewrite(done, flow, str(tmp_path / "out"), files=2)
    assert changed == [1, 2]
    written = spark.read.parquet(str(tmp_path / "out"))
    assert {r.shard: r["count"] for r in written.groupBy("shard").count().collect()} == {1: 100, 2: 100}


def test_empty_table(spark, documents):
    assert reshard_documents(documents([])).collect() == []
