"""Resharding by minimum-cost flow.

Old shards send their bytes to new shards of given capacities. A byte that stays in the shard of its number costs
nothing, every other one its move, and the cheapest flow says how many bytes go from each old shard to each new one. It
is solved over shards, so its size does not depend on the corpus. Rows of an old shard are laid out in blocks, large
rows first, and cut where the flow says; what moves is cut among the smallest rows, so capacities are met closely.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.sources.sinks import staged

BLOCK = 100_000


def equal_capacities(total: int, shards: int) -> list[int]:
    """``total`` in equal parts; the first ones get the odd bytes."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def cheapest_flow(sizes: Mapping[int, int], capacities: Sequence[int], cost: Mapping[tuple[int, int], int] | None = None) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard that fill the capacities at the least cost.

    A byte costs 0 where the numbers agree and 1 elsewhere, or what ``cost`` says. Paths of least cost are filled one
    after the other; potentials keep all costs non-negative, so each is found by Dijkstra's search. The capacities
    must add up to the sizes.
    """
    if sum(sizes.values()) != sum(capacities):
        raise ValueError("capacities must add up to the sizes of the old shards")
    old, new = sorted(sizes), range(len(capacities))
    price = lambda i, j: (cost or {}).get((i, j), 0 if i == j else 1)
    left = {i: sizes[i] for i in old}
    room = dict(enumerate(capacities))
    flow: dict[tuple[int, int], int] = {}
    # Bytes that stay cost least of all whatever the rest does, unless costs are given.
    if cost is None:
        for i in old:
            if n := min(left[i], room.get(i, 0)):
                flow[i, i] = n
                left[i] -= n
                room[i] -= n
    height = dict.fromkeys([("o", i) for i in old] + [("n", j) for j in new], 0)
    while sources := [i for i in old if left[i]]:
        far = {("o", i): 0 for i in sources}
        came: dict[tuple[str, int], tuple[str, int]] = {}
        heap, done = [(0, ("o", i)) for i in sources], {}
        while heap:
            d, at = heapq.heappop(heap)
            if at in done:
                continue
            done[at] = d
            side, k = at
            if side == "o":
                nexts = [(("n", j), price(k, j)) for j in new]
            else:
                nexts = [(("o", i), -price(i, k)) for i in old if flow.get((i, k))]
            for to, c in nexts:
                reached = d + c + height[at] - height[to]
                if to not in done and reached < far.get(to, 1 << 62):
                    far[to], came[to] = reached, at
                    heapq.heappush(heap, (reached, to))
        target = min((("n", j) for j in new if room[j]), key=lambda x: (done[x] + height[x], x))
        most = max(done.values())
        for x in height:
            height[x] += done.get(x, most)
        path, at = [], target
        while at in came:
            path.append((came[at], at))
            at = came[at]
        n = min([left[at[1]], room[target[1]], *(flow[b[1], a[1]] for a, b in path if a[0] == "n")])
        for a, b in path:
            edge, sign = ((a[1], b[1]), 1) if a[0] == "o" else ((b[1], a[1]), -1)
            flow[edge] = flow.get(edge, 0) + sign * n
        left[at[1]] -= n
        room[target[1]] -= n
    return {k: v for k, v in flow.items() if v}


def moved_bytes(flow: Mapping[tuple[int, int], int]) -> int:
    return sum(n for (i, j), n in flow.items() if i != j)


def _cuts(flow: Mapping[tuple[int, int], int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each old shard where each part of it ends and the new shard it goes to, the part that stays first."""
    parts: dict[int, list[tuple[int, int]]] = {}
    for (i, j), n in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        before = parts.setdefault(i, [])
        before.append(((before[-1][0] if before else 0) + n, j))
    return [(i, [*p[:-1], (1 << 62, p[-1][1])]) for i, p in parts.items()]


def resharded(rows: DataFrame, shards: int, old: Column, size: Column, key: Sequence[str]) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(``rows`` with old_shard, shard and slot, the flow between shards).

    ``old`` numbers a row's present shard, ``size`` is its bytes, ``key`` orders rows for a layout that does not depend
    on how they are read. New shards get equal bytes, up to a small row at each cut. slot numbers a shard's rows
    without gaps.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns]
    laid = rows.withColumns({"_old": old.cast("int"), "_size": size.cast("long")}).withColumn("_class", F.floor(F.log2(F.greatest("_size", F.lit(1)))).cast("int"))
    each = staged(laid, "sized")
    n_blocks = max(1, -(-each.count() // BLOCK))
    each = each.withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(n_blocks)))
    block = ["_old", "_class", "_block"]
    blocks = staged(each.groupBy(*block).agg(F.sum("_size").alias("_bytes")), "blocks")
    sizes = {r["_old"]: r["b"] for r in blocks.groupBy("_old").agg(F.sum("_bytes").alias("b")).collect()}
    flow = cheapest_flow(sizes, equal_capacities(sum(sizes.values()), shards))

    layout = Window.partitionBy("_old").orderBy(F.desc("_class"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select(*block, F.coalesce(F.sum("_bytes").over(layout), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy(*block).orderBy(*key)
    placed = each.withColumn("_order", F.row_number().over(inside)).withColumn(
        "_before", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")
    )
    cut = T.StructType([T.StructField("upto", T.LongType()), T.StructField("shard", T.IntegerType())])
    schema = T.StructType([T.StructField("_old", T.IntegerType()), T.StructField("_cuts", T.ArrayType(cut))])
    cuts = spark.createDataFrame(_cuts(flow), schema)  # one row per old shard
    middle = F.col("_begin") + F.col("_before") + F.col("_size") / 2
    goes = F.element_at(F.filter("_cuts", lambda c: middle < c["upto"]), 1)["shard"]
    sent = placed.join(begins, block).join(F.broadcast(cuts), "_old").withColumn("_shard", goes)
    sent = staged(sent.select(*own, *block, "_order", "_shard"), "placed")

    runs = sent.groupBy("_shard", *block).agg(F.count("*").alias("_n"), F.min("_order").alias("_first"))
    earlier = Window.partitionBy("_shard").orderBy("_old", F.desc("_class"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_shard", *block, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    # Rows of a block that go to one shard stand next to each other.
    slot = F.col("_earlier") + F.col("_order") - F.col("_first")
    done = sent.join(runs, ["_shard", *block]).select(*own, F.col("_old").alias("old_shard"), F.col("_shard").alias("shard"), slot.alias("slot"))
    return done, flow


def rewrite(done: DataFrame, flow: Mapping[tuple[int, int], int], path: str, files: int = 4) -> list[int]:
    """Write the shards whose rows change to ``path``/shard=N, each in ``files`` parts, and return their numbers.

    A shard that neither gains nor loses keeps its files and is not read into a new one.
    """
    changed = sorted({k for (i, j) in flow if i != j for k in (i, j)})
    rows = done.where(F.col("shard").isin(changed))
    part = F.pmod(F.col("slot"), F.lit(files))
    rows.repartition(max(1, files * len(changed)), "shard", part).write.partitionBy("shard").mode("overwrite").parquet(path)
    return changed


def reshard_documents(docs: DataFrame, old_shards: int = 32, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs`` (doc_id, text, ...).

    The present shard of a document is the crc32 of its id as text modulo ``old_shards``, 0 for a null id. size is the
    text's bytes (none for null) and 16. The law is ``bytes``: every shard gets an equal share of all bytes, and
    grown_shard, which belongs to another law, is null. text_crc32 of a null text is that of no bytes, 0. Repeated rows
    are placed once each, other columns of ``docs`` play no part, an empty table gives none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    home = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % old_shards, F.lit(0))
    done, _ = resharded(rows, shards, home, F.col("size"), ["doc_id", "text_crc32"])
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )
