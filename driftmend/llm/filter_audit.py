"""What each filter of a chain removes, for every order of the chain, as one aggregation of failure bits.

Five filters judge a text: A too few words, B too few distinct words, C too many capitals, D a character of mark-up,
E the same text as under a smaller id. A to D look at one row. E is an existential self-join: a left-semi join of the
rows with the first ids of texts that have several, on a hash, the exact text and a smaller id. Rows failing E are
stacked under the rows with their other failures, and each row's bits come together in one aggregation; so a row is
counted once however many filters it fails.

What an order of filters keeps follows from the numbers of rows per combination of bits: after the filters of a set
``P``, the rows that fail none of ``P`` are left. There are 32 such sets, so a part (a source) is one row of sums, and
its 600 lines (120 orders of five steps) are looked up in them.

Defined cases: a NULL text is empty; rows without an id neither fail E nor make others fail it, and rows of one id do
not either; a repeated row counts as often as it occurs; a document is labelled if any label of its id says so;
a NULL source is the empty string; a table without rows has no parts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.sources.sinks import staged

# The filters in the order of their bits.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(order) for order in permutations(FILTERS)]


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failures(text: Column) -> Column:
    """The bits A to D of a text that is not NULL."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 2 * F.char_length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }
    return sum((F.when(failed, bit(letter)).otherwise(0) for letter, failed in fails.items()), F.lit(0))


def repeated(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, text, _one, _two, ...) whose text stands under a smaller id as well.

    ``_one`` and ``_two`` are hashes of the text. Those with several ids are found first, from ids and hashes alone, and
    only texts with such hashes are compared; each task folds the copies it has of a text. What is looked up is written
    before each join: its size is then known, and as the joins keep or drop rows, adaptive execution splits those of a hot text.
    """
    same = ["_one", "_two"]
    several = rows.groupBy(*same).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last")
    suspects = staged(rows.join(staged(several.select(*same), "repeated-hashes"), same, "left_semi"), "suspects")
    first = staged(suspects.groupBy(*same, "text").agg(F.min("doc_id").alias("_first")), "first-ids")
    match = [suspects[c] == first[c] for c in (*same, "text")] + [first["_first"] < suspects["doc_id"]]
    return suspects.join(first, match, "left_semi")


def audited_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): each distinct (id, text, source) with its failure bits and its number of rows."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    ).withColumns({"_one": F.xxhash64("text"), "_two": F.xxhash64(F.lit(1), "text")})
    row = ["doc_id", "part", "_one", "_two"]
    own = rows.select(*row, failures(F.col("text")).alias("mask"), F.lit(1).alias("n"))
    again = repeated(rows).select(*row, F.lit(bit("E")).alias("mask"), F.lit(0).alias("n"))
    return own.unionByName(again).groupBy(*row).agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): one row per id."""
    return labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: what is kept, removed, redundant, failed by that filter only,
    labelled good or toxic among the removed, and the filter's removals over all orders."""
    rows = audited_rows(docs).join(labelled(labels), "doc_id", "left")
    counted = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )

    def total(count: Column, among: Column) -> Column:
        return F.coalesce(F.sum(F.when(among, count)), F.lit(0))

    mask = F.col("mask")
    left = {c: F.array(*[total(F.col(c), mask.bitwiseAND(p) == 0) for p in range(SUBSETS)]) for c in ("rows", "good", "toxic")}
    only = F.array(*[total(F.col("rows"), mask == bit(f)) for f in FILTERS])
    # Of the orders of all filters, one in as many as a row fails has this filter first among them.
    share = F.try_divide(F.lit(len(ORDERS)), F.bit_count(mask))
    first = F.array(*[total(F.col("rows") * share.cast("long"), mask.bitwiseAND(bit(f)) != 0) for f in FILTERS])
    sums = counted.groupBy("part").agg(*[v.alias(f"_{c}") for c, v in left.items()], only.alias("_only"), first.alias("_first"))
    lines = sums.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = f"instr('{FILTERS}', substr(filter_order, {{}}, 1))"
    lines = lines.withColumns(
        {
            "_place": F.expr(place.format("step")),
            "_after": F.expr(f"aggregate(transform(sequence(1, step), i -> shiftleft(1, {place.format('i')} - 1)), 0, (a, b) -> a | b)"),
        }
    ).withColumns({"_own": F.expr("shiftleft(1, _place - 1)"), "_before": F.expr("_after ^ shiftleft(1, _place - 1)")})
    at = lambda c, p: F.get(f"_{c}", F.col(p))
    removed = at("rows", "_before") - at("rows", "_after")
    return lines.select(
        "part",
        "filter_order",
        "step",
        at("rows", "_after").alias("kept"),
        removed.alias("removed"),
        (F.get("_rows", F.lit(0)) - at("rows", "_own") - removed).alias("redundant"),
        F.element_at("_only", F.col("_place")).alias("unique_fails"),
        (at("good", "_before") - at("good", "_after")).alias("good_lost"),
        (at("toxic", "_before") - at("toxic", "_after")).alias("toxic_lost"),
        F.element_at("_first", F.col("_place")).alias("shapley"),
    )
