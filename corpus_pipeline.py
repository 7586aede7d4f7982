"""A corpus pipeline of the training-data operators: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftmend.llm import language, secrets
from driftmend.llm.decontamination import contamination
from driftmend.llm.near_duplicates import SetSketch, near_duplicates
from driftmend.llm.packing import pack_documents
from driftmend.llm.texts import small_batches
from driftmend.sources.sinks import staged

#: Mean probability below which no language is credible.
LEAST_SCORE = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``docs`` has no such column."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that those with a ``lang`` teach; null texts and texts without a letter go.

    Where no document has a ``lang``, nothing can be learned and all documents stay.
    """
    small_batches(spark)
    network = language.learned(docs, F.lit(True))
    if network is None:
        return docs
    found, score = _free(docs, "_language"), _free(docs, "_language_score")
    known = language.identify(docs, network, found, score)
    return known.where((F.col(found) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their 5-word shingles, the one with the smallest id.

    Texts under one id are compared like any others, and of equal ones one stays; rows without an id come last in a
    group. Rows with neither an id nor a word all stay.
    """
    small_batches(spark)
    node = F.xxhash64("doc_id", "text")
    found = near_duplicates(docs.select(node.alias("doc_id"), "text"), shingle=5, percent=80, sketch=SetSketch(rows=4))
    ids = docs.select(node.alias("_node"), F.col("doc_id").alias("_id")).distinct()
    each = found.select(F.col("doc_id").alias("_node"), "component_id", "n_shingles").distinct().join(ids, "_node")
    order = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_node", "n_shingles")
    kept = each.groupBy("component_id").agg(F.min(order).alias("first")).select(
        F.col("first._node").alias("_kept_node"), (F.col("first.unnamed") & (F.col("first.n_shingles") == 0)).alias("_kept_all")
    )
    rank, own = _free(docs, "_rank"), _free(docs, "_node")
    one = Window.partitionBy(own).orderBy(F.xxhash64("text"))
    named = docs.withColumn(own, node).join(kept, F.col(own) == F.col("_kept_node")).withColumn(rank, F.row_number().over(one))
    return named.where((F.col(rank) == 1) | F.col("_kept_all")).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of a benchmark item."""
    small_batches(spark)
    _, hits = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id IS NOT NULL"), size=10)
    bad = hits.select(F.col("doc_id").alias("_bad_id"), F.col("digest").alias("_bad_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("text") == F.col("_bad_digest"))
    return docs.join(bad, same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their texts replaced by a mark; n_chars follows the text."""
    clean = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Trained models, sketches and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
