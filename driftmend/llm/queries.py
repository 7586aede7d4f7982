"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmend.llm import centroids, language, licenses
from driftmend.llm.decontamination import decontaminated
from driftmend.llm.filter_audit import filter_interactions
from driftmend.llm.near_duplicates import near_duplicates
from driftmend.llm.nearest import nearest
from driftmend.llm.packing import packed, token_pieces
from driftmend.llm.quality import learned, remainder, score_quality
from driftmend.llm.resharding import reshard_documents
from driftmend.llm.secrets import scan
from driftmend.llm.substrings import without_repeats
from driftmend.llm.suffix_tree import suffix_tree_scores
from driftmend.llm.texts import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a similarity of 85 % of 3-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores, learned from labelled documents outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = learned(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    found = suffix_tree_scores(docs, remainder("doc_id", 7) != 2)
    return found.withColumn("held_out", remainder("doc_id", 7) == 2)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of ten words of the benchmark."""
    return decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


ORACLES["op4_decontamination"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS words
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT r, p, places.n, item_id FROM places JOIN windows USING (words)),
covered AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(p, p + n)) AS place FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
found AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS joined FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@query
def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2048, with a checksum of each piece."""
    cut = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return packed(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048)


@query
def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 32 hashed shards to 40 of equal bytes, moving as few bytes as that takes."""
    return reshard_documents(table(spark, sf_dir, "documents"), old_shards=32, shards=40)


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all texts."""
    return scan(table(spark, sf_dir, "documents"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts, learned from three quarters of the documents."""
    docs = table(spark, sf_dir, "documents")
    network = language.learned(docs, remainder("doc_id", 4) != 2)
    found = language.identify(docs.select(F.col("doc_id").cast("long"), "text"), network)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op9_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows to every row whose vec_id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence texts and notices among all documents."""
    return licenses.license_digests(table(spark, sf_dir, "documents"))


ORACLES["op10_license_digests"] = licenses.oracle_sql()


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, in each of their 120 orders."""
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
marked AS (
    SELECT part, doc_id, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e
    FROM docs JOIN firsts USING (text)),
judged AS (
    SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
           coalesce(q.good, false) AS good, coalesce(q.toxic, false) AS toxic
    FROM marked LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) q USING (doc_id)),
counted AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits, p.f || q.f || r.f || s.f || t.f AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
      AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
lines AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (WHERE mask & (before + own) = 0), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM lines
"""


@query
def op11_equal_average_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in eight clusters, after ten rounds in whole numbers."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=8, rounds=10)


ORACLES["op11_equal_average_clusters"] = centroids.oracle_sql()


@query
def op12_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows of 35 that stand elsewhere too."""
    found = without_repeats(table(spark, sf_dir, "documents"), size=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op12_difference_cover"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, p, array_to_string(w[p:p + 34], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35)),
again AS (SELECT r, p FROM windows JOIN (SELECT words FROM windows GROUP BY words HAVING count(*) > 1) USING (words)),
covered AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS place FROM again),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS words
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs) ANTI JOIN covered USING (r, place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN (SELECT r, count(*) AS n FROM covered GROUP BY r) USING (r) LEFT JOIN kept USING (r)
"""
