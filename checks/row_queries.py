"""Queries that compare keys and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import driftmend as dm
from checks.registry import query
from checks.sql import (
    GIVEN_CONVERSATIONS,
    GIVEN_DOCUMENTS,
    GIVEN_ORDERS,
    ORDER_VALUES,
    diff,
    differing,
)
from checks.tables import Tables

ORDER_KEY = ["o_orderkey"]
CONVERSATION_KEY = ["conv_id", "turn"]
_MISSING_ORDERS = "SELECT o_orderkey FROM orders t WHERE NOT EXISTS (SELECT 1 FROM given_orders g WHERE g.o_orderkey = t.o_orderkey)"


@query(f"WITH {GIVEN_ORDERS} {_MISSING_ORDERS}")
def missing_keys(t: Tables) -> DataFrame:
    return dm.missing_keys(t.orders, t.given_orders(), ORDER_KEY)


@query(f"""WITH {GIVEN_CONVERSATIONS}
SELECT conv_id, turn FROM conversations t
WHERE NOT EXISTS (SELECT 1 FROM given_conversations g WHERE g.conv_id = t.conv_id AND g.turn = t.turn)""")
def missing_keys_composite(t: Tables) -> DataFrame:
    return dm.missing_keys(t.conversations, t.given_conversations(), CONVERSATION_KEY)


@query(f"""WITH {GIVEN_DOCUMENTS}
SELECT text FROM documents EXCEPT SELECT text FROM given_documents""")
def missing_keys_text(t: Tables) -> DataFrame:
    """A text as the key, with as many rows per key as there are copies."""
    return dm.missing_keys(t.documents, t.given_documents(), ["text"])


@query(f"WITH {GIVEN_ORDERS} SELECT count(*) AS unsynced FROM ({_MISSING_ORDERS})")
def unsynced_count(t: Tables) -> DataFrame:
    return dm.unsynced_count(t.orders, t.given_orders(), ORDER_KEY)


@query(f"""WITH {GIVEN_ORDERS}
SELECT o_orderkey FROM given_orders g WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = g.o_orderkey)""")
def reverse_missing_keys(t: Tables) -> DataFrame:
    return dm.missing_keys(t.given_orders(), t.orders, ORDER_KEY)


@query(f"""WITH {GIVEN_ORDERS}
SELECT coalesce(t.o_custkey, g.o_custkey) AS o_custkey, coalesce(n_target, 0) AS n_target, coalesce(n_given, 0) AS n_given
FROM (SELECT o_custkey, count(*) AS n_target FROM orders GROUP BY o_custkey) t
FULL JOIN (SELECT o_custkey, count(*) AS n_given FROM given_orders GROUP BY o_custkey) g ON t.o_custkey = g.o_custkey""")
def key_presence(t: Tables) -> DataFrame:
    return dm.key_presence(t.orders, t.given_orders(), ["o_custkey"])


_PROFILE = """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
       CAST(coalesce(sum(n) FILTER (WHERE {null}), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})"""


def _profile(df: DataFrame, keys: list[str]) -> DataFrame:
    return dm.key_profile(df, keys).withColumnRenamed("rows", "n_rows")


@query(_PROFILE.format(keys="l_orderkey, l_linenumber", table="lineitem", null="l_orderkey IS NULL OR l_linenumber IS NULL"))
def key_profile(t: Tables) -> DataFrame:
    return _profile(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    f"WITH {GIVEN_ORDERS} "
    + _PROFILE.format(keys="o_orderstatus, o_custkey", table="given_orders", null="o_orderstatus IS NULL OR o_custkey IS NULL")
)
def key_profile_with_nulls(t: Tables) -> DataFrame:
    return _profile(t.given_orders(), ["o_orderstatus", "o_custkey"])


@query(f"""WITH {GIVEN_ORDERS}
SELECT (SELECT count(*) = count(DISTINCT o_orderkey) AND count(*) = count(o_orderkey) FROM orders)
   AND (SELECT count(*) = count(DISTINCT o_orderkey) AND count(*) = count(o_orderkey) FROM given_orders) AS holds""")
def primary_key_holds(t: Tables) -> DataFrame:
    return dm.primary_key_holds(t.orders, t.given_orders(), ORDER_KEY)


_PARENTS = "parent_customer AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)"


@query(f"""WITH {_PARENTS}
SELECT * FROM orders WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM parent_customer WHERE c_custkey = o_custkey)""")
def orphan_rows(t: Tables) -> DataFrame:
    return dm.orphan_rows(t.orders, t.parent_customer(), ["o_custkey"], ["c_custkey"])


@query(f"""WITH {_PARENTS}
SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM parent_customer WHERE c_custkey = o_custkey) GROUP BY o_custkey""")
def orphan_keys(t: Tables) -> DataFrame:
    return dm.orphan_keys(t.orders, t.parent_customer(), ["o_custkey"], ["c_custkey"])


def _listed(found: DataFrame) -> DataFrame:
    return found.withColumn("changed_cols", F.concat_ws(",", "changed_cols"))


_ORDER_DIFF = diff("orders", "given_orders", ORDER_KEY, ORDER_VALUES)
_CHANGED_ORDERS = diff("orders", "given_orders", ORDER_KEY, ORDER_VALUES, same=False)


@query(f"WITH {GIVEN_ORDERS} {_ORDER_DIFF}")
def row_diff(t: Tables) -> DataFrame:
    return _listed(dm.row_diff(t.orders, t.given_orders(), ORDER_KEY))


@query(f"WITH {GIVEN_ORDERS} {_ORDER_DIFF}")
def row_diff_on_primary_key(t: Tables) -> DataFrame:
    return _listed(dm.row_diff(t.orders, t.given_orders(), ORDER_KEY, primary_key=True))


@query(f"WITH {GIVEN_CONVERSATIONS} {diff('conversations', 'given_conversations', CONVERSATION_KEY, ['role', 'text'])}")
def row_diff_composite(t: Tables) -> DataFrame:
    return _listed(dm.row_diff(t.conversations, t.given_conversations(), CONVERSATION_KEY))


@query(f"WITH {GIVEN_DOCUMENTS} {diff('documents', 'given_documents', ['doc_id'], ['text', 'lang', 'source', 'n_chars'], same=False)}")
def row_diff_text(t: Tables) -> DataFrame:
    return _listed(dm.row_diff(t.documents, t.given_documents(), ["doc_id"], include_same=False))


@query(f"""WITH given_embeddings AS (
  SELECT vec_id, CASE WHEN label = 1 THEN list_reverse(embedding) ELSE embedding END AS embedding, label FROM embeddings)
{diff('embeddings', 'given_embeddings', ['vec_id'], ['embedding', 'label'])}""")
def row_diff_nested(t: Tables) -> DataFrame:
    return _listed(dm.row_diff(t.embeddings, t.given_embeddings(), ["vec_id"]))


@query(f"""WITH drifted AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 3 <> 0),
t AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey),
g AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS o_orderkey FROM drifted GROUP BY o_custkey)
SELECT coalesce(t.o_custkey, g.o_custkey) AS o_custkey,
       CASE WHEN t.n > 1 OR g.n > 1 THEN 'duplicate_key' WHEN g.n IS NULL THEN 'missing_in_given'
            WHEN t.n IS NULL THEN 'only_in_given'
            WHEN t.o_orderkey IS DISTINCT FROM g.o_orderkey THEN 'changed' ELSE 'same' END AS status,
       '' AS changed_cols
FROM t FULL JOIN g ON t.o_custkey = g.o_custkey""")
def row_diff_repeated_keys(t: Tables) -> DataFrame:
    """A column with several rows per value taken for a key."""
    return _listed(dm.row_diff(t.orders, t.orders.where(F.col("o_custkey") % 3 != 0), ["o_custkey"]))


# Values whose common type must hold both: 2^53 and more as bigint and double, wide and fine decimals, days and instants.
@query("""SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 2 = 1 OR o_orderkey % 4 = 0 THEN 'changed' ELSE 'same' END AS status,
  concat_ws(',', CASE WHEN o_orderkey % 10 = 0 THEN 'exact' END, CASE WHEN o_orderkey % 2 = 1 THEN 'large' END,
            CASE WHEN o_orderkey % 4 = 0 THEN 'day' END) AS changed_cols FROM orders""")
def row_diff_unlike_types(t: Tables) -> DataFrame:
    key, power = F.col("o_orderkey"), F.lit(2**53)
    day = F.to_date("o_orderdate")
    target = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("exact"), (power + key).alias("large"), F.col("o_custkey").cast("decimal(38,0)").alias("wide"),
        day.alias("day"), F.lit("10000000000000000000000000").cast("decimal(38,0)").alias("huge"),
    )
    odd = F.when(key % 10 == 0, F.lit("0.5")).otherwise(F.lit("0")).cast("decimal(30,2)")
    given = t.orders.select(
        "o_orderkey",
        (F.col("o_custkey").cast("decimal(20,0)") + odd).cast("decimal(30,2)").alias("exact"),
        (power + key - key % 2).cast("double").alias("large"),
        F.col("o_custkey").cast("decimal(38,18)").alias("wide"),
        (day.cast("timestamp_ntz") + F.when(key % 4 == 0, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))).alias("day"),
        F.lit("10000000000000000000000000").cast("decimal(30,2)").alias("huge"),
    )
    return _listed(dm.row_diff(target, given, ORDER_KEY))


_STATUSES = ("missing_in_given", "only_in_given", "changed", "same")


@query(f"""WITH {GIVEN_ORDERS}
SELECT (SELECT count(*) FROM orders) AS rows_target, (SELECT count(*) FROM given_orders) AS rows_given,
       {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in _STATUSES)}, CAST(0 AS BIGINT) AS duplicate_key
FROM ({_ORDER_DIFF})""")
def status_counts(t: Tables) -> DataFrame:
    return dm.status_counts(t.orders, t.given_orders(), ORDER_KEY)


@query(f"""WITH {GIVEN_ORDERS}
SELECT o_orderkey, 'o_orderstatus' AS column_name, t.o_orderstatus AS target_value, g.o_orderstatus AS given_value
FROM orders t JOIN given_orders g USING (o_orderkey) WHERE t.o_orderstatus IS DISTINCT FROM g.o_orderstatus
UNION ALL
SELECT o_orderkey, 'o_totalprice', CAST(CAST(t.o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(g.o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
FROM orders t JOIN given_orders g USING (o_orderkey) WHERE t.o_totalprice IS DISTINCT FROM g.o_totalprice""")
def conflicts(t: Tables) -> DataFrame:
    """All differing cells; prices are shown with two decimals, as engines spell doubles in their own ways."""
    found = dm.conflicts(t.orders, t.given_orders(), ORDER_KEY)
    price = F.col("column") == "o_totalprice"
    shown = {c: F.when(price, F.col(c).cast("double").cast("decimal(18,2)").cast("string")).otherwise(F.col(c)) for c in ("target_value", "given_value")}
    return found.withColumns(shown).withColumnRenamed("column", "column_name")


@query("""WITH g AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_custkey)
SELECT o_custkey, CAST(NULL AS VARCHAR) AS column_name, concat(count(*), ' rows') AS target_value, concat(any_value(n), ' rows') AS given_value
FROM orders JOIN g USING (o_custkey) GROUP BY o_custkey HAVING count(*) > 1""")
def conflicts_repeated_keys(t: Tables) -> DataFrame:
    """A column with several rows per value taken for a key: one row for each such key that both sides have."""
    found = dm.conflicts(t.orders, t.orders.where(F.col("o_orderkey") % 3 != 0), ["o_custkey"])
    return found.withColumnRenamed("column", "column_name")


@query(f"""WITH {GIVEN_ORDERS}
SELECT o_orderkey, 'o_orderstatus' AS column_name FROM orders t JOIN given_orders g USING (o_orderkey)
WHERE t.o_orderstatus IS DISTINCT FROM g.o_orderstatus
UNION ALL
SELECT o_orderkey, 'o_totalprice' FROM orders t JOIN given_orders g USING (o_orderkey)
WHERE t.o_totalprice IS DISTINCT FROM g.o_totalprice""")
def conflict_cells(t: Tables) -> DataFrame:
    found = dm.conflicts(t.orders, t.given_orders(), ORDER_KEY, primary_key=True)
    return found.select("o_orderkey", F.col("column").alias("column_name"))


_SIDES = ", ".join(f"{side}.{c} AS {name}_{c}" for name, side in (("before", "g"), ("after", "t")) for c in ORDER_VALUES)
LOG = f"""SELECT coalesce(t.o_orderkey, g.o_orderkey) AS o_orderkey,
       CASE WHEN g.o_orderkey IS NULL THEN 'insert' WHEN t.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS op, {_SIDES}
FROM orders t FULL JOIN given_orders g ON t.o_orderkey = g.o_orderkey
WHERE t.o_orderkey IS NULL OR g.o_orderkey IS NULL OR {differing(ORDER_VALUES)}"""


def flat_log(log: DataFrame) -> DataFrame:
    return log.select(
        "o_orderkey", "op", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ORDER_VALUES]
    )


@query(f"WITH {GIVEN_ORDERS} {LOG}")
def change_log(t: Tables) -> DataFrame:
    return flat_log(dm.change_log(t.orders, t.given_orders(), ORDER_KEY))


@query(f"WITH {GIVEN_ORDERS} SELECT * FROM ({LOG}) WHERE op <> 'delete'")
def change_log_upsert(t: Tables) -> DataFrame:
    return flat_log(dm.change_log(t.orders, t.given_orders(), ORDER_KEY, primary_key=True, ops=("insert", "update")))


@query("""SELECT *, count(*) AS n_target, CAST(0 AS BIGINT) AS n_given FROM lineitem WHERE l_partkey % 9 = 0 GROUP BY ALL""")
def bag_diff(t: Tables) -> DataFrame:
    return dm.bag_diff(t.lineitem, t.given_lines())


@query("SELECT * FROM (FROM lineitem EXCEPT ALL FROM lineitem WHERE l_partkey % 9 <> 0)")
def bag_diff_rows(t: Tables) -> DataFrame:
    """The surplus rows of target, each as often as it is surplus."""
    found = dm.bag_diff(t.lineitem, t.given_lines())
    surplus = (F.col("n_target") - F.col("n_given")).cast("int")
    repeated = found.where(surplus > 0).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), surplus)))
    return repeated.select(t.lineitem.columns)


@query(f"WITH {GIVEN_ORDERS} {_CHANGED_ORDERS}")
def bucket_diff(t: Tables) -> DataFrame:
    return _listed(dm.bucket_diff(t.orders, t.given_orders(), ORDER_KEY, n=1024))


@query(f"WITH {GIVEN_DOCUMENTS} {diff('documents', 'given_documents', ['doc_id'], ['text', 'lang', 'source', 'n_chars'], same=False)}")
def bucket_diff_text(t: Tables) -> DataFrame:
    return _listed(dm.bucket_diff(t.documents, t.given_documents(), ["doc_id"], primary_key=True))


@query("""SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unlike_itself, true AS differs_from_given FROM orders""")
def bucket_digest(t: Tables) -> DataFrame:
    """The digests themselves have no twin in SQL: those of the same rows read in another order are the same, and those
    of rows altered in one column only are not."""
    digests = dm.bucket_digest(t.orders, ORDER_KEY, 256)
    again = dm.bucket_digest(t.orders.repartition(7, "o_custkey"), ORDER_KEY, 256)
    altered = t.orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")))
    unlike = dm.differing_buckets(digests, again).agg(F.count("*")).scalar()
    differs = dm.differing_buckets(digests, dm.bucket_digest(altered, ORDER_KEY, 256)).exists()
    return digests.agg(F.sum("n_rows").alias("n_rows")).select("n_rows", unlike.alias("n_unlike_itself"), differs.alias("differs_from_given"))


@query(f"WITH {GIVEN_ORDERS} SELECT o_orderkey, status FROM ({_ORDER_DIFF})")
def digest_diff(t: Tables) -> DataFrame:
    return dm.digest_diff(t.orders, t.given_orders(), ORDER_KEY, include_same=True)


@query(f"WITH {GIVEN_DOCUMENTS} SELECT doc_id, status FROM ({diff('documents', 'given_documents', ['doc_id'], ['text', 'lang', 'source', 'n_chars'], same=False)})")
def digest_diff_text(t: Tables) -> DataFrame:
    """Whole texts compared, only their digests shuffled."""
    return dm.digest_diff(t.documents, t.given_documents(), ["doc_id"])
