"""Queries that bring two sides together, and whole audits."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import driftmend as dm
from checks.catalog_queries import (
    MISSING_COLUMNS,
    MISSING_DEPENDENCIES,
    MISSING_TABLES,
    NULLABILITY_MISMATCHES,
    TYPE_MISMATCHES,
)
from checks.registry import query
from checks.row_queries import LOG, flat_log
from checks.sql import GIVEN_CONVERSATIONS, GIVEN_EVENTS, GIVEN_ORDERS, ORDER_COLUMNS, ORDER_VALUES, union_all
from checks.tables import LOOKBACK, Tables
from driftmend.functions.frames import stacked
from driftmend.sources.sinks import work_folder

ORDER_KEY = ["o_orderkey"]
_ALL = ", ".join(ORDER_COLUMNS)
_NOT_GIVEN = f"SELECT {_ALL} FROM orders t WHERE NOT EXISTS (SELECT 1 FROM given_orders g WHERE g.o_orderkey = t.o_orderkey)"
_ONLY_GIVEN = f"SELECT {_ALL} FROM given_orders g WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = g.o_orderkey)"
_INSERTED = f"WITH {GIVEN_ORDERS} SELECT {_ALL} FROM given_orders UNION ALL {_NOT_GIVEN}"
_UPSERTED = f"WITH {GIVEN_ORDERS} SELECT {_ALL} FROM orders UNION ALL {_ONLY_GIVEN}"


@query(_INSERTED)
def sync_insert(t: Tables) -> DataFrame:
    return dm.sync(t.orders, t.given_orders(), ORDER_KEY)


@query(_UPSERTED)
def sync_upsert(t: Tables) -> DataFrame:
    return dm.sync(t.orders, t.given_orders(), ORDER_KEY, mode="upsert")


@query(f"""WITH {GIVEN_ORDERS} SELECT 'state' AS part, {_ALL} FROM orders
UNION ALL SELECT 'delete' AS part, * FROM ({_ONLY_GIVEN})""")
def sync_mirror(t: Tables) -> DataFrame:
    """The mirrored state, and the rows of given it removes."""
    state = dm.sync(t.orders, t.given_orders(), ORDER_KEY, mode="mirror")
    gone = dm.rows_to_delete(t.orders, t.given_orders(), ORDER_KEY)
    return state.withColumn("part", F.lit("state")).unionByName(gone.withColumn("part", F.lit("delete")))


@query(f"WITH {GIVEN_ORDERS} {_NOT_GIVEN}")
def rows_to_insert(t: Tables) -> DataFrame:
    return dm.rows_to_insert(t.orders, t.given_orders(), ORDER_KEY, primary_key=True)


@query(f"WITH {GIVEN_ORDERS} {_ONLY_GIVEN}")
def rows_to_delete(t: Tables) -> DataFrame:
    return dm.rows_to_delete(t.orders, t.given_orders(), ORDER_KEY)


@query(f"SELECT {_ALL} FROM orders")
def sync_repeated_keys(t: Tables) -> DataFrame:
    """A column with several rows per value taken for a key: every row comes through."""
    return dm.sync(t.orders, t.orders.where(F.col("o_custkey") % 3 != 0), ["o_custkey"])


def _applied(t: Tables, mode: str, key: str) -> DataFrame:
    """Given with a run's change log applied to it, row by row."""
    given = t.given_orders()
    run = dm.run_sync(t.orders, given, [key], work_folder(t.spark, "sync"), mode=mode)
    log = t.spark.read.parquet(run.changes)
    gone = log.where("before IS NOT NULL").select(key, "before.*").select(given.columns)
    come = log.where("after IS NOT NULL").select(key, "after.*").select(given.columns)
    return given.exceptAll(gone).unionByName(come)


@query(f"SELECT {_ALL} FROM orders")
def mirror_log_applied_repeated_keys(t: Tables) -> DataFrame:
    return _applied(t, "mirror", "o_custkey")


@query(f"""WITH {GIVEN_ORDERS} SELECT {_ALL} FROM orders UNION ALL
SELECT {_ALL} FROM given_orders g WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_custkey = g.o_custkey)""")
def upsert_log_applied_repeated_keys(t: Tables) -> DataFrame:
    return _applied(t, "upsert", "o_custkey")


@query(_INSERTED)
def insert_log_applied(t: Tables) -> DataFrame:
    return _applied(t, "insert_missing", "o_orderkey")


@query(_INSERTED)
def run_sync_insert(t: Tables) -> DataFrame:
    run = dm.run_sync(t.orders, t.given_orders(), ORDER_KEY, work_folder(t.spark, "sync"))
    return t.spark.read.parquet(run.state)


@query(_UPSERTED)
def run_sync_upsert(t: Tables) -> DataFrame:
    run = dm.run_sync(t.orders, t.given_orders(), ORDER_KEY, work_folder(t.spark, "sync"), mode="upsert")
    return t.spark.read.parquet(run.state)


@query(f"WITH {GIVEN_ORDERS} {LOG}")
def run_sync_changes(t: Tables) -> DataFrame:
    """The change log a mirror leaves behind."""
    run = dm.run_sync(t.orders, t.given_orders(), ORDER_KEY, work_folder(t.spark, "sync"), mode="mirror")
    return flat_log(t.spark.read.parquet(run.changes))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def copy_table(t: Tables) -> DataFrame:
    folder = work_folder(t.spark, "copy")
    dm.copy_table(t.customer, folder)
    return t.spark.read.parquet(folder)


def _joined(settle: str, target: str = "orders", given: str = "given_orders") -> str:
    """A full join of the two sides with each value column settled by the text ``settle``."""
    values = ", ".join(f"{settle.format(t=f't.{c}', g=f'g.{c}')} AS {c}" for c in ORDER_VALUES)
    return (
        f"WITH {GIVEN_ORDERS} SELECT coalesce(t.o_orderkey, g.o_orderkey) AS o_orderkey, {values} "
        f"FROM {target} t FULL JOIN {given} g ON t.o_orderkey = g.o_orderkey"
    )


_GIVEN_WINS = _joined("CASE WHEN g.o_orderkey IS NOT NULL THEN {g} ELSE {t} END")
_LATEST = _joined(
    "CASE WHEN t.o_orderkey IS NOT NULL AND (g.o_orderkey IS NULL OR g.o_totalprice IS NULL "
    "OR t.o_totalprice >= g.o_totalprice) THEN {t} ELSE {g} END"
)
_FILLED = _joined("coalesce({t}, {g})", "given_orders", "orders")


@query(_UPSERTED)
def merge_target_wins(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(t.orders, t.given_orders(), ORDER_KEY, "target_wins")


@query(_GIVEN_WINS)
def merge_given_wins(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(t.orders, t.given_orders(), ORDER_KEY, "given_wins")


@query(_LATEST)
def merge_latest(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(t.orders, t.given_orders(), ORDER_KEY, "latest", version="o_totalprice")


@query(_LATEST)
def merge_latest_on_primary_key(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(
        t.orders, t.given_orders(), ORDER_KEY, "latest", version="o_totalprice", primary_key=True
    )


@query(_FILLED)
def merge_fill_nulls(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(t.given_orders(), t.orders, ORDER_KEY, "fill_nulls")


@query(_FILLED)
def merge_fill_nulls_on_primary_key(t: Tables) -> DataFrame:
    return dm.merge_bidirectional(t.given_orders(), t.orders, ORDER_KEY, "fill_nulls", primary_key=True)


def _incremental(lookback: str) -> str:
    return f"""SELECT * FROM events t
WHERE t.ts >= (SELECT max(ts) FROM given_events) - {lookback}"""


_UNSEEN = "NOT EXISTS (SELECT 1 FROM given_events g WHERE g.event_id = t.event_id)"
_THREE_DAYS = "INTERVAL 3 DAY"


@query(f"WITH {GIVEN_EVENTS} {_incremental(_THREE_DAYS)}")
def sync_candidates(t: Tables) -> DataFrame:
    return dm.sync_candidates(t.events, t.given_events(), "ts", LOOKBACK)


@query(f"WITH {GIVEN_EVENTS} SELECT * FROM given_events UNION ALL {_incremental(_THREE_DAYS)} AND {_UNSEEN}")
def incremental_sync(t: Tables) -> DataFrame:
    return dm.incremental_sync(t.events, t.given_events(), ["event_id"], "ts", LOOKBACK)


@query(f"WITH {GIVEN_EVENTS} SELECT * FROM given_events UNION ALL {_incremental('INTERVAL 0 DAY')} AND {_UNSEEN}")
def incremental_sync_fixed_progress(t: Tables) -> DataFrame:
    """No lookback, and event times that never change: only the newest part of given is compared."""
    return dm.incremental_sync(t.events, t.given_events(), ["event_id"], "ts", fixed_progress=True)


@query(f"""WITH {GIVEN_EVENTS}, recent AS ({_incremental(_THREE_DAYS)})
SELECT * FROM recent
UNION ALL SELECT * FROM given_events g WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.event_id = g.event_id)""")
def incremental_upsert(t: Tables) -> DataFrame:
    return dm.incremental_sync(t.events, t.given_events(), ["event_id"], "ts", LOOKBACK, mode="upsert")


_STREAMED = f"""WITH {GIVEN_EVENTS} SELECT * FROM given_events
UNION ALL SELECT * FROM events t WHERE {_UNSEEN}"""


def _streamed(t: Tables, **options) -> DataFrame:
    out = work_folder(t.spark, "stream")
    arrivals = dm.read_arrivals(t.spark, t.sf_dir, t.arrivals_schema(), glob="events.parquet")
    run = dm.stream_sync(arrivals, t.given_events(), ["event_id"], f"{out}/rows", f"{out}/checkpoint", **options)
    run.awaitTermination()
    return dm.synced_state(t.given_events(), f"{out}/rows")


@query(_STREAMED)
def stream_sync(t: Tables) -> DataFrame:
    return _streamed(t)


@query(_STREAMED)
def stream_sync_with_delay(t: Tables) -> DataFrame:
    """Repeated deliveries dropped in the stream's state; the one file is one batch, so no row is late."""
    return _streamed(t, progress="ts", delay="3 days", fixed_progress=True)


_LATE = "(event_id % 3 = 1 AND ts < TIMESTAMP '2024-01-05')"
_DELIVERIES = [
    f"ts < TIMESTAMP '2024-01-15' AND NOT {_LATE}",
    "ts >= TIMESTAMP '2024-01-15'",
    _LATE,
]


@query(f"""WITH {GIVEN_EVENTS}
SELECT 'state' AS part, event_id, ts FROM given_events
UNION ALL SELECT 'state', event_id, ts FROM events t WHERE {_UNSEEN}
UNION ALL SELECT 'rejected', event_id, ts FROM events t WHERE {_UNSEEN} AND {_DELIVERIES[0]} AND event_id % 10 = 0
UNION ALL SELECT 'rejected', event_id, ts FROM events t WHERE {_UNSEEN} AND {_DELIVERIES[1]} AND event_id % 7 = 0
UNION ALL SELECT 'late', event_id, ts FROM events t WHERE {_UNSEEN} AND {_LATE}""")
def stream_sync_files(t: Tables) -> DataFrame:
    """Three deliveries, one batch each: the second repeats rows of the first and some of its own, the third is late.

    What is written, what is turned down and what came late are all compared.
    """
    folder = work_folder(t.spark, "deliveries")
    parts = [t.events.where(rule) for rule in _DELIVERIES]
    parts[1] = parts[1].unionByName(parts[0].where("event_id % 10 = 0")).unionByName(parts[1].where("event_id % 7 = 0"))
    given = t.given_events()
    options = {"progress": "ts", "delay": "3 days", "fixed_progress": True}
    for i, part in enumerate(parts):
        # As many files as tasks wrote: the stream is started after each delivery, whose files are then one batch.
        part.write.parquet(f"{folder}/files/{i}")
        arrivals = dm.read_arrivals(t.spark, f"{folder}/files/*", t.arrivals_schema())
        dm.stream_sync(arrivals, given, ["event_id"], f"{folder}/rows", f"{folder}/checkpoint", **options).awaitTermination()
    results = {"state": dm.synced_state(given, f"{folder}/rows"), "rejected": dm.rejected_rows(given, f"{folder}/rows"), "late": dm.late_rows(given, f"{folder}/rows")}
    return stacked([rows.select(F.lit(part).alias("part"), "event_id", "ts") for part, rows in results.items()])


_WANTED = T.StructType(
    [
        T.StructField("ORDER_ID", T.LongType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_totalprice", T.DecimalType(15, 2)),
        T.StructField("priority", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("reference", T.LongType()),
    ]
)


def _mapped(t: Tables) -> tuple[DataFrame, DataFrame]:
    key = F.col("o_orderkey")
    orders = t.orders.withColumn("Reference", F.when(key % 11 == 0, "n/a").otherwise(key.cast("string")))
    renames = {"o_orderkey": "order_id", "o_orderpriority": "priority"}
    return dm.map_schema(orders, _WANTED, renames, {"channel": "web"})


_REFERENCE = "CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END"


@query(f"""SELECT o_orderkey AS "ORDER_ID", CAST(o_custkey AS INTEGER) AS o_custkey,
  CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, o_orderpriority AS priority, 'web' AS channel,
  CAST(NULL AS VARCHAR) AS note, TRY_CAST({_REFERENCE} AS BIGINT) AS reference FROM orders""")
def map_schema(t: Tables) -> DataFrame:
    return _mapped(t)[0]


@query(f"""SELECT 'ORDER_ID' AS column_name, count(o_orderkey) AS n_values, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_changed FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), 0, 0 FROM orders
UNION ALL SELECT 'o_totalprice', count(o_totalprice), 0,
  count(*) FILTER (WHERE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) <> o_totalprice) FROM orders
UNION ALL SELECT 'priority', count(o_orderpriority), 0, 0 FROM orders
UNION ALL SELECT 'reference', count(*), count(*) - count(TRY_CAST({_REFERENCE} AS BIGINT)), 0 FROM orders""")
def cast_loss(t: Tables) -> DataFrame:
    return _mapped(t)[1].withColumnRenamed("column", "column_name")


def _counted(table: str, kind: str, n: str, text: str, column: str | None = None, prefix: str = "MISMATCH TABLE") -> str:
    shown = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    head, _, tail = text.partition("#")
    return (
        f"SELECT '{table}' AS table_name, {shown} AS column_name, '{kind}' AS kind, n, "
        f"concat('{prefix} {table}: {head}', n, '{tail}') AS message FROM (SELECT ({n}) AS n) WHERE n > 0"
    )


def _missing(target: str, given: str, keys: list[str]) -> str:
    on = " AND ".join(f"g.{k} = t.{k}" for k in keys)
    return f"SELECT count(*) FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {given} g WHERE {on})"


_PARENTS = "parent_customer AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)"
_GIVEN = f"WITH {GIVEN_ORDERS}, {GIVEN_CONVERSATIONS}, {GIVEN_EVENTS}, {_PARENTS}"
_KEYED = [
    ("orders", "given_orders", ["o_orderkey"]),
    ("conversations", "given_conversations", ["conv_id", "turn"]),
    ("events", "given_events", ["event_id"]),
    ("customer", "parent_customer", ["c_custkey"]),
]
_UNSYNCED = [_counted(t, "unsynced_rows", _missing(t, g, keys), "# unsynced rows") for t, g, keys in _KEYED]
_EXTRA = [_counted(t, "extra_rows", _missing(g, t, keys), "# rows only in the given table") for t, g, keys in _KEYED]
_KEYLESS = [
    "SELECT 'lineitem' AS table_name, CAST(NULL AS VARCHAR) AS column_name, 'table_error' AS kind, CAST(NULL AS BIGINT) AS n, "
    "'TABLE ERROR lineitem: error comparing rows: table main.lineitem has no primary key' AS message"
]
_CHANGED = [
    _counted(
        "orders",
        "changed_rows",
        "SELECT count(*) FROM orders t JOIN given_orders g USING (o_orderkey) "
        "WHERE t.o_orderstatus IS DISTINCT FROM g.o_orderstatus OR t.o_totalprice <> g.o_totalprice",
        "# changed rows",
    )
]
_ORPHANS = [
    _counted(
        table,
        "orphan_rows",
        f"SELECT count(*) FROM {given} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})",
        f"# rows whose reference {column} has no parent",
        column,
    )
    for table, given, column, parent, parent_column in (
        ("orders", "given_orders", "o_custkey", "parent_customer", "c_custkey"),
        ("events", "given_events", "user_id", "parent_customer", "c_custkey"),
        ("customer", "parent_customer", "c_nationkey", "nation", "n_nationkey"),
        ("lineitem", "lineitem", "l_orderkey", "given_orders", "o_orderkey"),
    )
]
_SCHEMA = [*MISSING_TABLES, *MISSING_COLUMNS, *TYPE_MISMATCHES, *NULLABILITY_MISMATCHES]


def _findings(parts: list[str], run: str) -> str:
    labels = """CASE WHEN kind IN ('missing_table', 'missing_column') THEN 'MISSING'
       WHEN kind LIKE 'missing_dependency%' THEN 'MISSING_DEPENDENCY' WHEN kind = 'table_error' THEN 'ERROR' ELSE 'MISMATCH' END AS type,
  CASE WHEN kind LIKE 'missing_dependency%' THEN 'DEPENDENCY' WHEN kind = 'table_error' THEN 'ERROR' ELSE 'WARNING' END AS label"""
    return f"{_GIVEN} SELECT '{run}' AS run_id, table_name, column_name, kind, {labels}, n, message FROM ({union_all(parts)})"


def _shown(findings: DataFrame) -> DataFrame:
    return findings.withColumnsRenamed({"table": "table_name", "column": "column_name"})


@query(_findings([*_SCHEMA, *_UNSYNCED, *_KEYLESS], "check"))
def audit_findings(t: Tables) -> DataFrame:
    """A plain check, with the rows each schema finding concerns."""
    return _shown(dm.audit(t.audited(), t.drifted(), "check", checks=("schema", "rows", "dependencies", "affected")))


@query(_findings([*_SCHEMA, *_UNSYNCED, *_KEYLESS, *_EXTRA, *_CHANGED, *_ORPHANS], "full"))
def audit_everything(t: Tables) -> DataFrame:
    """Every check on the same two sides."""
    return _shown(dm.audit(t.audited(), t.drifted(), "full", checks=(*dm.plans.audit.CHECKS, *dm.plans.audit.FURTHER_CHECKS)))


_REVERSED = [
    "SELECT 'Orders' AS table_name, 'o_comment' AS column_name, 'missing_column' AS kind, "
    "CAST(NULL AS BIGINT) AS n, 'MISSING COLUMN: table Orders: missing column o_comment' AS message",
    *[
        f"SELECT 'Orders', '{c}', 'type_mismatch', NULL, "
        f"'MISMATCH TABLE Orders: column {c} of type {a} mismatches with column {c} of type {b}'"
        for c, a, b in (("o_custkey", "int", "bigint"), ("o_totalprice", "decimal", "double"))
    ],
    *[
        f"SELECT '{table}', '{c}', 'nullability_mismatch', NULL, 'MISMATCH TABLE {table}: column {c} nullable mismatch'"
        for table, c in (("Orders", "o_orderkey"), ("nation", "n_nationkey"))
    ],
    *[
        f"SELECT '{table}', NULL, 'table_error', NULL, "
        f"'TABLE ERROR {table}: error comparing rows: table main.{table} has no primary key'"
        for table in ("Orders", "lineitem", "nation")
    ],
    *[_counted(t, "unsynced_rows", _missing(g, t, keys), "# unsynced rows") for t, g, keys in _KEYED[1:]],
]


@query(_findings(_REVERSED, "reverse"))
def reverse_check(t: Tables) -> DataFrame:
    """What the given side has and the target lacks, by the keys declared for the given side."""
    return _shown(dm.reverse_check(t.audited(), t.drifted(), run_id="reverse"))


@query(_findings(MISSING_DEPENDENCIES, "references"))
def audit_dependencies(t: Tables) -> DataFrame:
    target, given, further = t.referring()
    found = dm.audit(target, given, "references", checks=("dependencies", "affected"), others=[further])
    return _shown(found)


@query(_findings([*_SCHEMA, *_UNSYNCED, *_KEYLESS], "written"))
def write_findings(t: Tables) -> DataFrame:
    """Findings written and read back."""
    folder = work_folder(t.spark, "findings")
    found = dm.audit(t.audited(), t.drifted(), "written", checks=("schema", "rows", "affected"))
    dm.write_findings(found, folder)
    return _shown(t.spark.read.parquet(folder).drop("found_at"))


@query(f"{_GIVEN} SELECT run_id, kind, count(*) AS n_findings FROM ({_findings([*_SCHEMA, *_UNSYNCED, *_KEYLESS], 'json')}) GROUP BY run_id, kind")
def write_findings_as_json(t: Tables) -> DataFrame:
    folder = work_folder(t.spark, "findings")
    found = dm.audit(t.audited(), t.drifted(), "json", checks=("schema", "rows", "affected"))
    dm.write_findings(found, folder, format="json")
    return t.spark.read.json(folder).groupBy("run_id", "kind").agg(F.count(F.lit(1)).alias("n_findings"))


_METRICS = union_all(
    [
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_target, (SELECT count(*) FROM {g}) AS rows_given, "
        f"({_missing(t, g, keys)}) AS missing_in_given, ({_missing(g, t, keys)}) AS only_in_given, ({changed}) AS changed, "
        f"(SELECT count(*) FROM {t} JOIN {g} USING ({', '.join(keys)})) - ({changed}) AS same, "
        f"CAST(0 AS BIGINT) AS duplicate_key, ({orphans}) AS orphan_rows"
        for (t, g, keys), changed, orphans in zip(
            _KEYED,
            [
                "SELECT count(*) FROM orders t JOIN given_orders g USING (o_orderkey) "
                "WHERE t.o_orderstatus IS DISTINCT FROM g.o_orderstatus OR t.o_totalprice <> g.o_totalprice",
                *["CAST(0 AS BIGINT)"] * 3,
            ],
            [
                "SELECT count(*) FROM given_orders WHERE NOT EXISTS (SELECT 1 FROM parent_customer WHERE c_custkey = o_custkey)",
                "CAST(0 AS BIGINT)",
                "SELECT count(*) FROM given_events WHERE NOT EXISTS (SELECT 1 FROM parent_customer WHERE c_custkey = user_id)",
                "CAST(0 AS BIGINT)",
            ],
            strict=True,
        )
    ]
    + [
        "SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), 0, 0, NULL, NULL, NULL, "
        "(SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM given_orders WHERE o_orderkey = l_orderkey))",
        "SELECT 'nation', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation), 0, 0, 0, count(*), 0, 0 FROM nation",
    ]
)


@query(f"{_GIVEN} {_METRICS}")
def audit_metrics(t: Tables) -> DataFrame:
    return dm.audit_metrics(t.audited(), t.drifted()).withColumnRenamed("table", "table_name")


def _broken(t: Tables) -> DataFrame:
    """The audit of keys with a table of orders that cannot be read to its end."""
    given = t.drifted()
    name = given.find("orders")
    failing = given.tables[name].withColumn("o_orderkey", F.when(F.col("o_orderkey") > 100, F.raise_error(F.lit("broken file")).cast("bigint")).otherwise(F.col("o_orderkey")))
    return _shown(dm.audit(t.audited(), replace(given, tables=given.tables | {name: failing}), "broken", checks=("rows",)))


@query(_findings([*_UNSYNCED[1:], *_KEYLESS], "broken"))
def audit_with_a_broken_table(t: Tables) -> DataFrame:
    """A table whose reading fails while the audit runs is one finding, and those of all other tables are there."""
    found = _broken(t)
    return found.where("table_name <> 'orders'")


@query("SELECT 'orders' AS table_name, 'table_error' AS kind, true AS told FROM (SELECT count(*) FROM orders)")
def broken_table_is_told(t: Tables) -> DataFrame:
    found = _broken(t)
    return found.where("lower(table_name) = 'orders'").select("table_name", "kind", (F.length("message") > 0).alias("told"))


@query("""WITH o AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS k FROM orders),
repeated AS (SELECT count(*) AS n FROM (SELECT k FROM o GROUP BY k HAVING count(*) > 1)),
sides AS (SELECT unnest(['target', 'given']) AS side)
SELECT 'orders' AS table_name, 'duplicate_key' AS kind, n FROM repeated, sides
UNION ALL SELECT 'orders', 'null_key', n FROM (SELECT count(*) AS n FROM o WHERE k IS NULL), sides
UNION ALL SELECT 'orders', 'cast_loss', count(*) FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT 'region', 'name_collision', 2 FROM (SELECT count(*) FROM region)
UNION ALL SELECT 'lost', 'load_error', NULL FROM (SELECT count(*) FROM region)""")
def audit_rare_kinds(t: Tables) -> DataFrame:
    """Repeated and NULL keys on either side, values that a cast loses, colliding names and a table that did not load."""
    key = F.col("o_orderkey")
    known = F.when(key % 50 == 0, None).when(key % 10 == 1, key - 1).otherwise(key)
    label = F.when(key % 11 == 0, "n/a").otherwise(key.cast("string"))
    target = t.orders.withColumn("reference", label).withColumn("o_orderkey", known)
    given = t.orders.withColumn("reference", key).withColumn("o_orderkey", known)
    contracts = (dm.TableContract("orders", keys="o_orderkey"),)
    ours = dm.Namespace("main", {"orders": target, "Region": t.region, "region": t.region}, contracts)
    theirs = dm.Namespace("main", {"orders": given, "region": t.region}, contracts, {"lost": "no such file"})
    found = _shown(dm.audit(ours, theirs, "rare", checks=("schema", "keys", "casts")))
    kinds = ("duplicate_key", "null_key", "cast_loss", "name_collision", "load_error")
    return found.where(F.col("kind").isin(*kinds)).select("table_name", "kind", "n")
