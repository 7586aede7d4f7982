"""The drifted copies and common pieces of the expected results, as SQL."""

from __future__ import annotations

from checks.tables import TABLES

GIVEN_ORDERS = """given_orders AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL
  SELECT o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 17 = 0)"""

GIVEN_EVENTS = """given_events AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_id % 50 <> 0)"""

GIVEN_CONVERSATIONS = """given_conversations AS (
  SELECT * FROM conversations WHERE (conv_id + turn) % 5 <> 0)"""

GIVEN_DOCUMENTS = """given_documents AS (
  SELECT doc_id, CASE WHEN n_chars > 500 THEN concat(text, '.') ELSE text END AS text, lang, source, n_chars
  FROM documents WHERE lang <> 'de')"""

ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_COLUMNS = ["o_orderkey", *ORDER_VALUES]


def differing(columns: list[str], left: str = "t", right: str = "g") -> str:
    return " OR ".join(f"{left}.{c} IS DISTINCT FROM {right}.{c}" for c in columns)


def changed_list(columns: list[str], left: str = "t", right: str = "g") -> str:
    cases = ", ".join(f"CASE WHEN {left}.{c} IS DISTINCT FROM {right}.{c} THEN '{c}' END" for c in columns)
    return f"concat_ws(',', {cases})"


def diff(target: str, given: str, keys: list[str], values: list[str], same: bool = True) -> str:
    """Key status and changed columns of two relations with unique keys."""
    on = " AND ".join(f"t.{k} = g.{k}" for k in keys)
    names = ", ".join(f"coalesce(t.{k}, g.{k}) AS {k}" for k in keys)
    first = keys[0]
    body = f"""SELECT {names},
       CASE WHEN g.{first} IS NULL THEN 'missing_in_given' WHEN t.{first} IS NULL THEN 'only_in_given'
            WHEN {differing(values)} THEN 'changed' ELSE 'same' END AS status,
       CASE WHEN t.{first} IS NULL OR g.{first} IS NULL THEN '' ELSE {changed_list(values)} END AS changed_cols
  FROM {target} t FULL JOIN {given} g ON {on}"""
    return body if same else f"SELECT * FROM ({body}) WHERE status <> 'same'"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def counted_columns(tables: dict[str, list[tuple[str, str]]] = TABLES) -> str:
    """One row per column of every table with its position, type family, rows and NULLs."""
    return union_all(
        [
            f"SELECT '{table}' AS table_name, CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
            f"count(*) AS n_rows, count(*) - count({name}) AS null_count FROM {table}"
            for table, columns in tables.items()
            for i, (name, kind) in enumerate(columns, start=1)
        ]
    )
