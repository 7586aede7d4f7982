"""Queries over a catalog joined from the relations of an ``information_schema``, and over names that need quoting."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import driftmend as dm
from checks.registry import query
from checks.sql import GIVEN_ORDERS, ORDER_COLUMNS, ORDER_VALUES, diff, union_all
from checks.tables import KEYS, REFERENCES, TABLES, Tables
from driftmend.functions.frames import stacked
from driftmend.functions.names import cols
from driftmend.functions.types import family
from driftmend.sources.catalog import Catalog
from driftmend.sources.information_schema import SOURCE_FAMILIES, catalog_from_information_schema, contracts_of

# A reference of two columns, from a table of turns to the conversations they belong to.
REPLY = ("replies", ("conv_id", "turn"), "conversations", ("conv_id", "turn"))
_REPLIES = "replies AS (SELECT CASE WHEN conv_id % 7 <> 0 THEN conv_id END AS conv_id, turn + conv_id % 3 AS turn FROM conversations)"


def replies(t: Tables) -> DataFrame:
    known = F.when(F.col("conv_id") % 7 != 0, F.col("conv_id")).alias("conv_id")
    return t.conversations.select(known, (F.col("turn") + F.col("conv_id") % 3).alias("turn"))


def _space(t: Tables) -> dm.Namespace:
    return dm.Namespace("main", {**t.namespace().tables, "replies": replies(t)})


def _database(t: Tables, space: dm.Namespace) -> Catalog:
    """What a database with these tables would tell of them: every key, and every reference as a constraint of its own."""
    types = {short: long for long, short in reversed(SOURCE_FAMILIES.items())}
    columns = [("main", n, i, f.name, types[family(f.dataType)], "YES", None) for n in space.names() for i, f in enumerate(space.tables[n].schema.fields, start=1)]
    references = [(c, (col,), p, (pcol,)) for c, col, p, pcol in REFERENCES] + [REPLY]
    constraints = [("main", f"{n}_pk", "PRIMARY KEY", "main", n) for n in KEYS]
    usage = [("main", f"{n}_pk", "main", n, k, i, None) for n, keys in KEYS.items() for i, k in enumerate(keys, start=1)]
    links = []
    for child, own, parent, theirs in references:
        name = f"{child}_{own[0]}_fk"
        constraints.append(("main", name, "FOREIGN KEY", "main", child))
        usage += [("main", name, "main", child, c, i, KEYS[parent].index(p) + 1) for i, (c, p) in enumerate(zip(own, theirs, strict=True), start=1)]
        links.append(("main", name, "main", f"{parent}_pk"))

    def frame(rows: list[tuple], *names: str) -> DataFrame:
        return t.spark.createDataFrame(pa.table({n: pa.array(list(c)) for n, c in zip(names, zip(*rows, strict=True), strict=True)}))

    shown = t.spark.createDataFrame(columns, "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string, column_default string")
    used = t.spark.createDataFrame(
        usage, "constraint_schema string, constraint_name string, table_schema string, table_name string, column_name string, ordinal_position int, position_in_unique_constraint int"
    )
    return catalog_from_information_schema(
        tables=frame([("main", n) for n in space.names()], "table_schema", "table_name"),
        columns=shown,
        table_constraints=frame(constraints, "constraint_schema", "constraint_name", "constraint_type", "table_schema", "table_name"),
        key_column_usage=used,
        referential_constraints=frame(links, "constraint_schema", "constraint_name", "unique_constraint_schema", "unique_constraint_name"),
    )


_SINGLE = [
    f"SELECT '{c}' AS table_name, CAST(1 AS BIGINT) AS position, '{col}' AS column_name, '{p}' AS ref_table, '{pcol}' AS ref_column, count({col}) AS n_references FROM {c}"
    for c, col, p, pcol in REFERENCES
]
_PAIR = [
    f"SELECT 'replies', CAST({i} AS BIGINT), '{c}', 'conversations', '{p}', count({c}) FROM replies"
    for i, (c, p) in enumerate(zip(REPLY[1], REPLY[3], strict=True), start=1)
]


@query(f"WITH {_REPLIES} {union_all(_SINGLE + _PAIR)}")
def catalog_joins_foreign_keys(t: Tables) -> DataFrame:
    """References joined from constraints, their columns and the keys they point at, with the values each column has."""
    space = _space(t)
    found = dm.list_foreign_keys(_database(t, space), "main")
    referring: dict[str, list[str]] = {}
    for child, column, _, _ in REFERENCES:
        referring.setdefault(child, []).append(column)
    facts = dm.column_facts(space, referring | {"replies": list(REPLY[1])})
    return found.join(facts, on=["table", "column"]).select(
        F.col("table").alias("table_name"), F.col("position").cast("long").alias("position"), F.col("column").alias("column_name"), "ref_table", "ref_column",
        (F.col("n_rows") - F.col("null_count")).alias("n_references"),
    )


@query(union_all([f"SELECT '{n}' AS table_name, '{', '.join(keys)}' AS keys, count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {n})) AS distinct_keys FROM {n}" for n, keys in KEYS.items()]))
def catalog_joins_primary_keys(t: Tables) -> DataFrame:
    """Contracts made of a database's catalog, and what holds of their keys."""
    space = _space(t)
    contracts = [c for c in contracts_of(_database(t, space), "main") if c.keys]
    return stacked(
        [
            dm.key_profile(space.tables[c.name], c.keys).select(F.lit(c.name).alias("table_name"), F.lit(", ".join(c.keys)).alias("keys"), F.col("rows").alias("n_rows"), "distinct_keys")
            for c in contracts
        ]
    )


@query(f"""WITH {_REPLIES} SELECT conv_id, turn, count(*) AS n_rows FROM replies r
WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = r.conv_id AND c.turn = r.turn)
GROUP BY conv_id, turn""")
def orphan_keys_composite(t: Tables) -> DataFrame:
    """The reference of two columns that the catalog tells, followed on the data; NULL parts point at nothing."""
    space = _space(t)
    reference = next(c for c in contracts_of(_database(t, space), "main") if c.name == "replies").references[0]
    return dm.orphan_keys(space.tables["replies"], space.tables[reference.table], reference.columns, reference.ref_columns)


# Names with dots, quotes, backticks, blanks and words of SQL.
ODD_NAMES = dict(zip(ORDER_COLUMNS, ["order.key", "cust`key", 'the "status"', "total price", "select", "a.b.`c`"], strict=True))


def _odd(orders: DataFrame) -> DataFrame:
    return orders.toDF(*[ODD_NAMES[c] for c in orders.columns])


def _shown(name: str) -> str:
    return "'" + name.replace("'", "''") + "'"


_CHANGED = ", ".join(f"CASE WHEN list_contains(string_split(changed_cols, ','), '{c}') THEN {_shown(ODD_NAMES[c])} END" for c in ORDER_VALUES)


@query(f"""WITH {GIVEN_ORDERS} SELECT o_orderkey AS order_key, status, concat_ws(', ', {_CHANGED}) AS changed_cols
FROM ({diff('orders', 'given_orders', ['o_orderkey'], ORDER_VALUES)})""")
def row_diff_quoted_names(t: Tables) -> DataFrame:
    found = dm.row_diff(_odd(t.orders), _odd(t.given_orders()), [ODD_NAMES["o_orderkey"]])
    return found.select(F.col("`order.key`").alias("order_key"), "status", F.array_join("changed_cols", ", ").alias("changed_cols"))


@query(f"""WITH {GIVEN_ORDERS} SELECT o_orderkey AS a, o_custkey AS b, o_orderstatus AS c, o_totalprice AS d, o_orderdate AS e, o_orderpriority AS f FROM orders
UNION ALL SELECT * FROM given_orders g WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = g.o_orderkey)""")
def sync_quoted_names(t: Tables) -> DataFrame:
    """An upsert whose key is the column named in another case."""
    state = dm.sync(_odd(t.orders), _odd(t.given_orders()), ["ORDER.Key"], mode="upsert")
    return state.select(*cols(ODD_NAMES.values())).toDF(*"abcdef")


# Columns of whole numbers and of text that references are looked for in.
_SEARCHED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus"],
    "events": ["event_id", "user_id"],
}
_KINDS = {(name, c): kind for name in _SEARCHED for c, kind in TABLES[name]}
_PLACES = [(name, c) for name, columns in _SEARCHED.items() for c in columns]
_UNIQUE = "(SELECT count(*) = count(DISTINCT {c}) FROM {t})"


@query(union_all([f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows FROM {t} HAVING count(*) = count(DISTINCT {c})" for t, c in _PLACES]))
def key_columns(t: Tables) -> DataFrame:
    return dm.key_columns(t.namespace(*_SEARCHED), _SEARCHED).toDF("table_name", "column_name", "n_rows")


@query(
    union_all(
        [
            f"SELECT '{a}' AS table_name, '{c}' AS column_name, '{b}' AS ref_table, '{d}' AS ref_column, count(DISTINCT {c}) AS n_values FROM {a} "
            f"HAVING count({c}) > 0 AND {_UNIQUE.format(c=d, t=b)} AND NOT EXISTS (SELECT {c} FROM {a} WHERE {c} IS NOT NULL EXCEPT SELECT {d} FROM {b})"
            for a, c in _PLACES
            for b, d in _PLACES
            if (a, c) != (b, d) and (_KINDS[a, c] == "string") == (_KINDS[b, d] == "string")
        ]
    )
)
def propose_references(t: Tables) -> DataFrame:
    """Every reference between these columns that holds in the data, the declared ones among them."""
    found = dm.propose_references(t.namespace(*_SEARCHED), _SEARCHED)
    return found.toDF("table_name", "column_name", "ref_table", "ref_column", "n_values")
