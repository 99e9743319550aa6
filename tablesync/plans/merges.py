"""Registered queries: last row per key, row sequence and the merge, on whole tables.

The orders table plays both sides of a sync: the target is what an earlier run loaded (up to a
watermark), the source is a later increment that overlaps it, so some rows update, some insert and
some stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.dedup import dedup_last, with_sequence
from tablesync.operators.merge import merge_frame, merge_preview, missing_columns
from tablesync.plans.base import load, path, register
from tablesync.sources.read import Window, read_path

LOADED = "1999-06-30 00:00:00"
AGAIN = "1998-12-31 00:00:00"

# The oracle's upsert: rows of t whose key is in s take the values of s, rows of s without a match are added.
UPSERT = """
    SELECT {updated} FROM t LEFT JOIN s ON {on}
    UNION ALL
    SELECT {inserted} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})"""


def last(table: str, keys: str, order: str) -> str:
    """The oracle's last row per key."""
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


@register(last("events", "user_id", "ts DESC, event_id DESC"))
def dedup_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_last(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@register(last("events", "user_id", "ts DESC, event_id DESC"))
def dedup_last_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ties refused: none here, as the order ends with a unique id."""
    return dedup_last(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ties="error")


_MISSING = ("s_suppkey", "s_name", "s_nationkey")


@register(" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS held FROM supplier" for c in _MISSING))
def missing_columns_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``supplier`` that ``part`` lacks, each with the values that a write would lose."""
    supplier = load(spark, sf_dir, "supplier").select(*_MISSING)
    lacking = missing_columns(supplier, load(spark, sf_dir, "part"))
    held = supplier.agg(F.map_from_arrays(F.array(*map(F.lit, _MISSING)), F.array(*map(F.count, _MISSING))).alias("held"))
    return lacking.join(held.select(F.explode("held").alias("name", "held")), "name")


_NULL_KEY = """(SELECT event_id, ts, CASE WHEN event_type <> 'view' THEN user_id END AS user_id, value FROM events)"""


@register(last(_NULL_KEY, "user_id", "ts DESC, event_id DESC"))
def dedup_last_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of all rows has the NULL key: one group, of which each map task sends one row."""
    events = load(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"), "value"
    )
    return dedup_last(events, ["user_id"], ["ts", "event_id"])


_ALL_DESC = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC,
    l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


@register(last("lineitem", "l_orderkey, l_linenumber", _ALL_DESC))
def dedup_last_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the ship date is named; rows that tie on it are told apart by their remaining columns."""
    columns = [
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    return dedup_last(load(spark, sf_dir, "lineitem").select(columns), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register(
    """SELECT o_orderdate, o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 99 AS _sync_seq
       FROM orders"""
)
def row_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return with_sequence(orders, ["o_orderdate", "o_orderkey"], start=100)


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_LOADED_SQL = f"""t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
    WHERE o_orderdate <= TIMESTAMP '{LOADED}')"""


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(spark, path(sf_dir, "orders"), columns=_ORDER_COLUMNS, window=Window("o_orderdate", upper=LOADED))


def _increment(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return read_path(
        spark, path(sf_dir, "orders"), columns=columns or _ORDER_COLUMNS, window=Window("o_orderdate", lower=AGAIN)
    ).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)


@register(
    f"""WITH {_LOADED_SQL},
    s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate FROM orders
          WHERE o_orderdate > TIMESTAMP '{AGAIN}')"""
    + UPSERT.format(
        on="t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey",
        updated="""t.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
            CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
            CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
            CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate""",
        inserted="s.*",
    )
)
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a bounded increment, its last row per key, merged into what was loaded before."""
    source = dedup_last(_increment(spark, sf_dir), ["o_orderkey"], ["o_orderdate"])
    return merge_frame(_loaded(spark, sf_dir), source, ["o_orderkey"])


_LAST_ORDER = last("orders", "o_custkey", "o_orderdate DESC, o_orderkey DESC")


@register(
    f"""WITH t AS (SELECT c_custkey AS custkey, c_acctbal AS amount FROM customer),
    s AS (SELECT o_custkey AS custkey, o_totalprice AS amount FROM ({_LAST_ORDER}))"""
    + UPSERT.format(
        on="t.custkey IS NOT DISTINCT FROM s.custkey",
        updated="t.custkey, CASE WHEN s.custkey IS NULL THEN t.amount ELSE s.amount END AS amount",
        inserted="s.*",
    )
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer takes the price of the customer's last order."""
    target = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"))
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"), "o_orderdate", "o_orderkey"
    )
    source = dedup_last(orders, ["custkey"], ["o_orderdate", "o_orderkey"]).select("custkey", "amount")
    return merge_frame(target, source, ["custkey"])


_NULL_ORDERS = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_totalprice AS amount FROM orders"""


@register(
    f"""WITH t AS ({_NULL_ORDERS}), s AS (SELECT k, amount FROM ({last("t", "k", "o_orderkey DESC")}))
    SELECT t.o_orderkey, t.k, s.amount FROM t JOIN s ON t.k IS NOT DISTINCT FROM s.k"""
)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the target has the NULL key, and repeats the others; all rows of a key are updated."""
    target = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"), F.col("o_totalprice").alias("amount")
    )
    return merge_frame(target, dedup_last(target, ["k"], ["o_orderkey"]).select("k", "amount"), ["k"])


_LINES = "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM lineitem"
_LINE_ORDER = "l_shipdate DESC, l_partkey DESC, l_extendedprice DESC"


@register(
    f"""WITH lines AS ({_LINES}), t AS (SELECT * FROM lines WHERE l_shipdate <= TIMESTAMP '{LOADED}'),
    s AS ({last(f"(SELECT * FROM lines WHERE l_shipdate > TIMESTAMP '{AGAIN}')", "l_orderkey, l_linenumber", _LINE_ORDER)})"""
    + UPSERT.format(
        on="t.l_orderkey IS NOT DISTINCT FROM s.l_orderkey AND t.l_linenumber IS NOT DISTINCT FROM s.l_linenumber",
        updated="""t.l_orderkey, t.l_linenumber, coalesce(s.l_shipdate, t.l_shipdate) AS l_shipdate,
            coalesce(s.l_partkey, t.l_partkey) AS l_partkey, coalesce(s.l_extendedprice, t.l_extendedprice) AS l_extendedprice""",
        inserted="s.*",
    )
)
def merge_composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice"]
    lineitem = path(sf_dir, "lineitem")
    target = read_path(spark, lineitem, columns=columns, window=Window("l_shipdate", upper=LOADED))
    increment = read_path(spark, lineitem, columns=columns, window=Window("l_shipdate", lower=AGAIN))
    keys = ["l_orderkey", "l_linenumber"]
    return merge_frame(target, dedup_last(increment, keys, ["l_shipdate"]), keys)


@register(
    """SELECT o_custkey AS k FROM orders
       UNION ALL SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)"""
)
def merge_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column is a key: nothing to update, missing keys are inserted."""
    target = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    source = dedup_last(load(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id"), ["k"], ["event_id"])
    return merge_frame(target, source.select("k"), ["k"])


@register(
    f"""WITH {_LOADED_SQL},
    s AS (SELECT o_orderkey, o_totalprice + 1.0 AS o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{AGAIN}')"""
    + UPSERT.format(
        on="t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey",
        updated="""t.o_orderkey, t.o_custkey, t.o_orderstatus, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
            t.o_orderdate""",
        inserted="s.o_orderkey, NULL, NULL, s.o_totalprice, NULL",
    )
)
def merge_extra_target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns the source does not carry stay on update and are NULL on insert."""
    source = _increment(spark, sf_dir, ["o_orderkey", "o_totalprice"])
    return merge_frame(_loaded(spark, sf_dir), source, ["o_orderkey"])


@register(
    """WITH s AS (SELECT DISTINCT l_partkey AS k FROM lineitem UNION SELECT o_orderkey FROM orders)
       SELECT count(*) AS source_rows, count(*) FILTER (k IN (SELECT c_custkey FROM customer)) AS updates,
              count(*) FILTER (k NOT IN (SELECT c_custkey FROM customer)) AS inserts FROM s"""
)
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_shipdate").alias("at"))
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("at"))
    source = dedup_last(lines.unionByName(orders), ["k"], ["at"]).select("k")
    return merge_preview(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), source, ["k"])
