"""Registered queries: reads, windows and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.nested import project_declared
from tablesync.functions.types import describe_dataset
from tablesync.plans.base import load, path, register
from tablesync.session import scratch_dir
from tablesync.sources.names import quote
from tablesync.sources.read import Window, partition_counts, read_path, read_query, read_staged, shape_read, split_counts


@register("SELECT c_name, c_custkey FROM customer")
def read_table_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(spark, path(sf_dir, "customer"), columns=["c_name", "c_custkey"])


@register(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE (o_orderstatus = 'F' OR o_totalprice > 300000.0) AND o_orderdate <= TIMESTAMP '1999-12-31 00:00:00'"""
)
def read_predicate_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(
        spark,
        path(sf_dir, "orders"),
        columns=["o_orderkey", "o_orderstatus", "o_totalprice"],
        predicate="o_orderstatus = 'F' or o_totalprice > 300000.0",
        window=Window("o_orderdate", upper="1999-12-31 00:00:00"),
    )


@register(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate > TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-06-30 00:00:00'"""
)
def window_exclusive_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(
        spark,
        path(sf_dir, "orders"),
        columns=["o_orderkey", "o_orderdate", "o_totalprice"],
        window=Window("o_orderdate", "1997-01-01 00:00:00", "1998-06-30 00:00:00"),
    )


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'"""
)
def window_lower_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(
        spark,
        path(sf_dir, "lineitem"),
        columns=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"],
        window=Window("l_shipdate", "1999-01-01 00:00:00", lower_inclusive=True),
    )


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem
       WHERE CAST(l_extendedprice AS DECIMAL(18,2)) > 20000.00 AND CAST(l_extendedprice AS DECIMAL(18,2)) <= 60000.50"""
)
def window_decimal_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    return shape_read(
        lineitem,
        columns=["l_orderkey", "l_linenumber", "l_partkey", "price"],
        window=Window("price", "20000.00", "60000.50"),
    )


@register(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day FROM orders
       WHERE CAST(o_orderdate AS DATE) > DATE '1996-02-29' AND CAST(o_orderdate AS DATE) <= DATE '2000-02-29'"""
)
def window_date_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("o_day", F.col("o_orderdate").cast("date"))
    return shape_read(orders, columns=["o_orderkey", "o_day"], window=Window("o_day", "1996-02-29", "2000-02-29"))


@register(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority > '1-URGENT' AND o_orderpriority <= '4-NOT SPECIFIED'"""
)
def window_string_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_path(
        spark,
        path(sf_dir, "orders"),
        columns=["o_orderkey", "o_orderpriority"],
        window=Window("o_orderpriority", "1-URGENT", "4-NOT SPECIFIED"),
    )


@register(
    """SELECT o_orderkey, seen_at FROM
         (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS seen_at FROM orders)
       WHERE seen_at <= TIMESTAMP '2001-12-31 00:00:00'"""
)
def window_null_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound lies beyond every date: only the rows with a NULL cursor drop out."""
    orders = load(spark, sf_dir, "orders").withColumn(
        "seen_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    )
    return shape_read(orders, columns=["o_orderkey", "seen_at"], window=Window("seen_at", upper="2001-12-31 00:00:00"))


_REVENUE = """
    SELECT o.o_orderpriority, l.l_returnflag, count(*) AS line_count,
           CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
    FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderpriority, l.l_returnflag"""


@register(_REVENUE.format(lineitem="lineitem", orders="orders"))
def read_query_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: f"parquet.{quote(path(sf_dir, t))}" for t in ("lineitem", "orders")}
    return read_query(spark, _REVENUE.format(**tables))


@register(
    """SELECT o_orderkey,
              'INTERVAL ''' || date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) || ' 00:00:00'' DAY TO SECOND' AS age,
              '["' || base64(encode(o_orderstatus)) || '"]' AS raw
       FROM orders"""
)
def read_query_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval and a nested value without a declared type, both as text; the query ends in a semicolon."""
    return read_query(
        spark,
        f"""SELECT o_orderkey, o_orderdate - TIMESTAMP_NTZ '1995-01-01 00:00:00' AS age,
                   array(cast(o_orderstatus AS binary)) AS raw
            FROM parquet.{quote(path(sf_dir, "orders"))};""",
    )


@register(
    """WITH described(position, name, source_type, declared_type, serialize) AS (VALUES
         (0, 'event_id', 'BIGINT', 'BIGINT', NULL),
         (1, 'ts', 'TIMESTAMP_NTZ', 'TIMESTAMP_NTZ', NULL),
         (2, 'user_id', 'BIGINT', 'BIGINT', NULL),
         (3, 'event_type', 'STRING', 'STRING', NULL),
         (4, 'value', 'DOUBLE', 'DOUBLE', NULL),
         (5, 'props', 'STRING', 'STRING', NULL),
         (6, 'scores', 'ARRAY<FLOAT>', 'ARRAY<DOUBLE>', NULL),
         (7, 'raw', 'ARRAY<BINARY>', 'STRING', 'to_json(`raw`)'),
         (8, 'since', 'INTERVAL DAY TO SECOND', 'STRING', 'cast(`since` as string)'))
       SELECT d.*, CASE name WHEN 'props' THEN (SELECT count(nullif(event_type, 'error')) FROM events)
                             ELSE (SELECT count(*) FROM events) END AS present
       FROM described d"""
)
def schema_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared schema of a dataset, and how many rows carry a value in each declared column."""
    events = load(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
        F.array(F.col("value").cast("float")).alias("scores"),
        F.array(F.col("props").cast("binary")).alias("raw"),
        F.expr("ts - TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("since"),
    )
    read = project_declared(events)
    counts = read.agg(*[F.count(quote(c)).alias(c) for c in read.columns])
    by_name = F.create_map(*[x for c in read.columns for x in (F.lit(c), F.col(quote(c)))])
    present = counts.select(F.explode(by_name).alias("name", "present"))
    return describe_dataset(events).join(F.broadcast(present), "name")


@register("SELECT * FROM lineitem")
def staged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged directory of several part files, next to another one that must not be read."""
    directory = scratch_dir(spark, "staged")
    lineitem = load(spark, sf_dir, "lineitem")
    lineitem.write.option("maxRecordsPerFile", 1_000_000).parquet(f"{directory}/rows")
    lineitem.select("l_orderkey").write.parquet(f"{directory}/other")
    return read_staged(spark, f"{directory}/rows", lineitem.schema)


@register(
    """SELECT 'events' AS dataset, count(*) AS rows_total FROM events
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders"""
)
def partition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [
        partition_counts(load(spark, sf_dir, t))
        .agg(F.sum("rows").alias("rows_total"))
        .select(F.lit(t).alias("dataset"), "rows_total")
        for t in ("events", "lineitem", "orders")
    ]
    return reduce(DataFrame.unionByName, totals)


@register(
    """SELECT 'events' AS dataset, 'events.parquet' AS file, count(*) AS rows_total FROM events
       UNION ALL SELECT 'lineitem', 'lineitem.parquet', count(*) FROM lineitem
       UNION ALL SELECT 'orders', 'orders.parquet', count(*) FROM orders"""
)
def split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each file of three tables, added up over its splits."""
    totals = [
        split_counts(load(spark, sf_dir, t))
        .groupBy(F.lit(t).alias("dataset"), F.element_at(F.split("file", "/"), -1).alias("file"))
        .agg(F.sum("rows").alias("rows_total"))
        for t in ("events", "lineitem", "orders")
    ]
    return reduce(DataFrame.unionByName, totals)
