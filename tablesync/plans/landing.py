"""Registered queries: writes into a target, by batch and by stream, then read back.

These run their writes when called; the result is the lazy read of the target.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.plans.base import ScratchTarget, load, register
from tablesync.plans.merges import AGAIN, LOADED, last
from tablesync.session import scratch_dir
from tablesync.sinks.write import append, compact, merge, replace
from tablesync.sources.names import literal
from tablesync.sources.read import incremental, read_table
from tablesync.streaming.stream import stream_append, stream_merge


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@register(
    f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '{LOADED}'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{AGAIN}'"""
)
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping increments; append keeps the duplicates."""
    orders = _orders(spark, sf_dir)
    with ScratchTarget(spark) as target:
        append(incremental(orders, "o_orderdate", upper=LOADED), target.name, **target.settings)
        append(incremental(orders, "o_orderdate", lower=AGAIN), target.name)
        return target.read()


@register(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
       UNION ALL SELECT l_orderkey, NULL, l_extendedprice, NULL FROM lineitem"""
)
def sink_append_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("O_ORDERKEY"), F.col("l_extendedprice").alias("o_totalprice")
    )
    with ScratchTarget(spark) as target:
        append(_orders(spark, sf_dir), target.name, **target.settings)
        append(lines, target.name)
        return target.read()


@register("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_replace_new_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    with ScratchTarget(spark) as target:
        replace(_orders(spark, sf_dir), target.name, **target.settings)
        replace(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), target.name)
        return target.read()


@register(
    f"""SELECT user_id, event_type, value FROM
          ({last("events", "user_id, event_type", "ts DESC, event_id DESC")})"""
)
def sink_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments of events, each de-duplicated on a two-part key; the order columns are not written."""
    events = load(spark, sf_dir, "events")
    with ScratchTarget(spark) as target:
        for window in ({"upper": "2024-01-15 00:00:00"}, {"lower": "2024-01-15 00:00:00"}):
            merge(
                incremental(events, "ts", **window),
                target.name,
                keys=["user_id", "event_type"],
                order_by=["ts", "event_id"],
                columns=["user_id", "event_type", "value"],
                **target.settings,
            )
        return target.read()


@register(
    """SELECT l_orderkey AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, CAST(l_extendedprice AS DOUBLE) AS o_totalprice
       FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (
               PARTITION BY l_orderkey ORDER BY l_shipdate DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC) = 1)
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL
       SELECT o_orderkey, o_custkey, coalesce(l_extendedprice, o_totalprice) FROM orders LEFT JOIN
         (SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_shipdate DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC) = 1)
         ON l_orderkey = o_orderkey"""
)
def sink_merge_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decimal increment merged into a DOUBLE column: store assignment casts it on the way."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("o_totalprice"), "l_shipdate"
    )
    with ScratchTarget(spark) as target:
        append(_orders(spark, sf_dir).drop("o_orderdate"), target.name, **target.settings)
        merge(lines, target.name, ["o_orderkey"], ["l_shipdate"], columns=["o_orderkey", "o_totalprice"])
        return target.read()


@register(
    "SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def sink_merge_order_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps merged into a DATE column: the last event of a user is that with the last time, not the last day."""
    events = load(spark, sf_dir, "events").select("user_id", F.col("ts").alias("day"), "event_id")
    with ScratchTarget(spark) as target:
        append(events.select("user_id", F.to_date("day").alias("day"), "event_id").limit(0), target.name, **target.settings)
        merge(events, target.name, ["user_id"], ["day"])
        return target.read()


@register(last("(SELECT user_id, event_id, ts, value, CAST(ts AS DATE) AS day FROM events)", "day, user_id", "ts DESC, event_id DESC"))
def sink_merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user and day, merged into a table by day: the second increment rewrites only its days."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value", F.to_date("ts").alias("day"))
    name, result = f"scratch_{uuid.uuid4().hex[:16]}", scratch_dir(spark, "result")
    spark.sql(
        f"CREATE TABLE {name} (user_id BIGINT, event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE, day DATE) "
        f"USING parquet PARTITIONED BY (day) LOCATION {literal(scratch_dir(spark, 'table'))}"
    )
    try:
        for window in ({"upper": "2024-01-18 12:00:00"}, {"lower": "2024-01-15 12:00:00"}):
            merge(incremental(events, "ts", **window), name, ["day", "user_id"], ["ts", "event_id"])
        read_table(spark, name).write.parquet(result)  # the table goes with its catalog entry
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(result)


@register("SELECT 0::BIGINT AS row_count, 4::BIGINT AS column_count FROM (SELECT count(*) FROM orders)")
def sink_empty_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty replace leaves an empty table that still has its columns."""
    orders = _orders(spark, sf_dir)
    with ScratchTarget(spark) as target:
        replace(orders, target.name, **target.settings)
        replace(incremental(orders, "o_orderdate", lower="9999-12-31"), target.name)
        found = target.read()
    return found.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(found.columns)).cast("bigint"))


@register("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def sink_empty_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    with ScratchTarget(spark) as target:
        append(orders, target.name, **target.settings)
        merge(incremental(orders, "o_orderdate", lower="9999-12-31"), target.name, ["o_orderkey"], ["o_orderdate"])
        append(incremental(orders, "o_orderdate", lower="9999-12-31"), target.name)
        return target.read()


@register(
    """SELECT 'append' AS mode, count(*) AS rows FROM lineitem
       UNION ALL SELECT 'merge', count(*) FROM lineitem UNION ALL SELECT 'replace', count(*) FROM orders"""
)
def write_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows submitted by each write, before a merge's de-duplication."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    with ScratchTarget(spark) as target:
        results = {"replace": replace(_orders(spark, sf_dir), target.name, **target.settings)}
    with ScratchTarget(spark) as target:
        results["append"] = append(lines, target.name, **target.settings)
        results["merge"] = merge(lines, target.name, ["l_orderkey"], ["l_shipdate"])
    out = None
    for mode, result in results.items():
        row = result.select(F.lit(mode).alias("mode"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


_WINDOWS = (
    {"upper": "2024-01-10 00:00:00"},
    {"lower": "2024-01-10 00:00:00", "upper": "2024-01-20 00:00:00"},
    {"lower": "2024-01-20 00:00:00"},
)


def _arrivals(spark: SparkSession, sf_dir: str, columns: list[str]) -> Iterator[DataFrame]:
    """The events table as a file stream: three time windows arrive one after the other.

    The caller drains the stream after each arrival, so that each window is one micro-batch.
    """
    landing = scratch_dir(spark, "landing")
    events = load(spark, sf_dir, "events").select(columns)
    for window in _WINDOWS:
        incremental(events, "ts", **window).write.mode("append").parquet(landing)
        yield spark.readStream.schema(events.schema).parquet(landing)


@register(f"SELECT user_id, event_id, ts, value FROM ({last('events', 'user_id', 'ts DESC, event_id DESC')})")
def stream_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint = scratch_dir(spark, "stream")
    with ScratchTarget(spark) as target:
        for stream in _arrivals(spark, sf_dir, ["user_id", "event_id", "ts", "value"]):
            stream_merge(stream, target.name, ["user_id"], ["ts", "event_id"], checkpoint, buckets=0, **target.settings).awaitTermination()
        return target.read()


@register("SELECT event_id, ts, user_id, value FROM events")
def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint = scratch_dir(spark, "stream")
    with ScratchTarget(spark) as target:
        for stream in _arrivals(spark, sf_dir, ["event_id", "ts", "user_id", "value"]):
            stream_append(stream, target.name, checkpoint, **target.settings).awaitTermination()
        return target.read()


_LAST_BY_USER = f"SELECT user_id, event_id, ts, value FROM ({last('events', 'user_id', 'ts DESC, event_id DESC')})"
_HALVES = ({"upper": "2024-01-18 12:00:00"}, {"lower": "2024-01-15 12:00:00"})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")


@register(_LAST_BY_USER)
def sink_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user, merged into an unpartitioned file table in two increments."""
    events = _events(spark, sf_dir)
    name, result = f"scratch_{uuid.uuid4().hex[:16]}", scratch_dir(spark, "result")
    spark.sql(
        f"CREATE TABLE {name} (user_id BIGINT, event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE) "
        f"USING parquet LOCATION {literal(scratch_dir(spark, 'table'))}"
    )
    try:
        for window in _HALVES:
            merge(incremental(events, "ts", **window), name, ["user_id"], ["ts", "event_id"])
        read_table(spark, name).write.parquet(result)  # the table goes with its catalog entry
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(result)


@register(_LAST_BY_USER)
def sink_merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into buckets of the users: the second increment rewrites those it has users in."""
    events = _events(spark, sf_dir)
    with ScratchTarget(spark) as target:
        for i, window in enumerate(_HALVES):
            more = {} if i else {"buckets": 8, **target.settings}
            merge(incremental(events, "ts", **window), target.name, ["user_id"], ["ts", "event_id"], **more)
        return target.result()


@register(
    """SELECT coalesce(l_orderkey, o_orderkey) AS o_orderkey, o_custkey, coalesce(CAST(l_extendedprice AS DOUBLE), CAST(o_totalprice AS DOUBLE)) AS o_totalprice
       FROM orders FULL JOIN (SELECT * FROM lineitem WHERE l_orderkey < 300 QUALIFY row_number() OVER (
         PARTITION BY l_orderkey ORDER BY l_shipdate DESC, CAST(l_extendedprice AS DOUBLE) DESC) = 1) ON l_orderkey = o_orderkey"""
)
def sink_merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files by key range; lines of the first orders rewrite only the files that hold those."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    lines = load(spark, sf_dir, "lineitem").where("l_orderkey < 300").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("double").alias("o_totalprice"), "l_shipdate"
    )
    size = {"max_file_bytes": 1 << 17}
    with ScratchTarget(spark) as target:
        append(orders, target.name, cluster_by=["o_orderkey"], **size, **target.settings)
        merge(lines, target.name, ["o_orderkey"], ["l_shipdate", "o_totalprice"], columns=["o_orderkey", "o_totalprice"], **size)
        return target.result()


@register("SELECT user_id, event_id, ts, value, CAST(ts AS DATE) AS day FROM events")
def sink_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three windows appended by day, then the days that lie in several batches brought together."""
    events = _events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    with ScratchTarget(spark) as target:
        for i, window in enumerate(_WINDOWS):
            append(incremental(events, "ts", **window), target.name, **({} if i else {"partition_by": ["day"], **target.settings}))
        compact(spark, target.name)
        return target.result()


@register(last("(SELECT user_id, event_id, ts, value, CAST(ts AS DATE) AS day FROM events)", "day, user_id", "ts DESC, event_id DESC"))
def stream_merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user and day by stream: a micro-batch rewrites only its days."""
    checkpoint = scratch_dir(spark, "stream")
    with ScratchTarget(spark) as target:
        for stream in _arrivals(spark, sf_dir, ["user_id", "event_id", "ts", "value"]):
            stream = stream.withColumn("day", F.to_date("ts"))
            stream_merge(
                stream, target.name, ["day", "user_id"], ["ts", "event_id"], checkpoint, partition_by=["day"], **target.settings
            ).awaitTermination()
        return target.result()


@register(_LAST_BY_USER)
def stream_merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user by stream, into the buckets that a stream's own target has."""
    checkpoint = scratch_dir(spark, "stream")
    with ScratchTarget(spark) as target:
        for stream in _arrivals(spark, sf_dir, ["user_id", "event_id", "ts", "value"]):
            stream_merge(stream, target.name, ["user_id"], ["ts", "event_id"], checkpoint, **target.settings).awaitTermination()
        return target.result()
