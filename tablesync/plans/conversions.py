"""Registered queries: nested values, exact text and write types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.nested import (
    decimal_text, decode_staged, encode_exact, interval_text, ntz_text, parse_nested, project_declared, to_json_text,
    widen_nested,
)
from tablesync.functions.types import normalize_for_write
from tablesync.plans.base import load, register
from tablesync.session import scratch_dir
from tablesync.sources.read import read_staged


@register("SELECT c_custkey, CAST(to_json([c_custkey, c_nationkey]) AS VARCHAR) AS keys FROM customer")
def nested_to_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        "c_custkey", to_json_text(F.array("c_custkey", F.col("c_nationkey").cast("bigint"))).alias("keys")
    )


@register("SELECT c_custkey, CAST(to_json({'a': c_custkey, 'b': c_name}) AS VARCHAR) AS rec FROM customer")
def nested_to_json_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        "c_custkey", to_json_text(F.struct(F.col("c_custkey").alias("a"), F.col("c_name").alias("b"))).alias("rec")
    )


@register(
    """SELECT event_id, '{"' || event_type || '":[' || user_id || ',null]}' AS tags,
              '{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS seen FROM events"""
)
def nested_to_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of arrays with a NULL element, and microseconds inside a struct."""
    return load(spark, sf_dir, "events").select(
        "event_id",
        to_json_text(F.create_map("event_type", F.array(F.col("user_id"), F.lit(None).cast("bigint")))).alias("tags"),
        to_json_text(F.struct(F.col("ts").alias("at"))).alias("seen"),
    )


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              'INTERVAL ''' || date_diff('day', TIMESTAMP '1994-12-31', l_shipdate) || ' 00:00:00'' DAY TO SECOND' AS shipped
       FROM lineitem"""
)
def interval_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.expr("l_shipdate - TIMESTAMP_NTZ '1994-12-31 00:00:00'")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", interval_text(since).alias("shipped")
    )


@register("SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events")
def variant_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_declared(load(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("props")))


@register("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_to_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "props")
    return parse_nested(events, "props", "STRUCT<k: BIGINT>", row_id=["event_id"]).select("event_id", "props.k")


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose props are fine, of the wrong shape, bad at depth, or followed by junk, by type."""
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.lit("[1]"))
        .when(kind == "purchase", F.regexp_replace("props", r"(\d+)", r'"$1x"'))
        .when(kind == "signup", F.concat("props", F.lit("} junk")))
        .otherwise(F.col("props"))
        .alias("props"),
    )


@register(
    """SELECT event_id, 'props' AS column_name, 'STRUCT<`k`: BIGINT>' AS expected_type FROM events
       WHERE event_type IN ('error', 'purchase', 'signup')"""
)
def json_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_nested(_mixed(spark, sf_dir), "props", "STRUCT<k: BIGINT>", on_error="report", row_id=["event_id"])


@register(
    """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'purchase', 'signup')
                             THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events"""
)
def json_bad_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_nested(_mixed(spark, sf_dir), "props", "STRUCT<k: BIGINT>", on_error="null").select("event_id", "props.k")


@register(
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
       FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i)"""
)
def nested_widen_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = widen_nested(load(spark, sf_dir, "embeddings"))
    return wide.select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@register(
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(CAST(embedding[i] AS VARCHAR) AS DOUBLE) AS value
       FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i)"""
)
def nested_widen_float_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = widen_nested(load(spark, sf_dir, "embeddings"), floats="shortest")
    return wide.select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@register("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders")
def decimal_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", decimal_text(F.col("o_totalprice").cast("decimal(18,2)")).alias("price")
    )


@register("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS price FROM orders")
def decimal_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(38,9)")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", exact.alias("price"))
    return decode_staged(encode_exact(orders), orders.schema)


@register("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM events")
def ntz_to_iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", ntz_text(F.col("ts")).alias("ts"))


@register(
    """SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
              o_custkey AS rec_cust, o_orderstatus AS rec_status, o_orderpriority AS tag
       FROM orders"""
)
def staged_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals, naive timestamps and nested values staged as text files and read back into their types."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")).alias("rec"),
        F.array("o_orderpriority").alias("tags"),
    )
    directory = scratch_dir(spark, "staged")
    encode_exact(orders).write.parquet(directory)
    back = decode_staged(read_staged(spark, directory), orders.schema)
    return back.select(
        "o_orderkey", "o_orderdate", "price",
        F.col("rec.cust").alias("rec_cust"), F.col("rec.status").alias("rec_status"), F.col("tags")[0].alias("tag"),
    )


@register(
    """SELECT c_custkey, CAST(c_nationkey AS INTEGER) AS nation8, CAST(c_nationkey AS INTEGER) AS nation16,
              c_name, CAST(c_acctbal AS FLOAT) AS balance FROM customer"""
)
def write_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast(T.ByteType()).alias("nation8"),
        F.col("c_nationkey").cast(T.ShortType()).alias("nation16"),
        "c_name",
        F.col("c_acctbal").cast(T.FloatType()).alias("balance"),
    )
    return normalize_for_write(customer)


@register(
    """SELECT o_orderkey, 'INTERVAL ''' || CASE WHEN us < 0 THEN '-' ELSE '' END || (abs(us) // 86400000000) || ' ' ||
              printf('%02d:%02d:%02d', CAST(abs(us) // 3600000000 % 24 AS INT), CAST(abs(us) // 60000000 % 60 AS INT),
                     CAST(abs(us) // 1000000 % 60 AS INT)) ||
              CASE WHEN us % 1000000 = 0 THEN '' ELSE rtrim(printf('.%06d', CAST(abs(us) % 1000000 AS INT)), '0') END ||
              ''' DAY TO SECOND' AS behind,
              'INTERVAL ''' || CASE WHEN m < 0 THEN '-' ELSE '' END || (abs(m) // 12) || '-' || (abs(m) % 12) || ''' YEAR TO MONTH' AS months
       FROM (SELECT o_orderkey, date_diff('microsecond', o_orderdate, TIMESTAMP '1996-06-30 12:34:56.789')
                    + CAST(o_orderkey % 7 AS BIGINT) * 10 AS us,
                    CAST(o_custkey % 50 - 25 AS BIGINT) AS m FROM orders)"""
)
def interval_to_text_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of both signs down to microseconds, and of years and months."""
    since = F.expr(
        "TIMESTAMP_NTZ '1996-06-30 12:34:56.789' - CAST(o_orderdate AS TIMESTAMP_NTZ)"
        " + make_dt_interval(0, 0, 0, CAST(o_orderkey % 7 AS INT) * 0.00001)"
    )
    months = F.expr("make_ym_interval(0, CAST(o_custkey % 50 - 25 AS INT))")
    return load(spark, sf_dir, "orders").select("o_orderkey", interval_text(since).alias("behind"), interval_text(months).alias("months"))
