import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.types import (
    JSON, NATIVE, NESTED, TEXT, classify, declared_type, describe_dataset, normalize_for_write, target_ddl, widened, write_schema,
)
from tablesync.sources.read import read_path


def of(ddl):
    return T.DataType.fromDDL(ddl)


@pytest.mark.parametrize(
    "ddl",
    "TINYINT SMALLINT INT BIGINT BOOLEAN FLOAT DOUBLE DECIMAL(38,9) STRING BINARY DATE TIMESTAMP TIMESTAMP_NTZ".split(),
)
def test_flat_types_read_as_they_are(ddl):
    assert classify(of(ddl)) == NATIVE
    assert declared_type("c", of(ddl)) == of(ddl)


@pytest.mark.parametrize(
    "ddl, declared",
    [
        ("ARRAY<INT>", "ARRAY<INT>"),
        ("ARRAY<TINYINT>", "ARRAY<INT>"),
        ("MAP<SMALLINT, FLOAT>", "MAP<INT, DOUBLE>"),
        ("STRUCT<a: FLOAT, b: DECIMAL(5,2), c: DATE>", "STRUCT<a: DOUBLE, b: DECIMAL(5,2), c: DATE>"),
        ("ARRAY<STRUCT<a: MAP<STRING, ARRAY<INT>>>>", "ARRAY<STRUCT<a: MAP<STRING, ARRAY<INT>>>>"),
        ("MAP<TIMESTAMP, STRING>", "MAP<TIMESTAMP, STRING>"),
    ],
)
def test_nested_types_widen_their_leaves(ddl, declared):
    assert classify(of(ddl)) == NESTED
    assert widened(of(ddl)) == of(declared)


@pytest.mark.parametrize(
    "ddl",
    [
        "ARRAY<BINARY>", "ARRAY<TIMESTAMP_NTZ>", "MAP<ARRAY<INT>, STRING>", "STRUCT<a: INTERVAL DAY>", "ARRAY<VARIANT>",
        "STRUCT<a: INT, b: ARRAY<BINARY>>", "STRUCT<>",
    ],
)
def test_other_nested_types_are_json_text(ddl):
    assert classify(of(ddl)) == JSON
    assert declared_type("c", of(ddl)) == T.StringType()


@pytest.mark.parametrize("ddl", ["INTERVAL DAY", "INTERVAL YEAR TO MONTH", "VARIANT"])
def test_intervals_and_variants_are_text(ddl):
    assert classify(of(ddl)) == TEXT


def test_unreadable_types_name_the_column(spark):
    with pytest.raises(SyncError, match="'gone' has type VOID"):
        describe_dataset(spark.sql("SELECT NULL AS gone"))
    with pytest.raises(SyncError, match="'t'"):
        declared_type("t", T.TimeType())


def test_target_ddl():
    schema = T.StructType.fromDDL(
        "rec STRUCT<n: INT, at: TIMESTAMP, `we``ird`: DECIMAL(38,18)>, tags ARRAY<STRING>, m MAP<STRING, ARRAY<BIGINT>>"
    )
    assert target_ddl(schema) == (
        "`rec` STRUCT<`n`: INT, `at`: TIMESTAMP, `we``ird`: DECIMAL(38,18)>, `tags` ARRAY<STRING>, `m` MAP<STRING, ARRAY<BIGINT>>"
    )


def test_write_types(spark):
    df = spark.sql("SELECT 1Y AS b, 2S AS s, 3 AS i, 4L AS l, 1.5F AS f, X'01' AS x, cast(18446744073709551615 AS DECIMAL(20,0)) AS u")
    out = normalize_for_write(df)
    assert out.dtypes == [
        ("b", "int"), ("s", "int"), ("i", "int"), ("l", "bigint"), ("f", "float"), ("x", "binary"), ("u", "decimal(20,0)"),
    ]
    assert out.first()["u"] == 18446744073709551615


@pytest.mark.parametrize(
    "ddl",
    [
        "TIME", "VOID", "VARIANT", "INTERVAL DAY", "MAP<INT, STRING>", "ARRAY<BINARY>", "ARRAY<FLOAT>", "ARRAY<SMALLINT>",
        "STRUCT<a: TIMESTAMP_NTZ>", "STRUCT<>", "ARRAY<MAP<DATE, INT>>",
    ],
)
def test_unwritable_types_name_output_and_column(spark, ddl):
    dtype = T.NullType() if ddl == "VOID" else T.TimeType() if ddl == "TIME" else of(ddl)
    df = spark.createDataFrame([], T.StructType([T.StructField("c", dtype)]))
    with pytest.raises(SyncError, match="out: column 'c'"):
        write_schema(df, "out")


def test_nested_strictness_can_be_lifted(spark):
    df = spark.sql("SELECT map(1, 'a') AS m, array(X'01') AS x")
    assert write_schema(df, strict_nested=False).simpleString() == "struct<m:map<int,string>,x:array<binary>>"


def test_parquet_inputs_of_another_writer(spark, tmp_path):
    """Unsigned integers, date64, fixed-size values and a naive timestamp, as a columnar writer stores them."""
    at = datetime.datetime(2026, 9, 10, 12, 34, 56, 123456)
    table = pa.table(
        {
            "u8": pa.array([255], pa.uint8()),
            "u16": pa.array([65535], pa.uint16()),
            "u32": pa.array([2**32 - 1], pa.uint32()),
            "u64": pa.array([2**64 - 1], pa.uint64()),
            "d64": pa.array([datetime.date(2026, 9, 10)], pa.date64()),
            "fixed": pa.array([b"ab"], pa.binary(2)),
            "pair": pa.array([[1, 2]], pa.list_(pa.int32(), 2)),
            "big": pa.array(["text"], pa.large_string()),
            "naive": pa.array([at], pa.timestamp("us")),
            "zoned": pa.array([at], pa.timestamp("us", "Europe/Berlin")),
            "exact": pa.array([Decimal("12345678901234567890.123456789")], pa.decimal128(38, 9)),
        }
    )
    pq.write_table(table, f"{tmp_path}/x.parquet")
    out = normalize_for_write(spark.read.parquet(f"{tmp_path}/x.parquet"))
    assert dict(out.dtypes) == {
        "u8": "int", "u16": "int", "u32": "bigint", "u64": "decimal(20,0)", "d64": "date", "fixed": "binary",
        "pair": "array<int>", "big": "string", "naive": "timestamp_ntz", "zoned": "timestamp", "exact": "decimal(38,9)",
    }
    row = out.first()
    assert (row["u8"], row["u16"], row["u32"], row["u64"]) == (255, 65535, 2**32 - 1, 2**64 - 1)
    assert row["pair"] == [1, 2] and row["naive"] == at and row["exact"] == Decimal("12345678901234567890.123456789")


def test_one_column_per_readable_type(spark, tmp_path):
    df = spark.sql(
        """SELECT 1Y AS a, 2S AS b, 3 AS c, 4L AS d, true AS e, 1.5F AS f, 2.5D AS g,
                  12345678901234567890.123456789BD AS h, 'x' AS i, X'6162' AS j, DATE '2026-09-10' AS k,
                  TIMESTAMP '2026-09-10 12:34:56.123456' AS l, TIMESTAMP_NTZ '2026-09-10 12:34:56.123456' AS m,
                  array(1, 2) AS n, map('k', 1) AS o, named_struct('a', 1) AS p"""
    )
    df.write.parquet(f"{tmp_path}/types")
    read = read_path(spark, f"{tmp_path}/types")
    assert read.dtypes == df.dtypes and read.collect() == df.collect()
