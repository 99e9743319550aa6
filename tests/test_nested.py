import datetime
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesync.errors import SyncError
from tablesync.functions.nested import (
    decode_staged, encode_exact, parse_nested, project_declared, to_json_text, widen_nested,
)

BAD = [
    '{"secret":1}', "[1.7]", "[99999999999]", '["secret"]', "", "secret", "[1", "[1,]", "[1] secret", "[1]} secret",
    '[1], "x":2', '[1], "v":[2]', '[1], "bad":null', "1], [2", "['1']", "[1]}", "[01]",
]


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, v STRING")


def test_json_list(spark):
    df = parse_nested(texts(spark, "[1,2]", None, "[]", "[null,4]", " [5] ", "null"), "v", "ARRAY<INT>")
    assert df.columns == ["id", "v"]
    assert [r["v"] for r in df.orderBy("id").collect()] == [[1, 2], None, [], [None, 4], [5], None]


def test_json_struct(spark):
    df = parse_nested(
        texts(spark, '{"n":7,"at":"2024-05-06T07:08:09.123456Z","m":{"a":1,"b":null},"d":"2024-05-06"}', '{"n":null}'),
        "v",
        "STRUCT<n: INT, at: TIMESTAMP, m: MAP<STRING, BIGINT>, d: DATE>",
    )
    micros = df.select("id", "v.n", F.unix_micros("v.at").alias("at"), "v.m", F.col("v.d").cast("string").alias("d"))
    want_at = int(datetime.datetime(2024, 5, 6, 7, 8, 9, 123456, datetime.timezone.utc).timestamp() * 1_000_000)
    assert [tuple(r) for r in micros.orderBy("id").collect()] == [
        (0, 7, want_at, {"a": 1, "b": None}, "2024-05-06"), (1, None, None, None, None),
    ]


@pytest.mark.parametrize("bad", BAD)
def test_bad_json_is_an_error_without_the_value(spark, bad):
    df = parse_nested(texts(spark, "[1]", bad), "v", "ARRAY<INT>", row_id=["id"])
    with pytest.raises(Exception, match="column 'v' is not a valid ARRAY<INT> id=1") as error:
        df.collect()
    assert "secret" not in str(error.value)


def test_bad_json_reported_or_null(spark):
    df = texts(spark, "[1]", *BAD, None)
    report = parse_nested(df, "v", "ARRAY<INT>", on_error="report", row_id=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in report] == [(i + 1, "v", "ARRAY<INT>") for i in range(len(BAD))]
    kept = parse_nested(df, "v", "ARRAY<INT>", on_error="null").where("v IS NOT NULL").collect()
    assert [tuple(r) for r in kept] == [(0, [1])]
    with pytest.raises(SyncError):
        parse_nested(df, "v", "ARRAY<INT>", on_error="ignore")


def test_acceptance_against_a_strict_parser(spark):
    """Random texts over the characters that could trick a wrapper."""
    rng = random.Random(11)
    tokens = ["[", "]", "{", "}", ",", "1", "22", "null", '"v"', ":", " ", '"bad"', "-", "1.5", "'", "x"]
    values = {"".join(rng.choices(tokens, k=rng.randint(1, 7))) for _ in range(6000)}
    for _ in range(300):
        items = ",".join(rng.choices(["1", "null", "-7"], k=rng.randint(0, 3)))
        values.add(f"[{items}]{rng.choice(['', '', ' ', ']', ',', '}'])}")

    def want(text):
        try:
            value = json.loads(text)
        except ValueError:
            return False
        return value is None or isinstance(value, list) and all(v is None or type(v) is int for v in value)

    values = sorted(values)
    bad = parse_nested(texts(spark, *values).repartition(4), "v", "ARRAY<INT>", on_error="report", row_id=["id"])
    refused = {r["id"] for r in bad.collect()}
    assert [v for i, v in enumerate(values) if (i not in refused) != want(v)] == []
    assert len(values) - len(refused) > 30


def test_a_bad_leaf_at_depth_is_found(spark):
    df = texts(spark, '[{"a":{"k":[1]}}]', '[{"a":{"k":["x"]}}]')
    bad = parse_nested(df, "v", "ARRAY<STRUCT<a: MAP<STRING, ARRAY<INT>>>>", on_error="report", row_id=["id"])
    assert [r["id"] for r in bad.collect()] == [1]


def test_a_pruned_bad_column_is_not_read(spark):
    assert parse_nested(texts(spark, "junk"), "v", "ARRAY<INT>").select("id").count() == 1


def test_json_text_keeps_microseconds(spark):
    row = spark.sql("SELECT struct(TIMESTAMP '2026-09-10 12:34:56.123456' AS a, TIMESTAMP_NTZ '2026-09-10 12:34:56.123456' AS b) AS s")
    assert row.select(to_json_text(F.col("s"))).first()[0] == '{"a":"2026-09-10T12:34:56.123456Z","b":"2026-09-10T12:34:56.123456"}'


def test_nested_fixture(spark):
    df = spark.sql("SELECT 1L AS id, array('a','b') AS tags, named_struct('n', 5, 'm', map('k', 9L)) AS props, array(X'0102') AS raw")
    row = project_declared(df).first()
    assert row["tags"] == ["a", "b"] and row["props"].n == 5 and row["props"].m == {"k": 9} and row["raw"] == '["AQI="]'


def test_widening(spark):
    df = spark.sql("SELECT array(0.1F) AS f, named_struct('s', 1S, 'm', map(2Y, 0.1F)) AS r, 0.1F AS flat")
    exact = widen_nested(df)
    assert exact.dtypes == [("f", "array<double>"), ("r", "struct<s:int,m:map<int,double>>"), ("flat", "float")]
    assert exact.first()["f"] == [0.10000000149011612]
    shortest = widen_nested(df, floats="shortest").first()
    assert shortest["f"] == [0.1] and shortest["r"].m == {2: 0.1}
    with pytest.raises(SyncError):
        widen_nested(df, floats="other")


def test_exact_text_round_trip(spark):
    df = spark.createDataFrame(
        [
            (1, Decimal("-12345.6789"), Decimal("18446744073709551615"), datetime.datetime(2026, 9, 10, 13, 45, 30, 123456), [1, None]),
            (2, None, None, None, None),
            (3, Decimal("0.0001"), Decimal("0"), datetime.datetime(2026, 1, 1), []),
        ],
        "id INT, amt DECIMAL(20,4), big DECIMAL(20,0), ts TIMESTAMP_NTZ, tags ARRAY<INT>",
    )
    text = encode_exact(df)
    assert text.dtypes[1:] == [(c, "string") for c in ("amt", "big", "ts", "tags")]
    assert tuple(text.orderBy("id").first()) == (1, "-12345.6789", "18446744073709551615", "2026-09-10T13:45:30.123456", "[1,null]")
    assert decode_staged(text, df.schema).orderBy("id").collect() == df.orderBy("id").collect()


def test_38_digits_survive(spark):
    df = spark.sql("SELECT cast('12345678901234567890123456789.123456789' AS DECIMAL(38,9)) AS d")
    assert decode_staged(encode_exact(df), df.schema).first()["d"] == Decimal("12345678901234567890123456789.123456789")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_staged_text_is_an_error(spark, ansi):
    schema = spark.createDataFrame([], "d DECIMAL(5,2), t TIMESTAMP_NTZ").schema
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for column, values in (("d", ("secret", None)), ("t", (None, "secret"))):
            text = spark.createDataFrame([("1.25", "2026-01-01T00:00:00.000001"), values], "d STRING, t STRING")
            with pytest.raises(Exception, match=f"column '{column}' is not a valid") as error:
                decode_staged(text, schema).collect()
            assert "secret" not in str(error.value)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
