import pytest
from pyspark.sql import functions as F

from plans import exchanges, plan
from tablesync.errors import SyncError
from tablesync.operators.dedup import SEQUENCE, dedup_last, with_sequence


def test_last_row_per_key_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 1, "n"), (None, 2, "m"), (2, None, "x"), (2, 0, "y")],
        "k INT, seq INT, v STRING",
    )
    got = {(r["k"], r["v"]) for r in dedup_last(df, ["k"], ["seq"]).collect()}
    assert got == {(1, "c"), (None, "m"), (2, "y")}


def test_ties_break_the_same_way_however_rows_are_spread(spark):
    rows = [(k, 0, "v", [i // 7], {"m": i}, str(i)) for i in range(50) for k in range(3)]
    df = spark.createDataFrame(rows, "k INT, seq INT, v STRING, a ARRAY<INT>, m MAP<STRING, INT>, j STRING")
    df = df.withColumn("j", F.parse_json("j"))
    seen = set()
    for parts in (1, 3, 7):
        last = dedup_last(df.repartition(parts), ["k"], ["seq"]).select("k", "m", F.col("j").cast("string"))
        seen.add(tuple(sorted(str(tuple(r)) for r in last.collect())))
    assert len(seen) == 1


def test_ties_can_be_refused(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c"), (2, 2, "d")], "k INT, seq INT, v STRING")
    with pytest.raises(Exception, match="tie on seq"):
        dedup_last(df, ["k"], ["seq"], ties="error").collect()
    clean = dedup_last(df.where("k = 2"), ["k"], ["seq"], ties="error")
    assert [tuple(r) for r in clean.collect()] == [(2, 2, "d")] and clean.columns == df.columns
    assert dedup_last(df, ["k"], ["seq", "v"], ties="error").count() == 2
    nulls = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 1, "c"), (2, None, "d")], "k INT, seq INT, v STRING")
    with pytest.raises(Exception, match="tie on seq"):
        dedup_last(nulls, ["k"], ["seq"], ties="error").collect()
    below = df.unionByName(spark.createDataFrame([(1, 6, "top")], "k INT, seq INT, v STRING"))
    assert {r["v"] for r in dedup_last(below, ["k"], ["seq"], ties="error").collect()} == {"top", "d"}


def test_keys_and_order_are_needed(spark):
    for keys, order in (([], ["id"]), (["id"], [])):
        with pytest.raises(SyncError):
            dedup_last(spark.range(1), keys, order)


@pytest.mark.parametrize("ties, partial", [("break", "partial_max"), ("error", "Partial")])
def test_each_map_task_cuts_its_rows_before_the_only_shuffle(spark, ties, partial):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedup_last(df, ["k"], ["id"], ties=ties))
    assert exchanges(text) == 1
    assert text.index("Exchange hashpartitioning") < text.index(partial)


def test_the_last_row_keeps_its_own_key(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 1), (float("nan"), 2), (None, 3)], "k DOUBLE, seq INT")
    got = sorted(str(tuple(r)) for r in dedup_last(df, ["k"], ["seq"]).collect())
    assert got == ["(-0.0, 2)", "(None, 3)", "(nan, 2)"]
    folded = spark.sql("SELECT * FROM VALUES ('a', 1), ('A', 2) AS t(k, seq)").select(F.collate("k", "UTF8_LCASE").alias("k"), "seq")
    assert [tuple(r) for r in dedup_last(folded, ["k"], ["seq"]).collect()] == [("A", 2)]


def test_an_order_within_the_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a INT, b INT")
    assert sorted(map(str, (tuple(r) for r in dedup_last(df, ["a", "b"], ["a"]).collect()))) == ["(1, 2)", "(None, 2)"]
    assert dedup_last(df, ["a"], ["a"]).columns == ["a", "b"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 5, 4)], ["k.1", "o`x", "v y"])
    last = dedup_last(df, ["k.1"], ["o`x"])
    assert last.columns == df.columns and tuple(last.first()) == (1, 5, 4)


def test_sequence_is_dense_and_follows_the_order(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v")).repartition(5)
    rows = sorted(with_sequence(df, ["v"], start=10).collect(), key=lambda r: r["v"])
    assert [r[SEQUENCE] for r in rows] == list(range(10, 10_010))


def test_sequence_splits_a_hot_value_over_ranges(spark):
    df = spark.range(9_000).select(F.when(F.col("id") < 6_000, 1).otherwise(F.col("id")).alias("v"))
    numbered = with_sequence(df, ["v"])
    assert sorted(r[SEQUENCE] for r in numbered.collect()) == list(range(9_000))
    per_task = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 3_000
