import random

import pytest
from pyspark.sql import functions as F

from plans import exchanges, final_plan, plan
from tablesync.errors import SyncError
from tablesync.operators.dedup import dedup_last
from tablesync.operators.merge import merge_frame, merge_into, merge_preview, missing_columns


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[False, True], ids=["shuffled", "broadcast"])
def small(request):
    return request.param


def test_update_insert_and_stay(spark, small):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "id INT, v STRING")
    assert rows(merge_frame(target, source, ["id"], small)) == [(1, "a"), (2, "B"), (3, "c")]


def test_null_keys_match_and_null_values_overwrite(spark, small):
    target = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id INT, v STRING")
    source = spark.createDataFrame([(None, "N"), (1, None)], "id INT, v STRING")
    assert rows(merge_frame(target, source, ["id"], small)) == rows(
        spark.createDataFrame([(None, "N"), (None, "N"), (1, None)], "id INT, v STRING")
    )


def test_a_stand_in_for_null_is_not_a_null(spark, small):
    ddl = "i INT, s STRING, d DATE, b BOOLEAN, x BINARY, t TIMESTAMP, m DECIMAL(9,2), v INT"
    zero = "0, '', DATE '1970-01-01', false, X'', TIMESTAMP '1970-01-01 00:00:00', 0.00BD"
    target = spark.sql(f"SELECT * FROM VALUES ({zero}, 1) AS t(i, s, d, b, x, t, m, v)").to(
        spark.createDataFrame([], ddl).schema
    )
    source = spark.createDataFrame([(None,) * 7 + (2,)], ddl)
    merged = merge_frame(target, source, ["i", "s", "d", "b", "x", "t", "m"], small)
    assert sorted(r["v"] for r in merged.collect()) == [1, 2]


def test_all_columns_are_keys(spark, small):
    target = spark.createDataFrame([(1,), (1,), (None,)], "id INT")
    source = spark.createDataFrame([(1,), (2,), (None,)], "id INT")
    merged = merge_frame(target, source, ["id"], small)
    assert rows(merged) == rows(spark.createDataFrame([(1,), (1,), (None,), (2,)], "id INT"))


def test_extra_target_columns_and_case(spark, small):
    target = spark.createDataFrame([(1, "a", "x")], "Id INT, v STRING, extra STRING")
    source = spark.createDataFrame([("A", 1), ("b", 2)], "V STRING, id INT")
    merged = merge_frame(target, source, ["id"], small)
    assert merged.columns == ["Id", "v", "extra"]
    assert rows(merged) == [(1, "A", "x"), (2, "b", None)]


def test_odd_column_names(spark, small):
    target = spark.createDataFrame([(1, "a", 5)], ["k.1", "we`ird", "t"])
    source = spark.createDataFrame([(1, "A"), (2, "b")], ["k.1", "we`ird"])
    assert rows(merge_frame(target, source, ["k.1"], small)) == [(1, "A", 5), (2, "b", None)]


def test_refusals(spark):
    target = spark.createDataFrame([(1, "a")], "id INT, v STRING")
    with pytest.raises(SyncError, match="'w'"):
        merge_frame(target, spark.createDataFrame([(1, 2)], "id INT, w INT"), ["id"])
    for keys in ([], ["ID"]):
        with pytest.raises(SyncError, match="keys"):
            merge_frame(target, target, keys)


def test_missing_columns(spark):
    part = spark.createDataFrame([], "p_partkey INT, P_Name STRING, p_size INT")
    target = spark.createDataFrame([], "p_name STRING, p_size INT, other INT")
    assert rows(missing_columns(part, target)) == [("p_partkey",)]


def test_preview_counts(spark):
    target = spark.createDataFrame([(1,), (1,), (None,)], "id INT")
    source = spark.createDataFrame([(1,), (None,), (7,), (8,)], "id INT")
    assert rows(merge_preview(target, source, ["id"])) == [(4, 2, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_random_merges_against_plain_python(spark, small, seed):
    rng = random.Random(seed)

    def key():
        return rng.choice([None, 0, 1, 2, 3, 4]), rng.choice([None, "", "a", "b"])

    target = [(*key(), i, f"t{i}") for i in range(40)]
    source = [(*key(), i, rng.choice([None, f"s{i}"])) for i in range(30)]
    ddl = "k1 INT, k2 STRING, n INT, v STRING"
    last = {row[:2]: row for row in source}
    want = [last.get(row[:2], row) for row in target]
    want += [row for k, row in last.items() if k not in {t[:2] for t in target}]
    merged = merge_frame(
        spark.createDataFrame(target, ddl).repartition(3),
        dedup_last(spark.createDataFrame(source, ddl).repartition(4), ["k1", "k2"], ["n"]),
        ["k1", "k2"],
        small,
    )
    assert rows(merged) == sorted(want, key=str)


def test_a_table_without_merge_support_says_so(spark):
    spark.sql("CREATE TABLE no_merge (id BIGINT) USING parquet")
    with pytest.raises(Exception, match="does not support MERGE"):
        merge_into(spark, "no_merge", spark.range(1), ["id"])
    spark.sql("DROP TABLE no_merge")


@pytest.fixture
def skewed(spark, tmp_path):
    """Two thirds of the target under one key, over many files."""
    big = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    big.repartition(16).write.parquet(f"{tmp_path}/target")
    dedup_last(big, ["k"], ["n"]).write.parquet(f"{tmp_path}/source")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/source")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_of_the_target_is_split(skewed):
    target, source = skewed
    merged = merge_frame(target, source, ["k"])
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.count() == 400_000


def test_shuffles_of_the_two_paths(skewed):
    target, source = skewed
    shuffled = plan(merge_frame(target, source, ["k"]))
    # target, source twice, and the target's keys once: their distinct already fits the join
    assert exchanges(shuffled) == 4
    assert "BroadcastExchange" not in shuffled
    broadcast = plan(merge_frame(target, source, ["k"], small_source=True))
    # only the distinct keys that the source has, cut down by each map task first
    assert exchanges(broadcast) == 1
    assert "SortMergeJoin" not in broadcast
