import os
import uuid

import pytest

from tablesync.sinks.sharded import read_parts
from tablesync.sinks.target import find_target
from tablesync.sinks.write import ensure_target, replace
from tablesync.sources.read import current_name, read_table
from tablesync.streaming.stream import stream_append, stream_merge

DDL = "id BIGINT, at INT, name STRING"


@pytest.fixture
def landing(spark, tmp_path):
    def add(*rows):
        spark.createDataFrame(list(rows), DDL).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")

    add((1, 1, "a"), (1, 2, "b"), (2, 1, "c"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/landing")
    name = f"s_{uuid.uuid4().hex[:12]}"
    yield add, stream, name, f"{tmp_path}/checkpoint"
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def rows(spark, name):
    return sorted((tuple(r) for r in read_table(spark, name).collect()), key=str)


def test_stream_merge(spark, landing):
    add, stream, name, checkpoint = landing
    add((2, 5, "d"), (None, 1, "n"))

    def run(checkpoint):
        stream_merge(stream, name, ["id"], ["at"], checkpoint, columns=["id", "name"]).awaitTermination()

    run(checkpoint)
    want = [(1, "b"), (2, "d"), (None, "n")]
    assert rows(spark, name) == want
    run(checkpoint)  # nothing new
    assert rows(spark, name) == want
    add((1, 9, "z"))
    run(checkpoint)
    assert rows(spark, name) == [(1, "z"), (2, "d"), (None, "n")]
    run(f"{checkpoint}-new")  # everything again, as after a lost checkpoint
    assert rows(spark, name) == [(1, "z"), (2, "d"), (None, "n")]


def test_stream_append_recognises_a_replayed_batch(spark, landing, monkeypatch):
    import tablesync.streaming.stream as module

    add, stream, name, checkpoint = landing
    ensure_target(spark, name, stream.schema)
    real, calls = module.append, []

    def append_then_die(batch, *args, **settings):
        real(batch, *args, **settings)
        calls.append(settings["tag"])
        if len(calls) == 1:
            raise OSError("driver lost after the batch landed")

    monkeypatch.setattr(module, "append", append_then_die)
    with pytest.raises(Exception, match="driver lost"):
        stream_append(stream, name, checkpoint).awaitTermination()
    add((7, 7, "g"))
    stream_append(stream, name, checkpoint).awaitTermination()
    assert calls[0] == calls[1]
    assert rows(spark, name) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (7, 7, "g")]


def test_a_stream_of_merges_rewrites_only_the_buckets_it_touches(spark, landing):
    add, stream, name, checkpoint = landing
    add(*((i, 1, "x") for i in range(100, 200)))

    def parts():
        target = find_target(spark, current_name(spark, name))
        return read_parts(spark, target.location, target.version)

    stream_merge(stream, name, ["id"], ["at"], checkpoint).awaitTermination()
    before = parts()
    assert len(before) == 16
    add((150, 2, "y"))
    stream_merge(stream, name, ["id"], ["at"], checkpoint).awaitTermination()
    assert len(set(before.items()) & set(parts().items())) == 15
    found = rows(spark, name)
    assert len(found) == 102 and (150, 2, "y") in found


def test_a_replayed_append_is_known_after_a_replace(spark, landing):
    add, stream, name, checkpoint = landing
    stream_append(stream, name, checkpoint).awaitTermination()
    replace(spark.createDataFrame([(9, 9, "r")], DDL), name)
    # As a driver that died after landing batch 0 and before noting it.
    for kind in ("commits",):
        for file in os.listdir(f"{checkpoint}/{kind}"):
            os.remove(f"{checkpoint}/{kind}/{file}")
    stream_append(stream, name, checkpoint).awaitTermination()
    assert rows(spark, name) == [(9, 9, "r")]
    add((7, 7, "g"))
    stream_append(stream, name, checkpoint).awaitTermination()
    assert rows(spark, name) == [(7, 7, "g"), (9, 9, "r")]
