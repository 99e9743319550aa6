"""Sharded targets, compaction, ledgers, leases and file sizes."""

import os
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from plans import plan
from tablesync.errors import SyncError
from tablesync.sinks import files
from tablesync.sinks import write as sinks
from tablesync.sinks.sharded import read_parts, version_table
from tablesync.sinks.target import clean_versions, find_target, lease
from tablesync.sinks.write import StagedWrite, append, compact, merge, replace
from tablesync.sources.read import current_name, read_table

DDL = "id BIGINT, v STRING, day STRING"
LAYOUTS = {
    "columns": {"partition_by": ["day"]},
    "buckets": {"buckets": 4},
    "both": {"partition_by": ["day"], "buckets": 2},
    "files": {"cluster_by": ["id"], "max_file_bytes": 2000},
}


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex[:12]}"
    yield name
    kind = find_target(spark, current_name(spark, name)).kind
    spark.sql(f"DROP {'TABLE' if kind == 'table' else 'VIEW'} IF EXISTS {name}")


def frame(spark, *rows, ddl=DDL):
    return spark.createDataFrame(list(rows), ddl)


def rows(spark, name):
    return sorted((tuple(r) for r in read_table(spark, name).collect()), key=str)


def target_of(spark, name):
    return find_target(spark, current_name(spark, name))


def parts_of(spark, name):
    target = target_of(spark, name)
    return read_parts(spark, target.location, target.version)


def many(spark, n, v="a"):
    return spark.range(n).select("id", F.concat(F.lit(v), F.col("id").cast("string")).alias("v"), F.concat(F.lit("d"), F.col("id") % 5).alias("day"))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_writes_equal_those_of_a_plain_target(spark, name, layout):
    other = f"{name}_plain"
    try:
        for target, more in ((name, LAYOUTS[layout]), (other, {})):
            append(many(spark, 40), target, keys=["id", "day"], **more)
            merge(frame(spark, (3, "x", "d3"), (3, "y", "d3"), (77, "n", None), (78, "n", "e/f ~=g")), target, ["id", "day"], ["v"])
            append(frame(spark, (3, "twice", "d3"), (None, "none", None)), target)
            merge(frame(spark, (3, "z", "d3"), (None, "known", None), (78, "o", "e/f ~=g")), target, ["id", "day"], ["v"])
            merge(frame(spark), target, ["id", "day"], ["v"])
            append(frame(spark), target)
        assert rows(spark, name) == rows(spark, other)
        assert read_table(spark, name).schema == read_table(spark, other).schema
        replace(frame(spark, (1, "only", "d")), name)
        assert rows(spark, name) == [(1, "only", "d")]
        replace(frame(spark), name)
        assert rows(spark, name) == []
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {other}")


@pytest.mark.parametrize("layout, untouched", [("columns", 4), ("buckets", 3), ("both", 9)])
def test_a_merge_rewrites_only_its_shards(spark, name, layout, untouched):
    append(many(spark, 200), name, keys=["id", "day"], **LAYOUTS[layout])
    before = parts_of(spark, name)
    merge(frame(spark, (7, "new", "d2")), name, ["id", "day"], ["v"])
    after = parts_of(spark, name)
    assert len(set(before.items()) & set(after.items())) == untouched == len(before) - 1
    assert len(rows(spark, name)) == 200 and (7, "new", "d2") in rows(spark, name)


def test_a_merge_by_files_rewrites_those_that_hold_its_keys(spark, name):
    """One per cent of clustered keys: the other files stay where they are."""
    append(many(spark, 20_000), name, cluster_by=["id"], max_file_bytes=4_000)
    before = parts_of(spark, name)
    assert len(before) > 20
    change = many(spark, 200, "b").withColumn("id", F.col("id") + 5000).withColumn("day", F.lit("d0"))
    merge(change.union(frame(spark, (10**6, "new", "d0"))), name, ["id"], ["v"], max_file_bytes=4_000)
    after = parts_of(spark, name)
    gone = set(before) - set(after)
    assert 1 <= len(gone) <= 3 and all(before[p] == after[p] for p in set(before) - gone)
    found = read_table(spark, name)
    assert found.count() == 20_001 and found.where("v LIKE 'b%'").count() == 200 and found.where("id BETWEEN 5000 AND 5199 AND v LIKE 'b%'").count() == 200
    # Keys that are not there yet rewrite nothing.
    before = parts_of(spark, name)
    merge(frame(spark, (-1, "low", "d0"), (10_000_000, "high", None)), name, ["id"], ["v"])
    assert set(before.items()) < set(parts_of(spark, name).items())


def test_partition_columns_prune_readers(spark, name):
    append(many(spark, 50), name, **LAYOUTS["columns"])
    text = plan(read_table(spark, name).where("day = 'd3'"))
    assert "day" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert read_table(spark, name).where("day = 'd3'").count() == 10


def test_a_reader_sees_old_or_new_never_both(spark, name):
    append(many(spark, 60, "old"), name, **LAYOUTS["columns"])
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(tuple(sorted({r[0][:3] for r in read_table(spark, name).select("v").collect()})))

    reader = threading.Thread(target=read)
    reader.start()
    for v in ("new", "old", "new"):
        merge(many(spark, 60, v), name, ["id", "day"], ["v"])
    stop.set()
    reader.join()
    assert seen <= {("old",), ("new",)}


def test_a_thousand_parts_need_few_statements(spark, name, monkeypatch):
    df = spark.range(1000).select("id", F.lit("a").alias("v"), F.col("id").cast("string").alias("day"))
    append(df, name, partition_by=["day"])
    calls, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (calls.append(text), real(self, text, *a, **k))[1])
    merge(df.withColumn("v", F.lit("b")), name, ["id", "day"], ["v"])
    monkeypatch.undo()
    assert len(calls) <= 12 and sum("ADD" in c for c in calls) == 1
    assert read_table(spark, name).where("v = 'b'").count() == 1000 and len(parts_of(spark, name)) == 1000


@pytest.mark.parametrize("write_meanwhile", ["append", "merge", "compact"])
def test_another_writer_is_noticed(spark, name, write_meanwhile, monkeypatch):
    append(frame(spark, (1, "a", "d1"), (2, "b", "d2")), name, **LAYOUTS["columns"])
    append(frame(spark, (1, "a", "d1")), name)
    before = rows(spark, name)
    real = sinks.merge_frame

    def meanwhile(*args, **more):
        monkeypatch.setattr(sinks, "merge_frame", real)
        if write_meanwhile == "append":
            append(frame(spark, (9, "late", "d1")), name)
        elif write_meanwhile == "merge":
            merge(frame(spark, (9, "late", "d1")), name, ["id", "day"], ["v"])
        else:
            compact(spark, name)
        return real(*args, **more)

    monkeypatch.setattr(sinks, "merge_frame", meanwhile)
    with pytest.raises(SyncError, match="another writer meanwhile"):
        merge(frame(spark, (2, "c", "d2")), name, ["id", "day"], ["v"])
    late = [] if write_meanwhile == "compact" else [(9, "late", "d1")]
    assert rows(spark, name) == sorted(before + late, key=str)
    clean_versions(spark, target_of(spark, name))
    assert rows(spark, name) == sorted(before + late, key=str)


@pytest.mark.parametrize("step", ["publish", "new_version"])
def test_a_failed_write_leaves_the_target_alone(spark, name, step, monkeypatch):
    append(many(spark, 20), name, **LAYOUTS["columns"])
    target, before = target_of(spark, name), rows(spark, name)
    held = set(files.children(spark, target.location))
    monkeypatch.setattr(sinks, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        merge(frame(spark, (2, "c", "d2")), name, ["id", "day"], ["v"])
    monkeypatch.undo()
    assert rows(spark, name) == before and set(files.children(spark, target.location)) - {"_leases"} == held - {"_leases"}
    assert files.children(spark, f"{target.location}/_parts") == [target.version]


def test_cleaning_drops_versions_and_what_only_they_had(spark, name):
    append(many(spark, 20), name, **LAYOUTS["columns"])
    old = target_of(spark, name)
    reader = read_table(spark, name).where("day = 'd1'")
    reader.count()
    merge(frame(spark, (1, "x", "d1")), name, ["id", "day"], ["v"])
    merge(frame(spark, *((i, "y", f"d{i}") for i in range(5))), name, ["id", "day"], ["v"])
    now = target_of(spark, name)
    assert clean_versions(spark, now, older_than=3600) == []
    assert spark.catalog.tableExists(version_table(now.name, old.version))
    assert len(clean_versions(spark, now)) == 2 and clean_versions(spark, now) == []
    assert not spark.catalog.tableExists(version_table(now.name, old.version))
    assert len(rows(spark, name)) == 20 and (4, "y", "d4") in rows(spark, name)


def test_refusals(spark, name):
    df = frame(spark, (1, "a", "d1"))
    for more, message in (
        ({"partition_by": ["gone"]}, "'gone'"), ({"buckets": 4}, "key columns"), ({"buckets": -1, "keys": ["id"]}, "positive"),
        ({"partition_by": ["day"], "cluster_by": ["id"]}, "not both"), ({"tag": "a/b"}, "tag"), ({"max_file_bytes": 0}, "room"),
    ):
        with pytest.raises(SyncError, match=message):
            append(df, name, **more)
    with pytest.raises(SyncError, match="belong to the parts"):
        append(df.withColumnRenamed("v", "sync_batch"), name, partition_by=["day"])
    append(df, name, partition_by=["day"])
    with pytest.raises(SyncError, match="must be keys"):
        merge(df, name, ["id"], ["v"])
    with pytest.raises(SyncError, match="such parts"):
        append(df, name, partition_by=["v"])
    with pytest.raises(SyncError, match="no column"):
        append(df.withColumn("more", F.lit(1)), name)


def test_zeros_of_both_signs_and_nan_share_a_bucket(spark, name):
    ddl = "k DOUBLE, v STRING"
    append(frame(spark, (0.0, "a"), (float("nan"), "a"), ddl=ddl), name, keys=["k"], buckets=64)
    merge(frame(spark, (-0.0, "b"), (float("nan"), "b"), ddl=ddl), name, ["k"], ["v"])
    assert sorted(r["v"] for r in read_table(spark, name).collect()) == ["b", "b"]


# -- ledger and compaction


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["day"]}])
@pytest.mark.parametrize("between", ["replace", "merge", "compact"])
def test_a_replayed_batch_is_known_after_a_new_version(spark, name, layout, between):
    query = str(uuid.uuid4())
    append(frame(spark, (1, "a", "d1")), name, tag=f"{query}-0", **layout)
    append(frame(spark, (2, "b", "d1")), name, tag=f"{query}-1")
    if between == "replace":
        replace(frame(spark, (5, "r", "d1")), name)
    elif between == "merge":
        merge(frame(spark, (1, "m", "d1")), name, ["id", "day"], ["v"])
    else:
        compact(spark, name)
    before = rows(spark, name)
    assert append(frame(spark, (2, "b", "d1")), name, tag=f"{query}-1").first()["rows"] == 0
    assert append(frame(spark, (1, "a", "d1")), name, tag=f"{query}-0").first()["rows"] == 0
    assert rows(spark, name) == before
    append(frame(spark, (3, "c", "d1")), name, tag=f"{query}-2")
    append(frame(spark, (4, "d", "d1")), name, tag=f"{uuid.uuid4()}-0")
    assert len(rows(spark, name)) == len(before) + 2
    # Other tags name no query: their numbers say nothing about what came before.
    append(frame(spark, (6, "e", "d1")), name, tag="day-5")
    append(frame(spark, (7, "f", "d1")), name, tag="day-4")
    assert len(rows(spark, name)) == len(before) + 4


def test_two_hundred_batches_become_few_files(spark, name, tmp_path):
    append(frame(spark, (0, "v", "d")), name)
    target = target_of(spark, name)
    more = spark.range(1, 200).select("id", F.lit("v").alias("v"), F.lit("d").alias("day"))
    more.repartition(199, "id").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/more")
    for i, file in enumerate(c for c in files.children(spark, f"{tmp_path}/more") if c.endswith(".parquet")):  # as appends leave them
        files.rename(spark, f"{tmp_path}/more/{file}", f"{target.version_dir}/b{i}/{file}")
    assert len(files.children(spark, target.version_dir)) == 200
    reader = read_table(spark, name)
    before = rows(spark, name)
    assert len(before) == 200
    found = compact(spark, name).first()
    assert (found["rows"], found["files"]) == (200, 1)
    assert rows(spark, name) == before and sorted((tuple(r) for r in reader.collect()), key=str) == before
    assert compact(spark, name).first()["rows"] == 0


@pytest.mark.parametrize("layout", ["columns", "buckets", "files"])
def test_compaction_of_parts(spark, name, layout):
    for i in range(6):
        append(frame(spark, (i, "v", f"d{i % 2}"), (i + 10, "v", "d9") if i == 0 else (i, "w", f"d{i % 2}")), name, keys=["id"], **({} if i else LAYOUTS[layout]))
    before, parts = rows(spark, name), parts_of(spark, name)
    assert compact(spark, name, max_file_bytes=10**6).first()["rows"] > 0
    after = parts_of(spark, name)
    assert rows(spark, name) == before and len(after) < len(parts)
    if layout == "columns":
        assert len(after) == 3 and len(set(parts.items()) & set(after.items())) == 1  # d9 had one batch
    assert compact(spark, name, max_file_bytes=10**6).first()["rows"] == 0


def test_compaction_notices_an_append(spark, name, monkeypatch):
    for i in range(3):
        append(frame(spark, (i, "v", "d")), name)
    real = sinks._land
    monkeypatch.setattr(sinks, "_land", lambda *a, **k: (monkeypatch.setattr(sinks, "_land", real), append(frame(spark, (9, "late", "d")), name), real(*a, **k))[2])
    with pytest.raises(SyncError, match="another writer"):
        compact(spark, name)
    assert len(rows(spark, name)) == 4


def test_compaction_is_for_batches(spark, name):
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet")
    with pytest.raises(SyncError, match="no batches"):
        compact(spark, name)


# -- leases


@pytest.mark.parametrize("kind", ["published", "sharded", "table", "partitions"])
def test_a_clean_during_a_landing_leaves_it_alone(spark, name, kind, monkeypatch):
    if kind in ("table", "partitions"):
        spark.sql(f"CREATE TABLE {name} ({DDL}) USING parquet{' PARTITIONED BY (day)' if kind == 'partitions' else ''}")
    append(frame(spark, (1, "a", "d1")), name, **({"partition_by": ["day"]} if kind == "sharded" else {}))
    merge(frame(spark, (1, "b", "d1")), name, ["id", "day"], ["v"])
    cleaned = []
    clean = lambda *a: cleaned.append(clean_versions(spark, target_of(spark, name)))
    step = {"published": "publish", "sharded": "new_version", "table": "literal", "partitions": "partition_names"}[kind]
    real = getattr(sinks, step)
    monkeypatch.setattr(sinks, step, lambda *a, **k: (clean(), real(*a, **k))[1])
    merge(frame(spark, (1, "c", "d1")), name, ["id", "day"], ["v"])
    monkeypatch.undo()
    assert cleaned and rows(spark, name) == [(1, "c", "d1")]


def test_the_lease_of_a_dead_writer_runs_out(spark, name):
    append(frame(spark, (1, "a", "d1")), name)
    target = target_of(spark, name)
    lease(spark, target, f"{target.location}/v-dead")
    frame(spark, (2, "x", "d1")).write.parquet(f"{target.location}/v-dead/x")
    assert clean_versions(spark, target) == []
    time.sleep(0.05)
    assert clean_versions(spark, target, lease_seconds=0.01) == ["v-dead"]
    assert files.children(spark, f"{target.location}/_leases") == [] and rows(spark, name) == [(1, "a", "d1")]


# -- file sizes


@pytest.mark.parametrize("width", [8, 800])
@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
def test_files_roll_by_bytes(spark, name, width, mode):
    n, limit = 600_000 // width, 100_000
    text = F.expr(f"concat_ws('', transform(sequence(1, {width // 8}), i -> lpad(conv(abs(xxhash64(id, i)) % 4294967296, 10, 16), 8, '0')))")
    df = spark.range(n, numPartitions=3).select("id", text.alias("v"), F.lit("d").alias("day"))
    sinks.write(df, name, mode, max_file_bytes=limit, **({"keys": ["id"], "order_by": ["v"]} if mode == "merge" else {}))
    target = target_of(spark, name)
    sizes = [x for batch in files.children(spark, target.version_dir) for x in files.sizes(spark, f"{target.version_dir}/{batch}")]
    assert len(sizes) > 2 and max(sizes) <= 1.25 * limit and sum(x < limit / 2 for x in sizes) <= 1
    assert read_table(spark, name).count() == n
    # Many small files become few.
    replace(df.repartition(40), name, max_file_bytes=limit * 100)
    target = target_of(spark, name)
    assert sum(len(files.sizes(spark, f"{target.version_dir}/{b}")) for b in files.children(spark, target.version_dir)) == 1


def test_stagedwrite_takes_the_layout(spark, name):
    with StagedWrite(frame(spark, (1, "a", "d1")), name, "append", partition_by=["day"]) as staged:
        staged.commit()
    assert target_of(spark, name).layout.by == ("day",) and os.path.basename(target_of(spark, name).location)
