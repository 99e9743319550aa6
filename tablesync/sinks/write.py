"""Append, replace and merge: checked first, staged, then made visible by one statement."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace as changed

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.types import has_length, is_nested, normalize_for_write, target_ddl, write_schema
from tablesync.operators.dedup import SEQUENCE, dedup_last
from tablesync.operators.merge import key_names, merge_frame, merge_into, missing_names, plain_keys
from tablesync.session import scratch_dir, wide_shuffles
from tablesync.sinks import files
from tablesync.sinks.partitions import by_partition, key_of, partition_keys, partition_rows, partition_state
from tablesync.sinks.sharded import BATCH, BUCKET, Layout, drop_version, new_version, read_parts, shard_of, version_table, with_shards
from tablesync.sinks.target import (
    Target, aligned, create_file_table, find_target, lease, new_version_path, partition_names, partition_spec,
    publish, release, stage_table,
)
from tablesync.sources.names import EntityName, literal, quote
from tablesync.sources.read import current_name, prune

MODES = ("append", "replace", "merge")
BROADCAST_BYTES = 64 << 20
#: Size that rewritten files have at most, about.
FILE_BYTES = 128 << 20
_OPTIONS = ("entity",)
#: How the streams tag their batches: the query's id and the batch's number.
_STREAM_TAG = re.compile(r"([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})-(\d+)")


def _ledger(known: Mapping[str, int], tags: Sequence[str]) -> dict[str, int]:
    """The last batch of each stream query, from a ledger and the tags of batches that have landed since."""
    out = dict(known)
    for match in filter(None, map(_STREAM_TAG.fullmatch, tags)):
        out[match[1]] = max(out.get(match[1], -1), int(match[2]))
    return out


def _has_landed(known: Mapping[str, int], tag: str) -> bool:
    match = _STREAM_TAG.fullmatch(tag)
    return bool(match) and known.get(match[1], -1) >= int(match[2])


def check_write(
    df: DataFrame,
    output: str,
    mode: str,
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    schema_policy: str = "fail_on_change",
) -> None:
    """Everything that can be refused from the schema alone, before any job or catalog call."""
    if mode not in MODES:
        raise SyncError(f"{output}: '{mode}' is none of the ways to write: append, replace, merge")
    if schema_policy != "fail_on_change":
        raise SyncError(f"{output}: no schema policy '{schema_policy}' here: change the target's columns yourself")
    if mode == "merge":
        if not keys:
            raise SyncError(f"{output}: merge needs at least one key")
        types = {f.name: f.dataType for f in df.schema.fields}
        absent = [k for k in keys if k not in types]
        if absent:
            raise SyncError(f"{output}: to merge by {', '.join(map(repr, absent))}, the frame must have such columns")
        nested = [k for k in keys if is_nested(types[k])]
        if nested:
            raise SyncError(f"{output}: {', '.join(map(repr, nested))} cannot be compared as keys: nested types")
        if not order_by:
            raise SyncError(f"{output}: merge needs an ordering (order_by): Spark rows have no arrival order")
        unknown = [c for c in order_by if c not in types]
        if unknown:
            raise SyncError(f"{output}: ordering column(s) {', '.join(map(repr, unknown))} not in the frame")
    if any(c.lower() == SEQUENCE for c in df.columns) and SEQUENCE not in order_by:
        raise SyncError(f"{output}: the name '{SEQUENCE}' belongs to the row sequence; rename the column")


def _row_bytes(was: T.StructType, now: T.StructType) -> Column | None:
    """An upper bound of a staged row's size in memory, or None if a nested column leaves it open."""
    if any(is_nested(f.dataType) for f in now.fields):
        return None
    # Per row: header and hash entry. Per column: its slot, and the digits of a value cast to text.
    slots = sum(16 if a.dataType == b.dataType else 80 for a, b in zip(was.fields, now.fields))
    size = F.lit(64 + slots).cast("bigint")
    for field in was.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(quote(field.name))), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, T.DecimalType):
            size = size + F.lit(16)
    return size


def _land(
    df: DataFrame, schema: T.StructType, path: str, max_records: int | None, name: EntityName, max_bytes: int | None = None
) -> tuple[int, int | None]:
    """Write the frame as Parquet in exactly this schema; returns its rows and an upper bound of its size.

    Where types differ, the rows go through an INSERT into a table over the directory, so that
    Spark's own store assignment casts them: an overflow fails, and text does not become a number.
    """
    spark = df.sparkSession
    frame = aligned(df, schema)
    size = _row_bytes(frame.schema, schema)
    measures = [F.count(F.lit(1)).alias("rows")]
    if size is not None:
        measures.append(F.sum(size).alias("bytes"))
    seen = Observation()
    observed = frame.observe(seen, *measures)
    if frame.schema.simpleString() == schema.simpleString() and not any(map(has_length, schema.fields)):
        options = {"maxRecordsPerFile": max_records} if max_records else {}
        observed.write.options(**options).parquet(path)
    else:
        table = stage_table(name)
        create_file_table(spark, table, schema, path, max_records)
        try:
            observed.write.insertInto(table)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    found = seen.get
    if max_bytes:
        _roll(spark, path, schema, max_bytes, max_records)
    return found["rows"], None if size is None else found["bytes"] or 0


def _roll(spark: SparkSession, path: str, schema: T.StructType, max_bytes: int, max_records: int | None) -> None:
    """Deal what has landed over files of at most about ``max_bytes``, by the bytes that it took; rows keep no order.

    Nothing is done if the files are neither too large nor too many. Rows are dealt evenly, so that files are of a size.
    """
    found = files.sizes(spark, path)
    count = max(1, -(-sum(found) * 10 // (max_bytes * 9)))
    if max(found, default=0) <= max_bytes and len(found) <= 2 * count:
        return
    rolled = f"{path}-rolled"
    options = {"maxRecordsPerFile": max_records} if max_records else {}
    try:
        spark.read.schema(schema).parquet(path).repartition(count).write.options(**options).parquet(rolled)
        files.remove(spark, path)
        files.rename(spark, rolled, path)
    except BaseException:
        files.remove(spark, rolled)
        raise


def _create(spark: SparkSession, target: Target, schema: T.StructType, tag: str) -> Target:
    if target.kind == "v2":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target.name.quoted} ({target_ddl(schema)})")
        return Target(target.name, "v2", True)
    version = f"v-{tag}"
    spark.createDataFrame([], schema).write.parquet(f"{target.location}/{version}/{tag}-new")
    publish(spark, target, schema, version)
    return Target(target.name, "published", True, target.location, version)


def ensure_target(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None) -> EntityName:
    """Create a missing target, empty, with the given schema (a sharded one is created by its first write)."""
    entity = current_name(spark, name)
    target = find_target(spark, entity, location)
    if not target.exists:
        _create(spark, target, schema, uuid.uuid4().hex[:16])
    return entity


class StagedWrite:
    """One write. Nothing is staged before ``commit``, and a second commit is an error.

    As a context manager it aborts when left without a commit. A failed commit is final: the staged
    rows are gone and the target is as it was.
    """

    def __init__(
        self,
        df: DataFrame,
        output: str,
        mode: str,
        keys: Sequence[str] = (),
        order_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
        schema_policy: str = "fail_on_change",
        location: str | None = None,
        columns: Sequence[str] | None = None,
        strict_nested: bool = True,
        max_records_per_file: int | None = None,
        broadcast_bytes: int = BROADCAST_BYTES,
        tag: str | None = None,
        catalog: str | None = None,
        schema: str | None = None,
        max_file_bytes: int | None = None,
        partition_by: Sequence[str] = (),
        buckets: int = 0,
        cluster_by: Sequence[str] = (),
    ):
        options = dict(options or {})
        check_write(df, output, mode, keys, order_by, schema_policy)
        errors = [f"no output option is called '{key}' (there are {', '.join(_OPTIONS)})" for key in options if key not in _OPTIONS]
        try:
            self.name = current_name(df.sparkSession, options.get("entity") or output, catalog, schema)
        except SyncError as error:
            errors.append(str(error))
        if errors:
            raise SyncError("; ".join(errors))
        self.spark = df.sparkSession
        self.output, self.mode, self.keys, self.order_by = output, mode, list(keys), list(order_by)
        written = list(columns) if columns else [c for c in df.columns if c != SEQUENCE]
        if any(c.lower() == SEQUENCE for c in written):
            raise SyncError(f"{output}: the name '{SEQUENCE}' belongs to the row sequence; rename the column")
        lost = [k for k in self.keys if k not in written]
        if lost:
            raise SyncError(f"{output}: merge key(s) {', '.join(map(repr, lost))} not among the written columns")
        self.schema = write_schema(prune(df, written), output, strict_nested)
        # Ordering columns that are not written travel with the staged rows only.
        order_only = [c for c in self.order_by if c not in written] if mode == "merge" else []
        self.frame = normalize_for_write(prune(df, written + order_only), output, strict_nested)
        self.location, self.max_records, self.broadcast_bytes = location, max_records_per_file, broadcast_bytes
        self.tag = tag or uuid.uuid4().hex[:16]
        if not re.fullmatch(r"[\w.-]+", self.tag):
            raise SyncError(f"{output}: a tag names a directory: letters, digits, '_', '-' and '.' only")
        self.max_bytes = max_file_bytes
        if max_file_bytes is not None and max_file_bytes < 1:
            raise SyncError(f"{output}: files need room for at least one byte")
        self.layout = Layout.of(partition_by, buckets, keys, cluster_by)
        if self.layout:
            self.layout.check(self.schema, output)
        self.state = "open"

    def __enter__(self) -> StagedWrite:
        return self

    def __exit__(self, *exc) -> None:
        if self.state == "open":
            self.abort()

    def _leave(self, state: str) -> None:
        if self.state != "open":
            raise RuntimeError(f"{self.output}: the write is already {self.state}")
        self.state = state

    def abort(self) -> None:
        self._leave("aborted")

    def commit(self) -> DataFrame:
        """Run the write; returns one row: ``rows`` submitted, before any de-duplication, and ``files`` staged."""
        self._leave("committed")
        target = find_target(self.spark, self.name, self.location)
        if self.layout and target.kind == "published" and not target.exists:
            target = changed(target, kind="sharded", layout=self.layout)
        elif self.layout and target.layout != self.layout:
            raise SyncError(f"{self.output}: {self.name} does not have its rows in such parts; leave the parts out, or remove it first")
        if not target.exists and target.kind == "v2" and self.mode != "replace":
            target = _create(self.spark, target, self.schema, self.tag)
        # Listed before the target is resolved, so that no batch the merge does not see is among them.
        self.batches = self._batches(target) if target.kind == "published" and self.mode == "merge" else None
        # Resolved once: on a file target this lists every data file. None: a published target to be.
        self.seen = self._state(target) if target.kind == "table" and self.mode == "merge" and not target.partitions else None
        self.current = self.spark.table(self.name.quoted) if target.exists else None
        self.into = self.schema if self.current is None or self.mode == "replace" else self.current.schema
        lacking = missing_names(self.schema.names, self.into.names)
        if lacking:
            raise SyncError(f"{self.output}: {self.name} has no column {', '.join(map(repr, lacking))}")
        land = getattr(self, f"_{self.mode}_{target.kind}")
        rows, count = land(target)
        return self.spark.createDataFrame([(rows, count)], "rows BIGINT, files BIGINT")

    # -- published: a view over Parquet batches ---------------------------------------------------

    def _append_published(self, target: Target) -> tuple[int, int]:
        if self.current is None:
            return self._new_version(target, self.frame)
        if files.exists(self.spark, target.batch_dir(self.tag)) or _has_landed(target.ledger, self.tag):
            return 0, 0  # this batch has landed before: a replay
        stage = target.stage_dir(self.tag)
        files.remove(self.spark, stage)  # left by a writer that died
        try:
            rows, _ = _land(self.frame, self.into, stage, self.max_records, self.name, self.max_bytes)
            count = files.data_files(self.spark, stage)
            files.rename(self.spark, stage, target.batch_dir(self.tag))
            if find_target(self.spark, self.name).version != target.version:
                raise SyncError(f"{self.output}: {self.name} was replaced by another writer meanwhile; append again")
        finally:
            files.remove(self.spark, stage)
        return rows, count

    def _new_version(self, target: Target, frame: DataFrame) -> tuple[int, int]:
        """Land a new version and publish it, unless the batches it was computed from have changed."""
        version = f"v-{uuid.uuid4().hex[:16]}"
        path = f"{target.location}/{version}"
        lease(self.spark, target, path)
        try:
            rows, _ = _land(frame, self.into, f"{path}/{self.tag}", self.max_records, self.name, self.max_bytes)
            count = files.data_files(self.spark, f"{path}/{self.tag}")
            if self.batches is not None and self._batches(target) != self.batches:
                raise SyncError(f"{self.output}: {self.name} was written by another writer meanwhile; merge again")
            landed = files.children(self.spark, target.version_dir) if target.exists else []
            publish(self.spark, target, self.into, version, _ledger(target.ledger, landed))
        except BaseException:
            if find_target(self.spark, self.name, self.location).version != version:
                files.remove(self.spark, path)
            raise
        finally:
            release(self.spark, target, path)
        return rows, count

    def _batches(self, target: Target) -> list[str] | None:
        """The batches of a version while it is the current one."""
        if not target.exists or find_target(self.spark, self.name).version != target.version:
            return None
        return sorted(files.children(self.spark, target.version_dir))

    def _replace_published(self, target: Target) -> tuple[int, int]:
        return self._new_version(target, self.frame)

    def _staged_source(self, stage: str) -> tuple[DataFrame, list[str], int, int, bool]:
        """Stage the raw rows, then read them back de-duplicated: source, keys, rows, files, is it small.

        Staging computes the source once although the merge reads it twice, freezes it against a
        changed answer on retry, casts it to the target's types, and gives its size.
        """
        have = {f.name.lower(): f for f in self.into.fields}
        fields = [have.get(f.name.lower(), f) for f in self.frame.schema.fields]
        staged_schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])
        spelled = {f.name.lower(): f.name for f in fields}
        keys = [spelled[k.lower()] for k in self.keys]
        # A cast can make different values equal: what decides which row is last keeps its own type as well.
        own = {
            f.name.lower(): T.StructField(f"_sync_own_{i}", f.dataType)
            for i, (f, to) in enumerate(zip(self.frame.schema.fields, fields))
            if f.dataType != to.dataType and to.name not in keys and not is_nested(f.dataType)
        }
        frame = self.frame.withColumns({field.name: F.col(quote(c)) for c, field in own.items()}) if own else self.frame
        self.staged_schema = staged_schema = T.StructType(staged_schema.fields + list(own.values()))
        rows, size = _land(frame, staged_schema, stage, self.max_records, self.name)
        order = [own[c.lower()].name if c.lower() in own else spelled[c.lower()] for c in self.order_by]
        order += [field.name for field in own.values() if field.name not in order]
        last = dedup_last(self.spark.read.schema(staged_schema).parquet(stage), keys, order)
        source = last.select([F.col(quote(spelled[c.lower()])) for c in self.schema.names])
        small = size is not None and size <= self.broadcast_bytes
        return source, keys, rows, files.data_files(self.spark, stage), small

    def _merged(self, stage: str) -> tuple[DataFrame, int, int]:
        source, keys, rows, count, small = self._staged_source(stage)
        if self.current is None:
            return source, rows, count
        return merge_frame(self.current, source, keys, small_source=small), rows, count

    def _merge_published(self, target: Target) -> tuple[int, int]:
        stage = target.stage_dir(self.tag)
        files.remove(self.spark, stage)
        try:
            merged, rows, count = self._merged(stage)
            if rows or self.current is None:
                held = files.size(self.spark, target.version_dir) if target.exists else 0
                with wide_shuffles(self.spark, held + files.size(self.spark, stage)):
                    self._new_version(target, merged)
        finally:
            files.remove(self.spark, stage)
        return rows, count

    def _counted(self, frame: DataFrame, run: Callable[[DataFrame], None]) -> tuple[int, None]:
        """Run a write whose format does its own staging; its files are not ours to count.

        Rows are counted in the writing tasks, where a task that runs twice counts once.
        """
        seen = Observation()
        run(frame.observe(seen, F.count(F.lit(1)).alias("rows")))
        return seen.get["rows"], None

    # -- file tables of the session catalog -------------------------------------------------------

    def _append_table(self, target: Target) -> tuple[int, None]:
        frame = by_partition(aligned(self.frame, self.into), target.partitions)
        return self._counted(frame, lambda counted: counted.write.insertInto(self.name.quoted))

    def _swap_location(self, target: Target, frame: DataFrame, schema: T.StructType) -> tuple[int, int]:
        if target.provider != "parquet" or target.partitions or target.bucketed:
            raise SyncError(
                f"{self.output}: {self.name} is not an unpartitioned, unbucketed Parquet table, which {self.mode} needs"
            )
        path = new_version_path(target)
        lease(self.spark, target, path)
        try:
            rows, _ = _land(frame, schema, path, self.max_records, self.name, self.max_bytes)
            count = files.data_files(self.spark, path)
            if self.mode == "merge" and self._state(target) != self.seen:
                raise SyncError(f"{self.output}: another writer changed {self.name} meanwhile; merge again")
            self.spark.sql(f"ALTER TABLE {self.name.quoted} SET LOCATION {literal(path)}")
        except BaseException:
            if find_target(self.spark, self.name).location == target.location:
                files.remove(self.spark, path)
            raise
        finally:
            release(self.spark, target, path)
        self.spark.catalog.refreshTable(self.name.quoted)
        return rows, count

    def _state(self, target: Target) -> tuple:
        """Where an unpartitioned file table is, and its files: what a merge was computed from."""
        now = find_target(self.spark, self.name)
        return now.location, sorted(files.children(self.spark, now.location))

    def _replace_table(self, target: Target) -> tuple[int, int]:
        if self.current.schema.simpleString() != self.schema.simpleString():
            raise SyncError(
                f"{self.output}: {self.name} is a file table: its columns and rows are not replaced together; "
                "remove the table first"
            )
        return self._swap_location(target, self.frame, self.current.schema)

    def _merge_table(self, target: Target) -> tuple[int, int]:
        if target.partitions:
            return self._merge_partitions(target)
        stage = scratch_dir(self.spark, "stage")
        try:
            merged, rows, count = self._merged(stage)
            if rows:
                with wide_shuffles(self.spark, files.size(self.spark, target.location) + files.size(self.spark, stage)):
                    self._swap_location(target, merged, self.current.schema)
        finally:
            files.remove(self.spark, stage)
        return rows, count

    def _merge_partitions(self, target: Target) -> tuple[int, int]:
        """Read and rewrite only the partitions the source has rows in.

        Partition columns are keys, so no row outside of those partitions can match, and no row moves.
        """
        outside = missing_names(target.partitions, self.keys)
        if outside:
            missing = ", ".join(map(repr, outside))
            raise SyncError(f"{self.output}: to merge into {self.name}, partition column(s) {missing} must be keys")
        if target.provider != "parquet" or target.bucketed:
            raise SyncError(f"{self.output}: {self.name} is not an unbucketed Parquet table, which merge needs")
        stage = scratch_dir(self.spark, "stage")
        try:
            source, keys, rows, count, small = self._staged_source(stage)
            if rows:
                # From the staged rows: partition columns are keys, which the de-duplication does not change.
                partitions = self.spark.read.schema(self.staged_schema).parquet(stage).select([F.col(quote(c)) for c in target.partitions])
                touched = partition_keys(partitions)
                # What the merge is computed from: taken before the partitions are read, compared before they are swapped.
                self.spark.catalog.refreshTable(self.name.quoted)
                held = partition_state(self.spark, self.name.quoted, touched)
                rows_held = partition_rows(self.spark.table(self.name.quoted), list(target.partitions), touched)
                self._swap_partitions(target, merge_frame(rows_held, source, keys, small_source=small), touched, held)
        finally:
            files.remove(self.spark, stage)
        return rows, count

    def _swap_partitions(self, target: Target, frame: DataFrame, touched: list[str], held: dict) -> None:
        """Write the partitions anew, beside the table, then point the catalog at them.

        Refused if another writer has added, changed, moved or dropped one of them since ``held`` was taken.
        New partitions come in one statement, then each changed one in a statement of its own. If one fails, those before are
        pointed back and the table is as it was. A driver that is lost in between leaves whole partitions, some old and
        some new, and the directory of the new ones; running the merge again completes it.
        """
        path = new_version_path(target)
        table = stage_table(self.name)
        lease(self.spark, target, path)
        try:
            self._swap(target, frame, touched, held, path, table)
        finally:
            release(self.spark, target, path)

    def _swap(self, target: Target, frame: DataFrame, touched: list[str], held: dict, path: str, table: str) -> None:
        create_file_table(self.spark, table, self.into, path, self.max_records, target.partitions)
        try:
            by_partition(aligned(frame, self.into), target.partitions).write.insertInto(table)
            fresh = partition_names(self.spark, table)
        except BaseException:
            files.remove(self.spark, path)
            raise
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        if find_target(self.spark, self.name).location != target.location or partition_state(self.spark, self.name.quoted, touched) != held:
            files.remove(self.spark, path)
            raise SyncError(f"{self.output}: another writer changed partitions of {self.name} meanwhile; merge again")
        before = {name: held[name][0] if name in held else None for name in fresh}
        added = [name for name in fresh if before[name] is None]
        moved: list[str] = []
        alter = f"ALTER TABLE {self.name.quoted}"
        try:
            if added:
                self.spark.sql(f"{alter} ADD " + " ".join(f"{partition_spec(n)} LOCATION {literal(f'{path}/{n}')}" for n in added))
            for name in fresh:
                if before[name] is not None:
                    moved.append(name)
                    self.spark.sql(f"{alter} {partition_spec(name)} SET LOCATION {literal(f'{path}/{name}')}")
        except BaseException:
            for name in moved:
                self.spark.sql(f"{alter} {partition_spec(name)} SET LOCATION {literal(before[name])}")
            if added:
                self.spark.sql(f"{alter} DROP IF EXISTS " + ", ".join(map(partition_spec, added)))
            files.remove(self.spark, path)
            raise
        finally:
            self.spark.catalog.refreshTable(self.name.quoted)

    # -- sharded: a view over parts -----------------------------------------------------------------

    def _append_sharded(self, target: Target) -> tuple[int, int]:
        held = read_parts(self.spark, target.location, target.version) if target.exists else {}
        if _has_landed(target.ledger, self.tag) or any(part.endswith(f"{BATCH}={self.tag}") for part in held):
            return 0, 0  # this batch has landed before: a replay
        return self._staged_parts(target, held)

    def _replace_sharded(self, target: Target) -> tuple[int, int]:
        target.layout.check(self.schema, self.output)
        return self._staged_parts(target, {})

    def _staged_parts(self, target: Target, held: dict[str, str]) -> tuple[int, int]:
        """Land the frame, cast to the target's types, as parts beside those held."""
        stage = scratch_dir(self.spark, "stage")
        try:
            rows, _ = _land(self.frame, self.into, stage, None, self.name)
            if not rows and held:
                return 0, 0
            size = files.size(self.spark, stage)
            return rows, self._publish_parts(target, held, self.spark.read.schema(self.into).parquet(stage), size)
        finally:
            files.remove(self.spark, stage)

    def _merge_sharded(self, target: Target) -> tuple[int, int]:
        """Rewrite only the parts that the source can have rows in, or, by files, those that hold its keys."""
        layout = target.layout
        outside = missing_names((*layout.by, *layout.keys), self.keys)
        if outside:
            missing = ", ".join(map(repr, outside))
            raise SyncError(f"{self.output}: to merge into {self.name}, {missing}, by which its parts are made, must be keys")
        stage = scratch_dir(self.spark, "stage")
        try:
            source, keys, rows, count, small = self._staged_source(stage)
            size = files.size(self.spark, stage)
            if self.current is None:
                self._publish_parts(target, {}, source, size)
            elif rows:
                held = read_parts(self.spark, target.location, target.version)
                store = self.spark.table(version_table(self.name, target.version))
                if layout.cluster:
                    hit = set(self._hit_files(store, source, keys, layout, small))
                    old = {part for part in held if part.rpartition("=")[2] in hit}
                    touched = store.where(F.col(BATCH).isin(sorted(hit))) if hit else store.where("false")
                else:
                    staged = self.spark.read.schema(self.staged_schema).parquet(stage)
                    if layout.buckets:
                        staged = staged.withColumn(BUCKET, layout.bucket(staged.schema))
                    shards = partition_keys(staged.select([F.col(quote(c)) for c in layout.shard]))
                    old = {part for part in held if key_of(shard_of(part)) in set(shards)}
                    touched = partition_rows(store, layout.shard, shards)
                rows_held = touched.select([F.col(quote(c)) for c in self.into.names])
                size += sum(files.size(self.spark, held[part]) for part in old)
                kept = {part: place for part, place in held.items() if part not in old}
                self._publish_parts(target, kept, merge_frame(rows_held, source, keys, small_source=small), size)
        finally:
            files.remove(self.spark, stage)
        return rows, count

    def _hit_files(self, store: DataFrame, source: DataFrame, keys: list[str], layout: Layout, small: bool) -> list[str]:
        """The parts that hold a key of the source: only keys are read, and only where the files' statistics let them be."""
        first = layout.cluster[0]
        found = store
        if first in keys:
            low, high, some = source.agg(F.min(quote(first)), F.max(quote(first)), F.count(F.when(F.col(quote(first)).isNull(), 1))).first()
            near = F.col(quote(first)).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
            found = found.where(near | F.col(quote(first)).isNull() if some else near)
        wanted = source.select(plain_keys(source, keys))
        hits = found.select(*plain_keys(found, keys), BATCH).join(F.broadcast(wanted) if small else wanted, key_names(keys), "left_semi")
        return [r[0] for r in hits.select(BATCH).distinct().collect()]

    def _publish_parts(self, target: Target, held: dict[str, str], frame: DataFrame, size: int) -> int:
        """Land a frame as parts and make them, with those held, the target's, unless another writer has been faster."""
        layout, path, table = target.layout, f"{target.location}/data-{uuid.uuid4().hex[:16]}", stage_table(self.name)
        max_bytes = self.max_bytes or FILE_BYTES
        frame = aligned(frame, self.into)
        if layout.cluster:
            frame = frame.repartitionByRange(max(1, -(-size // max_bytes)), *[F.col(quote(c)) for c in layout.cluster])
        shaped = with_shards(frame, layout, self.tag, self.into)
        if not layout.cluster:
            shaped = by_partition(shaped, (*layout.shard, BATCH))
        columns = {f.name: f for f in (*self.into.fields, *layout.hidden)}
        version = None
        lease(self.spark, target, path)
        try:
            schema = T.StructType([columns[c] for c in shaped.columns])
            create_file_table(self.spark, table, schema, path, self.max_records, (*layout.shard, BATCH))
            try:
                shaped.write.insertInto(table)
                landed = {part: f"{path}/{part}" for part in partition_names(self.spark, table)}
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            version = new_version(
                self.spark, self.name, target.location, self.into, layout, {**held, **landed}, create_file_table, partition_spec
            )
            now = find_target(self.spark, self.name, self.location)
            if self.mode != "replace" and (now.exists, now.version) != (target.exists, target.version):
                raise SyncError(f"{self.output}: {self.name} was written by another writer meanwhile; {self.mode} again")
            publish(self.spark, target, self.into, version, _ledger(target.ledger, [self.tag]))
        except BaseException:
            if version is None or find_target(self.spark, self.name, self.location).version != version:
                if version:
                    drop_version(self.spark, self.name, target.location, version)
                files.remove(self.spark, path)
            raise
        finally:
            release(self.spark, target, path)
        return sum(1 for _ in landed) if layout.cluster else files.data_files(self.spark, path)

    # -- tables whose format has its own atomic writes --------------------------------------------

    def _append_v2(self, target: Target) -> tuple[int, None]:
        return self._counted(self.frame, lambda counted: counted.writeTo(self.name.quoted).append())

    def _replace_v2(self, target: Target) -> tuple[int, None]:
        return self._counted(self.frame, lambda counted: counted.writeTo(self.name.quoted).createOrReplace())

    def _merge_v2(self, target: Target) -> tuple[int, int]:
        stage = scratch_dir(self.spark, "stage")
        try:
            source, keys, rows, count, _ = self._staged_source(stage)
            merge_into(self.spark, self.name.quoted, source, keys)
        finally:
            files.remove(self.spark, stage)
        return rows, count


    # -- compaction ---------------------------------------------------------------------------------

    def compact(self, max_batches: int) -> tuple[int, int]:
        """Rewrite what lies in more than ``max_batches`` batches; the frame must be the target's own rows."""
        self._leave("committed")
        target = find_target(self.spark, self.name)
        if target.kind not in ("published", "sharded") or not target.exists:
            raise SyncError(f"{self.output}: {self.name} has no batches to bring together")
        self.current, self.into = self.frame, self.frame.schema
        max_bytes = self.max_bytes or FILE_BYTES
        if target.kind == "published":
            self.batches = self._batches(target)
            if self.batches is None or len(self.batches) <= max_batches:
                return 0, 0
            count = max(1, -(-files.size(self.spark, target.version_dir) // max_bytes))
            return self._new_version(target, self.frame.repartition(count))
        held = read_parts(self.spark, target.location, target.version)
        groups: dict[str, list[str]] = {}
        for part in held:
            if not target.layout.cluster or files.size(self.spark, held[part]) * 2 < max_bytes:
                groups.setdefault(shard_of(part), []).append(part)
        old = {part for parts in groups.values() if len(parts) > max_batches for part in parts}
        if not old:
            return 0, 0
        store = self.spark.table(version_table(self.name, target.version))
        names = [*target.layout.shard, BATCH]
        rows = partition_rows(store, names, sorted(map(key_of, old))).select([F.col(quote(c)) for c in self.into.names])
        seen = Observation()
        size = sum(files.size(self.spark, held[part]) for part in old)
        kept = {part: place for part, place in held.items() if part not in old}
        count = self._publish_parts(target, kept, rows.observe(seen, F.count(F.lit(1)).alias("rows")), size)
        return seen.get["rows"], count


def write(df: DataFrame, output: str, mode: str, **settings) -> DataFrame:
    with StagedWrite(df, output, mode, **settings) as staged:
        return staged.commit()


def append(df: DataFrame, output: str, **settings) -> DataFrame:
    """Insert by name; target columns that are not written are NULL. At least once on retry, unless a tag is given."""
    return write(df, output, "append", **settings)


def replace(df: DataFrame, output: str, **settings) -> DataFrame:
    """New data and new schema at once."""
    return write(df, output, "replace", **settings)


def merge(df: DataFrame, output: str, keys: Sequence[str], order_by: Sequence[str], **settings) -> DataFrame:
    """Upsert the last row per key. Idempotent: the same rows again change nothing."""
    return write(df, output, "merge", keys=keys, order_by=order_by, **settings)


def compact(spark: SparkSession, output: str, max_batches: int = 1, **settings) -> DataFrame:
    """Bring the batches of a published or sharded target together into files of about ``max_file_bytes`` (128 MiB).

    Rows stay the same; readers see the batches or the files, never both, and a writer that lands meanwhile is noticed. What
    a ledger needs to recognise a replayed stream batch is kept. Returns ``rows`` rewritten and ``files``.
    """
    name = current_name(spark, output)
    with StagedWrite(spark.table(name.quoted), output, "append", strict_nested=False, **settings) as staged:
        return spark.createDataFrame([staged.compact(max_batches)], "rows BIGINT, files BIGINT")
