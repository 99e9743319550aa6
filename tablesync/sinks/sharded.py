"""Sharded targets: a view over parts that are rewritten one by one.

The rows lie in parts, one directory each. A *version* of the target is an external table whose partitions are the
parts that belong to it, wherever their directories are; the view names one version. A write lands new parts, lists them
with the untouched old ones in a new version table, and then makes that the view's: one statement, whatever the
number of parts, so that a reader sees all of a write or nothing. What the reader resolved stays readable until
``clean_versions``.

Parts are made by (``by``) columns, by the hash of key columns (``buckets``), or by file over ranges of key columns
(``cluster``). A merge finds the parts it touches from the source's own rows in the first two cases, and from the
key columns of the target in the last, where only the files that hold matching keys are rewritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.sinks import files
from tablesync.sources.names import EntityName, literal, quote

BUCKET, BATCH = "sync_bucket", "sync_batch"
#: Parts that one statement adds to a version.
ADDED_AT_ONCE = 2000


@dataclass(frozen=True)
class Layout:
    by: tuple[str, ...] = ()
    buckets: int = 0
    keys: tuple[str, ...] = ()  # of the buckets
    cluster: tuple[str, ...] = ()

    @staticmethod
    def of(by: Sequence[str] = (), buckets: int = 0, keys: Sequence[str] = (), cluster: Sequence[str] = ()) -> Layout | None:
        if cluster and (by or buckets):
            raise SyncError("parts are made by files of a key range, or by columns and buckets, not both")
        if not (by or buckets or cluster):
            return None
        return Layout(tuple(by), int(buckets), tuple(keys) if buckets else (), tuple(cluster))

    @staticmethod
    def parse(text: str) -> Layout:
        return Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @property
    def hidden(self) -> list[T.StructField]:
        bucket = [T.StructField(BUCKET, T.IntegerType())] if self.buckets else []
        return [*bucket, T.StructField(BATCH, T.StringType())]

    @property
    def shard(self) -> list[str]:
        """The columns that name a shard; its parts differ in their batch only."""
        return [*self.by, *([BUCKET] if self.buckets else [])]

    def check(self, schema: T.StructType, output: str) -> None:
        for column in (*self.by, *self.keys, *self.cluster):
            if column not in schema.names:
                raise SyncError(f"{output}: parts cannot be made by '{column}': no such column")
        if self.buckets < 0 or (self.buckets and not self.keys):
            raise SyncError(f"{output}: buckets need a positive number and key columns")
        if any(n.lower() in (BUCKET, BATCH) for n in schema.names):
            raise SyncError(f"{output}: the names '{BUCKET}' and '{BATCH}' belong to the parts; rename the column")

    def bucket(self, schema: T.StructType) -> Column:
        types = {f.name: f.dataType for f in schema.fields}
        # Zeros of both signs are one key.
        plain = lambda c: F.col(quote(c)) + F.lit(0.0).cast(types[c]) if isinstance(types[c], (T.FloatType, T.DoubleType)) else F.col(quote(c))
        return F.pmod(F.xxhash64(*map(plain, self.keys)), F.lit(self.buckets)).cast("int")


def version_table(name: EntityName, version: str) -> str:
    return f"`spark_catalog`.{quote(name.schema)}.{quote(f'sync_{version}_{name.table}'.replace('-', '_'))}"


def read_parts(spark: SparkSession, location: str, version: str) -> dict[str, str]:
    """The parts of a version, by name, and their directories: as many as the version has partitions."""
    rows = spark.read.schema("part STRING, place STRING").parquet(f"{location}/_parts/{version}").collect()
    return {r["part"]: r["place"] for r in rows}


def shard_of(part: str) -> str:
    """A part's name without its batch."""
    return part.rpartition(f"{BATCH}=")[0].rstrip("/")


def new_version(
    spark: SparkSession, name: EntityName, location: str, schema: T.StructType, layout: Layout, parts: dict[str, str], create, spec
) -> str:
    """List parts as a version that no reader sees yet: its table, and the file the next write finds them in."""
    version = f"v-{uuid.uuid4().hex[:16]}"
    table = version_table(name, version)
    columns = T.StructType([f for f in schema.fields if f.name not in layout.by] + [f for f in schema.fields if f.name in layout.by] + layout.hidden)
    create(spark, table, columns, f"{location}/_tables/{version}", partitions=(*layout.shard, BATCH))
    try:
        listed = sorted(parts.items())
        for i in range(0, len(listed), ADDED_AT_ONCE):
            some = " ".join(f"{spec(part)} LOCATION {literal(place)}" for part, place in listed[i : i + ADDED_AT_ONCE])
            spark.sql(f"ALTER TABLE {table} ADD {some}")
        frame = spark.createDataFrame(listed, "part STRING, place STRING") if listed else spark.createDataFrame([], "part STRING, place STRING")
        frame.coalesce(1).write.parquet(f"{location}/_parts/{version}")
    except BaseException:
        drop_version(spark, name, location, version)
        raise
    return version


def drop_version(spark: SparkSession, name: EntityName, location: str, version: str) -> None:
    """Forget a version; its parts' directories stay."""
    spark.sql(f"DROP TABLE IF EXISTS {version_table(name, version)}")
    files.remove(spark, f"{location}/_parts/{version}")
    files.remove(spark, f"{location}/_tables/{version}")


def with_shards(frame: DataFrame, layout: Layout, tag: str, schema: T.StructType) -> DataFrame:
    """The frame, its columns of exactly ``schema``, with the hidden columns; partition columns last."""
    if layout.buckets:
        frame = frame.withColumn(BUCKET, layout.bucket(schema))
    batch = F.concat(F.lit(f"{tag}-"), F.spark_partition_id().cast("string")) if layout.cluster else F.lit(tag)
    names = [f.name for f in schema.fields if f.name not in layout.by]
    return frame.select([F.col(quote(c)) for c in (*names, *layout.shard)] + [batch.alias(BATCH)])
