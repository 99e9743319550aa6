"""Where a write lands.

``published``  a view over a directory of Parquet batches. A new version of the data is a new
               directory, made visible by one CREATE OR REPLACE VIEW; a batch is appended by one rename.
``sharded``    a view over parts that are rewritten one by one (see :mod:`tablesync.sinks.sharded`).
``table``      a file table of the session catalog. A merge into a partitioned one, whose partition columns are
               among the keys, rewrites only the partitions that the source has.
``v2``         a table of a catalog whose format has its own atomic append, replace and merge.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.types import omitted, target_ddl
from tablesync.sinks import files
from tablesync.sinks.sharded import Layout, drop_version, read_parts, version_table
from tablesync.sources.names import EntityName, literal, quote

_LOCATION = "tablesync.location"
_VERSION = "tablesync.version"
_LAYOUT = "tablesync.layout"
_LEDGER = "tablesync.ledger"
#: Seconds for which a writer's lease protects what it lands.
LEASE_SECONDS = 7 * 86_400.0
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_FILE_PROVIDERS = ("parquet", "orc", "json", "csv", "text", "avro", "hive")


@dataclass(frozen=True)
class Target:
    name: EntityName
    kind: str
    exists: bool
    location: str | None = None
    version: str | None = None
    provider: str | None = None
    partitions: tuple[str, ...] = ()
    bucketed: bool = False
    layout: Layout | None = None
    ledger: Mapping[str, int] = field(default_factory=dict)  # the last batch of each stream query that is known to be in

    @property
    def version_dir(self) -> str:
        return f"{self.location}/{self.version}"

    def batch_dir(self, tag: str) -> str:
        return f"{self.version_dir}/{tag}"

    def stage_dir(self, tag: str) -> str:
        return f"{self.location}/_stage/{tag}"


def find_target(spark: SparkSession, name: EntityName, location: str | None = None) -> Target:
    """Look a target up; ``location`` is where a published target that does not exist yet will live."""
    if not spark.catalog.tableExists(name.quoted):
        if name.catalog != "spark_catalog" or spark.conf.get("spark.sql.catalog.spark_catalog", None):
            return Target(name, "v2", False)
        return Target(name, "published", False, (location or _default_location(spark, name)).rstrip("/"))
    if name.catalog != "spark_catalog":
        return Target(name, "v2", True)
    if spark.catalog.getTable(name.quoted).tableType == "VIEW":
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name.quoted}").collect()}
        if _LOCATION not in props:
            raise SyncError(f"{name} is a view that was not published by this library; it cannot be written")
        layout = Layout.parse(props[_LAYOUT]) if _LAYOUT in props else None
        return Target(
            name, "sharded" if layout else "published", True, props[_LOCATION], props[_VERSION], layout=layout,
            ledger=json.loads(props.get(_LEDGER, "{}")),
        )
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name.quoted}").collect()}
    provider = described.get("Provider", "hive").lower()
    if provider not in _FILE_PROVIDERS:
        return Target(name, "v2", True, provider=provider)
    partitions = tuple(c.name for c in spark.catalog.listColumns(name.quoted) if c.isPartition)
    return Target(
        name, "table", True, described.get("Location"), provider=provider, partitions=partitions,
        bucketed="Num Buckets" in described,
    )


def _default_location(spark: SparkSession, name: EntityName) -> str:
    database = spark.catalog.getDatabase(f"{quote(name.catalog)}.{quote(name.schema)}")
    return f"{database.locationUri.rstrip('/')}/{name.table}"


def publish(spark: SparkSession, target: Target, schema: T.StructType, version: str, ledger: Mapping[str, int] | None = None) -> None:
    """Make one version of the data the target's content and schema, in a single catalog statement."""
    if set(target.location) & set("{}[]*?\\"):
        raise SyncError(f"{target.name}: a location may not hold glob characters")
    columns = ", ".join(quote(c) for c in schema.names)
    source = version_table(target.name, version) if target.layout else f"parquet.{quote(f'{target.location}/{version}/*')}"
    props = {_LOCATION: target.location, _VERSION: version}
    if target.layout:
        props[_LAYOUT] = target.layout.text()
    if ledger:
        props[_LEDGER] = json.dumps(dict(ledger), sort_keys=True)
    spark.sql(
        f"CREATE OR REPLACE VIEW {target.name.quoted} "
        f"TBLPROPERTIES ({', '.join(f'{literal(k)} = {literal(v)}' for k, v in props.items())}) "
        f"AS SELECT {columns} FROM {source}"
    )


def _lease(target: Target, name: str) -> str:
    if target.kind == "table":
        folder, _, base = _base(target).rpartition("/")
        return f"{folder}/_leases-{base}/{name}"
    return f"{target.location}/_leases/{name}"


def lease(spark: SparkSession, target: Target, path: str) -> None:
    """Say that a writer is landing rows in a directory, so that it is not cleaned away beneath it."""
    files.touch(spark, _lease(target, path.rstrip("/").rpartition("/")[2]))


def release(spark: SparkSession, target: Target, path: str) -> None:
    files.remove(spark, _lease(target, path.rstrip("/").rpartition("/")[2]))


def new_version_path(target: Target) -> str:
    """A new directory beside a file table's first one: the name of a version is replaced, not lengthened."""
    return f"{_base(target)}-{uuid.uuid4().hex[:16]}"


def _base(target: Target) -> str:
    return re.sub(r"-[0-9a-f]{16}$", "", target.location.rstrip("/"))


def stage_table(name: EntityName) -> str:
    """A name for a table over staged files, in the target's own schema (that of the session for other catalogs)."""
    schema = name.schema if name.catalog == "spark_catalog" else "default"
    return f"`spark_catalog`.{quote(schema)}.`sync_stage_{uuid.uuid4().hex}`"


def clean_versions(spark: SparkSession, target: Target, older_than: float = 0.0, lease_seconds: float = LEASE_SECONDS) -> list[str]:
    """Remove what no longer belongs to a target; returns the directories' names.

    Kept are what the target consists of, what was changed within ``older_than`` seconds, and what a writer has leased, for
    ``lease_seconds`` after it began: the lease of a writer that died runs out. Not part of a write: a query that
    started on an older version may still be reading it.
    """
    if target.kind not in ("published", "sharded", "table") or not target.exists:
        raise SyncError(f"{target.name} is neither a published target nor a file table")

    def free(folder: str, name: str) -> bool:
        held = files.age(spark, _lease(target, name))
        changed = files.age(spark, f"{folder}/{name}")
        return (held is None or held > lease_seconds) and (not older_than or changed is None or changed > older_than)

    if target.kind == "sharded":
        return _clean_parts(spark, target, free)
    if target.kind == "published":
        folder, old = target.location, [c for c in files.children(spark, target.location) if c not in (target.version, "_stage", "_leases")]
        for stage in files.children(spark, f"{folder}/_stage"):
            if (files.age(spark, f"{folder}/_stage/{stage}") or 0) > max(older_than, lease_seconds):  # of a writer that died
                files.remove(spark, f"{folder}/_stage/{stage}")
    else:
        folder, _, name = _base(target).rpartition("/")
        used = {target.location.rstrip("/").rpartition("/")[2]}
        if target.partitions:
            used |= {name}  # the table's own directory, in which partitions are that were never merged into
            places = (partition_location(spark, target.name.quoted, p) for p in partition_names(spark, target.name.quoted))
            used |= {re.sub(r"^.*/([^/]+)$", r"\1", "/".join(p.rstrip("/").split("/")[: -len(target.partitions)])) for p in places if p}
        old = [c for c in files.children(spark, folder) if re.fullmatch(re.escape(name) + "(-[0-9a-f]{16})?", c) and c not in used]
    old = [name for name in old if free(folder, name)]
    for version in old:
        files.remove(spark, f"{folder}/{version}")
        files.remove(spark, _lease(target, version))
    return old


def _clean_parts(spark: SparkSession, target: Target, free) -> list[str]:
    """Drop old versions of a sharded target, then the directories that no version left has a part in."""
    for version in files.children(spark, f"{target.location}/_parts"):
        if version != target.version and free(f"{target.location}/_parts", version):
            drop_version(spark, target.name, target.location, version)
    used = {
        place[len(target.location) + 1 :].split("/")[0]
        for version in files.children(spark, f"{target.location}/_parts")
        for place in read_parts(spark, target.location, version).values()
    }
    old = [c for c in files.children(spark, target.location) if c.startswith("data-") and c not in used and free(target.location, c)]
    for name in old:
        files.remove(spark, f"{target.location}/{name}")
        files.remove(spark, _lease(target, name))
    return old


def drop_target(spark: SparkSession, target: Target) -> None:
    """Remove a target's catalog entries, those of a sharded target's versions too. Files of views and external tables stay."""
    spark.sql(f"DROP {'VIEW' if target.kind in ('published', 'sharded') else 'TABLE'} IF EXISTS {target.name.quoted}")
    if target.kind == "sharded":
        for version in files.children(spark, f"{target.location}/_parts"):
            spark.sql(f"DROP TABLE IF EXISTS {version_table(target.name, version)}")


def partition_location(spark: SparkSession, table: str, name: str) -> str | None:
    """Where one partition of a table lies, or None if there is none of that name."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition_spec(name)}").collect()
    except AnalysisException as error:
        if "PARTITIONS_NOT_FOUND" in str(error) or "NoSuchPartition" in str(error):
            return None
        raise
    inside = False
    for row in rows:
        inside |= row[0].startswith("# Detailed Partition Information")
        if inside and row[0] == "Location":
            return row[1]
    return None


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns under the schema's names and order; types unchanged, absent ones filled."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        [
            F.col(quote(have[f.name.lower()])).alias(f.name) if f.name.lower() in have else omitted(f)
            for f in schema.fields
        ]
    )


def create_file_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, max_records: int | None = None,
    partitions: tuple[str, ...] = (),
) -> None:
    options = f"OPTIONS ('maxRecordsPerFile' = '{max_records}') " if max_records else ""
    by = f"PARTITIONED BY ({', '.join(map(quote, partitions))}) " if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({target_ddl(schema)}) USING parquet {options}{by}LOCATION {literal(path)}")


def partition_names(spark: SparkSession, table: str) -> list[str]:
    """The partitions of a table as their directories are named: ``day=2026-01-01/kind=x``."""
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def partition_spec(name: str) -> str:
    """The ``PARTITION (…)`` clause of a partition directory's name."""
    parts = [tuple(map(unquote, part.split("=", 1))) for part in name.split("/")]
    values = [f"{quote(k)} = {'NULL' if v == _NULL_PARTITION else literal(v)}" for k, v in parts]
    return f"PARTITION ({', '.join(values)})"
