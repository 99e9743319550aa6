"""Upsert of a de-duplicated source into a target, as DataFrame joins or as one MERGE statement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.types import omitted
from tablesync.sources.names import quote


def missing_names(columns: Sequence[str], target: Sequence[str]) -> list[str]:
    """Columns the target does not have, compared without case."""
    present = {c.lower() for c in target}
    return [c for c in columns if c.lower() not in present]


def missing_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    names = missing_names(df.columns, target.columns)
    return df.sparkSession.createDataFrame([(n,) for n in names], "name STRING")


def _all_of(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms)


def _matched(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys; a NULL key equals a NULL key."""
    return _all_of([F.col(f"{left}.{quote(k)}").eqNullSafe(F.col(f"{right}.{quote(k)}")) for k in keys])


def _source_as_target(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The source under the target's spelling of its names, the keys and the written columns likewise."""
    lacking = missing_names(source.columns, target.columns)
    if lacking:
        raise SyncError(f"the target has no column {', '.join(repr(c) for c in lacking)}")
    absent = [k for k in keys if k not in source.columns]
    if not keys or absent:
        raise SyncError(f"merge needs keys that the source has; absent: {', '.join(absent) or 'all'}")
    spelled = {c.lower(): c for c in target.columns}
    renamed = source.select([F.col(quote(c)).alias(spelled[c.lower()]) for c in source.columns])
    return renamed, [spelled[k.lower()] for k in keys], renamed.columns


def _stand_in(dtype: T.DataType) -> Column:
    """Any constant of the type, to stand for NULL next to a flag that says so."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return F.lit("").cast(dtype) if isinstance(dtype, (T.StringType, T.BinaryType)) else F.lit(0).cast(dtype)


def plain_keys(frame: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Each key as a value without NULL and a NULL flag, so that plain equality compares them.

    A distinct over these columns leaves its rows partitioned the way the join on them needs;
    under ``<=>`` the join would shuffle the distinct keys a second time.
    """
    types = {f.name: f.dataType for f in frame.schema.fields}
    out = []
    for i, key in enumerate(keys):
        col = F.col(quote(key))
        out += [F.coalesce(col, _stand_in(types[key])).alias(f"_sync_key{i}"), col.isNull().alias(f"_sync_null{i}")]
    return out


def key_names(keys: Sequence[str]) -> list[str]:
    return [name for i in range(len(keys)) for name in (f"_sync_key{i}", f"_sync_null{i}")]


def merge_frame(target: DataFrame, source: DataFrame, keys: Sequence[str], small_source: bool = False) -> DataFrame:
    """The target after the upsert. The source must hold one row per key (see ``dedup_last``).

    Every target row that matches is updated, duplicates too; target columns the source does not carry
    keep their value, and are NULL (or their DEFAULT) on insert. Not a full outer join: adaptive execution can split a
    hot key only on the preserved side of a left join, and the target is where keys repeat. Inserts
    are an anti join against the target's distinct keys, which each map task reduces before its shuffle.

    ``small_source`` is for a source whose size the caller has checked: it is broadcast, and the
    target is not shuffled at all.
    """
    source, keys, written = _source_as_target(target, source, keys)
    hint = F.broadcast if small_source else (lambda frame: frame)
    changed = [c for c in written if c not in keys]

    if changed:
        hit = source.withColumn("_sync_hit", F.lit(True)).alias("s")
        updates = target.alias("t").join(hint(hit), _matched(keys, "t", "s"), "left_outer").select(
            [
                F.when(F.col("s._sync_hit"), F.col(f"s.{quote(c)}")).otherwise(F.col(f"t.{quote(c)}")).alias(c)
                if c in changed
                else F.col(f"t.{quote(c)}")
                for c in target.columns
            ]
        )
    else:
        updates = target  # all columns are keys: nothing to update

    keyed = source.select("*", *plain_keys(source, keys))
    seen = target.select(plain_keys(target, keys))
    if small_source:
        # No more distinct keys than the source has rows, hence under the same size check.
        seen = seen.join(F.broadcast(keyed.select(key_names(keys))), key_names(keys), "left_semi")
    inserts = keyed.join(hint(seen.distinct()), key_names(keys), "left_anti").select(
        [F.col(quote(f.name)) if f.name in written else omitted(f) for f in target.schema.fields]
    )
    return updates.unionByName(inserts)


def merge_preview(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many source rows would update and how many would insert."""
    source, keys, _ = _source_as_target(target, source, keys)
    seen = target.select(plain_keys(target, keys)).distinct().withColumn("_sync_hit", F.lit(True))
    hit = F.count("_sync_hit")
    return (
        source.select(plain_keys(source, keys))
        .join(seen, key_names(keys), "left_outer")
        .agg(F.count(F.lit(1)).alias("source_rows"), hit.alias("updates"), (F.count(F.lit(1)) - hit).alias("inserts"))
    )


def merge_into(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> None:
    """One MERGE statement, for tables whose format supports it. The source must hold one row per key."""
    source, keys, written = _source_as_target(spark.table(table), source, keys)
    changed = [c for c in written if c not in keys]
    on = _all_of([F.col(f"{table}.{quote(k)}").eqNullSafe(F.col(f"s.{quote(k)}")) for k in keys])
    writer = source.alias("s").mergeInto(table, on)
    if changed:
        writer = writer.whenMatched().update({quote(c): F.col(f"s.{quote(c)}") for c in changed})
    writer.whenNotMatched().insert({quote(c): F.col(f"s.{quote(c)}") for c in written}).merge()
