"""Last row per key, and a global row sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.nested import to_json_text
from tablesync.functions.types import is_nested
from tablesync.session import ensure_checkpoint_dir, shuffle_partitions
from tablesync.sources.names import quote

SEQUENCE = "_sync_seq"
_ROW = "_sync_row"
_TIED = "_sync_tied"
_LAST = "_sync_last"


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _exact(dtype: T.DataType) -> bool:
    """Whether equal keys of the type are the same value: -0.0 equals 0.0, and a collation may ignore case."""
    if isinstance(dtype, T.StringType):
        return dtype == T.StringType()
    return not isinstance(dtype, (T.FloatType, T.DoubleType))


def _comparable(field: T.StructField) -> Column:
    """The column, or its text where Spark has no order for the type."""
    col = F.col(quote(field.name))
    if _orderable(field.dataType):
        return col
    return to_json_text(col) if is_nested(field.dataType) else col.cast("string")


def _ordered(fields: Sequence[T.StructField], order_by: Sequence[str]) -> list[T.StructField]:
    """The named fields in the named order, then every other one, so that only equal rows can tie."""
    by_name = {f.name: f for f in fields}
    return [by_name[c] for c in order_by if c in by_name] + [f for f in fields if f.name not in order_by]


def _last_by_window(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row per key where no two rows of a key may tie on the order.

    Of each key two rows reach the final window, from each map task and in the end: a tie for the
    last place is a tie of these two.
    """
    order, row = [F.col(quote(c)) for c in order_by], F.col(_ROW)
    latest = Window.partitionBy([F.col(quote(k)) for k in keys]).orderBy([c.desc() for c in order])
    top = df.withColumn(_ROW, F.row_number().over(latest)).where(row <= 2)
    tied = F.lag(F.struct(order)).over(latest).eqNullSafe(F.struct(order)) & (row == 2)
    message = F.lit(f"two rows of one key tie on {', '.join(order_by)}; name a tie-break column")
    return (
        top.withColumn(_TIED, tied)
        .where(F.when(F.col(_TIED), F.raise_error(message).cast("boolean")).otherwise(row == 1))
        .drop(_ROW, _TIED)
    )


def dedup_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], ties: str = "break") -> DataFrame:
    """Keep the last row per key by ``order_by``; NULL keys form one group, a NULL order comes first.

    Spark has no arrival order, so the order must be named. Rows that tie on it are told apart by the
    remaining columns (``break``), the same way on every run and every retry, or refused (``error``).

    The last row is the largest, as a struct that starts with the order: an aggregate, of which each
    map task sends one row per key, so a key that holds most of the rows does not load one task. It
    needs a sort by key only; a window would sort by key and order.
    """
    if not keys or not order_by:
        raise SyncError("dedup_last needs at least one key and one ordering column")
    if ties == "error":
        return _last_by_window(df, keys, order_by)
    if ties != "break":
        raise SyncError("ties must be 'break' or 'error'")
    carried = _ordered([f for f in df.schema.fields if f.name not in keys or not _exact(f.dataType)], order_by)
    if not carried:
        return df.distinct()
    row = F.struct([F.col(quote(f.name)) for f in carried])
    if all(_orderable(f.dataType) for f in carried):
        last = F.max(row)
    else:
        last = F.max_by(row, F.struct([_comparable(f).alias(f"o{i}") for i, f in enumerate(carried)]))
    names = {f.name for f in carried}
    return (
        df.groupBy([F.col(quote(k)) for k in keys])
        .agg(last.alias(_LAST))
        .select([(F.col(_LAST).getField(c) if c in names else F.col(quote(c))).alias(c) for c in df.columns])
    )


def with_sequence(
    df: DataFrame, order_by: Sequence[str], name: str = SEQUENCE, start: int = 0, ranges: int | None = None
) -> DataFrame:
    """Number all rows ``start``, ``start + 1``, … in the given order, without one task seeing them all.

    Rows are range-partitioned and sorted, with the remaining columns and a row id as the last range
    keys so that even a third of all rows being equal splits over many ranges. Checkpointed twice: once
    with the row ids, which a task that runs again could give to other rows, and once with the ranges,
    so that the counts per range and the rows are read from the same ones.
    """
    if not order_by:
        raise SyncError("with_sequence needs at least one ordering column")
    ensure_checkpoint_dir(df.sparkSession)
    part, row, offset = "_sync_part", _ROW, "_sync_offset"
    ordered = [*[_comparable(f) for f in _ordered(df.schema.fields, order_by)], F.col(row)]
    numbered = df.withColumn(row, F.monotonically_increasing_id()).checkpoint()
    if ranges is None:
        texts = [F.octet_length(F.col(quote(f.name))) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        size = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(16 * (1 + len(df.columns)))).cast("bigint")
        held = numbered.agg(F.sum(size)).first()[0] or 0
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), shuffle_partitions(held))
    ranged = (
        numbered
        .repartitionByRange(ranges, *ordered)
        .sortWithinPartitions(*ordered)
        .drop(row)
        .withColumn(part, F.spark_partition_id())
        .withColumn(row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    # One row per range: the window and the broadcast are bounded by the number of shuffle partitions.
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_sync_count")).withColumn(
        "_sync_count",
        F.when(F.col("_sync_count") <= F.lit(1 << 33), F.col("_sync_count")).otherwise(
            F.raise_error(F.lit("a range has more than 2^33 rows: name more ranges")).cast("bigint")
        ),
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("_sync_count").over(before), F.lit(0)).alias(offset))
    return (
        ranged.join(F.broadcast(offsets), part)
        .withColumn(name, F.lit(start) + F.col(offset) + F.col(row))
        .select([F.col(quote(c)) for c in df.columns] + [F.col(quote(name)).cast("bigint").alias(name)])
    )
