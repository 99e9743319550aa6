"""Type rules: how a column is read, what a written column becomes, and what is refused."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.sources.names import quote

NATIVE = "native"  # read as it is
NESTED = "nested"  # array, map or struct whose leaves all have a declared type
JSON = "json"  # array, map or struct with some other leaf: JSON text
TEXT = "text"  # interval or variant: its string form

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_STRINGS = (T.StringType, T.CharType, T.VarcharType)
_TEXT = (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType, T.VariantType)
_LEAVES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.BooleanType, T.DateType, T.TimestampType, *_STRINGS,
)
_FLAT = (*_LEAVES, T.BinaryType, T.TimestampNTZType)
_WRITABLE_LEAVES = (
    T.IntegerType, T.LongType, T.DoubleType, T.DecimalType, T.BooleanType, T.DateType,
    T.TimestampType, T.StringType,
)
# Cursor types a bound can be compared with.
CURSOR_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType,
    T.TimestampType, T.TimestampNTZType, *_STRINGS,
)


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NESTED)


def ddl(dtype: T.DataType) -> str:
    """A type as DDL text, struct fields quoted."""
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{ddl(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<{ddl(dtype.keyType)}, {ddl(dtype.valueType)}>"
    if isinstance(dtype, T.StructType):
        return f"STRUCT<{', '.join(f'{quote(f.name)}: {ddl(f.dataType)}' for f in dtype.fields)}>"
    return dtype.simpleString().upper()


# Where Spark keeps a table column's declared CHAR/VARCHAR length and its DEFAULT expression.
_LENGTH = "__CHAR_VARCHAR_TYPE_STRING"
_DEFAULT = "CURRENT_DEFAULT"


def has_length(field: T.StructField) -> bool:
    return _LENGTH in (field.metadata or {})


def target_ddl(schema: T.StructType) -> str:
    """The column list of a ``CREATE TABLE`` statement."""
    return ", ".join(f"{quote(f.name)} {(f.metadata or {}).get(_LENGTH) or ddl(f.dataType)}" for f in schema.fields)


def omitted(field: T.StructField) -> Column:
    """What a target column holds in a row that does not carry it: its DEFAULT, or NULL."""
    default = (field.metadata or {}).get(_DEFAULT)
    return (F.expr(default) if default else F.lit(None)).cast(field.dataType).alias(field.name)


def map_leaves(dtype: T.DataType, leaf: Callable[[T.DataType], T.DataType]) -> T.DataType:
    """The same nesting with every leaf type replaced."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(map_leaves(dtype.elementType, leaf), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(map_leaves(dtype.keyType, leaf), map_leaves(dtype.valueType, leaf), dtype.valueContainsNull)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, map_leaves(f.dataType, leaf), f.nullable) for f in dtype.fields])
    return leaf(dtype)


def _mappable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _mappable(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return not is_nested(dtype.keyType) and _mappable(dtype.keyType) and _mappable(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return bool(dtype.fields) and all(_mappable(f.dataType) for f in dtype.fields)
    return isinstance(dtype, _LEAVES)


def classify(dtype: T.DataType) -> str | None:
    """How a column of this type is read; ``None`` for a type that cannot be read."""
    if is_nested(dtype):
        return NESTED if _mappable(dtype) else JSON
    if isinstance(dtype, _TEXT):
        return TEXT
    return NATIVE if isinstance(dtype, _FLAT) else None


def widened(dtype: T.DataType) -> T.DataType:
    """Nested leaves widened: narrow integers to INT, FLOAT to DOUBLE. Flat types stay."""

    def widen(leaf: T.DataType) -> T.DataType:
        if isinstance(leaf, (T.ByteType, T.ShortType)):
            return T.IntegerType()
        return T.DoubleType() if isinstance(leaf, T.FloatType) else leaf

    return map_leaves(dtype, widen) if is_nested(dtype) else dtype


def declared_type(name: str, dtype: T.DataType) -> T.DataType:
    how = classify(dtype)
    if how is None:
        raise SyncError(f"column '{name}' has type {ddl(dtype)}, which cannot be read here; cast it in a query")
    if how in (JSON, TEXT):
        return T.StringType()
    return widened(dtype)


def describe_dataset(df: DataFrame) -> DataFrame:
    """The schema a read declares, one row per column. Comes from analysis alone; no job runs."""
    rows = []
    for position, field in enumerate(df.schema.fields):
        how = classify(field.dataType)
        declared = declared_type(field.name, field.dataType)
        serialize = {JSON: f"to_json({quote(field.name)})", TEXT: f"cast({quote(field.name)} as string)"}.get(how)
        rows.append((position, field.name, ddl(field.dataType), ddl(declared), serialize))
    return df.sparkSession.createDataFrame(
        rows, "position INT, name STRING, source_type STRING, declared_type STRING, serialize STRING"
    )


def target_type(output: str, name: str, dtype: T.DataType, strict_nested: bool = True) -> T.DataType:
    """The type a written column gets in its target."""
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(dtype, _STRINGS):
        return T.StringType()
    if isinstance(dtype, _FLAT):
        return dtype
    if is_nested(dtype):
        if strict_nested:
            _check_nested(output, name, dtype)
        return dtype
    raise SyncError(f"{output}: column '{name}' has type {ddl(dtype)}, which cannot be written")


def _check_nested(output: str, name: str, dtype: T.DataType) -> None:
    if isinstance(dtype, T.ArrayType):
        _check_nested(output, name, dtype.elementType)
    elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        _check_nested(output, name, dtype.valueType)
    elif isinstance(dtype, T.StructType) and dtype.fields:
        for field in dtype.fields:
            _check_nested(output, name, field.dataType)
    elif not isinstance(dtype, _WRITABLE_LEAVES):
        raise SyncError(
            f"{output}: column '{name}' is nested and holds {ddl(dtype)}; map keys must be STRING, and leaves "
            "INT, BIGINT, DOUBLE, DECIMAL, STRING, BOOLEAN, DATE or TIMESTAMP"
        )


def write_schema(df: DataFrame, output: str = "output", strict_nested: bool = True) -> T.StructType:
    """The schema a write lands, all columns nullable."""
    return T.StructType(
        [T.StructField(f.name, target_type(output, f.name, f.dataType, strict_nested), True) for f in df.schema.fields]
    )


def normalize_for_write(df: DataFrame, output: str = "output", strict_nested: bool = True) -> DataFrame:
    """Cast every column to the type it gets in a target. Columns that have it already stay bare."""
    schema = write_schema(df, output, strict_nested)
    return df.select(
        [
            F.col(quote(was.name)) if was.dataType == now.dataType else F.col(quote(was.name)).cast(now.dataType).alias(was.name)
            for was, now in zip(df.schema.fields, schema.fields)
        ]
    )
