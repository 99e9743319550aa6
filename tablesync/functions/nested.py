"""Nested values, intervals, exact decimals and naive timestamps to text and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SyncError
from tablesync.functions.types import JSON, NESTED, TEXT, classify, ddl, declared_type, is_nested, map_leaves, widened
from tablesync.sources.names import quote

# to_json cuts timestamps to milliseconds unless it is told otherwise.
_JSON_WRITE = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_NTZ_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_json_text(col: Column) -> Column:
    """A nested value as JSON text; microseconds kept."""
    return F.to_json(col, _JSON_WRITE)


def interval_text(col: Column) -> Column:
    return col.cast("string")


def _widen(col: Column, dtype: T.DataType, floats: str) -> Column:
    to = widened(dtype)
    if to == dtype:
        return col
    if floats == "shortest":
        text = map_leaves(dtype, lambda leaf: T.StringType() if isinstance(leaf, T.FloatType) else leaf)
        col = col if text == dtype else col.cast(text)
    return col.cast(to)


def widen_nested(df: DataFrame, floats: str = "exact") -> DataFrame:
    """Widen the leaves of nested columns: narrow integers to INT, FLOAT to DOUBLE.

    ``exact`` keeps the binary value of a FLOAT; ``shortest`` reads its shortest decimal form, which is
    what a reader of the JSON text would get (0.1 rather than 0.10000000149011612).
    """
    if floats not in ("exact", "shortest"):
        raise SyncError("floats must be 'exact' or 'shortest'")
    return df.select([_widen(F.col(quote(f.name)), f.dataType, floats).alias(f.name) for f in df.schema.fields])


def project_declared(df: DataFrame, floats: str = "exact") -> DataFrame:
    """Every column in its declared type, in schema order. A frame with nothing to convert comes back as it is."""
    out, changed = [], False
    for field in df.schema.fields:
        declared = declared_type(field.name, field.dataType)
        col, how = F.col(quote(field.name)), classify(field.dataType)
        if how == JSON:
            col = to_json_text(col)
        elif how == TEXT:
            col = interval_text(col)
        elif how == NESTED:
            col = _widen(col, field.dataType, floats)
        changed = changed or how in (JSON, TEXT) or declared != field.dataType
        out.append(col.alias(field.name))
    return df.select(out) if changed else df


def _as_type(dtype: str | T.DataType) -> T.DataType:
    return T.DataType.fromDDL(dtype) if isinstance(dtype, str) else dtype


def _strict_json(df: DataFrame, column: str, dtype: T.DataType) -> tuple[DataFrame, Column, Column]:
    """Parse a text column; returns the frame with a helper column, the value and the "bad" flag.

    from_json alone turns a bad leaf into NULL and ignores text after the value. Wrapped as a member
    of an object, any bad leaf marks the record as corrupt; wrapped as an array, only text that is
    exactly one value has length 1. Text that closes one wrapper early breaks the other.
    """
    text = F.col(quote(column))
    schema = T.StructType([T.StructField("v", dtype), T.StructField("bad", T.StringType())])
    parsed = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")),
        schema,
        {"columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"},
    )
    helper = "_sync_parsed"
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))).eqNullSafe(F.lit(1))
    bad = text.isNotNull() & (F.col(f"{helper}.bad").isNotNull() | ~one)
    return df.withColumn(helper, parsed), F.col(f"{helper}.v"), bad


def parse_nested(
    df: DataFrame,
    column: str,
    dtype: str | T.DataType,
    on_error: str = "fail",
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Replace a JSON text column by its nested value.

    NULL stays NULL and a missing struct member is NULL. Text that does not fit is an error that names
    the column, and the ``row_id`` columns if given, but never the value (``fail``); or NULL
    (``null``); or one row of a bad-row report (``report``: row_id columns, column_name, expected_type).
    """
    dtype = _as_type(dtype)
    frame, value, bad = _strict_json(df, column, dtype)
    if on_error == "report":
        return frame.where(bad).select(
            *[F.col(quote(c)) for c in row_id],
            F.lit(column).alias("column_name"),
            F.lit(ddl(dtype)).alias("expected_type"),
        )
    if on_error == "null":
        strict = F.when(~bad, value)
    elif on_error == "fail":
        where = [F.concat(F.lit(f" {c}="), F.coalesce(F.col(quote(c)).cast("string"), F.lit("NULL"))) for c in row_id]
        message = F.concat(F.lit(f"column '{column}' is not a valid {ddl(dtype)}"), *where)
        strict = F.when(bad, F.raise_error(message)).otherwise(value)
    else:
        raise SyncError("on_error must be 'fail', 'null' or 'report'")
    return frame.select([(strict if c == column else F.col(quote(c))).alias(c) for c in df.columns])


def decimal_text(col: Column) -> Column:
    """All digits of the scale and the sign, e.g. ``-12345.6789`` or ``1.500000000``."""
    return col.cast("string")


def ntz_text(col: Column) -> Column:
    return F.date_format(col, _NTZ_TEXT)


def encode_exact(df: DataFrame) -> DataFrame:
    """Decimals, naive timestamps and nested values as text, for files that only carry text exactly."""
    out = []
    for field in df.schema.fields:
        col = F.col(quote(field.name))
        if isinstance(field.dataType, T.DecimalType):
            col = decimal_text(col)
        elif isinstance(field.dataType, T.TimestampNTZType):
            col = ntz_text(col)
        elif is_nested(field.dataType):
            col = to_json_text(col)
        out.append(col.alias(field.name))
    return df.select(out)


def _strict_cast(name: str, dtype: T.DataType) -> Column:
    """Text to a flat type; what does not fit is an error in any ANSI mode, naming the column, not the value."""
    text = F.col(quote(name))
    value = text.try_cast(dtype)
    message = F.lit(f"column '{name}' is not a valid {ddl(dtype)}")
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def decode_staged(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The inverse of :func:`encode_exact`: text columns back to the types of ``schema``, strictly."""
    types = {f.name: f.dataType for f in schema.fields}
    for field in df.schema.fields:
        dtype = types.get(field.name, field.dataType)
        if isinstance(field.dataType, T.StringType) and is_nested(dtype):
            df = parse_nested(df, field.name, dtype)
        elif dtype != field.dataType:
            df = df.withColumn(field.name, _strict_cast(field.name, dtype))
    return df
