"""What the operators share: table paths, staged tables, bounded label samples and batch-wise text functions."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.session import scratch_dir

#: Rows that a stage hands to a Python worker at once; texts of a batch are held in memory together.
BATCH_ROWS = 1000
#: Tasks a core that write a small table.
TASKS_A_CORE = 2


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, label: str, few: bool = False) -> DataFrame:
    """Written to the folder all executors share, and read again: later jobs start from the files.

    ``few``: by :data:`TASKS_A_CORE` tasks a core at most, each of which takes several partitions one after the other. Made for
    tables that are small beside the texts: where no partitions are merged, each would else have its own little file.
    """
    path = scratch_dir(df.sparkSession, label)
    if few:
        df = df.coalesce(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, schema: StructType | str, each: Callable[..., dict[str, object]]) -> DataFrame:
    """Apply ``each(**columns as lists) -> columns as lists, arrays or Arrow arrays`` to small batches of rows.

    The batches are slices of what Arrow delivers, so that a few very long texts are not copied all at once.
    """
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                columns = each(**{name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [arrow_column(columns[f.name], arrow_type(f.dataType.simpleString())) for f in out.fields],
                    names=out.names,
                )

    return df.mapInArrow(run, out)


def arrow_column(values: object, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    if name.startswith("struct<"):
        fields, depth, start = [], 0, 7
        for at in range(7, len(name)):
            depth += {"<": 1, ">": -1}.get(name[at], 0)
            if depth < 0 or (depth == 0 and name[at] == ","):
                key, _, kind = name[start:at].partition(":")
                fields.append((key, arrow_type(kind)))
                start = at + 1
        return pa.struct(fields)
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
    }[name]


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the key, the same ones on every run.

    For fitting models on labelled rows only.
    """
    parts = max(1, -(-df.count() // bound))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(parts)) == 0)


def broadcast_object(spark: SparkSession, value: object) -> Callable[[], object]:
    """Send an object of this package to the workers once; what is returned gives it back there."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        state = worker_state()
        if state.get("broadcast") is None or state["broadcast"][0] != data.value:
            state["broadcast"] = data.value, cloudpickle.loads(data.value)
        return state["broadcast"][1]

    return get


def worker_state() -> dict:
    """A dictionary that outlives a task where Python workers are reused; for caches only."""
    name = "tablesync_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__
