"""Partitions of file tables: the rows of some, how they are written, and what they held when a merge began."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sinks import files
from tablesync.sinks.target import partition_location, partition_names
from tablesync.sources.names import literal, quote

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def by_partition(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Bring the rows of a partition together before a write, so that not every task writes a file
    in each; a large partition is split again into files of the advisory size."""
    return frame.hint("rebalance", *[F.col(quote(c)) for c in columns]) if columns else frame


def _key(columns: list[str]) -> str:
    one = lambda c: f"coalesce(replace(replace(CAST({quote(c)} AS STRING), '~', '~t'), '/', '~s'), '~n')"
    return f"concat_ws('/', {', '.join(map(one, columns))})"


def partition_keys(partitions: DataFrame) -> list[str]:
    """The distinct partitions that rows fall into, as text; as many as there are partitions."""
    return sorted(r[0] for r in partitions.select(F.expr(_key(partitions.columns))).distinct().collect())


def partition_rows(table: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """The rows of some partitions, by one membership test on the partition columns, which prunes the scan."""
    return table.where(f"{_key(columns)} IN ({', '.join(map(literal, keys))})" if keys else "false")


def key_of(name: str) -> str:
    """The text of :func:`partition_keys` for a partition that is named like its directory."""
    values = [unquote(part.split("=", 1)[1]) for part in name.split("/")]
    return "/".join("~n" if v == NULL_PARTITION else v.replace("~", "~t").replace("/", "~s") for v in values)


def partition_state(spark: SparkSession, table: str, keys: list[str]) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Where some partitions of a table are, and their files; partitions that are not there are left out.

    Every write into a partition adds, removes or moves files of names of their own, so that equal states mean equal rows.
    """
    wanted, state = set(keys), {}
    for name in partition_names(spark, table):
        if key_of(name) in wanted:
            place = partition_location(spark, table, name)
            if place is not None:
                state[name] = place, tuple(sorted(files.children(spark, place)))
    return state
