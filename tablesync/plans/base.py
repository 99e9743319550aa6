"""What the registered queries share: table paths, scratch targets and the registry itself."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablesync.session import scratch_dir
from tablesync.sinks.target import drop_target, find_target
from tablesync.sources.read import current_name, read_table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    query: Query
    oracle: str


REGISTRY: dict[str, Registered] = {}


def register(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def add(query: Query) -> Query:
        REGISTRY[query.__name__] = Registered(query, oracle)
        return query

    return add


def path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, table))


class ScratchTarget:
    """A new published or sharded target in the shared scratch folder, under a name of its own.

    Its files stay behind for the lazy result; the catalog entries do not.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"scratch_{uuid.uuid4().hex[:16]}"
        self.settings = {"location": scratch_dir(spark, "target")}

    def __enter__(self) -> ScratchTarget:
        return self

    def __exit__(self, *exc) -> None:
        drop_target(self.spark, find_target(self.spark, current_name(self.spark, self.name)))

    def read(self) -> DataFrame:
        return read_table(self.spark, self.name)

    def result(self) -> DataFrame:
        """The rows as they are now, in files of their own: parts need the catalog entries that go."""
        path = scratch_dir(self.spark, "result")
        self.read().write.parquet(path)
        return self.spark.read.parquet(path)
