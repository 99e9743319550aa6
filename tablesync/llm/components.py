"""Connected components by alternating large-star and small-star, every step an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (``u``, ``v``: bigint) that is not
    itself the smallest. Loops, repeats and edges with a null end are ignored; no edges give no rows.

    Each round is written out, so that a lost executor costs one round at most.
    """
    current = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components", few=True
    )
    while not _stars(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            # an end that is smaller than its neighbours hangs below the least of them
            least.where("m < u").select("u", F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        ).distinct()
        current = staged(small, "components", few=True)
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node that hangs below another hangs below one only, which itself hangs below none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below")).union(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.count_if(F.col("below") == 0).alias("above"))
    return nodes.agg(F.count_if((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0)))).first()[0] == 0
