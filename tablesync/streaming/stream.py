"""The same append and merge on Structured Streaming micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablesync.sinks.target import find_target
from tablesync.sinks.write import append, merge
from tablesync.sources.read import current_name

#: Buckets of a new target of a stream of merges.
BUCKETS = 16


def _start(stream: DataFrame, land, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_merge(
    stream: DataFrame,
    output: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    trigger: dict | None = None,
    buckets: int = BUCKETS,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    **settings,
) -> StreamingQuery:
    """Merge every micro-batch. A replayed batch is harmless: the merge is idempotent.

    A target that does not exist yet has its rows in buckets of the keys, or in the parts that ``partition_by`` or
    ``cluster_by`` name, so that a batch rewrites only what its rows fall into. Without parts (``buckets=0``) every
    batch rewrites all of the target.
    """
    parts = {"partition_by": partition_by, "cluster_by": cluster_by} if partition_by or cluster_by else {"buckets": buckets}

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = find_target(spark, current_name(spark, output))
        new = not target.exists and target.kind == "published"
        merge(batch, output, keys, order_by, **settings, **(parts if new else {}))

    return _start(stream, land, checkpoint, trigger)


def stream_append(
    stream: DataFrame, output: str, checkpoint: str, trigger: dict | None = None, **settings
) -> StreamingQuery:
    """Append every micro-batch. On a published or sharded target a replay is recognised and skipped, also after a replace,
    a merge or a compaction: the last batch of each query is kept with the view. ``compact`` brings batches together."""

    def land(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append(batch, output, tag=f"{query}-{batch_id}", **settings)

    return _start(stream, land, checkpoint, trigger)
