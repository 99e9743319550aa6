"""Time the registered queries on ``local[$BENCH_CPUS]``; prints one JSON line.

The value is the summed time of the headline queries; ``queries`` lists every registered one.
Each is run to completion (all rows computed, none kept), best of two after a warm-up of the session.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablesync.plans import REGISTRY  # noqa: E402
from tablesync.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "window_exclusive_inclusive", "read_query_verbatim", "json_to_struct", "staged_text_roundtrip", "dedup_last_row",
    "dedup_last_composite", "row_sequence", "incremental_merge", "merge_upsert", "merge_null_keys",
    "merge_composite_keys", "sink_append", "sink_merge_dedup", "sink_merge_casts", "redact_registered", "redact_pages",
    "stream_merge_events", "stream_append_events",
)


def run(spark, query):
    started = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    only = sys.argv[1:]
    spark = build_session(
        "tablesync-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tablesync-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, REGISTRY["incremental_merge"].query)
    names = only or list(REGISTRY)
    seconds = {name: round(min(run(spark, REGISTRY[name].query) for _ in range(RUNS)), 3) for name in names}
    spark.stop()
    total = round(sum(seconds[name] for name in (only or HEADLINE)), 3)
    scale = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
