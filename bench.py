"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and
cores; ``BENCH_RUNS`` (default 2) how often each query runs after one warm-up. Results go to the
``noop`` sink, so the whole output is computed and none is collected.

The tables come as one row group each, which no task can split. They are first written anew, untimed,
to a scratch folder: the same rows in the same order, in row groups of about 1 MB as larger files have
many of. The tasks of each query are printed beside its time.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import pyarrow.parquet as pq

from newsloom.plans.registered import queries
from newsloom.session import build_session

HEADLINE = (
    "clean_text", "low_value_drop", "links_from_text", "links_from_pages", "lookback_24h",
    "registered_messages", "dedup_latest", "dedup_channel", "channel_stats", "run_totals",
    "topic_rubric", "label_batches", "label_fallback", "label_with_fn", "digest", "digest_by_day",
    "digest_24h", "digest_from_replies", "incremental_digest",
)
ROW_GROUP_BYTES = 1 << 20


def regrouped(sf_dir: str, to: str) -> str:
    """The tables that the queries read, in small row groups."""
    for name in ("documents", "events", "conversations", "pages", "labels"):
        table = pq.read_table(f"{sf_dir}/{name}.parquet")
        rows = max(1, table.num_rows * ROW_GROUP_BYTES // max(1, table.nbytes))
        pq.write_table(table, f"{to}/{name}.parquet", row_group_size=rows)
    return to


def timed(spark, query, sf_dir: str, group: str) -> tuple[float, int]:
    """Seconds, and the tasks of all stages that ran."""
    spark.sparkContext.setJobGroup(group, group)
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    infos = (tracker.getStageInfo(s) for s in stages)
    return seconds, sum(i.numCompletedTasks for i in infos if i)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "newsloom-bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.sql.files.maxPartitionBytes": "2m", "spark.sql.files.openCostInBytes": "0",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="newsloom-bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = regrouped(sf_dir, tempfile.mkdtemp(prefix="newsloom-bench-tables-"))
    registered, seconds, tasks = queries(), {}, {}
    for name in HEADLINE:
        query = registered[name]
        timed(spark, query, tables, f"{name}-0")
        found = [timed(spark, query, tables, f"{name}-{i}") for i in range(1, runs + 1)]
        seconds[name] = round(statistics.median(s for s, _ in found), 3)
        tasks[name] = found[-1][1]
    print(json.dumps({
        "metric": "headline queries, sum of median wall times",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "tasks": tasks,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
