"""The digest kept current while messages keep landing.

The table has a folder for each day and in it one for each micro-batch, ``run_date=D/batch_id=N``. A
closed day can be compacted: its batches up to N are merged into ``batch_id=-(N+1)``, which stands for
them from then on.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType

from ..functions import fixed as v
from ..operators.dedup import dedup_latest
from ..operators.filters import as_timestamp, kept, lookback
from ..schemas import MESSAGES, RAW_DISCORD, RAW_TELEGRAM, columns, extend
from ..sources.discord import normalize_discord
from ..sources.telegram import normalize_telegram

_STORED = extend(MESSAGES, run_date=DateType(), batch_id=LongType())
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def stream_landed(spark: SparkSession, platform: str, path: str,
                  max_files: int | None = None) -> DataFrame:
    """Landed files of a platform as a stream of common columns with ``low_value``."""
    schema, normalize = {
        v.DISCORD: (RAW_DISCORD, normalize_discord), v.TELEGRAM: (RAW_TELEGRAM, normalize_telegram)
    }[platform]
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return normalize(reader.json(path))


def incremental_digest(collected: DataFrame, table: str, checkpoint: str,
                       **trigger) -> StreamingQuery:
    """Start the stream: each micro-batch adds its latest row per text and day to ``table``.

    Latest of latest is latest, so the batches are reduced one by one and compared with each other
    only on reading. A batch writes its own partitions, one per day it touches, and a repeated batch
    holds the same rows and replaces them: a run that is restarted leaves nothing twice. Nothing is
    held between batches, so there is no state that grows with the texts seen. Days that have left
    the window can be deleted as folders.
    """
    messages = kept(collected)

    def add(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("run_date", F.to_date("timestamp"))
        (
            dedup_latest(dated, by=("run_date",))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .hint("rebalance", "run_date")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy("run_date", "batch_id").parquet(table)
        )

    return (
        messages.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# --- the table's folders --------------------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def _folders(spark: SparkSession, path: str, key: str) -> dict[str, int]:
    """Values of ``key`` among the folders in ``path``, and when each was last changed (ms)."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return {}
    found = ((s.getPath().getName(), s) for s in files.listStatus(folder) if s.isDirectory())
    return {name[len(key) + 1:]: s.getModificationTime() for name, s in found if name.startswith(f"{key}=")}


def _batches(spark: SparkSession, table: str, day: str) -> tuple[list[int], list[int]]:
    """Batches of a day that count, and those that a merged one stands for."""
    ids = [int(b) for b in _folders(spark, f"{table}/run_date={day}", "batch_id")]
    merged = min((b for b in ids if b < 0), default=0)  # of several, the one that reaches furthest
    counts = [b for b in ids if b == merged < 0 or b >= max(0, -merged)]
    return sorted(counts), sorted(set(ids) - set(counts))


def _days(spark: SparkSession, table: str) -> list[str]:
    return sorted(d for d in _folders(spark, table, "run_date") if d != _NO_DAY)


def _stored(spark: SparkSession, table: str, batches: dict[str, list[int]]) -> DataFrame:
    paths = [f"{table}/run_date={day}/batch_id={b}" for day, ids in batches.items() for b in ids]
    if not paths:
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).option("basePath", table).parquet(*paths)


def current_messages(spark: SparkSession, table: str, as_of=None,
                     hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Deduplicated messages of the look-back window as the stream has them now.

    Of the table only the days' names are listed; the files of a day only if the window touches it, and
    of a compacted day only the merged ones.
    """
    if as_of is None:
        days = [*_days(spark, table), *(d for d in _folders(spark, table, "run_date") if d == _NO_DAY)]
    else:
        bound = as_timestamp(as_of) - F.make_interval(hours=F.lit(hours))
        first = str(spark.range(1).select(bound.cast("date")).first()[0])
        days = [d for d in _days(spark, table) if d >= first]
    rows = _stored(spark, table, {d: _batches(spark, table, d)[0] for d in days})
    if as_of is not None:
        rows = lookback(rows, as_of, hours)
    return dedup_latest(rows.select(*columns(MESSAGES)))


def compact_days(spark: SparkSession, table: str, before: str) -> list[str]:
    """Merge the batches of each day earlier than ``before`` that has several: the latest row per text.

    All days are made in one job, outside the table, and then moved in, each as one folder. Ranges of day
    and text hash bring equal texts together and keep days together for writing, so texts are shuffled once; a
    large day is split, and as each batch holds a text of a day once, no range is filled by copies. Until then
    readers use the batches, afterwards the merged folder; the batches stay for readers that have
    already begun, see ``remove_superseded``. Batches that arrive later count beside it, and a repeated
    batch that it holds is passed over. Returns the days.
    """
    todo = {d: ids for d in _days(spark, table) if d < before and len(ids := _batches(spark, table, d)[0]) > 1}
    if not todo:
        return []
    made = f"{table}/_compact-{uuid.uuid4().hex}"
    stored = _stored(spark, table, todo).drop("batch_id")
    rows = dedup_latest(stored.repartitionByRange("run_date", F.xxhash64("text")), by=("run_date",))
    rows.write.option("compression", "zstd").partitionBy("run_date").parquet(made)
    for day, ids in todo.items():
        files, source = _file_system(spark, f"{made}/run_date={day}")
        last = max(b if b >= 0 else -b - 1 for b in ids)
        target = _file_system(spark, f"{table}/run_date={day}/batch_id={-last - 1}")[1]
        if not files.rename(source, target):
            raise OSError(f"could not move {source} to {target}")
    files, folder = _file_system(spark, made)
    files.delete(folder, True)
    return list(todo)


def remove_superseded(spark: SparkSession, table: str, grace_seconds: float = 3600) -> int:
    """Delete the batches that a merged folder has stood for longer than ``grace_seconds``; readers that
    began before the merge must be done by then. Returns how many were deleted."""
    deleted, now = 0, 1000 * time.time()
    for day in _days(spark, table):
        counts, superseded = _batches(spark, table, day)
        changed = _folders(spark, f"{table}/run_date={day}", "batch_id")
        merged = [b for b in counts if b < 0]
        if merged and now - changed[str(merged[0])] >= 1000 * grace_seconds:
            for b in superseded:
                files, folder = _file_system(spark, f"{table}/run_date={day}/batch_id={b}")
                deleted += files.delete(folder, True)
    return deleted
