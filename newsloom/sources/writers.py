"""Sinks: dated digest table, JSON array export, run log."""

from __future__ import annotations

import uuid
from datetime import date
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from ..functions.times import offset_text
from ..operators.ordering import newest_first, with_row_index
from ..session import discard


def day_path(path: str, run_date) -> str:
    """The folder of one day in a table partitioned by ``run_date``."""
    day = date.fromisoformat(str(run_date)[:10])
    return f"{path.rstrip('/')}/run_date={day.isoformat()}"


def write_digest(df: DataFrame, path: str, run_date=None, fmt: str = "parquet") -> None:
    """Write a digest partitioned by ``run_date``.

    With a ``run_date`` that date's partition is replaced, also by nothing when the frame is empty; rows
    stay in the partitions they are in, without a shuffle. Without ``run_date`` the frame brings the column itself and may hold
    many days: rows are then brought together by day, where adaptive execution splits large days and
    joins small ones, so that not every task writes a file for every day. A rerun then replaces the
    days it holds and no others: name the day to clear one that has become empty.
    """
    rows = df.hint("rebalance", "run_date") if run_date is None else df.drop("run_date")
    writer = (
        rows.write.mode("overwrite").format(fmt)
        .option("maxRecordsPerFile", 5_000_000)
        .options(timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX", ignoreNullFields=False)
    )
    if run_date is None:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("run_date").save(path)
    else:
        writer.save(day_path(path, run_date))


def append_run_log(stats: DataFrame, path: str, run_date, run_id: str | None = None) -> None:
    """Write the per-channel counts of a run to the log table, under its date and ``run_id``. A rerun
    with the same id replaces its rows; another id of the same day stands beside it, and without an
    id every call does."""
    run_id = run_id or uuid.uuid4().hex
    columns = ("channel_id", "platform", "pulled", "kept", "success", "error")
    stats.select(*columns, F.lit(run_id).alias("run_id")).write.mode("overwrite").parquet(
        f"{day_path(path, run_date)}/run={quote(run_id, safe='')}")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """``channel_id, platform, pulled, kept, success, error, run_id, run_date`` of all runs."""
    return spark.read.parquet(path).drop("run").withColumn("run_date", F.col("run_date").cast("date"))


def records_json(df: DataFrame, order=newest_first) -> DataFrame:
    """The frame as one JSON array, in pieces: ``(seq, line)`` with one record per piece.

    The pieces joined by line breaks in the order of ``seq`` are a valid document with indented
    records, nulls written and letters unescaped. No task ever holds more than its own records.
    """
    indexed = with_row_index(df, order, "_seq", tag="records-json")
    fields = (
        offset_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f.name) for f in df.schema
    )
    record = F.to_json(F.struct(*fields), {"pretty": "true", "ignoreNullFields": "false"})
    body = indexed.select(
        (F.col("_seq") + 1).alias("seq"),
        F.concat(F.when(F.col("_seq") > 0, ",\n").otherwise(""), record).alias("line"),
    )
    ends = df.sparkSession.sql(
        "SELECT * FROM VALUES (0L, '['), (9223372036854775807L, ']') AS t(seq, line)"
    )
    pieces = body.unionByName(ends)
    pieces.temporary = indexed.temporary
    return pieces


def write_digest_array(df: DataFrame, path: str, order=newest_first) -> None:
    """Write the JSON array of ``records_json`` as text files; read in name order they are the
    document."""
    pieces = records_json(df, order)
    pieces.orderBy("seq").select("line").write.mode("overwrite").text(path)
    discard(*pieces.temporary)


def write_digest_documents(df: DataFrame, path: str, size: int = 1000, order=newest_first) -> None:
    """Write a digest as JSON arrays of up to ``size`` records, one file each, as ``read_digest`` reads.

    Messages without labels get the bare ``NaN`` that earlier digests have for them. Each task of the range sort
    makes documents of its own rows, its last one shorter, so texts are shuffled once and kept nowhere
    else. A task holds one document at a time.
    """
    plain = F.to_json(F.struct("id", "text", offset_text(F.col("timestamp")).alias("timestamp"), "author", "channel_id",
                               "platform", "links"), {"ignoreNullFields": "false"})
    score = F.coalesce(F.concat(F.lit('"'), F.col("score").cast("string"), F.lit('"')), F.lit("NaN"))
    tags = F.coalesce(F.to_json("tags"), F.lit("NaN"))
    record = F.concat(F.rtrim(plain, F.lit("}")), F.lit(',"score":'), score, F.lit(',"tags":'), tags, F.lit("}"))

    def documents(batches):
        lines = []
        for batch in batches:
            for line in batch.column(0).to_pylist():
                lines.append(line)
                if len(lines) == size:
                    yield _document(lines)
                    lines = []
        if lines:
            yield _document(lines)

    df.orderBy(*order()).select(record.alias("line")).mapInArrow(documents, "value string") \
        .write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _document(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(["[\n" + ",\n".join(lines) + "\n]"], pa.string())], ["value"])
