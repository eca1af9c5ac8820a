"""Landed JSON files in dated folders: reading no more days than a run needs, and telling what in them
cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructType

from ..functions import fixed as v
from ..operators.filters import as_timestamp
from ..schemas import RAW_DISCORD, RAW_TELEGRAM, TEXT, columns, extend

RAW = {v.DISCORD: RAW_DISCORD, v.TELEGRAM: RAW_TELEGRAM}
_HELPERS = ("landed", "_unreadable", "_file")


def write_landed(raw: DataFrame, path: str, day: Column) -> None:
    """Add raw messages to ``path/landed=<day>`` as JSON lines."""
    raw.withColumn("landed", day.cast("date")).hint("rebalance", "landed") \
        .write.mode("append").partitionBy("landed").json(path)


def read_landed(spark: SparkSession, path: str, schema: StructType, as_of=None,
                hours: int = v.LOOKBACK_HOURS, margin_days: int = 1) -> DataFrame:
    """The landed rows with ``landed`` (day of the folder), ``_unreadable`` (the line, where it does not
    fit the schema) and ``_file``. A line is one message or a JSON list of messages.

    A file is never landed more than ``margin_days`` before the time of a message in it. With ``as_of``,
    folders of earlier days are therefore not even listed for a scan: no message of the look-back
    window is lost. Files outside dated folders have no ``landed`` and are always read.
    """
    rows = (
        spark.read.schema(extend(schema, _unreadable=TEXT, landed=DateType()))
        .option("columnNameOfCorruptRecord", "_unreadable").json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )
    if as_of is None:
        return rows
    first = F.date_sub((as_timestamp(as_of) - F.make_interval(hours=F.lit(hours))).cast("date"), margin_days)
    return rows.where(F.col("landed").isNull() | (F.col("landed") >= first))


def readable(landed: DataFrame) -> DataFrame:
    """The rows that could be read, in their raw columns. A line that fits the schema only in part is
    left out as a whole."""
    return landed.where(F.col("_unreadable").isNull()).drop(*_HELPERS)


def landing_account(landed: DataFrame) -> DataFrame:
    """``landed, file, n_rows, n_unreadable, n_empty`` for each file: its rows, those that cannot be read,
    and those that can but hold none of the fields."""
    empty = F.lit(True)
    for name in columns(landed.drop(*_HELPERS).schema):
        empty &= F.col(name).isNull()
    # as a grouping key the kind stays dependent on all fields, whichever counts are used
    kind = F.when(F.col("_unreadable").isNotNull(), "unreadable").when(empty, "empty").otherwise("row")
    kinds = landed.groupBy("landed", F.col("_file").alias("file"), kind.alias("kind")).agg(F.count("*").alias("n"))

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("kind") == name, F.col("n")).otherwise(0))

    return kinds.groupBy("landed", "file").agg(
        F.sum("n").alias("n_rows"), of("unreadable").alias("n_unreadable"), of("empty").alias("n_empty"))
