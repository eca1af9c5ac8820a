"""Digests written earlier as JSON arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.links import links_or_empty
from ..functions.times import parse_utc
from ..schemas import ARCHIVE


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """A dated JSON array per file. A bare ``NaN`` in score, tags or author means unlabelled and
    reads as null; scores such as ``0.9`` and ``0.95`` get one scale."""
    raw = spark.read.schema(ARCHIVE).option("multiLine", True).json(path)

    def present(name: str):
        return F.nullif(F.col(name), F.lit("NaN"))

    return raw.select(
        "id", "text", parse_utc(F.col("timestamp")).alias("timestamp"),
        present("author").alias("author"), "channel_id", "platform",
        links_or_empty(F.col("links")).alias("links"),
        present("score").try_cast("decimal(3,2)").alias("score"),
        "tags",
    )
