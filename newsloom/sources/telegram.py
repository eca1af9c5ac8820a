"""Telegram: landed message exports to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed as v
from ..functions.links import concat_links, links_from_entities, links_from_text
from ..functions.text import clean_text, is_low_value
from ..functions.times import parse_utc
from ..operators.filters import lookback, non_empty
from ..schemas import COLLECTED, RAW_TELEGRAM, columns
from .landing import read_landed, readable


def read_telegram(spark: SparkSession, path: str, as_of=None, hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Landed message exports: each line is one message or a JSON list of messages. With ``as_of`` only
    the days that the look-back window can need are read, see ``read_landed``."""
    return readable(read_landed(spark, path, RAW_TELEGRAM, as_of, hours))


def normalize_telegram(raw: DataFrame, as_of=None, hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Raw messages to the common columns, with ``low_value`` still in place for the counts.

    Messages without text are left out. The author is the sending user, else the channel.
    """
    timed = raw.withColumn("timestamp", parse_utc(F.col("date")))
    if as_of is not None:
        timed = lookback(timed, as_of, hours)
    message = F.col("message")
    flagged = non_empty(timed, "text").withColumn("low_value", is_low_value(message))
    author = F.when(
        F.col("from_id.kind") == "user", F.col("from_id.user_id").cast("string")
    ).when(
        F.col("peer_id.channel_id").isNotNull(),
        F.concat(F.lit("admin#"), F.col("peer_id.channel_id").cast("string")),
    )
    return flagged.select(
        F.col("id").cast("string").alias("id"),
        F.when(~F.col("low_value"), clean_text(message)).alias("text"),
        "timestamp",
        author.alias("author"),
        "channel_id",
        F.lit(v.TELEGRAM).alias("platform"),
        F.when(~F.col("low_value"),
               concat_links(links_from_entities(F.col("entities")), links_from_text(message)))
        .alias("links"),
        "low_value",
    ).select(*columns(COLLECTED))
