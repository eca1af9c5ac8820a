"""Discord: landed REST pages to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed as v
from ..functions.links import links_from_embeds
from ..functions.text import clean_text, is_low_value
from ..functions.times import parse_utc
from ..operators.filters import lookback
from ..schemas import COLLECTED, RAW_DISCORD, columns
from .landing import read_landed, readable


def read_discord(spark: SparkSession, path: str, as_of=None, hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Landed message pages: each line is one message or one page (a JSON list of messages). With
    ``as_of`` only the days that the look-back window can need are read, see ``read_landed``."""
    return readable(read_landed(spark, path, RAW_DISCORD, as_of, hours))


def normalize_discord(raw: DataFrame, as_of=None, hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Raw messages to the common columns, with ``low_value`` still in place for the counts.

    Messages without a readable time are left out. With ``as_of`` only the look-back window stays.
    """
    timed = raw.select(
        "*", parse_utc(F.col("timestamp")).alias("_ts")
    ).drop("timestamp").withColumnRenamed("_ts", "timestamp").where(F.col("timestamp").isNotNull())
    if as_of is not None:
        timed = lookback(timed, as_of, hours)
    content = F.coalesce(F.col("content"), F.lit(""))
    flagged = timed.withColumn("low_value", is_low_value(content))
    return flagged.select(
        "id",
        F.when(~F.col("low_value"), clean_text(content)).alias("text"),
        "timestamp",
        F.when(F.col("author").isNotNull(),
               F.concat_ws("#", "author.username", "author.id")).alias("author"),
        "channel_id",
        F.lit(v.DISCORD).alias("platform"),
        links_from_embeds(F.col("embeds")).alias("links"),
        "low_value",
    ).select(*columns(COLLECTED))
