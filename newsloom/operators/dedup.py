"""Union of channels and repeated-text removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F


def union_channels(*frames: DataFrame) -> DataFrame:
    """All frames as one; an empty frame adds nothing."""
    return reduce(DataFrame.unionByName, frames)


def dedup_latest(df: DataFrame, key: str = "text", by: Sequence[str] = (),
                 keep_empty: bool = False) -> DataFrame:
    """One row per text: the latest, where an unknown time counts as latest; ties by platform,
    channel and id. ``by`` restricts the comparison to rows alike in those columns.

    Messages whose cleaned text is empty count as one text. With ``keep_empty`` they are told apart
    by their links.

    Rank 1 of a window is planned with a limit per task before the shuffle, so a text that makes up
    a third of all rows sends one row per task, not all of them. The 8-byte hash leads the key:
    sorting compares it first and looks at whole texts only when it ties.
    """
    keys = [F.xxhash64(key), F.col(key), *map(F.col, by)]
    if keep_empty:
        keys.append(F.when(F.col(key) == "", F.to_json("links")))
    latest = W.partitionBy(*keys).orderBy(
        F.col("timestamp").desc_nulls_first(), "platform", "channel_id", "id"
    )
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def dedup_channel(df: DataFrame) -> DataFrame:
    """The same inside each channel."""
    return dedup_latest(df, by=("platform", "channel_id"))
