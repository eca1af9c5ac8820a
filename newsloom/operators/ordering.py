"""Final order and exact row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import materialize

_IN_PARTITION = (1 << 33) - 1


def newest_first() -> list[Column]:
    """Newest first, unknown times last; ties by platform, channel and id."""
    return [F.col("timestamp").desc_nulls_last(), F.col("platform").asc(),
            F.col("channel_id").asc(), F.col("id").asc()]


def final_order(df: DataFrame) -> DataFrame:
    """The order of an export. Ties are broken down to the id, so the range partitions stay even
    when very many messages share one time or have none."""
    return df.orderBy(*newest_first())


def with_row_index(df: DataFrame, order=newest_first, name: str = "row_index",
                   tag: str = "row-index") -> DataFrame:
    """Add the 0-based position of every row in the given order.

    Sort by range over all tasks, note each row's partition and place in it, write that once to the
    shared folder, then add the number of rows in the partitions before. The written table fixes
    the partitions, so a lost executor cannot change a number already given out. The side that is
    broadcast has one row per sort partition, whatever the data size. The written table is the
    result's ``temporary``, for ``session.discard`` once nothing reads it.
    """
    placed = df.orderBy(*order()).withColumn("_place", F.monotonically_increasing_id())
    saved = materialize(placed, tag)
    partition = F.shiftright(F.col("_place"), 33)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        saved.groupBy(partition.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    indexed = (
        saved.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_IN_PARTITION)))
        .drop("_part", "_place", "_offset")
    )
    indexed.temporary = [saved]
    return indexed
