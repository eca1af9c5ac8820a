"""Channel registry: reading and checking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed as v
from ..schemas import SOURCES


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The registry CSV. A row that does not fit the schema fails the read."""
    return (
        spark.read.schema(SOURCES)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def check_sources(sources: DataFrame) -> DataFrame:
    """Violations of the registry rules as ``(rule, value, n)``; empty when the registry is sound.

    Rules: ``id`` unique and present, ``channel_id`` unique and present, ``platform`` one of the
    known ones, ``channel_name`` present.
    """
    def repeated(column: str) -> DataFrame:
        return (
            sources.where(F.col(column).isNotNull())
            .groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count("*").alias("n"))
            .where("n > 1")
            .select(F.lit(f"{column} repeated").alias("rule"), "value", "n")
        )

    per_row = F.array_compact(F.array(
        *(F.when(F.col(c).isNull(), F.struct(F.lit(f"{c} missing").alias("rule"),
                                             F.lit(None).cast("string").alias("value")))
          for c in ("id", "channel_id", "platform", "channel_name")),
        F.when(~F.col("platform").isin(*v.PLATFORMS),
               F.struct(F.lit("platform unknown").alias("rule"), F.col("platform").alias("value"))),
    ))
    rows = (
        sources.select(F.explode(per_row).alias("v"))
        .groupBy("v.rule", "v.value")
        .agg(F.count("*").alias("n"))
    )
    return repeated("id").unionByName(repeated("channel_id")).unionByName(rows)


def channels_for(sources: DataFrame, platform: str) -> DataFrame:
    """Channel ids registered for a platform."""
    return sources.where(F.col("platform") == platform).select("channel_id")


def registered_only(messages: DataFrame, sources: DataFrame, platform: str) -> DataFrame:
    """Messages of the channels registered for their platform.

    No broadcast is forced: Spark broadcasts the channel ids while their size is under
    ``autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution splits the
    partition of a dominant channel.
    """
    return messages.join(channels_for(sources, platform), "channel_id", "left_semi")
