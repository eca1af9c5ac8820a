"""Per-channel counts of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import fixed as v

_CHANNEL = ["channel_id", "platform"]


def text_key(text: Column) -> Column:
    """A text's SHA-256: what counting distinct texts shuffles instead of the texts."""
    return F.unhex(F.sha2(text, 256))


def channel_stats(collected: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """``pulled`` and ``kept`` per channel of a collected frame.

    Discord: ``pulled`` counts the window, ``kept`` what is left without greetings. Telegram:
    ``pulled`` counts what is left without greetings, ``kept`` its distinct texts. ``in_window`` and
    ``distinct_text`` mean the same on both. With ``sources`` every registered channel has a row.

    The distinct count runs in two shuffles, first on channel and text key, so no task gets a whole
    channel.
    """
    kept_text = F.when(~F.col("low_value"), text_key(F.col("text")))
    counts = (
        collected.select(*_CHANNEL, "low_value", kept_text.alias("_key"))
        .groupBy(*_CHANNEL)
        .agg(
            F.count("*").alias("in_window"),
            F.count_if(~F.col("low_value")).alias("no_greeting"),
            F.count_distinct("_key").alias("distinct_text"),
        )
    )
    if sources is not None:
        counts = sources.select(*_CHANNEL).join(counts, _CHANNEL, "left").na.fill(0)
    discord = F.col("platform") == v.DISCORD
    return counts.select(
        *_CHANNEL,
        F.when(discord, F.col("in_window")).otherwise(F.col("no_greeting")).alias("pulled"),
        F.when(discord, F.col("no_greeting")).otherwise(F.col("distinct_text")).alias("kept"),
        "in_window",
        "distinct_text",
    )


def fatal(errors: DataFrame) -> DataFrame:
    """Load errors that end a channel: refused, unknown, or any failure without a status."""
    status = F.col("http_status")
    return errors.where(status.isNull() | status.isin(*v.ALERT_HTTP_STATUS))


def with_failures(stats: DataFrame, errors: DataFrame) -> DataFrame:
    """Run statistics with one 0/0 row, ``success = false``, per channel that failed. A failed
    channel has that row only."""
    from .alerts import error_text

    failed = fatal(errors).groupBy(*_CHANNEL).agg(F.min(error_text()).alias("error"))
    fine = stats.join(failed.select(*_CHANNEL), _CHANNEL, "left_anti").select(
        *_CHANNEL, "pulled", "kept",
        F.lit(None).cast("boolean").alias("success"), F.lit(None).cast("string").alias("error"),
    )
    zero = F.lit(0).cast("bigint")
    return fine.unionByName(failed.select(
        *_CHANNEL, zero.alias("pulled"), zero.alias("kept"), F.lit(False).alias("success"), "error",
    ))


def run_totals(stats: DataFrame) -> DataFrame:
    """Sums per channel, per platform and over all: null stands for all."""
    return (
        stats.rollup("platform", "channel_id")
        .agg(F.sum("pulled").alias("pulled"), F.sum("kept").alias("kept"))
    )


def observe_count(df: DataFrame, name: str = "combined") -> tuple[DataFrame, Observation]:
    """Count rows in passing: the count is there once the frame has been written, without a second
    pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
