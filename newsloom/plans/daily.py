"""The daily digest from landed messages to written output."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed as v
from ..functions.rubric import keep_rule, topic_score, topic_tags
from ..functions.times import run_day
from ..operators.alerts import run_alerts, unreadable_alerts
from ..operators.dedup import dedup_latest, union_channels
from ..operators.filters import kept
from ..operators.labelling import LABEL_KEYS, join_labels, label_input, label_with
from ..operators.stats import channel_stats, observe_count, run_totals, with_failures
from ..schemas import DIGEST, LOAD_ERRORS, columns
from ..session import discard, materialize
from ..sources.discord import normalize_discord
from ..sources.landing import RAW, landing_account, read_landed, readable
from ..sources.registry import registered_only
from ..sources.telegram import normalize_telegram
from ..sources.writers import (
    append_run_log, day_path, read_run_log, write_digest, write_digest_array,
)


def collect_messages(discord: DataFrame, telegram: DataFrame, sources: DataFrame | None = None,
                     as_of=None, hours: int = v.LOOKBACK_HOURS) -> DataFrame:
    """Both platforms as one frame of common columns with ``low_value``; narrow work only.

    With ``sources`` only registered channels are taken up, before any text is cleaned.
    """
    if sources is not None:
        discord = registered_only(discord, sources, v.DISCORD)
        telegram = registered_only(telegram, sources, v.TELEGRAM)
    return union_channels(
        normalize_discord(discord, as_of, hours), normalize_telegram(telegram, as_of, hours)
    )


Labeller = Callable[[DataFrame], DataFrame]


def rubric_labeller(messages: DataFrame) -> DataFrame:
    """Score and tags by the keyword rubric, as columns of the same rows: no join, no shuffle."""
    tagged = messages.withColumn("_tags", topic_tags(F.col("text"), F.col("links")))
    scored = tagged.withColumn("_score", topic_score(F.col("_tags")))
    keep = keep_rule(F.col("_score"))
    return scored.select(
        *messages.columns, F.when(keep, F.col("_score")).alias("score"),
        F.when(keep, F.col("_tags")).alias("tags"),
    )


def function_labeller(fn: Callable, batch_size: int = v.DAILY_BATCH_SIZE, **options) -> Labeller:
    """Score and tags by a labelling function, see ``label_with``.

    Messages and labels are each written once before they are joined, so that no message is
    deduplicated and no batch labelled a second time.
    """
    def label(messages: DataFrame) -> DataFrame:
        saved = materialize(messages, "messages")
        labels = materialize(label_with(saved, fn, batch_size, **options), "labels")
        joined = join_labels(saved, labels)
        joined.temporary = [saved, labels]
        return joined

    return label


def known_labels(labels: DataFrame, keys=LABEL_KEYS) -> Labeller:
    """Score and tags from a frame of kept labels."""
    return lambda messages: join_labels(messages, labels, keys)


def digest(collected: DataFrame, labeller: Labeller = rubric_labeller, by: tuple[str, ...] = (),
           keep_empty: bool = False) -> DataFrame:
    """Deduplicated messages with score and tags. ``by`` limits the comparison of texts, as
    ``("run_date",)`` does for many days in one job."""
    return labeller(dedup_latest(kept(collected), by=by, keep_empty=keep_empty))


def with_run_days(collected: DataFrame) -> DataFrame:
    """Give each message the day whose run takes it up: that of its own time. For making the
    digests of many days in one job."""
    return collected.withColumn("run_date", run_day(F.col("timestamp")))


def daily_digest(discord: DataFrame, telegram: DataFrame, sources: DataFrame | None, as_of,
                 labeller: Labeller = rubric_labeller, hours: int = v.LOOKBACK_HOURS,
                 keep_empty: bool = False) -> DataFrame:
    """The digest of one run."""
    collected = collect_messages(discord, telegram, sources, as_of, hours)
    return digest(collected, labeller, keep_empty=keep_empty).select(*columns(DIGEST))


class RunResult(NamedTuple):
    """What a run leaves besides its output: alert rows, totals, the number of messages, and of the
    landed rows those that could not be read."""

    alerts: DataFrame
    totals: DataFrame
    combined: int
    unreadable: int = 0


def run_daily(discord: DataFrame, telegram: DataFrame, sources: DataFrame, as_of, run_date: str,
              out: str, labeller: Labeller = rubric_labeller, errors: DataFrame | None = None,
              hours: int = v.LOOKBACK_HOURS, json_array: bool = False) -> RunResult:
    """Run and write everything: ``out/digest`` and ``out/run_log`` by date, and with ``json_array``
    the ordered JSON array of the date under ``out/array``.

    Cleaned messages are written once to the shared folder. Counts, digest and alerts read them
    from there, each only the columns it needs, so no text is cleaned twice, also when executors
    are lost. Messages are counted while the digest is written, totals are read from the log, and what the run
    kept in the shared folder is removed at its end, but for the alert rows. A rerun with the same ``as_of``
    replaces everything that the first run wrote.
    """
    spark = discord.sparkSession
    if errors is None:
        errors = spark.createDataFrame([], LOAD_ERRORS)
    collected = materialize(collect_messages(discord, telegram, sources, as_of, hours), "collected")
    labelled = labeller(dedup_latest(kept(collected)))
    rows, seen = observe_count(labelled.select(*columns(DIGEST)))
    write_digest(rows, f"{out}/digest", run_date)
    if json_array:
        today = spark.read.schema(DIGEST).parquet(day_path(f"{out}/digest", run_date))
        write_digest_array(today, f"{out}/array/{run_date}")
    run_id = str(as_of)
    append_run_log(with_failures(channel_stats(collected, sources), errors), f"{out}/run_log", run_date, run_id)
    logged = read_run_log(spark, f"{out}/run_log").where(
        (F.col("run_date") == F.lit(str(run_date)[:10]).cast("date")) & (F.col("run_id") == run_id))
    messages = kept(collected)
    alerts = materialize(run_alerts(errors, messages, label_input(messages)), "alerts")
    discard(collected, *getattr(labelled, "temporary", ()))
    return RunResult(alerts, run_totals(logged), seen.get["rows"])


def run_landed(spark: SparkSession, landed: dict[str, str], sources: DataFrame, as_of, run_date: str, out: str,
               hours: int = v.LOOKBACK_HOURS, margin_days: int = 1, **options) -> RunResult:
    """``run_daily`` over landed files: ``landed`` has the folder of each platform.

    Only days that the look-back window can need are read. Rows that cannot be read are left out; a
    second, narrow pass over the same files counts them, for an alert on each file that holds some.
    """
    rows = {p: read_landed(spark, landed[p], RAW[p], as_of, hours, margin_days) for p in RAW}
    result = run_daily(readable(rows[v.DISCORD]), readable(rows[v.TELEGRAM]), sources, as_of, run_date, out,
                       hours=hours, **options)
    accounts = union_channels(*(landing_account(rows[p]).withColumn("platform", F.lit(p)) for p in RAW))
    faulty = materialize(accounts.where("n_unreadable > 0"), "unreadable")
    told = (unreadable_alerts(faulty.where(F.col("platform") == p), p) for p in RAW)
    total = faulty.agg(F.coalesce(F.sum("n_unreadable"), F.lit(0))).first()[0]
    return result._replace(alerts=union_channels(result.alerts, *told), unreadable=total)
