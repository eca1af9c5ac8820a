"""Alert rows of a run. Delivery is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed as v
from ..schemas import ALERTS, columns


def format_alert(message: Column) -> Column:
    return F.concat(F.lit(v.ALERT_PREFIX), message)


def http_alert(status: Column, body: Column) -> Column:
    """Text for an HTTP status: a fixed one for 401, 403 and 404, else the start of the body."""
    text = None
    for code, message in v.ALERT_HTTP_STATUS.items():
        text = (F if text is None else text).when(status == code, F.lit(message))
    excerpt = F.substring(F.coalesce(body, F.lit("")), 1, v.ALERT_BODY_CHARS)
    return text.otherwise(F.format_string(v.ALERT_HTTP_OTHER, status, excerpt))


def error_text() -> Column:
    """What a load error says: the status text if there is a status, else the error."""
    return F.when(
        F.col("http_status").isNotNull(), http_alert(F.col("http_status"), F.col("error"))
    ).otherwise(F.coalesce(F.col("error"), F.lit("")))


def source_alerts(errors: DataFrame) -> DataFrame:
    """One alert per HTTP failure and one per channel failure that ends the channel."""
    from .stats import fatal

    http = errors.where(F.col("http_status").isNotNull()).select(
        F.lit("http_status").alias("kind"), "channel_id", "platform", error_text().alias("text")
    )
    text = None
    for platform, message in v.ALERT_SOURCE_ERROR.items():
        line = F.format_string(message, F.col("channel_id"), error_text())
        text = (F if text is None else text).when(F.col("platform") == platform, line)
    failed = fatal(errors).select(
        F.lit("source_error").alias("kind"), "channel_id", "platform", text.alias("text")
    )
    return http.unionByName(failed)


def empty_alert(df: DataFrame, kind: str, text: str) -> DataFrame:
    """One row if the frame is empty. Each task contributes at most one row to the test."""
    none = F.lit(None).cast("string")
    return (
        df.limit(1).agg(F.count("*").alias("n")).where("n = 0")
        .select(F.lit(kind).alias("kind"), none.alias("channel_id"), none.alias("platform"),
                F.lit(text).alias("text"))
    )


def unreadable_alerts(account: DataFrame, platform: str) -> DataFrame:
    """One alert per landed file that holds rows which cannot be read, from ``landing_account``."""
    text = F.format_string(v.ALERT_UNREADABLE, F.col("file"), F.col("n_unreadable"), F.col("n_rows"))
    return account.where("n_unreadable > 0").select(
        F.lit("unreadable_rows").alias("kind"), F.lit(None).cast("string").alias("channel_id"),
        F.lit(platform).alias("platform"), format_alert(text).alias("message")).select(*columns(ALERTS))


def run_alerts(errors: DataFrame, messages: DataFrame, labelable: DataFrame) -> DataFrame:
    """All alerts of a run: source errors, nothing collected, nothing to label."""
    rows = (
        source_alerts(errors)
        .unionByName(empty_alert(messages, "no_messages", v.ALERT_NO_MESSAGES))
        .unionByName(empty_alert(labelable, "nothing_to_label", v.ALERT_NOTHING_TO_LABEL))
    )
    return rows.select("kind", "channel_id", "platform",
                       format_alert(F.col("text")).alias("message")).select(*columns(ALERTS))
