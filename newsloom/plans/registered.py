"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed as v
from ..functions import links as ln
from ..functions import text as tx
from ..functions.times import parse_utc, stamp
from ..operators import alerts, dedup, filters, labelling, ordering, stats
from ..schemas import DIGEST, MESSAGES, columns
from ..session import discard, materialize, new_table_path
from ..sources import landing, registry as reg, writers
from ..sources.archive import read_digest
from ..sources.discord import normalize_discord, read_discord
from ..sources.telegram import normalize_telegram, read_telegram
from ..sources.writers import append_run_log, write_digest
from ..streaming.incremental import (
    compact_days, current_messages, incremental_digest as keep_current, remove_superseded, stream_landed,
)
from . import daily
from .posts import (
    discord_posts, faulty_registry, land_with_faults, load, odd_discord, odd_telegram, posts, raw_discord,
    raw_telegram, registry, registry_rows, telegram_posts,
)

AS_OF = "2024-01-31 00:00:00"
#: A time by which the tables have been quiet for more than a day.
QUIET = "2024-02-04 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query; its name is the function's. Queries count on UTC as session zone."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared frames --------------------------------------------------------------------------------

def _collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collect(spark, sf_dir, load(spark, sf_dir, "events"))


def _collect(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    return daily.collect_messages(
        raw_discord(discord_posts(spark, sf_dir, events)),
        raw_telegram(telegram_posts(spark, sf_dir, events)))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_latest(filters.kept(_collected(spark, sf_dir)))


def _joined(items: Column) -> Column:
    return F.coalesce(F.array_join(items, " "), F.lit(""))


def _shown(df: DataFrame, *extra: Column | str) -> DataFrame:
    """Messages with plain column types: times and links as text."""
    return df.select("id", "text", stamp(F.col("timestamp")).alias("timestamp"), "author",
                     "channel_id", "platform", _joined(F.col("links")).alias("links"), *extra)


def _shown_digest(df: DataFrame, *extra: Column | str) -> DataFrame:
    return _shown(df, F.coalesce(F.col("score").cast("string"), F.lit("")).alias("score"),
                  _joined(F.col("tags")).alias("tags"), *extra)


def _with_text(spark: SparkSession, sf_dir: str, fn: Callable[[Column], Column],
               name: str = "text") -> DataFrame:
    return posts(spark, sf_dir).select("id", "channel_id", fn(F.col("text")).alias(name))


def _doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = F.col("toxic") == 1
    sources = load(spark, sf_dir, "documents").select("doc_id", "source")
    return load(spark, sf_dir, "labels").where("quality = 1").join(sources, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(v.TELEGRAM).alias("platform"),
        F.col("source").alias("channel_id"),
        F.when(toxic, "0.75").otherwise("0.95").cast("decimal(3,2)").alias("score"),
        F.array(F.when(toxic, "scam").otherwise("news")).alias("tags"),
    )


def _digest(spark: SparkSession, sf_dir: str, collected: DataFrame, by=()) -> DataFrame:
    return daily.digest(collected, daily.known_labels(_doc_labels(spark, sf_dir)), by=by)


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelling.assign_batches(_messages(spark, sf_dir), v.DAILY_BATCH_SIZE)


def _responses(batched: DataFrame) -> DataFrame:
    """Replies derived from the batches: some good at once, some broken in each way the check must
    catch, some in another order or with odd items, half of the broken ones answered well at the third attempt."""
    size = F.length("text")
    keep = F.when(size % 3 == 0, '"false"').when(size % 3 == 1, '"true"').otherwise("true")
    item = F.concat(
        F.lit('{"id":"'), "id", F.lit('","platform":"'), "platform", F.lit('","keep":'), keep,
        F.lit(',"score":"0.'), (70 + size % 30).cast("string"), F.lit('","tags":["news"]}'),
    )
    rows = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"), "id", "platform")))
    answers = batched.groupBy("batch_id").agg(rows.alias("r")).select(
        "batch_id",
        F.array_join(F.transform("r", lambda r: r["item"]), ",").alias("items"),
        F.array_join(
            F.transform(F.filter("r", lambda r: r["pos"] > 0),
                        lambda r: F.concat(F.lit('{"id":"'), r["id"], F.lit('"}'))), ","
        ).alias("short"),
        F.array_join(F.reverse(F.transform("r", lambda r: F.concat(
            F.lit('{"id":"'), r["id"], F.lit('","platform":"'), r["platform"],
            F.lit('","keep":"true","score":"0.8","tags":[1,"x"]}')))), ",").alias("reversed"),
        F.array_join(F.transform("r", lambda r: F.when(r["pos"] == 0, "5").otherwise(F.concat(
            F.lit('{"id":"'), r["id"], F.lit('","platform":"'), r["platform"],
            F.lit('","keep":"true","score":0.9,"tags":"news"}')))), ",").alias("odd"),
    )
    kind = F.col("batch_id") % 7
    good = F.concat(F.lit("["), "items", F.lit("]"))
    first = (
        F.when(kind == 0, F.lit("sorry, no"))
        .when(kind == 1, F.concat(F.lit("["), "short", F.lit("]")))
        .when(kind == 2, F.concat(F.lit('{"labels": '), good, F.lit("}")))
        .when(kind == 3, F.concat(good, F.lit(" done")))
        .when(kind == 5, F.concat(F.lit("["), "reversed", F.lit("]")))
        .when(kind == 6, F.concat(F.lit("["), "odd", F.lit("]")))
        .otherwise(F.concat(F.lit(" "), good, F.lit(" ")))
    )
    third = F.when(kind < 4, F.struct(
        F.lit(3).alias("attempt"), F.when(F.col("batch_id") % 2 == 0, good).alias("body")))
    tries = F.array_compact(F.array(
        F.struct(F.lit(1).alias("attempt"), first.alias("body")), third))
    return answers.select("batch_id", F.inline(tries))


def _errors(rows: DataFrame) -> DataFrame:
    kind = F.min("user_id") % 5
    status = F.when(kind == 0, 401).when(kind == 1, 403).when(kind == 2, 404).when(kind == 3, 500)
    return rows.groupBy("channel_id", "platform").agg(status.cast("int").alias("http_status")).select(
        "channel_id", "platform", "http_status",
        F.concat(F.lit("upstream said: "),
                 F.repeat(F.concat("channel_id", F.lit(" is away; ")), F.lit(20))).alias("error"),
    )


# --- registry and filters -------------------------------------------------------------------------

@query
def sources_check(spark, sf_dir):
    return reg.check_sources(faulty_registry(spark, sf_dir))


@query
def channels_by_platform(spark, sf_dir):
    known = registry(spark, sf_dir)
    parts = (reg.channels_for(known, p).withColumn("platform", F.lit(p)) for p in v.PLATFORMS)
    return dedup.union_channels(*parts)


@query
def registered_messages(spark, sf_dir):
    known = registry(spark, sf_dir)
    rows = dedup.union_channels(
        reg.registered_only(telegram_posts(spark, sf_dir), known, v.TELEGRAM),
        reg.registered_only(discord_posts(spark, sf_dir), known, v.DISCORD),
    )
    return rows.select("id", "channel_id", "platform")


@query
def lookback_24h(spark, sf_dir):
    rows = filters.lookback(posts(spark, sf_dir), AS_OF, column="ts")
    return rows.select("id", "channel_id", "platform", stamp(F.col("ts")).alias("timestamp"))


@query
def low_value_drop(spark, sf_dir):
    return filters.drop_low_value(posts(spark, sf_dir)).select(
        "id", "channel_id", "platform", F.length("text").alias("n_chars"))


# --- text and links -------------------------------------------------------------------------------

@query
def normalized_words(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.normalize_words, "words")


@query
def clean_text(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.clean_text)


@query
def strip_urls(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.strip_urls)


@query
def strip_emoji(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.strip_emoji)


@query
def collapse_whitespace(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.collapse_whitespace)


@query
def repair_unicode(spark, sf_dir):
    return _with_text(spark, sf_dir, tx.repair_unicode)


@query
def clean_conversations(spark, sf_dir):
    text = F.col("text")
    return load(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.clean_text(text).alias("text"), tx.is_low_value(text).alias("low_value"))


@query
def links_from_text(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "id", "channel_id", F.posexplode(ln.links_from_text(F.col("text"))).alias("pos", "link"))


@query
def links_from_pages(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(ln.links_from_text(F.col("html"))).alias("pos", "link"))


@query
def distinct_links(spark, sf_dir):
    """Links of entities and texts, each link of a message once."""
    raw = raw_telegram(telegram_posts(spark, sf_dir))
    found = ln.links_from_entities(F.col("entities"))
    in_text = ln.links_from_text(F.col("message"))
    return raw.select(F.col("id").cast("string").alias("id"), "channel_id", F.posexplode(
        ln.concat_links(found, in_text, in_text, distinct=True)).alias("pos", "link"))


# --- messages and deduplication -------------------------------------------------------------------

def _shown_platform(df: DataFrame) -> DataFrame:
    return _shown(df, "low_value").withColumn("text", F.coalesce("text", F.lit("")))


@query
def telegram_messages(spark, sf_dir):
    return _shown_platform(normalize_telegram(raw_telegram(telegram_posts(spark, sf_dir))))


@query
def discord_messages(spark, sf_dir):
    return _shown_platform(normalize_discord(raw_discord(discord_posts(spark, sf_dir))))


@query
def union_platforms(spark, sf_dir):
    return filters.kept(_collected(spark, sf_dir)).select(
        "id", "channel_id", "platform", F.length("text").alias("n_chars"))


@query
def dedup_latest(spark, sf_dir):
    return _shown(_messages(spark, sf_dir))


@query
def dedup_keep_empty(spark, sf_dir):
    return _shown(dedup.dedup_latest(filters.kept(_collected(spark, sf_dir)), keep_empty=True))


@query
def dedup_channel(spark, sf_dir):
    return _shown(dedup.dedup_channel(filters.kept(_collected(spark, sf_dir))))


@query
def ranked_newest_first(spark, sf_dir):
    rows = _messages(spark, sf_dir).select("id", "channel_id", "platform", "timestamp")
    return ordering.with_row_index(rows, name="position").drop("timestamp")


@query
def parsed_times(spark, sf_dir):
    kind = F.col("event_type")
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(kind == "error", "").otherwise(F.date_format("ts", ".SSSSSS")),
        F.when(kind == "click", "+02:00").when(kind == "signup", "Z").when(kind == "view", " later")
        .otherwise(""),
    )
    user = F.col("user_id") % 20  # some texts without a whole date, and some in the basic form
    text = (
        F.when(user == 0, F.date_format("ts", "HH:mm")).when(user == 1, F.date_format("ts", "'T'HH:mm:ss"))
        .when(user == 2, F.date_format("ts", "yyyy")).when(user == 3, F.date_format("ts", "yyyy-MM"))
        .when(user == 4, F.date_format("ts", "yyyyMMdd'T'HHmmss'+0100'"))
        .when(user == 5, F.date_format("ts", "yyyyMMdd")).when(user == 6, F.date_format("ts", "yyyy-MM-dd"))
        .when(user == 7, "soon").otherwise(text)
    )
    return load(spark, sf_dir, "events").select("event_id", stamp(parse_utc(text)).alias("parsed"))


@query
def landed_messages(spark, sf_dir):
    discord, telegram = (new_table_path(spark, f"landed-{p}") for p in (v.DISCORD, v.TELEGRAM))
    raw_discord(discord_posts(spark, sf_dir)).write.json(discord)
    raw_telegram(telegram_posts(spark, sf_dir)).write.json(telegram)
    return _shown_platform(daily.collect_messages(
        read_discord(spark, discord), read_telegram(spark, telegram)))


def _land(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Both platforms landed in dated folders: odd times and texts, and lines cut short."""
    paths = {p: new_table_path(spark, f"landed-{p}") for p in v.PLATFORMS}
    discord, telegram = (odd_discord(discord_posts(spark, sf_dir)), odd_telegram(telegram_posts(spark, sf_dir)))
    land_with_faults(discord, F.col("author.id").cast("int"), parse_utc(F.col("timestamp")), paths[v.DISCORD])
    land_with_faults(telegram, F.col("peer_id.channel_id"), parse_utc(F.col("date")), paths[v.TELEGRAM])
    return paths


@query
def landed_24h(spark, sf_dir):
    """Odd landed messages of one day, read from the folders that can hold them."""
    paths = _land(spark, sf_dir)
    return _shown_platform(daily.collect_messages(
        read_discord(spark, paths[v.DISCORD], AS_OF), read_telegram(spark, paths[v.TELEGRAM], AS_OF), as_of=AS_OF))


@query
def landing_account(spark, sf_dir):
    paths = _land(spark, sf_dir)
    accounts = (landing.landing_account(landing.read_landed(spark, paths[p], landing.RAW[p])).select(
        F.lit(p).alias("platform"), "*") for p in v.PLATFORMS)
    return dedup.union_channels(*accounts).groupBy(
        "platform", F.coalesce(F.col("landed").cast("string"), F.lit("")).alias("landed")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_unreadable").alias("n_unreadable"), F.sum("n_empty").alias("n_empty"))


@query
def records_json(spark, sf_dir):
    rows = _messages(spark, sf_dir).select("id", "channel_id", "platform", "text", "timestamp")
    return writers.records_json(rows)


# --- counts and alerts ----------------------------------------------------------------------------

@query
def channel_stats(spark, sf_dir):
    return stats.channel_stats(_collected(spark, sf_dir))


@query
def run_totals(spark, sf_dir):
    totals = stats.run_totals(stats.channel_stats(_collected(spark, sf_dir)))
    return totals.na.fill("all", ["platform", "channel_id"])


@query
def combined_count(spark, sf_dir):
    return _messages(spark, sf_dir).agg(F.count("*").alias("combined"))


@query
def observed_count(spark, sf_dir):
    """Counted while the messages are written, without a pass of its own."""
    rows, seen = stats.observe_count(_messages(spark, sf_dir))
    write_digest(rows, new_table_path(spark, "observed"), AS_OF[:10])
    return spark.createDataFrame([(seen.get["rows"],)], "combined long")


@query
def run_stats(spark, sf_dir):
    counted = stats.channel_stats(_collected(spark, sf_dir))
    rows = stats.with_failures(counted, _errors(posts(spark, sf_dir)))
    return rows.withColumn("success", F.coalesce(F.col("success").cast("string"), F.lit("unknown"))) \
        .withColumn("error", F.coalesce("error", F.lit("")))


@query
def run_alerts(spark, sf_dir):
    """A quiet day, and of all days the channels that have nothing but greetings."""
    discord, telegram = discord_posts(spark, sf_dir), telegram_posts(spark, sf_dir)

    def left(condition: Column) -> DataFrame:
        return filters.kept(daily.collect_messages(
            raw_discord(discord.where(condition)), raw_telegram(telegram.where(condition))))

    quiet = left(F.col("ts") >= F.lit(QUIET).cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS"))
    greetings = left(F.col("channel_id").isin("feed_signup", "feed_view"))
    return alerts.run_alerts(_errors(posts(spark, sf_dir)), quiet, labelling.label_input(greetings)).na.fill(
        "", ["channel_id", "platform"])


# --- labelling ------------------------------------------------------------------------------------

@query
def label_input(spark, sf_dir):
    return labelling.label_input(_messages(spark, sf_dir)).withColumn("links", _joined(F.col("links")))


@query
def label_input_defaults(spark, sf_dir):
    """Messages without links, some without a text."""
    text = F.when(F.length("text") % 3 != 0, F.col("text"))
    return labelling.label_input(_messages(spark, sf_dir).drop("links").withColumn("text", text)) \
        .withColumn("links", F.size("links"))


@query
def label_batches(spark, sf_dir):
    rows = _messages(spark, sf_dir).select("id", "channel_id", "platform", "timestamp")
    return labelling.assign_batches(rows, v.DAILY_BATCH_SIZE).drop("timestamp")


@query
def label_requests(spark, sf_dir):
    return labelling.label_requests(_batched(spark, sf_dir))


@query
def label_validate(spark, sf_dir):
    batched = _batched(spark, sf_dir)
    sizes = batched.groupBy("batch_id").agg(F.count("*").alias("n"))
    return labelling.accepted_replies(_responses(batched), sizes)


def _replayed(batched: DataFrame) -> DataFrame:
    return labelling.replay_labels(batched, _responses(batched))


@query
def label_fallback(spark, sf_dir):
    return _replayed(_batched(spark, sf_dir)).withColumn("tags", _joined(F.col("tags"))) \
        .withColumn("keep", F.coalesce("keep", F.lit(""))) \
        .withColumn("score", F.coalesce("score", F.lit("")))


@query
def label_kept(spark, sf_dir):
    kept = labelling.kept_labels(_replayed(_batched(spark, sf_dir)))
    return kept.withColumn("tags", _joined(F.col("tags"))) \
        .withColumn("score", F.coalesce(F.col("score").cast("string"), F.lit("")))


@query
def digest_from_replies(spark, sf_dir):
    batched = _batched(spark, sf_dir)
    kept = labelling.kept_labels(_replayed(batched))
    return _shown_digest(labelling.join_labels(batched.select(*columns(MESSAGES)), kept))


@query
def topic_rubric(spark, sf_dir):
    labels = labelling.rubric_labels(labelling.label_input(_messages(spark, sf_dir)))
    return labels.withColumn("tags", _joined(F.col("tags")))


@query
def tag_check(spark, sf_dir):
    labels = labelling.rubric_labels(labelling.label_input(_messages(spark, sf_dir)))
    with_foreign = labels.withColumn("tags", F.array_append("tags", F.col("platform")))
    return labelling.unknown_tag_rows(with_foreign).select("id", "channel_id", "tag")


@query
def label_with_fn(spark, sf_dir):
    def judge(items):
        return [{
            "id": item["id"], "platform": item["platform"],
            "keep": "true" if len(item["text"]) % 3 else "false",
            "score": f"0.{70 + len(item['text']) % 30}",
            "tags": ["news", "product"] if len(item["links"]) > 1 else ["news"],
        } for item in items]

    labels = labelling.label_with(_messages(spark, sf_dir), judge, batch_size=v.DAILY_BATCH_SIZE)
    return labels.withColumn("tags", _joined(F.col("tags"))) \
        .withColumn("score", F.col("score").cast("string"))


# --- digests --------------------------------------------------------------------------------------

@query
def digest_by_rubric(spark, sf_dir):
    return _shown_digest(daily.digest(_collected(spark, sf_dir)))


@query
def digest(spark, sf_dir):
    return _shown_digest(_digest(spark, sf_dir, _collected(spark, sf_dir)))


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, daily.with_run_days(_collected(spark, sf_dir)), by=("run_date",))


@query
def digest_by_day(spark, sf_dir):
    return _shown_digest(_by_day(spark, sf_dir), F.col("run_date").cast("string").alias("run_date"))


@query
def digest_24h(spark, sf_dir):
    discord = filters.lookback(discord_posts(spark, sf_dir), AS_OF, column="ts")
    telegram = filters.lookback(telegram_posts(spark, sf_dir), AS_OF, column="ts")
    collected = daily.collect_messages(raw_discord(discord), raw_telegram(telegram), as_of=AS_OF)
    return _shown_digest(_digest(spark, sf_dir, collected))


@query
def digest_written(spark, sf_dir):
    path = new_table_path(spark, "digest")
    rows = _by_day(spark, sf_dir)
    write_digest(rows, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return _shown_digest(stored, F.col("run_date").cast("string").alias("run_date"))


@query
def run_log(spark, sf_dir):
    path = new_table_path(spark, "run-log")
    counted = materialize(stats.channel_stats(_collected(spark, sf_dir)).select(
        "*", F.lit(None).cast("boolean").alias("success"), F.lit(None).cast("string").alias("error")), "run-counts")
    for run_id in ("first", "second", "second"):
        append_run_log(counted, path, AS_OF[:10], run_id)
    discard(counted)
    return writers.read_run_log(spark, path).select(
        "channel_id", "platform", "pulled", "kept", F.coalesce("success", F.lit(True)).alias("success"),
        F.coalesce("error", F.lit("")).alias("error"), "run_id",
        F.col("run_date").cast("string").alias("run_date"))


@query
def digest_rerun(spark, sf_dir):
    """A day that is written again as empty is gone; the others stay."""
    path = new_table_path(spark, "digest-rerun")
    rows = _by_day(spark, sf_dir)
    write_digest(rows, path)
    write_digest(rows.limit(0), path, "2024-01-30")
    stored = spark.read.schema(rows.schema).parquet(path)
    return _shown_digest(stored, F.col("run_date").cast("string").alias("run_date"))


@query
def incremental_digest(spark, sf_dir):
    path = new_table_path(spark, "stream")
    source = spark.readStream.schema(load(spark, sf_dir, "events").schema).option(
        "pathGlobFilter", "events.parquet").parquet(sf_dir)
    collected = _collect(spark, sf_dir, source)
    keep_current(collected, f"{path}/table", f"{path}/state").awaitTermination()
    return _shown(current_messages(spark, f"{path}/table"))


@query
def digest_archive(spark, sf_dir):
    """The digests as JSON arrays with a bare NaN for what is missing, read back."""
    path = new_table_path(spark, "archive")
    writers.write_digest_documents(_by_day(spark, sf_dir), path)
    return _shown_digest(read_digest(spark, path))


@query
def incremental_landed(spark, sf_dir):
    """Landed files taken up one at a time, a restart with more of them, closed days compacted, and the
    last 24 hours read."""
    path = new_table_path(spark, "stream-landed")
    for turn in range(2):
        for platform, rows, raw in ((v.TELEGRAM, telegram_posts, raw_telegram), (v.DISCORD, discord_posts, raw_discord)):
            share = F.pmod(F.hash("id", "channel_id"), F.lit(2)) == turn
            raw(rows(spark, sf_dir).where(share).repartition(2)).write.mode("append").json(f"{path}/{platform}")
        landed = [stream_landed(spark, p, f"{path}/{p}", max_files=1) for p in v.PLATFORMS]
        keep_current(dedup.union_channels(*landed), f"{path}/table", f"{path}/state").awaitTermination()
    compact_days(spark, f"{path}/table", AS_OF[:10])
    remove_superseded(spark, f"{path}/table", grace_seconds=0)
    return _shown(current_messages(spark, f"{path}/table", AS_OF))


@query
def whole_run(spark, sf_dir):
    """A day's run from registry and landed files to what it leaves, twice: the digest read back from JSON
    arrays, the run log, the alerts on channels, and the counts of messages and unreadable rows."""
    paths, out = _land(spark, sf_dir), new_table_path(spark, "run")
    registry_rows(spark, sf_dir).write.option("header", True).csv(f"{out}/registry")
    sources = reg.read_sources(spark, f"{out}/registry")
    errors = _errors(posts(spark, sf_dir)).join(sources, ["channel_id", "platform"], "left_semi")
    for _ in range(2):
        result = daily.run_landed(spark, paths, sources, AS_OF, AS_OF[:10], out, errors=errors, json_array=True)
    writers.write_digest_documents(spark.read.schema(DIGEST).parquet(f"{out}/digest"), f"{out}/documents")
    score = F.coalesce(F.col("score").cast("string"), F.lit(""))
    digest_rows = read_digest(spark, f"{out}/documents").select(
        F.lit("digest").alias("part"), "channel_id", "platform", F.col("id").alias("key"),
        F.concat_ws("|", stamp(F.col("timestamp")), "author", _joined(F.col("links")), score, _joined(F.col("tags")),
                    "text").alias("value"))
    log = writers.read_run_log(spark, f"{out}/run_log").select(
        F.lit("log").alias("part"), "channel_id", "platform", F.col("run_id").alias("key"),
        F.concat_ws("|", "pulled", "kept", F.coalesce(F.col("success").cast("string"), F.lit("")),
                    F.coalesce("error", F.lit(""))).alias("value"))
    told = result.alerts.where("kind <> 'unreadable_rows'").select(
        F.lit("alert").alias("part"), F.coalesce("channel_id", F.lit("")).alias("channel_id"),
        F.coalesce("platform", F.lit("")).alias("platform"), F.col("kind").alias("key"), F.col("message").alias("value"))
    counts = spark.createDataFrame(
        [("count", "", "", "combined", str(result.combined)), ("count", "", "", "unreadable", str(result.unreadable))],
        told.schema)
    return dedup.union_channels(digest_rows, log, told, counts)
