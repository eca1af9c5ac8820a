"""Chat posts derived from the benchmark tables.

The tables have no chat data. Every row of ``events``, ``documents`` and ``conversations`` becomes
one post. Documents are long Telegram posts and conversation turns Discord messages, both with
their whole text and timed by the event of the same number. An event itself is a short post after
its type: some types are greetings or links only, and each repeats one text or a few in very many
posts, as in real channels. A third of the purchases have a text of their own: those share id, time and
platform with the document of the same number, but not the channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed as v

GREETING = "GM!! 🚀"
SPACED_GREETING = "selamat   pagi."
REPEATED = "Token launch 🎉: “staking” is live at the café\n\tsee www.foo.com."
# Both encodings side by side, an entity, a ligature and full-width letters.
MIXED = "cafÃ© — 😀 &amp; ﬁne “ＡＢ１” CafÃ©, Привет ÐŸÑ€ «CAFÉ» no. "
DISCORD_EVENTS = ("signup", "error")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _link(site: Column | str) -> Column:
    return F.concat(F.lit("https://"), site, F.lit(".example.com/p/"), F.col("user_id").cast("string"))


def _select(rows: DataFrame, post_id: Column, ts: Column, channel: Column, platform: str,
            text: Column) -> DataFrame:
    return rows.select(
        post_id.cast("string").alias("id"), "user_id",
        F.get_json_object("props", "$.k").alias("k"), ts.alias("ts"), channel.alias("channel_id"),
        F.lit(platform).alias("platform"), F.col("event_type").alias("kind"), text.alias("text"),
    )


def _short_posts(events: DataFrame, platform: str) -> DataFrame:
    kind = F.col("event_type")
    on_discord = kind.isin(*DISCORD_EVENTS)
    text = (
        F.when(kind == "signup", F.lit(GREETING))
        .when(kind == "view", F.lit(SPACED_GREETING))
        .when(kind == "click", F.concat(_link(F.lit("feed")), F.lit(" www.foo.com/x")))
        .when(kind == "error",
              F.concat(F.lit("Exploit report: vulnerability in a bridge "), F.col("props")))
        .when((kind == "purchase") & (F.col("user_id") % 30 == 3), F.concat(
            F.lit("long "), _link(F.concat(F.repeat(F.lit("u"), F.lit(300)), F.lit("@host"))), F.lit(" and http://"),
            F.repeat(F.lit("x."), F.lit(140)), F.lit("com/"), F.col("event_id"), F.lit(") end")))
        .when((kind == "purchase") & (F.col("user_id") % 30 == 6), F.concat(F.lit(MIXED), F.col("event_id")))
        .when((kind == "purchase") & (F.col("user_id") % 3 == 0),
              F.concat(F.lit("Order no. "), F.col("event_id"), F.lit(" of the token sale is filled")))
        .otherwise(F.lit(REPEATED))
    )
    rows = events.where(on_discord if platform == v.DISCORD else ~on_discord)
    return _select(rows, F.col("event_id"), F.col("ts"), F.concat(F.lit("feed_"), kind), platform, text)


def telegram_posts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``id, user_id, k, ts, channel_id, platform, kind, text``: documents and short posts."""
    events = load(spark, sf_dir, "events") if events is None else events
    documents = load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("event_id"), "source", F.col("text").alias("doc"))
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat("doc", F.lit(" see "), _link("source"),
                                         F.lit("). and www.foo.com,")))
        .when(kind == "purchase", F.concat("doc", F.lit(" 🎉🏽 soon▯ ")))
        .otherwise(F.col("doc"))
    )
    long = _select(events.join(documents, "event_id"), F.col("event_id"), F.col("ts"),
                   F.col("source"), v.TELEGRAM, text)
    return long.unionByName(_short_posts(events, v.TELEGRAM))


def discord_posts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The same columns: conversation turns, a minute apart, and short posts."""
    events = load(spark, sf_dir, "events") if events is None else events
    turns = load(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "event_id")
    chat = _select(
        events.join(turns, "event_id"), F.concat_ws(".", "event_id", "turn"),
        F.col("ts") + F.make_dt_interval(mins=F.col("turn").cast("int")),
        F.concat(F.lit("chat_"), "role"), v.DISCORD, F.col("text"),
    )
    return chat.unionByName(_short_posts(events, v.DISCORD))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return telegram_posts(spark, sf_dir, events).unionByName(discord_posts(spark, sf_dir, events))


def raw_discord(rows: DataFrame) -> DataFrame:
    """Discord posts in the landed shape."""
    url = F.concat(F.lit(" https://cdn.example.com/"), F.col("k"), F.lit(" "))
    return rows.select(
        "channel_id",
        "id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("text").alias("content"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"),
                 F.col("user_id").cast("string").alias("id")).alias("author"),
        F.array(F.struct(url.alias("url")), F.struct(F.lit(" ").alias("url"))).alias("embeds"),
    )


def raw_telegram(rows: DataFrame) -> DataFrame:
    """Telegram posts in the landed shape. Views are channel posts without a sender."""
    url = F.concat(F.lit(" https://t.example.com/"), F.col("k"))
    user = F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("user_id"))
    return rows.select(
        "channel_id",
        F.col("id").cast("bigint").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"),
        "text",
        F.col("text").alias("message"),
        F.when(F.col("kind") != "view", user).alias("from_id"),
        F.struct(F.col("user_id").alias("channel_id")).alias("peer_id"),
        F.array(F.struct(F.lit("text_url").alias("kind"), url.alias("url")),
                F.struct(F.lit("bold").alias("kind"), F.lit(None).cast("string").alias("url")))
        .alias("entities"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channels of the long posts and of the conversations; the short posts' channels are not
    registered."""
    sources = load(spark, sf_dir, "documents").select(
        F.col("source").alias("channel_id"), F.lit(v.TELEGRAM).alias("platform"))
    chats = load(spark, sf_dir, "conversations").select(
        F.concat(F.lit("chat_"), "role").alias("channel_id"), F.lit(v.DISCORD).alias("platform"))
    return sources.unionByName(chats).distinct()


def faulty_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per source and language: sources repeat, and two languages stand for a platform
    while the others name none."""
    lang = F.col("lang")
    return load(spark, sf_dir, "documents").select(
        F.col("source").alias("channel_id"),
        F.when(lang == "en", v.TELEGRAM).when(lang == "fr", v.DISCORD).otherwise(lang)
        .alias("platform"),
    ).distinct().select(
        F.ascii("platform").cast("bigint").alias("id"), "channel_id", "platform",
        F.concat(F.lit("@"), F.col("channel_id")).alias("channel_name"),
    )


def odd_discord(rows: DataFrame) -> DataFrame:
    """Landed Discord messages, some with a time that cannot be read or none."""
    user = F.col("author.id").cast("int") % 40
    return raw_discord(rows).withColumn(
        "timestamp", F.when(user == 1, "soon").when(user != 2, F.col("timestamp")))


def odd_telegram(rows: DataFrame) -> DataFrame:
    """Landed Telegram messages, some with an empty text or none."""
    user = F.col("peer_id.channel_id") % 40
    return raw_telegram(rows).withColumn("text", F.when(user == 3, "").when(user != 4, F.col("text")))


def land_with_faults(raw: DataFrame, user: Column, moment: Column, path: str) -> None:
    """Raw messages as dated folders of JSON lines, a fortieth of the lines cut short."""
    line = F.to_json(F.struct(*raw.columns))
    cut = F.when(user % 40 == 5, F.left(line, F.length(line) - 10)).otherwise(line)
    raw.select(cut.alias("value"), moment.cast("date").alias("landed")) \
        .write.partitionBy("landed").text(path)


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with all its columns; the numbers come from the names."""
    return registry(spark, sf_dir).select(
        F.xxhash64("platform", "channel_id").alias("id"), "channel_id", "platform",
        F.concat(F.lit("@"), F.col("channel_id")).alias("channel_name"))
