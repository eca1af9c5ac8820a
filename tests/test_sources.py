import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators.filters import drop_low_value, kept, lookback, non_empty
from newsloom.schemas import COLLECTED, DIGEST, MESSAGES, columns
from newsloom.sources.archive import read_digest
from newsloom.sources.discord import normalize_discord, read_discord
from newsloom.sources.registry import (
    channels_for, check_sources, read_sources, registered_only,
)
from newsloom.sources.telegram import normalize_telegram, read_telegram
from newsloom.sources.writers import (
    append_run_log, records_json, write_digest, write_digest_array,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_registry_reading(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'id,channel_id,platform,channel_name\n20,one,telegram,@One\n'
                                     '21,two,discord,"@Två, x"\n')
    rows = read_sources(spark, path)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [
        (20, "one", "telegram", "@One"), (21, "two", "discord", "@Två, x")]
    assert [r[0] for r in channels_for(rows, "discord").collect()] == ["two"]
    assert check_sources(rows).count() == 0
    bad = write(tmp_path / "bad.csv", "id,channel_id,platform,channel_name\nx,one,telegram,@One\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_sources(spark, bad).collect()


def test_registry_check(spark):
    rows = spark.createDataFrame([
        (1, "a", "telegram", "A"), (1, "b", "discord", None), (2, "b", "irc", "B"),
        (None, None, None, "C"),
    ], "id bigint, channel_id string, platform string, channel_name string")
    assert sorted(map(str, (tuple(r) for r in check_sources(rows).collect()))) == sorted(map(str, [
        ("id repeated", "1", 2), ("channel_id repeated", "b", 2), ("id missing", None, 1),
        ("channel_id missing", None, 1), ("platform missing", None, 1),
        ("channel_name missing", None, 1), ("platform unknown", "irc", 1)]))


def discord_message(**more):
    return {"channel_id": "d1", "id": "5", "timestamp": "2024-01-02T10:00:00.123000+00:00",
            "content": "Hello 🚀 world https://x.io/a", "author": {"username": "alice", "id": "7"},
            "embeds": [{"url": " https://e.io/1 "}, {"title": "t"}], **more}


def test_discord(spark, tmp_path):
    page = [discord_message(), discord_message(id="6", timestamp="2024-01-02T12:00:00+02:00", content=None),
            discord_message(id="7", timestamp="soon"), discord_message(id="8", timestamp=None)]
    single = discord_message(id="9", content="gm 🚀", embeds=[], timestamp="2024-01-02T10:00:00Z")
    path = write(tmp_path / "d.json", json.dumps(page) + "\n" + json.dumps(single) + "\n")
    rows = {r.id: r for r in normalize_discord(read_discord(spark, path)).collect()}
    assert sorted(rows) == ["5", "6", "9"]
    first = rows["5"]
    assert first.asDict() == {
        "id": "5", "text": "Hello world", "timestamp": datetime(2024, 1, 2, 10, 0, 0, 123000),
        "author": "alice#7", "channel_id": "d1", "platform": "discord",
        "links": ["https://e.io/1"], "low_value": False}
    assert rows["6"].timestamp == datetime(2024, 1, 2, 10) and rows["6"].low_value
    assert rows["9"].low_value and rows["9"].links == []


def telegram_message(**more):
    return {"channel_id": "t1", "id": 5, "date": "2024-01-02T10:00:00", "text": "**Hi** x",
            "message": "Read www.foo.com, now", "from_id": {"kind": "user", "user_id": 42},
            "peer_id": {"channel_id": 9},
            "entities": [{"kind": "text_url", "url": " https://e.io "}], **more}


def test_telegram(spark, tmp_path):
    lines = [
        telegram_message(), telegram_message(id=6, from_id=None, entities=None),
        telegram_message(id=7, from_id={"kind": "channel"}, peer_id=None),
        telegram_message(id=8, text=""), telegram_message(id=9, text=None),
        telegram_message(id=10, message="Good morning"), telegram_message(id=11, date="2024-01-02T12:00:00+02:00"),
    ]
    path = write(tmp_path / "t.json", "\n".join(map(json.dumps, lines)))
    df = normalize_telegram(read_telegram(spark, path))
    assert df.columns == columns(COLLECTED) and kept(df).columns == columns(MESSAGES)
    rows = {r.id: r for r in df.collect()}
    assert sorted(rows) == ["10", "11", "5", "6", "7"]
    assert rows["5"].text == "Read , now" and rows["5"].author == "42"
    assert rows["5"].links == ["https://e.io", "https://www.foo.com"]
    assert rows["6"].author == "admin#9" and rows["6"].links == ["https://www.foo.com"]
    assert rows["7"].author is None and rows["10"].low_value
    assert rows["11"].timestamp == datetime(2024, 1, 2, 10)


def test_lookback_bounds(spark, messages):
    rows = messages(("1", "a", "2024-01-01 12:00:00", "c", "telegram"),
                    ("2", "b", "2024-01-01 11:59:59.999999", "c", "telegram"),
                    ("3", "c", None, "c", "telegram"))
    assert [r.id for r in lookback(rows, "2024-01-02 12:00:00").collect()] == ["1"]
    assert lookback(rows, datetime(2024, 1, 2, 12), hours=25).count() == 2


def test_small_filters(spark, messages):
    rows = messages(("1", "", None, "c", "telegram"), ("2", None, None, "c", "telegram"),
                    ("3", "gm", None, "x", "telegram"), ("4", "news", None, "c", "telegram"))
    assert [r.id for r in non_empty(rows).collect()] == ["3", "4"]
    assert [r.id for r in drop_low_value(rows).collect()] == ["4"]
    sources = spark.createDataFrame([("x", "telegram"), ("c", "discord")], "channel_id string, platform string")
    assert [r.id for r in registered_only(rows, sources, "telegram").collect()] == ["3"]


@pytest.fixture
def digest(messages):
    def make(*rows):
        return messages(*rows).select(
            "*", F.lit("0.90").cast("decimal(3,2)").alias("score"), F.array(F.lit("news")).alias("tags"))
    return make


def test_rerun_replaces_its_day_only(spark, digest, tmp_path):
    path = str(tmp_path / "out")
    write_digest(digest(("1", "a", None, "c", "telegram")), path, "2024-01-01")
    write_digest(digest(("2", "b", None, "c", "telegram")), path, "2024-01-02")
    write_digest(digest(("3", "c", None, "c", "telegram")), path, "2024-01-02")
    got = spark.read.parquet(path)
    assert sorted((str(r.run_date), r.id) for r in got.collect()) == [("2024-01-01", "1"), ("2024-01-02", "3")]
    write_digest(digest(("9", "é", None, "c", "telegram")), str(tmp_path / "json"), "2024-01-02", "json")
    assert [r.text for r in spark.read.json(str(tmp_path / "json")).collect()] == ["é"]


def test_run_log_appends(spark, tmp_path):
    stats = spark.sql("SELECT 'c' AS channel_id, 'discord' AS platform, 2L AS pulled, 1L AS kept, "
                      "CAST(NULL AS BOOLEAN) AS success, CAST(NULL AS STRING) AS error")
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        append_run_log(stats, str(tmp_path / "log"), day)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3


def test_json_array_export(spark, digest, tmp_path):
    rows = [(str(i), f"té \"{i}\"\n", f"2024-01-0{1 + i}", "c", "telegram") for i in range(5)]
    df = digest(*rows).withColumn("author", F.lit(None).cast("string")).repartition(4)
    whole = "\n".join(r.line for r in records_json(df).orderBy("seq").collect())
    parsed = json.loads(whole)
    assert [p["id"] for p in parsed] == list("43210")
    assert list(parsed[0]) == columns(DIGEST) and parsed[0]["author"] is None
    assert "té" in whole and '\n  "id"' in whole
    assert parsed[0]["timestamp"] == "2024-01-05 00:00:00+00:00"
    write_digest_array(df, str(tmp_path / "array"))
    parts = sorted((tmp_path / "array").glob("part-*"))
    assert json.loads("".join(p.read_text(encoding="utf-8") for p in parts)) == parsed
    empty = records_json(df.where("false")).orderBy("seq").collect()
    assert json.loads("".join(r.line for r in empty)) == []


def test_archive(spark, tmp_path):
    records = [
        {"id": 101, "text": "a", "timestamp": "2024-01-02 10:00:00+00:00", "author": "admin#1",
         "channel_id": "c", "platform": "telegram", "links": ["https://a.io/xyz"], "score": "0.9",
         "tags": ["news"]},
        {"id": "102", "text": "b", "timestamp": "2024-01-02 09:00:00+00:00", "author": 7,
         "channel_id": "c", "platform": "telegram", "links": [], "score": float("nan"),
         "tags": float("nan")},
    ]
    path = write(tmp_path / "old.json", json.dumps(records, indent=2))
    df = read_digest(spark, path)
    assert df.columns == columns(DIGEST)
    a, b = df.orderBy("id").collect()
    assert (a.id, str(a.score), a.tags, a.timestamp) == ("101", "0.90", ["news"], datetime(2024, 1, 2, 10))
    assert (b.author, b.score, b.tags, b.links) == ("7", None, None, [])
