import json

from pyspark.sql import functions as F

from newsloom.functions import fixed as v
from newsloom.operators.alerts import run_alerts
from newsloom.operators.dedup import dedup_latest
from newsloom.operators.labelling import join_labels
from newsloom.operators.stats import channel_stats, observe_count, run_totals, with_failures
from newsloom.plans.daily import collect_messages, daily_digest, function_labeller, run_daily
from newsloom.schemas import DIGEST, LOAD_ERRORS, RAW_DISCORD, RAW_TELEGRAM, columns
from newsloom.streaming.incremental import current_messages, incremental_digest, stream_landed
from tests.test_sources import discord_message, telegram_message

TEXTS = ["gm", "a", "a", "b", "c"]


def raw(spark, schema, rows):
    path = spark.sparkContext.parallelize(list(map(json.dumps, rows)), 2)
    return spark.read.schema(schema).json(path)


def sample(spark):
    discord = [discord_message(id=f"d{i}", content=t, timestamp=f"2024-01-02T10:00:0{i}Z")
               for i, t in enumerate(TEXTS)]
    telegram = [telegram_message(id=i, text=t, message=t, date=f"2024-01-02T11:00:0{i}")
                for i, t in enumerate(TEXTS)]
    old = telegram_message(id=99, text="old", message="old", date="2023-12-31T00:00:00")
    return raw(spark, RAW_DISCORD, discord), raw(spark, RAW_TELEGRAM, [*telegram, old])


def registry(spark):
    return spark.createDataFrame([(1, "d1", "discord", "D"), (2, "t1", "telegram", "T"),
                                  (3, "quiet", "telegram", "Q"), (4, "gone", "discord", "G")],
                                 "id bigint, channel_id string, platform string, channel_name string")


def errors(spark):
    return spark.createDataFrame([
        ("gone", "discord", 404, "x"), ("d1", "discord", 500, "b" * 300),
        ("t9", "telegram", None, "boom")], LOAD_ERRORS)


def test_counts(spark):
    collected = collect_messages(*sample(spark), registry(spark), as_of="2024-01-02 12:00:00")
    stats = channel_stats(collected, registry(spark))
    got = {r.channel_id: (r.pulled, r.kept, r.in_window, r.distinct_text) for r in stats.collect()}
    assert got == {"d1": (5, 4, 5, 3), "t1": (4, 3, 5, 3), "quiet": (0, 0, 0, 0), "gone": (0, 0, 0, 0)}
    totals = {(r.platform, r.channel_id): (r.pulled, r.kept) for r in run_totals(stats).collect()}
    assert totals[(None, None)] == (9, 7) and totals[("discord", None)] == (5, 4)
    rows = {r.channel_id: r for r in with_failures(stats, errors(spark)).collect()}
    assert rows["gone"].success is False and rows["gone"].error == v.ALERT_HTTP_STATUS[404]
    assert rows["d1"].success is None and rows["d1"].pulled == 5
    assert (rows["t9"].pulled, rows["t9"].error) == (0, "boom")


def test_digest_of_a_run(spark):
    got = daily_digest(*sample(spark), registry(spark), "2024-01-02 12:00:00")
    assert got.columns == columns(DIGEST)
    assert sorted((r.text, r.id, r.platform) for r in got.collect()) == [
        ("a", "2", "telegram"), ("b", "3", "telegram"), ("c", "4", "telegram")]
    empty = daily_digest(*sample(spark), registry(spark), "2030-01-02 12:00:00")
    assert empty.columns == columns(DIGEST) and empty.count() == 0


def test_digest_by_function(spark):
    def judge(items):
        return [{"id": i["id"], "platform": i["platform"], "score": "0.8", "tags": ["news"],
                 "keep": "true" if i["text"] == "b" else "false"} for i in items]

    got = daily_digest(*sample(spark), None, "2024-01-02 12:00:00", function_labeller(judge, 2))
    assert sorted((r.text, r.tags) for r in got.collect()) == [("a", None), ("b", ["news"]), ("c", None)]


def test_run_writes_everything(spark, tmp_path):
    out = str(tmp_path / "run")

    def labels(messages):
        return messages.where("text = 'a'").select(
            "id", "platform", "channel_id", F.lit(0.9).cast("decimal(3,2)").alias("score"),
            F.array(F.lit("news")).alias("tags"))

    for _ in range(2):
        result = run_daily(*sample(spark), registry(spark), "2024-01-02 12:00:00", "2024-01-02", out,
                           lambda m: join_labels(m, labels(m)), errors(spark), json_array=True)
    got = spark.read.parquet(f"{out}/digest")
    assert sorted((r.text, r.tags) for r in got.collect()) == [("a", ["news"]), ("b", None), ("c", None)]
    assert spark.read.parquet(f"{out}/run_log").where("channel_id = 't1'").first().kept == 3
    assert result.combined == 3
    totals = {(r.platform, r.channel_id): (r.pulled, r.kept) for r in result.totals.collect()}
    assert totals[(None, None)] == (9, 7)
    parts = sorted((tmp_path / "run" / "array" / "2024-01-02").glob("part-*"))
    array = json.loads("".join(p.read_text(encoding="utf-8") for p in parts))
    assert [r["text"] for r in array] == ["c", "b", "a"] and array[2]["tags"] == ["news"]
    assert sorted(r.kind for r in result.alerts.collect()) == ["http_status", "http_status", "source_error", "source_error"]


def test_empty_run(spark, tmp_path):
    out = str(tmp_path / "run")
    result = run_daily(*sample(spark), registry(spark), "2030-01-02", "2030-01-02", out, json_array=True)
    assert result.combined == 0
    assert sorted(r.kind for r in result.alerts.collect()) == ["no_messages", "nothing_to_label"]
    parts = sorted((tmp_path / "run" / "array" / "2030-01-02").glob("part-*"))
    assert json.loads("".join(p.read_text(encoding="utf-8") for p in parts)) == []


def test_alert_texts(spark, messages):
    none = messages(("1", "a", None, "c", "telegram")).where("false")
    rows = {(r.kind, r.channel_id): r.message for r in run_alerts(errors(spark), none, none).collect()}
    head = "🚨 *ERROR NOTIFICATION*\n\n"
    assert rows == {
        ("http_status", "gone"): head + "❌ Channel ID not found.",
        ("http_status", "d1"): head + "⚠️ HTTP 500: " + "b" * 200,
        ("source_error", "gone"): head + "❌ Discord gone error: ❌ Channel ID not found.",
        ("source_error", "t9"): head + "❌ Telegram t9 error: boom",
        ("no_messages", None): head + "⚠️ No messages collected from any source.",
        ("nothing_to_label", None): head + "❌ No valid messages to classify.",
    }


def test_count_in_passing(spark, messages, tmp_path):
    seen_df, seen = observe_count(messages(*((str(i), "t", None, "c", "telegram") for i in range(7))))
    seen_df.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"rows": 7}


def test_stream_equals_batch(spark, tmp_path):
    landed, table, state = tmp_path / "landed", str(tmp_path / "table"), str(tmp_path / "state")
    landed.mkdir()

    def land(name, rows):
        (landed / name).write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")

    def run():
        source = stream_landed(spark, v.TELEGRAM, str(landed), max_files=1)
        incremental_digest(source, table, state).awaitTermination()

    def post(i, text, day):
        return telegram_message(id=i, text=text, message=text, date=f"2024-01-0{day}T10:00:00")

    land("a.json", [post(1, "x", 1), post(2, "x", 2), post(3, "gm", 2)])
    land("b.json", [post(4, "y", 2), post(5, "x", 1)])
    run()
    land("c.json", [post(6, "y", 3), post(7, "z", 1)])
    run()
    run()
    schema = spark.read.schema(RAW_TELEGRAM).json(str(landed))
    from newsloom.operators.filters import kept
    batch = dedup_latest(kept(collect_messages(raw(spark, RAW_DISCORD, []), schema)))
    got = current_messages(spark, table)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(*got.columns).collect()))
    assert sorted(r.id for r in got.collect()) == ["2", "6", "7"]
    recent = current_messages(spark, table, as_of="2024-01-03 10:00:00")
    assert sorted(r.id for r in recent.collect()) == ["2", "6"]


def test_repeated_batch_leaves_nothing_twice(spark, messages, tmp_path):
    """The stream's progress is lost after a batch was written: it runs again and replaces itself."""
    landed, table = tmp_path / "landed", str(tmp_path / "table")
    landed.mkdir()
    (landed / "a.json").write_text(json.dumps(telegram_message(message="x", text="x")))
    for state in ("state1", "state2"):
        source = stream_landed(spark, v.TELEGRAM, str(landed))
        incremental_digest(source, table, str(tmp_path / state)).awaitTermination()
    assert spark.read.parquet(table).count() == 1
    assert current_messages(spark, table).count() == 1
