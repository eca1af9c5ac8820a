"""Landed folders: pruning, rows that cannot be read, the stream's table and its compaction."""

import json
import os

import pytest
from pyspark.sql import functions as F

from newsloom.functions import fixed as v
from newsloom.operators.alerts import unreadable_alerts
from newsloom.plans import daily
from newsloom.schemas import COLLECTED, DIGEST, RAW_DISCORD, columns
from newsloom.sources import landing, writers
from newsloom.sources.archive import read_digest
from newsloom.sources.discord import read_discord
from newsloom.streaming import incremental


def message(i, time, text="hello there you"):
    return {"channel_id": "c", "id": str(i), "timestamp": time, "content": text,
            "author": {"username": "u", "id": "1"}, "embeds": []}


@pytest.fixture
def folder(tmp_path):
    """Three days of landed files with faults in two of them."""
    root = tmp_path / "discord"

    def write(day, *lines, name="a.json"):
        os.makedirs(root / f"landed={day}", exist_ok=True)
        (root / f"landed={day}" / name).write_text("\n".join(lines) + "\n")

    good = lambda i, t, **k: json.dumps(message(i, t, **k))
    write("2024-01-01", good(1, "2024-01-01T10:00:00Z"), good(2, "2024-01-01T11:00:00Z"))
    write("2024-01-02", good(3, "2024-01-02T10:00:00Z"), good(4, "2024-01-02T10:00:00Z")[:-9], "no json", "{}", "")
    write("2024-01-03", json.dumps([message(5, "2024-01-03T01:00:00Z"), message(6, "2024-01-02T23:30:00Z")]),
          json.dumps(message(7, "2024-01-03T02:00:00Z") | {"embeds": "none"}), '["x"]')
    write("2024-01-03", good(8, "2024-01-01T01:00:00Z"), name="b.json")
    return str(root)


def test_only_readable_rows_are_taken(spark, folder):
    rows = read_discord(spark, folder)
    assert rows.columns == columns(RAW_DISCORD)
    assert sorted(r["id"] for r in rows.collect() if r["id"]) == ["1", "2", "3", "5", "6", "8"]


def test_account_per_file(spark, folder):
    found = landing.landing_account(landing.read_landed(spark, folder, RAW_DISCORD)).collect()
    got = {(str(r["landed"]), r["file"].rsplit("/", 1)[1]): (r["n_rows"], r["n_unreadable"], r["n_empty"]) for r in found}
    assert got == {("2024-01-01", "a.json"): (2, 0, 0), ("2024-01-02", "a.json"): (4, 2, 1),
                   ("2024-01-03", "a.json"): (4, 2, 0), ("2024-01-03", "b.json"): (1, 0, 0)}
    account = landing.landing_account(landing.read_landed(spark, folder, RAW_DISCORD))
    texts = sorted(r["message"] for r in unreadable_alerts(account, v.DISCORD).collect())
    assert len(texts) == 2 and all(": 2 of 4 rows cannot be read." in t for t in texts)


@pytest.mark.parametrize("margin, ids", [(1, ["3", "5", "6", "8"]), (0, ["5", "6", "8"]), (5, ["1", "2", "3", "5", "6", "8"])])
def test_folders_of_earlier_days_are_left_out(spark, folder, margin, ids):
    rows = landing.readable(landing.read_landed(spark, folder, RAW_DISCORD, "2024-01-04 00:00:00", margin_days=margin))
    assert sorted(r["id"] for r in rows.collect() if r["id"]) == ids
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(landed" in plan and "landed" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len(rows.inputFiles()) == 4  # what is there; what is read:
    read = landing.read_landed(spark, folder, RAW_DISCORD, "2024-01-04 00:00:00", margin_days=margin)
    assert read.select("_file").distinct().count() == {0: 2, 1: 3, 5: 4}[margin]


def test_files_outside_dated_folders(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(message(1, "2024-01-01T10:00:00Z")))
    assert read_discord(spark, str(tmp_path), "2030-01-01 00:00:00").count() == 1


def test_empty_landing_and_round_trip(spark, tmp_path, folder):
    rows = read_discord(spark, folder).where("id IS NOT NULL")
    landing.write_landed(rows, str(tmp_path / "copy"), F.col("timestamp").try_cast("timestamp"))
    again = read_discord(spark, str(tmp_path / "copy"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_run_over_landed_files(spark, folder, tmp_path):
    telegram = tmp_path / "telegram"
    telegram.mkdir()
    (telegram / "a.json").write_text("broken\n")
    sources = spark.createDataFrame([(1, "c", v.DISCORD, "x"), (2, "d", v.TELEGRAM, "y")],
                                    "id long, channel_id string, platform string, channel_name string")
    for _ in range(2):
        result = daily.run_landed(spark, {v.DISCORD: folder, v.TELEGRAM: str(telegram)}, sources,
                                  "2024-01-04 00:00:00", "2024-01-04", str(tmp_path / "out"))
        assert (result.combined, result.unreadable) == (1, 5)
        kinds = sorted((r["kind"], r["platform"]) for r in result.alerts.collect())
        assert kinds == [("unreadable_rows", "discord")] * 2 + [("unreadable_rows", "telegram")]
    stored = spark.read.schema(DIGEST).parquet(str(tmp_path / "out" / "digest"))
    assert [r["id"] for r in stored.collect()] == ["5"]
    quiet = daily.run_landed(spark, {v.DISCORD: folder, v.TELEGRAM: str(telegram)}, sources,
                             "2025-01-04 00:00:00", "2025-01-04", str(tmp_path / "quiet"))
    assert sorted(r["kind"] for r in quiet.alerts.collect()) == ["no_messages", "nothing_to_label", "unreadable_rows"]


def test_documents_with_nan_are_read_back(spark, messages, tmp_path):
    rows = messages(*[(str(i), f"text {i} }}\n \"q\" NaN", f"2024-01-01 00:00:{i:02d}", "c", v.TELEGRAM) for i in range(25)])
    labelled = rows.withColumn("score", F.when(F.col("id") < "2", F.lit("0.8").cast("decimal(3,2)"))) \
        .withColumn("tags", F.when(F.col("id") < "2", F.array(F.lit("news")))).select(*columns(DIGEST))
    writers.write_digest_documents(labelled, str(tmp_path / "d"), size=10)
    files = [f for f in os.listdir(tmp_path / "d") if f.startswith("part")]
    texts = [(tmp_path / "d" / f).read_text() for f in files]
    assert len(files) == 3 and sum(t.count('"score":NaN') for t in texts) == labelled.where("score IS NULL").count()
    assert all(isinstance(json.loads(t), list) for t in texts)
    assert sorted(map(str, read_digest(spark, str(tmp_path / "d")).collect())) == sorted(map(str, labelled.collect()))


# --- the stream's table ----------------------------------------------------------------------------

def collected(spark, *rows):
    df = spark.createDataFrame(list(rows), "id string, text string, t string")
    return df.select("id", "text", F.col("t").cast("timestamp").alias("timestamp"), F.lit("a").alias("author"),
                     F.lit("c").alias("channel_id"), F.lit(v.TELEGRAM).alias("platform"),
                     F.array().cast("array<string>").alias("links"), F.lit(False).alias("low_value")).select(*columns(COLLECTED))


@pytest.fixture
def streamed(spark, tmp_path):
    """A function that lands rows as one file and lets the stream take it up."""
    source, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    os.makedirs(source)

    def run(*batches):
        for rows in batches:
            collected(spark, *rows).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(COLLECTED).option("maxFilesPerTrigger", 1).parquet(source)
            incremental.incremental_digest(stream, table, state).awaitTermination()
        return table
    return run


def ids(df):
    return sorted(r["id"] for r in df.collect())


BATCHES = (
    [("1", "a", "2024-01-01 10:00:00"), ("2", "b", "2024-01-01 11:00:00"), ("3", "c", "2024-01-02 01:00:00")],
    [("4", "a", "2024-01-01 12:00:00"), ("5", "c", "2024-01-02 00:30:00"), ("6", "b", None)],
    [("7", "d", "2024-01-01 13:00:00"), ("8", "a", "2024-01-02 05:00:00")],
)


def test_compaction_changes_nothing_for_readers(spark, streamed, tmp_path):
    table = streamed(*BATCHES)
    whole, day = ids(incremental.current_messages(spark, table)), ids(incremental.current_messages(spark, table, "2024-01-02 12:00:00"))
    assert whole == ["3", "6", "7", "8"] and day == ["3", "7", "8"]  # a null time counts as latest, but is in no window
    begun = incremental.current_messages(spark, table)
    assert incremental.compact_days(spark, table, "2024-01-02") == ["2024-01-01"]
    assert incremental.compact_days(spark, table, "2024-01-02") == []
    assert sorted(os.listdir(f"{table}/run_date=2024-01-01")) == [f"batch_id={n}" for n in (-3, 0, 1, 2)]
    assert not [f for f in os.listdir(table) if f.startswith("_compact")]
    assert ids(incremental.current_messages(spark, table)) == whole and ids(begun) == whole
    assert incremental.remove_superseded(spark, table) == 0  # readers may still be there
    assert incremental.remove_superseded(spark, table, 0) == 3
    assert os.listdir(f"{table}/run_date=2024-01-01") == ["batch_id=-3"]
    assert ids(incremental.current_messages(spark, table)) == whole
    assert ids(incremental.current_messages(spark, table, "2024-01-02 12:00:00")) == day


def test_late_and_repeated_batches_beside_a_merged_day(spark, streamed):
    table = streamed(*BATCHES)
    incremental.compact_days(spark, table, "2024-01-03")
    before = ids(incremental.current_messages(spark, table))
    again = collected(spark, *BATCHES[0]).drop("low_value").withColumn("run_date", F.to_date("timestamp"))
    again.withColumn("batch_id", F.lit(0).cast("long")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "batch_id").parquet(table)
    assert ids(incremental.current_messages(spark, table)) == before
    streamed([("9", "d", "2024-01-01 23:00:00")])
    assert ids(incremental.current_messages(spark, table)) == ["3", "6", "8", "9"]
    assert incremental.compact_days(spark, table, "2024-01-02") == ["2024-01-01"]
    assert ids(incremental.current_messages(spark, table)) == ["3", "6", "8", "9"]
    incremental.remove_superseded(spark, table, 0)
    assert os.listdir(f"{table}/run_date=2024-01-01") == ["batch_id=-4"]
    assert ids(incremental.current_messages(spark, table)) == ["3", "6", "8", "9"]


def test_latest_of_an_earlier_batch_stays_in_the_window(spark, streamed):
    table = streamed([("1", "a", "2024-01-02 10:00:00"), ("2", "a", None)], [("3", "a", "2024-01-01 10:00:00")])
    assert ids(incremental.current_messages(spark, table, "2024-01-03 00:00:00")) == ["1"]
    assert ids(incremental.current_messages(spark, table, "2024-03-03 00:00:00")) == []


def test_table_that_is_not_there(spark, tmp_path):
    assert incremental.current_messages(spark, str(tmp_path / "none")).collect() == []
    assert incremental.compact_days(spark, str(tmp_path / "none"), "2024-01-01") == []
