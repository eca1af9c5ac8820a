"""How often a run reads, computes and shuffles what it writes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from newsloom.functions import fixed as v
from newsloom.operators.dedup import dedup_latest
from newsloom.plans import registered
from newsloom.schemas import DIGEST, columns
from newsloom.sources import writers
from newsloom.streaming import incremental


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables of events, documents and conversations."""
    spark.range(20).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-30 10:00:00' + make_dt_interval(0, 0, id)").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.element_at(F.array(*map(F.lit, ("signup", "error", "click", "purchase"))),
                                                         (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        F.lit('{"k": 1}').alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(10).select(F.col("id").alias("doc_id"), F.concat(F.lit("text no. "), "id").alias("text"),
                           F.lit("src").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(5).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"),
                          F.lit("hello there").alias("text")).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_the_run_log_are_made_once(spark, tables, monkeypatch):
    seen, append = [], registered.append_run_log

    def spy(stats, *args):
        seen.append(plan(stats))
        append(stats, *args)

    monkeypatch.setattr(registered, "append_run_log", spy)
    rows = registered.run_log(spark, tables).collect()
    assert len(seen) == 3 and not any("Exchange" in p or "documents.parquet" in p for p in seen)
    assert {r["run_id"] for r in rows} == {"first", "second"}
    assert {(r["channel_id"], r["pulled"]) for r in rows if r["platform"] == v.TELEGRAM} >= {("src", 10)}


def test_documents_are_shuffled_once(spark, messages, tmp_path, monkeypatch):
    def kept(*args, **kwargs):
        raise AssertionError("the digest is written a second time")

    monkeypatch.setattr(writers, "with_row_index", kept)
    rows = messages(*[(str(i), f"text {i}", f"2024-01-01 00:00:{i:02d}", "c", v.TELEGRAM) for i in range(45)])
    digest = rows.select("*", F.lit("0.90").cast("decimal(3,2)").alias("score"), F.array(F.lit("news")).alias("tags"))
    writers.write_digest_documents(digest.select(*columns(DIGEST)), str(tmp_path / "d"), size=10)
    found = [json.loads((tmp_path / "d" / f).read_text()) for f in os.listdir(tmp_path / "d") if f.startswith("part")]
    assert max(map(len, found)) == 10 and sorted(int(r["id"]) for d in found for r in d) == list(range(45))
    for document in found:
        ids = [int(r["id"]) for r in document]
        assert ids == list(range(ids[0], ids[0] - len(ids), -1))
    writers.write_digest_documents(digest.where("false").select(*columns(DIGEST)), str(tmp_path / "none"))
    assert not sum((tmp_path / "none" / f).stat().st_size for f in os.listdir(tmp_path / "none") if f.startswith("part"))


def test_compaction_shuffles_texts_once(spark, messages, tmp_path, monkeypatch):
    table, seen = str(tmp_path / "table"), []

    def spy(df, **options):
        seen.append(dedup_latest(df, **options))
        return seen[-1]

    for batch in (0, 1):
        messages(*[(f"{batch}-{i}", f"text {i % 3}", f"2024-01-0{1 + i % 2} 00:00:{batch:02d}", "c", v.TELEGRAM) for i in range(12)]) \
            .withColumn("run_date", F.to_date("timestamp")).withColumn("batch_id", F.lit(batch)) \
            .write.mode("append").partitionBy("run_date", "batch_id").parquet(table)
    expected = sorted(r["text"] for r in incremental.current_messages(spark, table).collect())
    monkeypatch.setattr(incremental, "dedup_latest", spy)
    assert incremental.compact_days(spark, table, "2024-02-01") == ["2024-01-01", "2024-01-02"]
    assert plan(seen[0]).count("Exchange") == 1 and "rangepartitioning(run_date" in plan(seen[0])
    monkeypatch.undo()
    assert incremental.remove_superseded(spark, table, grace_seconds=0) == 4
    assert spark.read.parquet(table).count() == 6  # three texts in each of two days
    assert sorted(r["text"] for r in incremental.current_messages(spark, table).collect()) == expected
