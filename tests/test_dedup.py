import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsloom.operators.dedup import dedup_channel, dedup_latest, union_channels
from newsloom.operators.ordering import final_order, with_row_index


def ids(df):
    return sorted(r.id for r in df.collect())


def test_latest_wins_and_unknown_time_is_latest(messages):
    df = messages(("1", "a", "2024-01-02", "c", "telegram"), ("2", "a", None, "c", "telegram"),
                  ("3", "a", "2024-01-03", "c", "telegram"), ("4", "b", "2024-01-01", "c", "telegram"))
    assert ids(dedup_latest(df)) == ["2", "4"]
    assert [r.id for r in final_order(dedup_latest(df)).collect()] == ["4", "2"]


def test_ties_empty_and_channels(messages):
    t = "2024-01-02"
    df = messages(("9", "x", t, "c1", "telegram"), ("1", "x", t, "c1", "telegram"),
                  ("5", "x", t, "c0", "telegram"), ("7", "x", t, "c9", "discord"),
                  ("8", "", t, "c1", "telegram"), ("6", "", "2024-01-03", "c2", "telegram"),
                  ("4", None, t, "c1", "telegram"), ("3", None, t, "c2", "telegram"))
    assert ids(dedup_latest(df)) == ["4", "6", "7"]
    assert ids(dedup_channel(df)) == ["1", "3", "4", "5", "6", "7", "8"]
    apart = df.withColumn("links", F.array("channel_id"))
    assert ids(dedup_latest(apart, keep_empty=True)) == ["4", "6", "7", "8"]


def test_properties(spark, messages):
    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(["", "a", "b", "c", None]),
                              st.sampled_from([None, "2024-01-01", "2024-01-02"]),
                              st.sampled_from(["c1", "c2"]), st.sampled_from(["discord", "telegram"])),
                    min_size=2, max_size=25))
    def check(rows):
        full = [(str(i), *r) for i, r in enumerate(rows)]
        best = {}
        for i, text, t, channel, platform in full:
            rank = (0 if t is None else 1, [-ord(c) for c in t or ""], platform, channel, i)
            best[text] = min(best.get(text, (rank, i)), (rank, i))
        want = sorted(i for _, i in best.values())
        df = messages(*full)
        once = dedup_latest(df)
        assert ids(once) == want
        assert ids(dedup_latest(once)) == want
        random.Random(1).shuffle(full)
        half = len(full) // 2
        parts = [dedup_latest(messages(*p)) for p in (full[:half], full[half:]) if p]
        assert ids(dedup_latest(union_channels(*parts))) == want
    check()


def test_hot_text_is_cut_before_the_shuffle(spark, messages):
    df = messages(("1", "a", "2024-01-02", "c", "telegram"))
    plan = dedup_latest(df)._jdf.queryExecution().executedPlan().toString()
    final, exchange = plan.index("Final"), plan.index("Exchange hashpartitioning")
    assert final < exchange < plan.index("Partial")


def test_row_index_is_exact_with_one_time_for_most_rows(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("id"), F.lit("t").alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).cast("timestamp").alias("timestamp"),
        F.lit("c").alias("channel_id"), F.lit("telegram").alias("platform")).repartition(13)
    got = {r.row_index: (r.timestamp, r.id) for r in with_row_index(df).collect()}
    assert sorted(got) == list(range(5000))
    rows = sorted(((t is None, i) for t, i in ((r.timestamp, r.id) for r in df.collect())))
    assert [(t is None, i) for t, i in (got[n] for n in range(5000))] == rows


def test_row_index_of_nothing(messages, spark):
    df = messages(("1", "a", None, "c", "telegram")).where("false")
    assert with_row_index(df).count() == 0
