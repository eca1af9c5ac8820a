import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions.rubric import topic_score, topic_tags, unknown_tags
from newsloom.operators import labelling as lb
from newsloom.schemas import DIGEST, LABEL_RESPONSES, LABELS, columns


@pytest.fixture
def batched(messages):
    rows = messages(*((str(i), f"t{i}", f"2024-01-0{9 - i}", "c", "telegram") for i in range(5)))
    return lb.assign_batches(rows, 2)


def test_batches_and_requests(batched):
    got = sorted((r.batch_id, r.pos, r.id) for r in batched.collect())
    assert got == [(0, 0, "0"), (0, 1, "1"), (1, 0, "2"), (1, 1, "3"), (2, 0, "4")]
    requests = {r.batch_id: r for r in lb.label_requests(batched).collect()}
    assert requests[2].n == 1
    assert json.loads(requests[0].request) == [
        {"id": "0", "text": "t0", "platform": "telegram", "links": []},
        {"id": "1", "text": "t1", "platform": "telegram", "links": []}]


GOOD = '[{"id": 1, "keep": "true"}, {"id": 2}]'


@pytest.mark.parametrize("body, accepted", [
    (GOOD, True), (f"\n {GOOD}\t", True), ('[{"id": 1}]', False), ('{"id": 1}', False),
    ("oops", False), (None, False), ("", False), (f"{GOOD} thanks", False), (f"{GOOD}]", False),
    (f"{GOOD},{GOOD}", False), (f"{GOOD}}} x", False), (f"{GOOD}] x [", False), ("[1,", False),
    (f'"{len(GOOD)}"', False), (f"```json {GOOD}```", False),
])
def test_reply_check(spark, body, accepted):
    responses = spark.createDataFrame([(7, 1, body)], LABEL_RESPONSES)
    batches = spark.createDataFrame([(7, 2)], "batch_id bigint, n int")
    assert lb.accepted_replies(responses, batches).count() == accepted


def test_first_good_attempt(spark):
    responses = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, GOOD), (1, 3, GOOD), (2, 1, "x"), (2, 2, "[]"), (2, 3, None), (2, 4, GOOD)],
        LABEL_RESPONSES)
    batches = spark.createDataFrame([(1, 2), (2, 2)], "batch_id bigint, n int")
    assert [(r.batch_id, r.attempt) for r in lb.accepted_replies(responses, batches).collect()] == [(1, 2)]


def test_replay_covers_every_item_once(spark, batched):
    def item(i, **more):
        return {"id": i, "platform": "telegram", "score": "0.9", "tags": ["news"], **more}
    responses = spark.createDataFrame([
        (0, 1, json.dumps([item(0, keep="true"), item("1", keep=True)])),
        (1, 1, "bad"), (1, 2, "{}"),
        (2, 1, json.dumps([item(4, keep="true", score=0.8, tags="x")])),
    ], LABEL_RESPONSES)
    labels = lb.replay_labels(batched, responses)
    rows = {r.id: r for r in labels.collect()}
    assert labels.count() == 5 and sorted(rows) == list("01234")
    assert (rows["0"].keep, rows["1"].keep) == ("true", None)
    assert (rows["2"].keep, rows["2"].score, rows["2"].tags) == ("false", "0.0", [])
    assert (rows["4"].score, rows["4"].tags) == (None, None)
    assert {r.channel_id for r in rows.values()} == {"c"}
    kept = {r.id: str(r.score) for r in lb.kept_labels(labels).collect()}
    assert kept == {"0": "0.90", "4": "None"}


def test_join_keeps_every_message(spark, messages):
    rows = messages(("1", "a", None, "c1", "telegram"), ("1", "b", None, "c2", "telegram"),
                    ("2", "c", None, "c1", "telegram"))
    labels = spark.sql("SELECT '1' AS id, 'telegram' AS platform, 'c1' AS channel_id, "
                       "CAST(0.9 AS DECIMAL(3,2)) AS score, array('news') AS tags")
    got = lb.join_labels(rows, labels)
    assert got.columns == columns(DIGEST)
    assert sorted((r.text, r.tags) for r in got.collect()) == [("a", ["news"]), ("b", None), ("c", None)]
    assert lb.join_labels(rows, labels.drop("channel_id"), keys=("id", "platform")).where(
        "tags is not null").count() == 2


def test_label_input(spark, messages):
    rows = messages(("1", "a", None, "c", "telegram"), ("2", None, None, "c", "telegram"))
    assert lb.label_input(rows).count() == 1
    bare = rows.select("id", "platform", "text", F.lit(None).cast("array<string>").alias("links"))
    assert lb.label_input(bare).first().links == []
    assert lb.label_input(bare.drop("links")).first().links == []
    with pytest.raises(ValueError, match="platform.*text"):
        lb.label_input(rows.select("id"))


def test_label_with(spark, messages):
    rows = messages(*((str(i), "bad" if i == 7 else f"t{i}", None, "c", "telegram")
                      for i in range(50))).repartition(2)

    def judge(items):
        if any(i["text"] == "bad" for i in items):
            raise RuntimeError("no answer")
        assert set(items[0]) == {"id", "text", "platform", "links"} and len(items) <= 10
        return json.dumps([{"id": int(i["id"]), "platform": i["platform"], "score": "0.8",
                            "keep": "true" if int(i["id"]) % 2 else True, "tags": ["news"]}
                           for i in items])

    got = lb.label_with(rows, judge, batch_size=10, concurrency=3).collect()
    assert all(int(r.id) % 2 and r.channel_id == "c" and str(r.score) == "0.80" for r in got)
    assert 15 <= len(got) < 25
    short = lb.label_with(rows, lambda items: items[:-1], batch_size=10)
    assert short.count() == 0


def test_second_attempt_counts(spark, messages):
    rows = messages(("1", "a", None, "c", "telegram")).coalesce(1)
    calls = []

    def flaky(items):
        calls.append(1)
        if len(calls) < 3:
            return [] if len(calls) == 1 else "not json"
        return [{"id": "1", "platform": "telegram", "keep": "true", "score": "x", "tags": None}]

    assert [(r.id, r.score, r.tags) for r in lb.label_with(rows, flaky).collect()] == [("1", None, None)]


def test_rubric(spark):
    df = spark.createDataFrame([
        ("New LISTING and a hacked bridge", []), ("Explained: gas fees, zk-proof", ["https://dao.io"]),
        ("nothing", []), ("daola", []), (None, []), ("Exploit! rug pulls? wallet safety", []),
    ], "t string, l array<string>")
    tags = topic_tags(F.col("t"), F.col("l"))
    got = [(r[0], str(r[1])) for r in df.select(tags, topic_score(tags)).collect()]
    assert got == [(["news", "product"], "0.80"), (["governance", "education"], "0.80"), ([], "0.00"),
                   ([], "0.00"), ([], "0.00"), (["scam", "security"], "0.80")]
    assert df.select(unknown_tags(F.array(F.lit("news"), F.lit("x")))).first()[0] == ["x"]


def test_unknown_tag_rows(spark):
    labels = spark.createDataFrame([("1", "telegram", "c", "true", "1", ["news", "fun"])], LABELS)
    assert [(r.id, r.tag) for r in lb.unknown_tag_rows(labels).collect()] == [("1", "fun")]


# --- odd replies: stored and live follow one rule -----------------------------------------------------

def _item(id_, keep="true", score="0.8", tags=("news",), platform="telegram"):
    return {"id": id_, "platform": platform, "keep": keep, "score": score, "tags": tags}


ODD_REPLIES = {
    "equal ids in two channels": [_item("5", score="0.7"), _item("5", score="0.9"), _item("7")],
    "other order": [_item("7"), _item("5"), _item("5")],
    "no objects": [5, None, "text"],
    "odd tags": [_item("5", tags=[1, None, True, "a"]), _item("5", tags="news"), _item("7", tags={"a": 1})],
    "repeated id": [_item("7", score="0.7"), _item("7", score="0.9"), _item("7", score="0.8")],
    "number as id": [_item(5), _item("5"), _item(7, score=0.9)],
    "unknown id": [_item("8"), _item("5"), _item(None)],
    "odd fields": [{"id": {}, "platform": []}, _item("5", keep=True), _item("7", score="high")],
}


@pytest.mark.parametrize("name", sorted(ODD_REPLIES))
def test_stored_and_live_replies_agree(spark, messages, name):
    reply = ODD_REPLIES[name]
    rows = messages(("5", "a", "2024-01-03", "A", "telegram"), ("5", "b", "2024-01-02", "B", "telegram"),
                    ("7", "c", "2024-01-01", "A", "telegram")).coalesce(1)
    batched = lb.assign_batches(rows, 3)
    stored = spark.createDataFrame([(0, 1, json.dumps(reply))], "batch_id long, attempt int, body string")
    replayed = lb.kept_labels(lb.replay_labels(batched, stored))
    live = lb.label_with(rows, lambda items: reply, batch_size=3)
    assert sorted(map(str, replayed.collect())) == sorted(map(str, live.collect()))
    assert lb.join_labels(rows, replayed).count() == 3
    lost = lb.unmatched_items(batched, stored).agg({"items": "sum"}).first()[0] or 0
    if name == "equal ids in two channels":
        assert {(r.channel_id, str(r.score)) for r in replayed.where("id = '5'").collect()} == {
            ("A", "0.70"), ("B", "0.90")}
        assert lost == 0
    if name == "no objects":
        assert replayed.count() == 0 and lost == 3
