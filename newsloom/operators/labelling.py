"""Everything around the labelling call, and the call itself as a plug-in function."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import fixed as v
from ..functions.links import links_or_empty, no_links
from ..functions.replies import (
    encode_items, list_field, reply_length, strict_text_field, text_field, trimmed,
)
from ..functions.rubric import keep_rule, topic_score, topic_tags
from ..schemas import LABEL_ITEMS, LABELS, columns
from .ordering import newest_first, with_row_index

LABEL_KEYS = ("id", "platform", "channel_id")
_SCORE = "decimal(3,2)"


# --- preparing ------------------------------------------------------------------------------------

def require_columns(df: DataFrame, names: Iterable[str] = ("id", "platform", "text")) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def label_input(messages: DataFrame) -> DataFrame:
    """What is sent for labelling: rows with a text, links never null, only the columns needed.

    ``channel_id`` comes along because message ids are unique only within a channel.
    """
    require_columns(messages)
    links = links_or_empty(F.col("links")) if "links" in messages.columns else no_links()
    channel = F.col("channel_id") if "channel_id" in messages.columns else F.lit(None)
    return messages.dropna(subset=["text"]).select(
        F.col("id").cast("string").alias("id"),
        F.col("text").cast("string").alias("text"),
        "platform",
        channel.cast("string").alias("channel_id"),
        links.alias("links"),
    ).select(*columns(LABEL_ITEMS))


# --- batches --------------------------------------------------------------------------------------

def assign_batches(df: DataFrame, size: int = v.DEFAULT_BATCH_SIZE, order=newest_first) -> DataFrame:
    """Consecutive slices of ``size`` rows in the given order: adds ``batch_id`` and ``pos``."""
    index = F.col("_index")
    return (
        with_row_index(df, order, "_index", tag="batches")
        .withColumn("batch_id", F.floor(index / size).cast("bigint"))
        .withColumn("pos", (index % size).cast("int"))
        .drop("_index")
    )


def label_requests(batched: DataFrame) -> DataFrame:
    """One JSON request per batch: ``batch_id, n, request``. A group holds at most one batch."""
    item = F.struct("id", "text", "platform", "links")
    rows = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    return batched.groupBy("batch_id").agg(
        F.count("*").cast("int").alias("n"),
        encode_items(F.transform(rows, lambda r: r["item"])).alias("request"),
    )


# --- replies --------------------------------------------------------------------------------------

def accepted_replies(responses: DataFrame, batches: DataFrame,
                     max_attempts: int = v.MAX_ATTEMPTS) -> DataFrame:
    """The first good attempt per batch: ``batch_id, attempt, body``.

    Good is a JSON list, and nothing after it, with as many items as the batch has.
    """
    sizes = batches.select("batch_id", "n")
    good = (
        responses.where(F.col("attempt") <= max_attempts)
        .withColumn("_items", reply_length(F.col("body")))
        .where(F.col("_items").isNotNull())
        .join(sizes, "batch_id")
        .where(F.col("_items") == F.col("n"))
    )
    first = W.partitionBy("batch_id").orderBy("attempt")
    return (
        good.withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
        .select("batch_id", "attempt", "body")
    )


_ANSWER = ("id", "platform", "keep", "score", "tags")


def parsed_reply(body: Column) -> Column:
    """The items of a reply as an array of ``id, platform, keep, score, tags``. ``keep`` and ``score``
    are read only where they are JSON strings; an item that is no object has nulls throughout."""
    items = F.try_variant_get(F.try_parse_json(trimmed(body)), "$", "array<variant>")
    return F.transform(items, lambda item: F.struct(
        text_field(item, "id").alias("id"), text_field(item, "platform").alias("platform"),
        strict_text_field(item, "keep").alias("keep"), strict_text_field(item, "score").alias("score"),
        list_field(item, "tags").alias("tags")))


def matched_replies(batched: DataFrame, responses: DataFrame,
                    max_attempts: int = v.MAX_ATTEMPTS) -> DataFrame:
    """Every item of every batch's answer: ``batch_id, target, by_position`` and the label.

    The answer is the first good reply or, without one, a refusal of each item. An item labels the
    message at its own place in the batch if id and platform agree with it; else the only message of
    the batch with that id and platform; else none, and ``target`` is null. Messages and replies are
    brought together by batch once; a group holds one batch and its few attempts.
    """
    item = F.struct("pos", "id", "platform", "channel_id")
    batches = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    attempts = (
        responses.where(F.col("attempt") <= max_attempts)
        .withColumn("n", reply_length(F.col("body"))).where(F.col("n").isNotNull())
        .groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("attempt", "n", "body"))).alias("tries"))
    )
    refusal = F.transform("items", lambda i: F.struct(
        i["id"].alias("id"), i["platform"].alias("platform"), F.lit(v.FALLBACK_KEEP).alias("keep"),
        F.lit(v.FALLBACK_SCORE).alias("score"), no_links().alias("tags")))
    good = F.get(F.filter("tries", lambda t: t["n"] == F.size("items")), F.lit(0))["body"]
    answered = batches.join(attempts, "batch_id", "left").select(
        "batch_id", "items", F.coalesce(parsed_reply(good), refusal).alias("answers"))

    def agrees(item: Column, answer: Column) -> Column:
        return (item["id"] == answer["id"]) & (item["platform"] == answer["platform"])

    pairs = F.arrays_zip("items", "answers")
    in_order = F.forall(pairs, lambda p: F.coalesce(agrees(p["items"], p["answers"]), F.lit(False)))
    rows = answered.select("batch_id", F.when(~in_order, F.col("items")).alias("items"),
                           F.explode(pairs).alias("pair"))
    here, answer = F.col("pair.items"), F.col("pair.answers")
    by_position = F.coalesce(agrees(here, answer), F.lit(False))
    same = F.filter("items", lambda i: agrees(i, answer))
    target = F.when(by_position, here).when(F.size(same) == 1, F.get(same, F.lit(0)))
    return rows.select("batch_id", here["pos"].alias("place"), target.alias("target"),
                       by_position.alias("by_position"), *[answer[n].alias(n) for n in _ANSWER[2:]])


def replay_labels(batched: DataFrame, responses: DataFrame) -> DataFrame:
    """Labels from stored replies: at most one for each message, an item at the message's own place
    before one that only names it."""
    found = matched_replies(batched, responses).where(F.col("target").isNotNull())
    first = W.partitionBy("batch_id", "target.pos").orderBy(F.desc("by_position"), "place")
    ranked = found.withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
    return ranked.select("batch_id", "target.pos", "target.id", "target.platform", "target.channel_id",
                         *_ANSWER[2:]).select("batch_id", "pos", *columns(LABELS))


def unmatched_items(batched: DataFrame, responses: DataFrame) -> DataFrame:
    """How many reply items name no message: ``batch_id, items``."""
    lost = matched_replies(batched, responses).where(F.col("target").isNull())
    return lost.groupBy("batch_id").agg(F.count("*").alias("items"))


def kept_labels(labels: DataFrame) -> DataFrame:
    """Labels to join back: ``keep`` is exactly ``"true"``; score as a decimal."""
    return labels.where(F.col("keep") == v.KEEP).select(
        *LABEL_KEYS, F.col("score").try_cast(_SCORE).alias("score"), "tags"
    )


def join_labels(messages: DataFrame, labels: DataFrame, keys: Iterable[str] = LABEL_KEYS) -> DataFrame:
    """Messages with the score and tags of their kept label; the others stay with nulls.

    The build side is left to the planner: broadcast while it is small, else sort-merge with
    skewed partitions split.
    """
    keys = list(keys)
    return messages.join(labels.select(*keys, "score", "tags"), keys, "left").select(
        *messages.columns, "score", "tags"
    )


# --- labelling functions ----------------------------------------------------------------------------

def rubric_labels(items: DataFrame, **rubric) -> DataFrame:
    """Labels by the keyword rubric, in the shape a service would return them."""
    tagged = items.withColumn("tags", topic_tags(F.col("text"), F.col("links"), **rubric))
    scored = tagged.withColumn("_score", topic_score(F.col("tags")))
    return scored.select(
        "id", "platform", "channel_id",
        F.when(keep_rule(F.col("_score")), v.KEEP).otherwise(v.FALLBACK_KEEP).alias("keep"),
        F.col("_score").cast("string").alias("score"), "tags",
    )


def unknown_tag_rows(labels: DataFrame) -> DataFrame:
    """Tags outside the vocabulary, one row each."""
    from ..functions.rubric import unknown_tags

    return labels.select(*LABEL_KEYS, F.explode(unknown_tags(F.col("tags"))).alias("tag"))


def _partition_labeller(fn: Callable, batch_size: int, attempts: int):
    """The function for one partition. It refers to nothing of this package, so workers need only
    what ``fn`` needs."""
    names, sent = columns(LABELS), ("id", "text", "platform", "links")
    fallback = {"keep": v.FALLBACK_KEEP, "score": v.FALLBACK_SCORE, "tags": []}

    def reply_to(items: list[dict]) -> list[dict]:
        for attempt in range(1, attempts + 1):
            try:
                reply = fn([{name: item[name] for name in sent} for item in items])
                if isinstance(reply, str):
                    reply = json.loads(reply.strip())
            except Exception as error:  # what a service raises is its own affair
                logging.getLogger("newsloom").warning("attempt %d failed: %s", attempt, error)
                continue
            if isinstance(reply, list) and len(reply) == len(items):
                return reply
        return [{"id": i["id"], "platform": i["platform"], **fallback} for i in items]

    def as_text(value):
        """A JSON value as the text a stored reply would give."""
        if value is None or isinstance(value, str):
            return value
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))

    def scalar(value):
        return None if isinstance(value, (dict, list)) else as_text(value)

    def rows(items: list[dict]) -> pd.DataFrame:
        named: dict = {}
        for place, item in enumerate(items):
            named.setdefault((item["id"], item["platform"]), []).append(place)
        found: dict = {}
        for place, label in enumerate(reply_to(items)):
            if not isinstance(label, dict):
                continue
            key = (scalar(label.get("id")), scalar(label.get("platform")))
            places = named.get(key, [])
            by_position = place in places
            if by_position or len(places) == 1:
                target = place if by_position else places[0]
                if target not in found or by_position and not found[target][0]:
                    found[target] = by_position, label
        labels = []
        for target, (_, label) in sorted(found.items()):
            item, tags = items[target], label.get("tags")
            texts = {n: label.get(n) if isinstance(label.get(n), str) else None for n in ("keep", "score")}
            labels.append({"id": item["id"], "platform": item["platform"], "channel_id": item["channel_id"], **texts,
                           "tags": [as_text(t) for t in tags] if isinstance(tags, (list, tuple)) else None})
        return pd.DataFrame(labels, columns=names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[dict] = []
        for frame in frames:
            frame["links"] = frame["links"].map(list)
            waiting.extend(frame.to_dict("records"))
            while len(waiting) >= batch_size:
                batch, waiting = waiting[:batch_size], waiting[batch_size:]
                yield rows(batch)
        if waiting:
            yield rows(waiting)

    return run


def label_with(messages: DataFrame, fn: Callable, batch_size: int = v.DEFAULT_BATCH_SIZE,
               attempts: int = v.MAX_ATTEMPTS, concurrency: int | None = None) -> DataFrame:
    """Label messages with ``fn`` and return the kept labels (see ``kept_labels``).

    ``fn`` gets a list of items (``id, text, platform, links``) and returns a list of labels or its
    JSON text; it is called once per batch of a partition, again after a bad reply, and a batch
    without a good reply is not kept. ``concurrency`` sets the number of partitions and so how many
    calls run at once. A service that answers differently each time needs its labels written before
    they are used twice: see ``plans.daily.run_daily``.
    """
    items = label_input(messages)
    if concurrency:
        items = items.repartition(concurrency)
    return kept_labels(items.mapInPandas(_partition_labeller(fn, batch_size, attempts), LABELS))
