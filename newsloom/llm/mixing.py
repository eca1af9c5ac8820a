"""Mixing sources to target weights by capped water-filling.

Every source has a weight, and the mix is as large as all sources together. Each source gets its
share of the mix by weight, but no more than ``max_epochs`` times its own size: sources above that
are clamped, and what they cannot take goes to the others by weight, until no source is above.

A source's target then is so many whole repetitions of all its documents plus a fraction of one. The
fraction goes once along a seeded shuffle of the source's documents and takes each that fits into what
is still missing. The shuffle is the order of a hash of the seed and the id, so reruns agree.

The way along the shuffle is found in written rounds. A round takes all documents up to the first that
does not fit any more, and leaves out whatever is longer than what was missing at its start. It needs
sums by the first hex digits of the hash, as many as leave a few thousand documents to a bucket; only
the bucket in which a source stops is put in order. Documents are known by hash and size then, their
rows and texts are not moved. A source with a third of all rows is thus summed in the map tasks and
sorted by small parts. What is missing at least halves about every other round, so the rounds grow with
the logarithm of a target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ordering import with_row_index
from ..session import discard
from .common import WORD_CHARS, Scratch

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Documents of a source in a bucket of the shuffle, about.
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CHARS)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``weight`` and ``target`` to a table of ``source, source_size``.

    Weights repeat over the sources by code point, null last. Each round reads four sums over the
    sources and clamps those above the level; the level only rises, so the rounds end.
    """
    ranked = with_row_index(sources, lambda: [F.col("source").asc_nulls_last()], "place", "sources")
    temporary = ranked.temporary
    ranked = ranked.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)),
                               (F.col("place") % len(weights) + 1).cast("int"))).drop("place")
    cap = F.col("source_size") * max_epochs
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        clamped = cap <= F.col("weight") * F.lit(level)
        free = ~clamped & (F.col("source_size") > 0)
        fixed, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0))).first()
        if not open_weight:
            break
        risen = (total - fixed) / open_weight
        if risen <= level:
            break
        level = risen
    share = F.col("weight") * F.lit(float(level))
    found = ranked.withColumn("target", F.least(cap.cast("double"), share))
    found.temporary = temporary
    return found


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` with ``size, source_size, target, copies, taken``.

    ``copies`` is how often the mix repeats the document and ``taken = copies * size``. A source's
    taken words stay under its target, by less than the shortest document that the fraction leaves out. Null
    text has size 0; null sources form a source of their own, as do empty ones; null ids are shuffled
    as an empty text. Rows equal in id and size are interchangeable. A mix of nothing is nothing.
    Columns of ``docs`` with one of the new names are replaced.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    most = docs.groupBy(source).count().agg(F.max("count")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(most / BUCKET_ROWS, 1), 16)))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        key.alias("key"), F.substring(key, 1, digits).alias("bucket"))
    shuffled = scratch.save(sized.groupBy("source", "bucket", "key", "size").agg(F.count("*").alias("n")), "shuffle")
    buckets = shuffled.select("source", "bucket", (F.col("size") * F.col("n")).alias("words")) \
        .groupBy("source", "bucket").agg(F.sum("words").alias("bucket_size"))
    sources = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)

    # the whole repetitions of each source, and what is missing then
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = scratch.save(sources.select(
        F.col("source").alias("_from"), "source_size", "target", F.floor(epochs).alias("whole"),
        (F.col("target") - F.floor(epochs) * F.col("source_size")).alias("part")), "targets")
    discard(*sources.temporary)
    rounds = _along_the_shuffle(shuffled, plan.select("_from", F.col("part").alias("rest")).where("rest > 0"), scratch)

    # one row for each source, written so that the planner knows how small it is and moves no texts
    decided = scratch.save(plan.join(rounds.select(F.col("_from").alias("_s"), "rounds"), F.col("_s").eqNullSafe(
        F.col("_from")), "left").drop("_s"), "decided")
    size, place = F.col("size"), F.struct("key", "size")
    joined = sized.join(decided, F.col("source").eqNullSafe(F.col("_from")))

    def within(r):
        return (size <= r["most"]) & (r["after"].isNull() | (place > r["after"])) & (
            r["upto"].isNull() | (place < r["upto"]))

    def at_stop(r):
        return (place == r["upto"]) & (r["same"] > 0)

    joined = joined.withColumn("tied", F.coalesce(F.exists("rounds", at_stop), F.lit(False)))
    most_rows = joined.where("NOT tied").withColumn("more", F.coalesce(F.exists("rounds", within), F.lit(False)))
    number = F.row_number().over(W.partitionBy("source", "key", "size").orderBy("size"))
    tied = joined.where("tied").withColumn("number", number).withColumn("more", F.exists(
        "rounds", lambda r: at_stop(r) & (F.col("number") <= r["same"])))
    made = ["size", "source_size", "target", "copies", "taken"]
    copies = (F.col("whole") + F.col("more").cast("int")).cast("int")
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in made]
    return most_rows.unionByName(tied.drop("number")).select(
        *own, "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))


_ROUND = "array<struct<most: double, after: struct<key: string, size: bigint>, " \
         "upto: struct<key: string, size: bigint>, same: bigint>>"


def _along_the_shuffle(shuffled: DataFrame, missing: DataFrame, scratch: Scratch) -> DataFrame:
    """``_from, rest, rounds`` of the sources of ``missing``: what they take along their shuffle.

    A round is ``most``, what was missing at its start; ``after``, the place where the one before
    stopped; and ``upto``, the place of the first document of at most ``most`` words that does not
    fit any more, null if all do. Of rows at that place it takes ``same``.
    """
    place, ours = F.struct("key", "size"), F.col("source").eqNullSafe(F.col("_from"))
    state = missing.withColumns({"rounds": F.array().cast(_ROUND), "after": F.lit(None).cast(
        "struct<key: string, size: bigint>"), "open": F.lit(True)})
    size, same = F.col("size"), F.floor((F.col("rest") - F.col("passed")) / F.col("size"))
    old = None
    while True:
        fitting = shuffled.join(state.where("open").select("_from", "rest", "after"), ours).where(
            (size > 0) & (size <= F.col("rest")) & (F.col("after").isNull() | (place > F.col("after"))))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        ends = (
            fitting.groupBy("source", "bucket").agg(F.sum(size * F.col("n")).alias("words"))
            .withColumn("passed_before", upto - F.col("words")).withColumn("passed_with", upto)
            .join(state.select("_from", "rest"), ours)
            .where((F.col("passed_before") <= F.col("rest")) & (F.col("passed_with") > F.col("rest")))
            .select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), "passed_before")
        )
        in_order = W.partitionBy("source").orderBy("key", "size")
        stops = (
            fitting.join(ends, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
            .withColumn("with", F.col("passed_before") + F.sum(size * F.col("n")).over(in_order))
            .withColumn("passed", F.col("with") - size * F.col("n")).where(F.col("with") > F.col("rest"))
            .groupBy("source").agg(F.min(F.struct(
                place.alias("upto"), same.alias("same"),
                (F.col("rest") - F.col("passed") - same * size).alias("rest"))).alias("stop"))
            .withColumnRenamed("source", "_stopped")
        )
        last = F.struct(F.col("rest").alias("most"), "after", F.col("stop.upto").alias("upto"), F.col("stop.same").alias("same"))
        new = scratch.save(
            state.join(stops, F.col("_from").eqNullSafe(F.col("_stopped")), "left").select(
                "_from", F.coalesce("stop.rest", "rest").alias("rest"),
                F.when(F.col("open"), F.concat("rounds", F.array(last).cast(_ROUND))).otherwise(F.col("rounds")).alias("rounds"),
                F.coalesce("stop.upto", "after").alias("after"), F.col("stop").isNotNull().alias("open")), "rounds")
        if old is not None:
            scratch.drop(old)
        state = old = new
        if state.where("open").isEmpty():
            return state.select("_from", "rest", "rounds")


def repeat_by_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as the mix takes it, with the columns it came with."""
    packed = docs.select(F.struct("*").alias("_row"), *[
        F.col(options.get(k, k)).alias(options.get(k, k)) for k in ("text", "source")],
        F.col(options.get("id_col", "doc_id")))
    mixed = mix(packed, **options)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where("copies > 0").select("_row", times).select("_row.*")
