"""Quality rules: signals of each text, and how many documents of a host share its lines.

A line is normalised to its letters in lower case and hashed; one without a letter counts as it stands. For every host and line the distinct
documents that have it are counted; documents with the same text count once, so a copied document
does not turn its own lines into boilerplate. Lines in more than ``MIN_DOCS`` documents and more
than ``SHARE`` of the host's documents are boilerplate and are taken out, and so are lines of ``LONG_LINE``
words or more in more than ``MAX_DOCS`` documents, however large the host is; short lines may be common words. A document is rejected
if its base rules fail, or if it is depleted: too few of its words are left.

Texts are read once. Lines travel as two hashes, are made distinct before they are counted, and are
counted in two steps, so a line in a third of all documents is summed in the map tasks.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Scratch

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MIN_DOCS = 10
SHARE = 0.05
MAX_DOCS = 200
LONG_LINE = 4
MIN_LEFT_PERCENT = 30
_no_letters = re.compile(r"[\W\d_]+").sub


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in windows that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    first: dict[bytes, int] = {}
    repeats = []
    for i, (a, b) in enumerate(zip(starts, ends[window - 1:].tolist())):
        j = first.setdefault(joined[a:b], i)
        if i != j:
            repeats += (i, j)
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.array(repeats, np.int64))
    edges[at] += 1
    edges[at + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def line_key(line: str) -> int:
    """The hash of a normalised line; odd if it has ``LONG_LINE`` words or more."""
    plain = _no_letters(" ", line.lower()).strip() or "\n" + " ".join(line.split())
    return (xxhash.xxh64_intdigest(plain) & ~1 | (len(plain.split()) >= LONG_LINE)) - (1 << 63)


def signals(text: str | None) -> tuple:
    """Signals of a whole text, then the hashes of its distinct lines and the words of each."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    seen, duplicates, lines = set(), 0, {}
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "replace").split())
        if not n:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        key = line_key(line)
        lines[key] = lines.get(key, 0) + n
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            duplicates, repeated_words(words), list(lines), list(lines.values()))


_SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = "rid long, id {id}, host string, digest long, n_words long, word_chars long, " \
          "n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"


def _measure(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        found = list(zip(*map(signals, texts))) or [[]] * 7
        digests = [xxhash.xxh64_intdigest((t or "").encode("utf-8", "replace")) - (1 << 63) for t in texts]
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("id"), batch.column("host"), pa.array(digests, pa.int64()),
             *[pa.array(list(column), kind) for column, kind in zip(found, kinds)]],
            ["rid", "id", "host", "digest", *_SIGNALS, "lines", "line_words"])


def rules(docs: DataFrame, text: str = "text", host: str = "source", id_col: str = "doc_id",
          min_docs: int = MIN_DOCS, share: float = SHARE, max_docs: int = MAX_DOCS) -> DataFrame:
    """``id_col``, the signals, ``removed_words``, ``base_failed`` and ``kept`` for every row.

    A null text has no words and fails the base rules. Null hosts count as the empty one. Rows that are equal
    are judged each. An empty table gives no rows. Other columns of ``docs`` are left out.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                       F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    schema = _SCHEMA.format(id=rows.schema["id"].dataType.simpleString())
    measured = scratch.save(rows.mapInArrow(_measure, schema), "signals")
    site = F.coalesce("host", F.lit("")).alias("site")  # null joins the empty host
    lines = measured.select(site, "digest", F.explode("lines").alias("line")).distinct()
    hosts = measured.select(site, "digest").distinct().groupBy("site").agg(F.count("*").alias("docs"))
    everywhere = (F.col("n") > max_docs) & (F.col("line").bitwiseAND(F.lit(1)) == 1)
    shared = lines.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    frequent = scratch.save(
        shared.join(hosts, "site").where((F.col("n") > F.col("docs") * share) | everywhere).select("site", "line"),
        "frequent-lines")
    each = measured.select("rid", site, F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "rid", "site", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    removed = scratch.save(
        each.join(frequent, ["site", "line"]).groupBy("rid").agg(F.sum("words").alias("removed_words")),
        "removed")
    scratch.drop(frequent)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left < MIN_WORDS) | (100 * left < MIN_LEFT_PERCENT * F.col("n_words"))
    return (
        measured.drop("lines", "line_words", "host", "digest").join(removed, "rid", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
        .select(F.col("id").alias(id_col), *_SIGNALS, "removed_words", "base_failed", "kept")
    )
