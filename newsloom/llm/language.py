"""Language identification by cross-parsing against suffix automata of labelled text.

For each language a suffix automaton is built from labelled text. It accepts every substring of
that text, so following it letter by letter finds the longest match from any place. A text is cut
greedily into phrases: each is the longest match from where the last one ended, or a single letter
that the language does not know. The better a language fits, the longer the phrases and the fewer
of them are needed; the language with the fewest phrases per letter wins. Ties go to the language
with more labelled documents, then to the smaller code.

Texts are lower-cased and reduced to their runs of letters. Each run is parsed with the spaces
around it, and phrases do not cross from one run to the next; a run's numbers of phrases thus do
not depend on where it stands, and each worker keeps those it has met. All of a text is parsed.

The automata are fitted on a bounded sample: of each language the ``SAMPLE_DOCS`` labelled texts
first in the order of a hash of their text, up to ``SAMPLE_DOC_CHARS`` characters of each and
``SAMPLE_CHARS`` letters in all. That sample is the only thing broadcast, and it does not grow with
the table, only with the number of languages. Texts are chosen by their hashes, counted in the map
tasks first; only those chosen are gathered.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import worker_model

SAMPLE_DOCS = 48
SAMPLE_DOC_CHARS = 4096
SAMPLE_CHARS = 60_000
UNKNOWN = "und"
CACHED = 500_000
LONGEST_CACHED = 64
_LANE = 40
_runs = re.compile(r"[^\W\d_]+").findall


def suffix_automaton(text: str) -> dict:
    """The start state; a state is a dictionary from a letter to the next state."""
    moves, link, length, last = [{}], [-1], [0], 0
    for letter in text:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and letter not in moves[p]:
            moves[p][letter] = state
            p = link[p]
        if p >= 0:
            q = moves[p][letter]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(letter) == q:
                    moves[p][letter] = twin
                    p = link[p]
                link[q] = link[state] = twin
        last = state
    for move in moves:
        for letter, state in move.items():
            move[letter] = moves[state]
    return moves[0]


def phrases(text: str, start: dict) -> int:
    """How many phrases the text is cut into."""
    count, state = 0, start
    for letter in text:
        following = state.get(letter)
        if following is None:
            if state is not start:
                count += 1
            following = start.get(letter)
            if following is None:
                count, following = count + 1, start
        state = following
    return count + (state is not start)


class Parser:
    """Phrase counts of texts for all languages of a model, one 40-bit lane of a number each."""

    def __init__(self, samples: dict[str, str]):
        self.languages = list(samples)
        self.starts = [suffix_automaton(text) for text in samples.values()]
        self.known: dict[str, int] = {}

    def count(self, run: str) -> int:
        found = self.known.get(run)
        if found is None:
            spaced, found = f" {run} ", 0
            for lane, start in enumerate(self.starts):
                found |= phrases(spaced, start) << _LANE * lane
            if len(run) <= LONGEST_CACHED:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[run] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure: the share of the runner-up in the phrases of both."""
        runs = _runs(text.lower()) if text else []
        if not self.languages or not any(any(map(str.isalpha, run)) for run in runs):
            return UNKNOWN, 0.0
        total = sum(map(self.count, runs))
        lanes = [total >> _LANE * i & (1 << _LANE) - 1 for i in range(len(self.languages))]
        best = min(range(len(lanes)), key=lanes.__getitem__)
        second = min((x for i, x in enumerate(lanes) if i != best), default=None)
        sure = 1.0 if second is None else second / (lanes[best] + second)
        return self.languages[best], sure


@dataclass
class Model:
    """Sample text of each language, the language with most labelled documents first."""

    samples: dict[str, str]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        sample_docs: int = SAMPLE_DOCS, doc_chars: int = SAMPLE_DOC_CHARS,
        sample_chars: int = SAMPLE_CHARS) -> Model:
    """Sample text for every non-null language; no labelled rows give a model without languages. Equal
    texts of a language count as one, so copies do not fill its sample."""
    rows = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    hashes = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))
    sizes = {r[0]: r[1] for r in hashes.groupBy("lang").agg(F.sum("n")).collect()}
    order = W.partitionBy("lang").orderBy(F.xxhash64("h"))
    chosen = hashes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs).drop("n")
    first = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "rank").agg(
        F.min(F.col("text").substr(1, doc_chars)).alias("text"))
    texts: dict[str, str] = {}
    for row in sorted(first.collect(), key=lambda r: (r["lang"], r["rank"])):
        have = texts.get(row["lang"], " ")
        if len(have) < sample_chars:
            texts[row["lang"]] = have + " ".join(_runs(row["text"].lower()) + [""])
    names = sorted(texts, key=lambda name: (-sizes[name], name))
    return Model({name: texts[name][:sample_chars] for name in names if texts[name].strip()})


def _parser(shared) -> Parser:
    """The worker's parser, kept between tasks."""
    return worker_model(shared.value, lambda model: Parser(model.samples))


def predict(docs: DataFrame, model: Model, text: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted language and a score from 0 to 1.

    A null text, one without a letter, or a model without languages gives ``und`` with score 0.
    Only the text decides. Columns of ``docs`` with the two new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [c for c in docs.columns if c not in (lang_col, score_col)]
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    schema = StructType([packed.schema["row"]]).add(lang_col, StringType()).add(score_col, DoubleType())

    def run(batches):
        parser = _parser(shared)
        for batch in batches:
            found = [parser.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [f.name for f in schema])

    made = packed.mapInArrow(run, schema)
    return made.select(*[F.col("row")[c].alias(c) for c in own], lang_col, score_col)


def held_out(id_col: Column, parts: int) -> Column:
    """True for the rows whose crc32 of the id as text is a multiple of ``parts``; a null id counts as
    empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts == 0


def keep_known(docs: DataFrame, wanted: Collection[str] | None = None, text: str = "text", lang: str = "lang",
               id_col: str = "doc_id") -> DataFrame:
    """The rows whose language is known, and one of ``wanted`` if that is given, with the columns they
    came with; where ``lang`` is null it becomes the predicted one. Languages are learned from the labelled
    rows that are not held out; without any, rows with a letter stay and ``lang`` stays null.
    """
    model = fit(docs.where(~held_out(F.col(id_col), 5)), text, lang)
    if not model.samples:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    found = predict(packed, model, "_text")
    known = found.where(F.col("lang_pred") != UNKNOWN if wanted is None else F.col("lang_pred").isin(*wanted))
    own = (F.coalesce(F.col("_row")[c], F.col("lang_pred")) if c == lang else F.col("_row")[c] for c in docs.columns)
    return known.select(*(value.alias(c) for value, c in zip(own, docs.columns)))
