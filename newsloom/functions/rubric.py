"""A deterministic keyword rubric for topics and relevance.

It stands in for a hosted labelling service so that a digest can be made and tested without one.
Its labels are its own: they are not, and do not try to be, those of any model.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from . import fixed as v

# Words per topic, following the topic definitions: announcements, votes, products, complaints,
# fraud, explanations, weaknesses. A word ending in ``*`` also matches longer words.
DEFAULT_RUBRIC = {
    "news": ("announc*", "listing*", "partnership*", "hack*", "audit*"),
    "governance": ("dao", "proposal*", "voting", "upgrade*"),
    "product": ("dapp*", "nft*", "token launch*", "staking", "bridge*"),
    "feedback": ("complaint*", "bug report*", "suggestion*"),
    "scam": ("phishing", "fake site*", "rug pull*", "impersonat*"),
    "education": ("gas fee*", "zk-proof*", "explain*", "tutorial*"),
    "security": ("exploit*", "vulnerabilit*", "wallet safety"),
}


_EDGE = rf"[^{v.WORD}]"


def words_pattern(words: Iterable[str]) -> str:
    """One pattern for any of the words, case ignored. Written without look-around or ``\\b``, whose
    meaning differs between engines."""
    ends = (w.removesuffix("*") + ("" if w.endswith("*") else f"(?:{_EDGE}|$)") for w in words)
    return f"(?i)(?:^|{_EDGE})(?:{'|'.join(ends)})"


def topic_tags(text: Column, links: Column | None = None, rubric=DEFAULT_RUBRIC) -> Column:
    """Topics with a hit in the text or the links, in the order of the vocabulary.

    One pattern over all words comes first: text without any hit is read once, not once per topic.
    """
    where = text if links is None else F.concat_ws(" ", text, links)
    topics = [t for t in v.TOPICS if rubric.get(t)]
    flags = [F.when(where.rlike(words_pattern(rubric[t])), F.lit(t)) for t in topics]
    some = where.rlike(words_pattern(w for t in topics for w in rubric[t]))
    none = F.array().cast("array<string>")
    return F.when(some, F.array_compact(F.array(*flags))).otherwise(none)


def topic_score(tags: Column) -> Column:
    """0 without a topic, else 0.70 and 0.10 more per further topic, at most 0.98."""
    hits = F.size(tags)
    score = F.least(F.lit("0.98").cast("decimal(3,2)"),
                    (F.lit("0.60").cast("decimal(3,2)") + F.lit("0.10").cast("decimal(3,2)") * hits)
                    .cast("decimal(3,2)"))
    return F.when(hits == 0, F.lit("0.00").cast("decimal(3,2)")).otherwise(score)


def keep_rule(score: Column) -> Column:
    return score >= F.lit(v.KEEP_SCORE).cast("decimal(3,2)")


def unknown_tags(tags: Column) -> Column:
    """Tags outside the vocabulary."""
    return F.array_except(tags, F.array(*map(F.lit, v.TOPICS)))
