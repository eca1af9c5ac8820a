import random
import re
import time
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsloom.functions import fixed as v
from newsloom.functions import text as tx


def low_by_hand(text):
    """Greeting test in plain Python, for comparison."""
    if text is None:
        return True
    letters = "".join(c for c in text.lower() if c.isalnum() or c == "_" or c.isspace())
    return " ".join(letters.split()) in {"", *v.LOW_VALUE_PHRASES}


@pytest.mark.parametrize("text, low", [
    (None, True), ("", True), ("  \n", True), ("gm", True), ("GM!! 🚀", True),
    ("Good  morning.", True), ("selamat pagi 😀", True), ("🚀🚀", True), ("hi‍", True),
    ("g.m", True), ("K", False), ("OK", True), ("Hİ", True), ("hmm", True), ("hm", True),
    ("gm https://x.co/abc", False), ("hello there", False), ("ok_", False), ("é", False),
    ("a b gm", False), ("o k", False), ("no-no", False), ("www.x.y", False), ("gmm", False),
    ("selamat　pagi", True), ("selamatpagi", False), ("gm\x1f!", True),
])
def test_low_value(one, text, low):
    assert one(tx.is_low_value, text) == [low]
    assert low_by_hand(text) == low


def test_low_value_on_mixed_texts(spark):
    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.lists(st.sampled_from(
        [*"gmhioksap", "selamat", "pagi", "good", "morning", " ", "  ", " ", "\n", "!", "🚀", "_",
         "é", "́", "1", "GM", "K", "İ", "-", " "]), max_size=6).map("".join),
        min_size=40, max_size=80))
    def check(texts):
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        words = tx.normalize_words(F.col("t"))
        got = rows.select("t", tx.is_low_value(F.col("t")).alias("low"),
                          words.isin("", *v.LOW_VALUE_PHRASES).alias("by_words")).collect()
        assert [(r.t, r.low, r.by_words) for r in got] == [
            (r.t, low_by_hand(r.t), low_by_hand(r.t)) for r in got]
    check()


@pytest.mark.parametrize("text, cleaned", [
    ("line1\nline2\t x", "line1 line2 x"),
    ("https://a.io/x?y=1", ""),
    ("Case, 42 and a@b.io stay ▯▮ • €5", "Case, 42 and a@b.io stay ▯▮ • €5"),
    ("Two projects (https://omni.example.com/x) and", "Two projects () and"),
    ("see https://a.io, then", "see , then"),
    ("see https://a.io/p, then", "see then"),
    ("www2.site.org/a]b HTTP://X.COM ftp://f.de/y", "]b"),
    ("user https://me:pw@h.example.com:8080/x end", "user end"),
    ("xhttps://a.io/x", "xhttps://a.io/x"), ("a/www.b.com", "a/www.b.com"),
    ("http://localhost:3000/a http://10.0.0.1/x", ""),
    ("http://nodot www.x y", "http://nodot www.x y"),
    ("🚀up 👩🏽‍💻 ❤️ 1️⃣ ©2024 🇮🇩 🏴󠁧󠁢󠁥󠁮󠁧󠁿.", "up 2024 ."),
    ("“a” ‘b’ ʼ", "\"a\" 'b' '"), ("ﬁne ﬂow", "fine flow"), ("ＡＢ１！", "AB1!"),
    ("café", "café"), ("CafÃ©", "Café"), ("itâ€™s", "it's"), ("Ã¼ und é", "ü und é"),
    ("cafÃ© — 😀 text", "café — text"), ("CafÃ© and “ok”", 'Café and "ok"'), ("Привет ÐŸÑ€Ð¸Ð²ÐµÑ‚ é", "Привет Привет é"),
    ("«CAFÉ» und «MAÇÃ»", "«CAFÉ» und «MAÇÃ»"), ("漢 â‚¬5 Â£3 Ã", "漢 €5 £3 Ã"), ("à ª bÃ", "à ª bÃ"),
    ("a\x1b[31mred\x07﻿ b", "ared b"), ("a &amp; b &lt;c&gt; &amp;lt;", "a & b <c> &lt;"),
    ("a &amp; <b>", "a &amp; <b>"), ("x 　y   z", "x y z"),
    ("x\x91y\x92", "x'y'"), ("Ünïcödé Ŝ Привет 漢字", "Ünïcödé Ŝ Привет 漢字"),
])
def test_clean(one, text, cleaned):
    assert one(tx.clean_text, text) == [cleaned]


def test_clean_null_and_idempotent(one):
    assert one(tx.clean_text, None) == [None]
    texts = ["a  b 🚀 https://x.io/a", "“q” \n ﬁ", "plain"]
    once = one(tx.clean_text, *texts)
    assert one(tx.clean_text, *once) == once


def test_long_hosts_and_long_texts(one):
    host = "www." + "a." * 20000 + "com"
    tail = "x" * 300_000
    got = one(tx.clean_text, f"{host} {tail} gm", "!" * 200_000 + "gm", "a-" * 50_000 + ".io")
    assert got[0].endswith(f"{tail} gm")
    assert one(tx.is_low_value, "!" * 200_000 + "gm") == [True]


LABEL = rf"{v.URL_HOST_CHARS}+(?:-{v.URL_HOST_CHARS}+)*"
PLAIN_URL = (
    rf"(?<!{v.URL_NOT_AFTER})(?:{v.URL_SCHEME}|{v.URL_WWW})(?:{v.URL_USER_CHARS}+@)?(?:{v.URL_IPV4}"
    rf"|{LABEL}(?:\.{LABEL})*\.{v.URL_LAST_LABEL}{{2,}}|[lL][oO][cC][aA][lL][hH][oO][sS][tT]){v.URL_TAIL}"
)


def test_addresses_as_by_the_plain_pattern(spark):
    """The pattern that reads a text once finds what the plain one does."""
    rng = random.Random(1)
    parts = ["www.", "WWW2.", "http://", "https://", "ftp://", "a", "bc", "com", "1", "1.2.3.4", "10.0.0.1", "@", "-",
             ".", "..", "--", ",", "/", " ", ")", "(", "localhost", "é", "€", "x.com", ":80", ":", "_", "www", "ht", "漢"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randint(2, 14))),) for _ in range(40_000)]
    rows = spark.createDataFrame(texts, "t string").repartition(8)
    got = rows.select("t", tx.strip_urls(F.col("t")).alias("got"), F.regexp_replace("t", PLAIN_URL, "").alias("plain"))
    assert got.where("got != plain").limit(5).collect() == []
    assert got.where("got != t").count() > 1000


@pytest.mark.parametrize("piece", [
    "www.a,", "http://", "https://a-", "www.1.", "a@", "&amp", "“Ã", " \t", "www.x.co/(", "é́", "1️",
    "www.a-", "www.a@", "www.1.2.3.4-", "http://a@", "www.x€", "Ã©", "ÃÃ", "漢Ã",
])
def test_time_is_linear(one, piece):
    texts = [piece * n for n in (2_000, 60_000)]
    start = time.monotonic()
    assert len(one(tx.clean_text, *texts)) == 2
    assert time.monotonic() - start < 20


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_whitespace_and_nfc(spark, data):
    texts = data.draw(st.lists(st.text(st.sampled_from(
        " \t\n\r\x0c  　\x85\x1dabẹ́́oA"), max_size=20), min_size=30, max_size=60))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", tx.collapse_whitespace(F.col("t")).alias("w"),
                      tx.compose_nfc(F.col("t")).alias("n")).collect()
    for r in got:
        assert r.w == " ".join(r.t.split())
        assert r.n == unicodedata.normalize("NFC", r.t)


def test_emoji_ranges_are_whole():
    chars = re.compile("[" + "".join(
        "-".join(chr(int(p, 16)) for p in item.split("-")) for item in v.EMOJI_RANGES.split()) + "]")
    assert all(chars.match(c) for c in "🚀⭐™▶☎🎉🫶🇩🏽")
    assert not any(chars.match(c) for c in "▯▮•·€漢é1#—")


def test_settled_texts_by_runs(spark):
    """Runs of ASCII beside one class of all settled characters: the same texts, and much less work."""
    plain = rf"\A[\x20-\x7E{tx._SETTLED}]*+\z"
    texts = [chr(p) for p in range(0x3200) if not 0xD800 <= p < 0xE000] + ["", "a\nbé c", "á", "x😀", "漢字 a",
             "aé" * 300_000, "a" * 500_000 + "🎉", "\t" * 500_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(F.col("t").rlike(tx._ONLY_SETTLED) != F.col("t").rlike(plain)).count() == 0

    prose = spark.range(0, 16, 1, 1).select(F.concat(F.repeat(F.lit("plain words, "), F.lit(150_000)), F.col("id")).alias("t")).cache()
    prose.count()

    def seconds(pattern):
        start = time.perf_counter()
        assert prose.where(F.col("t").rlike(pattern)).count() == 16
        return time.perf_counter() - start

    assert min(seconds(tx._ONLY_SETTLED) for _ in range(4)) < 0.75 * min(seconds(plain) for _ in range(4))
