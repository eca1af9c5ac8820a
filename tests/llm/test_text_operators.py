"""Tokens, token files, languages, quality rules and pages against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import bpe, htmltext, language, quality, tokenfile
from newsloom.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
ODD = st.text(alphabet="ab é\n\t '#12١\xa0\x85\x1c 漢😀sdl", max_size=80)


# --- byte-level BPE --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(ranks, library):
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)

    @settings(max_examples=400, deadline=None)
    @given(ODD)
    def check(text):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    check()


def test_bpe_merges_leftmost_first():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    assert bpe.encode_match(b"aaab", ranks) == [2, 3]
    assert bpe.encode_match(b"aaa", ranks) == [2, 0]


def test_bpe_of_one_very_long_match(ranks, library):
    text = "".join(random.Random(1).choice("abcde") for _ in range(60_000))
    assert bpe.encode_match(text.encode(), ranks) == library.encode_ordinary(text)


def test_bpe_odd_rows(spark, documents, odd_rows, ranks, library):
    found = bpe.encode(documents(*odd_rows), ranks, public_tokenizers.PATTERN)
    rows = found.collect()
    expected = Counter()
    for i, text, *_ in odd_rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        expected[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == expected
    back = bpe.decode(found, ranks)
    assert Counter(r["text"] for r in back.collect()) == Counter(t or "" for _, t, *_ in odd_rows)
    assert bpe.encode(documents().limit(0), ranks, public_tokenizers.PATTERN).count() == 0


# --- token file ------------------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300))
def test_elias_fano(values):
    values = sorted(values)
    made = tokenfile.EliasFano.of(np.array(values, np.uint64))
    read, _ = tokenfile.EliasFano.read(memoryview(made.to_bytes()), 0)
    assert read.get(range(len(values))).tolist() == values and [read[i] for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 1000, 20_000))
    assert len(tokenfile.EliasFano.of(ends).to_bytes()) < 20_000 * 14 / 8


@pytest.mark.parametrize("segment_ids", [50, 1 << 21])
def test_token_file_odd_rows(spark, documents, odd_rows, tmp_path, segment_ids):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    path, library = str(tmp_path / "tokens"), Tokenizer.from_str(definition)
    library.encode_special_tokens = True  # their strings in a text are ordinary text
    rows = odd_rows + [(30 + i, t, "en", "a") for i, t in enumerate(
        ["'s don't", "Σίσυφος İ", "<|endoftext|> x", "a\x00b \x00", "é   x"])]
    tokenfile.write_token_file(documents(*rows), path, definition, 2, segment_ids=segment_ids)
    found = sorted(tokenfile.read_token_file(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    def place(r):
        hashed = xxhash.xxh64_intdigest(r[1].encode(), 42) if r[1] is not None else 42
        return r[0] is not None, r[0] or 0, hashed - (hashed >> 63 << 64), r[1] or ""

    ordered = sorted(rows, key=place)
    assert [r["doc_id"] for r in found] == [r[0] for r in ordered]
    start = 0
    for r, (_, text, *_) in zip(found, ordered):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(r["ids"]) == ids.tobytes()
        start += len(ids)
    segments = [tokenfile.Segment.read(bytes(r[0])) for r in spark.read.parquet(path).select("segment").collect()]
    assert sum(s.ends.n for s in segments) == len(rows)
    one = segments[-1]
    assert len(one.document(one.ends.n - 1)) == one.bounds(one.ends.n - 1)[1] - one.bounds(one.ends.n - 1)[0]


def test_token_file_of_an_empty_table(spark, documents, tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenfile.write_token_file(documents().limit(0), str(tmp_path / "t"), f.read(), 2)
    assert tokenfile.read_token_file(spark, str(tmp_path / "t")).count() == 0


# --- language --------------------------------------------------------------------------------------

def slow_phrases(text, sample):
    at = count = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=60), st.text("abcd ", max_size=40))
def test_phrases_are_longest_matches(sample, text):
    assert language.phrases(text, language.suffix_automaton(sample)) == slow_phrases(text, sample)


def test_language_odd_rows(spark, documents, odd_rows):
    model = language.Model({"en": " the cat sat on the mat and the dog ", "fr": " le chat est sur la table et le chien "})
    rows = odd_rows + [(40, "the dog sat", None, "a"), (41, "LE CHIEN est la", "en", "a")]
    found = language.predict(documents(*rows), model)
    assert set(documents(*rows).columns) <= set(found.columns)
    got = {r["doc_id"]: r for r in found.collect()}
    assert got[40]["lang_pred"] == "en" and got[41]["lang_pred"] == "fr"
    for i, text, *_ in rows:
        unknown = not any(c.isalpha() for c in text or "")
        assert (got[i]["lang_pred"] == "und") == unknown and 0 <= got[i]["score"] <= 1
    nothing = language.predict(documents(*rows), language.Model({})).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language.predict(documents().limit(0), model).count() == 0


def test_language_fit_is_bounded_and_uses_only_text(spark, documents):
    rows = [(i, "the cat and the dog " * 50, "en", "s") for i in range(80)] + [
        (100 + i, "le chat et le chien " * 50, "fr", "s") for i in range(30)] + [(200, "x y", None, "s"), (201, None, "de", "s")]
    model = language.fit(documents(*rows), sample_docs=5, sample_chars=2000)
    assert list(model.samples) == ["en", "fr"] and all(len(t) <= 2000 for t in model.samples.values())
    assert language.fit(documents().limit(0)).samples == {}
    kept = language.keep_known(documents(*rows, (300, "123", "en", "s")))
    assert kept.columns == documents(*rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows if r[1]}


# --- quality ---------------------------------------------------------------------------------------

def slow_signals(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            duplicates += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab# \n\té\x1c", max_size=120))
def test_signals(text):
    assert quality.signals(text)[:5] == slow_signals(text)


def test_quality_odd_rows(spark, documents, odd_rows):
    got = quality.rules(documents(*odd_rows)).collect()
    assert len(got) == len(odd_rows)
    texts = {r[0]: r[1] for r in odd_rows}
    for r in got:
        s = slow_signals(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == s
        assert r["base_failed"] == (s[0] < 20 or 100 * s[4] > 30 * s[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality.rules(documents().limit(0)).count() == 0


def test_lines_shared_by_many_documents_go(spark, documents):
    rng = random.Random(7)
    def own(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    notice = "Subscribe NOW to our daily newsletter, it has all the latest stories of the week 2024"
    rows = [(i, f"{own(40)}\n{notice} {i}", "en", "h1") for i in range(30)]          # lose a line, stay
    rows += [(100 + i, f"{notice}\n{own(12)}", "en", "h1") for i in range(5)]         # depleted
    rows += [(200 + i, f"{notice}\n{own(12)}", "en", "h2") for i in range(5)]         # rare on its host
    rows += [(300 + i, own(30) if i == 0 else rows_text, "en", "h1") for i in range(1) for rows_text in [""]]
    copied = own(40)
    rows += [(400 + i, copied, "en", "h1") for i in range(40)]                       # copies count once
    got = {r["doc_id"]: r for r in quality.rules(documents(*rows)).collect()}
    assert all(got[i]["kept"] and got[i]["removed_words"] == 17 for i in range(30))
    assert not any(got[100 + i]["kept"] or got[100 + i]["base_failed"] for i in range(5))
    assert all(got[200 + i]["kept"] for i in range(5)) and all(got[400 + i]["kept"] for i in range(40))


def test_a_passage_of_a_large_source_goes(spark, documents):
    def own(i, n):
        return " ".join("".join(chr(97 + (i * 31 + j * j + 7) // 26**k % 26) for k in range(4)) + "abcdefgh"[j % 8] for j in range(n))
    notice = "Subscribe now to our daily newsletter, it has all the latest stories of the week"
    rows = [(i, own(i, 30), "en", "hot") for i in range(20_000)]
    rows += [(30_000 + i, f"{notice}\n{own(30_000 + i, 12)}", "en", "hot") for i in range(300)]
    rows += [(40_000 + i, f"{own(40_000 + i, 18)}\nyes\n\nand no", "en", "hot") for i in range(300)]
    rows += [(50_000 + i, f"{own(50_000 + i, 30)}\n* * *\n12", "en", "small") for i in range(30)]
    got = {r["doc_id"]: r for r in quality.rules(documents(*rows)).collect()}
    assert not any(got[30_000 + i]["kept"] or got[30_000 + i]["base_failed"] for i in range(300))
    assert all(got[40_000 + i]["kept"] and got[40_000 + i]["removed_words"] == 0 for i in range(300))
    assert all(got[50_000 + i]["removed_words"] == 4 for i in range(30)) and got[0]["kept"]


# --- pages -----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T{i}</title><script>var t="</p><p>no";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home {i}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title {i}</h1><span>Published by the desk of the paper</span><p>First &amp; <b>bold</b>  text {i}.<br>Next<p>Second&nbsp;one {j}
<form><input>Mail me</form><div class="ad">Buy {i}</div></p><section id="comments"><p>nice {i}</p></section></article>
<aside>Related</aside><footer>&copy; {i}</footer></body></html>"""


def test_article_without_furniture():
    assert htmltext.main_text(PAGE.format(i=3, j=4)) == \
        "Title 3 Published by the desk of the paper First & bold text 3. Next Second one 4"
    assert htmltext.main_text(None) == htmltext.main_text("") == ""
    assert htmltext.main_text("just text &lt;b> &#65; <p>cut <a hre") == "just text <b> A cut"
    assert htmltext.main_text("<p>a<p>b</div></div>c") == "a b c"


def test_template_texts_are_left_out(spark):
    rows = [(i, f"http://h/{i}", PAGE.format(i=i, j=i * 7), 1) for i in range(25)]
    rows += [(100, "http://other/1", PAGE.format(i=1, j=1), 1), (101, None, None, 1), (102, "http://h/x", "", 1),
             (3, "http://h/3", PAGE.format(i=3, j=21), 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, site int")
    found = htmltext.extract(table).collect()
    assert len(found) == len(rows)
    got = {r["page_id"]: r["text"] for r in found}
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert got[3] == "Title 3 First & bold text 3. Next Second one 21"      # the same on every page of the host
    assert "desk of the paper" in got[100]                                   # one page tells no template
    assert got[101] == got[102] == ""
    assert htmltext.extract(table.limit(0)).count() == 0


@pytest.mark.parametrize("source, text", [
    ("<div class='layout with-sidebar'><article><p>Body text</p></article><div class='sidebar'>Side</div></div>", "Body text"),
    ("<div class='no-sidebar'><p>Body</p><p>More</p></div>", "Body More"),
    ("<div class='sidebar-left'><article>Only here</article></div>", "Only here"),
    ("<div class='sidebar'><article>Teaser</article></div><article>Main <p class='advert'>Buy</p><p>one</p></article>", "Main one"),
    ("<article><h3 class='related'>See also</h3><p>a<span class='cookie-notice'>We use cookies</span> b</p></article>", "a b"),
    ("<article><h1 class='header'>Title</h1><p class='advert'>Ad <b>now</b><p>text</article>", "Title text"),
    ("<article>one<br>two<br/>three<wbr>four</article>", "one two threefour"),
    ("<article><ul><li class='ad'><p>Ad</p></li><li>point</li></ul></article>", "point"),
    ("<main><div role='complementary'>x</div><p>Para<!-- c --> graph</p></main><p>after</p>", "Para graph"),
    ("<div class=banner><p>Some text that is all there is</p></div>", "Some text that is all there is"),
    ("<section id=comments><p>I say</p></section><p>Story</p><div class='story-comments'>they say</div>", "Story"),
])
def test_names_and_breaks(source, text):
    assert htmltext.main_text(source) == text


def test_deep_and_long_pages():
    start = time.monotonic()
    deep = "<div class=a>" * 40_000 + "core" + "</div>" * 40_000
    assert htmltext.main_text(deep) == "core"
    assert htmltext.main_text("<p class=ad>" * 30_000 + "x") in ("", "x")
    assert htmltext.main_text("<b>" * 100_000 + "x" + "</i>" * 100_000) == "x"
    assert len(htmltext.main_text("<article>" + "<p>word</p>" * 200_000)) == 5 * 200_000 - 1
    tracemalloc.start()
    htmltext.Page("<div>" * 8_000)
    assert tracemalloc.get_traced_memory()[1] < 20_000_000 and time.monotonic() - start < 60
    tracemalloc.stop()


def site_pages(seed, n, host="h"):
    """Pages of two templates without a main element, article and telling class names."""
    rng = random.Random(seed)
    def words(k):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    rows, texts = [], {}
    for i in range(n):
        story = [words(rng.randint(8, 30)) for _ in range(rng.randint(2, 6))]
        body = "".join(f"<p>{p}</p>" for p in story)
        extra = "<div class=x9><p>Reader offer of the week for you</p></div>" if i % 3 == 0 else ""
        top = "<div class=x1><p>The Daily Paper</p><p>World</p><p>Sports and more</p></div>"
        if i % 2:
            page = f"<body>{top}<div class=x2>{extra}{body}</div><div class=x3><p>Made by the paper, all rights</p></div></body>"
        else:
            page = f"<body><table><tr><td>{top}<td class=x5>{body}{extra}</td></tr></table><div class=x6>Call our desk</div></body>"
        rows.append((i, f"http://{host}/{i}", page, 1))
        texts[i] = " ".join(story)
    return rows, texts


def test_classes_against_brute_force(spark):
    rows, _ = site_pages(3, 24)
    rows += [(100 + i, f"http://other/{i}", r[2], 1) for i, r in enumerate(rows[:3])] + [rows[0], rows[0]]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, site int")
    pages = table.select(F.xxhash64(F.substring_index("url", "/", 3)).alias("site"), F.xxhash64("html").alias("page"), "html")
    found = htmltext.page_classes(pages, Scratch(spark, "test")).collect()
    got = defaultdict(set)
    for r in found:
        for m in r["marks"]:
            got[r["site"], m["vector"], m["pages"]].add((m["token"], r["page"]))
    vectors = defaultdict(set)
    for r in pages.distinct().collect():
        page = htmltext.Page(r["html"])
        for token in {t for t, _ in page.tags} | {htmltext.text_token(e, t) for e, _, t in page.kept()}:
            vectors[r["site"], token].add(r["page"])
    expected = defaultdict(set)
    for (site, token), where in vectors.items():
        if len(where) >= htmltext.MIN_SUPPORT:
            expected[site, frozenset(where)] |= {(token, page) for page in where}
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values())) and len(expected) >= 5


def test_templates_alone_remove_furniture(spark, monkeypatch):
    """With no telling names the template alone finds the story on a host of ten pages or more."""
    for n in (10, 30, 60):
        rows, texts = site_pages(n, n)
        table = spark.createDataFrame(rows, "page_id long, url string, html string, site int")
        got = {r["page_id"]: r["text"] for r in htmltext.extract(table).collect()}
        if n > 10:
            assert got == texts
        left = sum(len(got[i]) - len(texts[i]) for i in texts)  # a part on two pages stays
        furniture = sum(len(htmltext.main_text(r[2])) - len(texts[r[0]]) for r in rows)
        assert 0 <= left < 0.2 * furniture and all(got[i].startswith(texts[i]) or texts[i] in got[i] for i in texts)
    few, texts = site_pages(5, 3)
    got = {r["page_id"]: r["text"] for r in htmltext.extract(spark.createDataFrame(few, table.schema)).collect()}
    assert all(len(got[i]) > len(texts[i]) for i in texts)  # three pages tell no template


def test_near_copies_are_no_template(spark):
    story = [f"Paragraph {i} of a story that many pages carry in the same words" for i in range(12)]
    rows = [(i, f"http://h/{i}", "<nav>x</nav><article>" + "".join(f"<p>{p}</p>" for p in story) +
             f"<p>Read {i} times</p></article>", 1) for i in range(30)]
    rows += [(100 + i, f"http://h/o{i}", f"<article><p>Own text number {i}</p></article>", 1) for i in range(3)]
    rows += [(200 + i, f"http://one/{i}", f"<div class=c{i}>" + "".join(f"<p>{p}</p>" for p in story) + "</div>", 1) for i in range(12)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, site int")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(table).collect()}
    assert all(got[i] == " ".join([*story, f"Read {i} times"]) for i in range(30))
    assert all(got[200 + i] == " ".join(story) for i in range(12))
