"""Main text of web pages by equivalence-class template deduction.

Pages of one host are made from a few templates. A page is a sequence of tokens: the opening tags of
containers, told apart by their path (names, classes and ids, and which of their like they are), and
the blocks of text between block tags, told apart by path and text. A token's occurrence vector is the
set of the host's pages that have it. Tokens with one vector form an equivalence class; those of at least
``MIN_SUPPORT`` pages, however large the host, are candidates for template parts. On a page a class is valid
if its tokens come in the order they have on the other pages, and nests if they all lie in one gap of every
valid class of more pages, or around it. What the nested valid classes leave are the slots.

A block of text belongs to the template, not to a slot,

- if the class of the container that holds it has it too: wherever that container is, it says the
  same. Inside the main element this counts for the main element and for containers with a class or id;
- outside a main element, also if its class has tags at all, or is of texts alone and nests between
  template tags, and most of its container's text on the page is of such classes.

If that left a page without any text, the page is a copy of others rather than furniture, and keeps it.

Of the slots those in a main element are extracted if the page has one, else all, but never those in
elements whose name, class, id or role says menu, header, footer, sidebar, notice, advert, form or
comment. A class name does not exclude an element that holds a main element or most of the page's text.

Occurrence vectors are not gathered. One is named by the exclusive-or of its pages' hashes and its
size, which Spark adds up in the map tasks. No list of a host's classes is made either: what is known
of a token is joined to the pages that have it, so a task holds what belongs to one page, however many pages
and classes a host has. Pages that are equal count once.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Scratch

#: Pages that share a class of tokens, at least.
MIN_SUPPORT = 4
#: The same for texts inside a main element.
MIN_TEXT_SUPPORT = 10

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe|svg|math|xmp)\b[^>]*>.*?"
    r"(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
# fixed values: HTML elements by what they do to text
CONTAINERS = frozenset(
    "html head body article main section div aside nav header footer form fieldset ul ol dl table tbody "
    "thead tfoot tr td th figure dialog details menu blockquote button select label".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
EXCLUDED = frozenset("head nav aside footer form button select dialog menu".split())
#: Parts of class, id and role names that mark what is not the article.
EXCLUDED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply replies "
    "disqus cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended widget toolbar pagination "
    "pager search complementary contentinfo dialog hidden".split())
#: Those that in the names of headings, paragraphs and inline elements say nothing.
OF_CONTAINERS = frozenset("header banner hidden search toolbar".split())
#: First parts of names that speak of another element.
ABOUT_OTHERS = frozenset("no not has with without".split())
MAIN = frozenset(("article", "main"))
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Share of the text that an element of whatever name is not left out with.
NEARLY_ALL = 0.9


def _hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace")) - (1 << 63)


def _role(tag: str, container: bool) -> tuple[bool, bool, str]:
    """Whether class, id or role of a tag mark it as no part of the article, and as the main part; and its
    class and id."""
    excluded = main = False
    names = []
    for attribute, *values in _ATTRIBUTE.findall(tag):
        value = "".join(values).lower()
        for name in value.split():
            parts = _PARTS.findall(name)
            bad = EXCLUDED_NAMES.intersection(parts if container else set(parts) - OF_CONTAINERS)
            excluded = excluded or bool(bad) and parts[0] not in ABOUT_OTHERS
        if attribute.lower() == "role":
            main = main or "main" in value.split()
        else:
            names.append(value)
    return excluded, main, " ".join(names)


class Element:
    """An open or closed element: a container, or one that its name marks as no part of the article."""

    __slots__ = ("name", "parent", "path", "token", "named", "marked", "gone", "inside", "holds_main", "chars", "like")

    def __init__(self, name, parent, path, token, named, marked, gone, inside):
        self.name, self.parent, self.path, self.token, self.named = name, parent, path, token, named
        self.marked, self.gone, self.inside = marked, gone, inside
        self.holds_main, self.chars, self.like = False, 0, None


class Page:
    """A page's tokens: ``tags`` with ``(token, place)`` and ``blocks`` with ``(element, place, text)``.

    Places count tags and blocks. Markup that the page cuts off is left out. Each element keeps a hash
    of its path, not the path, so memory is linear in the page, however deep its elements nest.
    """

    def __init__(self, page: str):
        self.tags: list[tuple[int, int]] = []
        self.blocks: list[tuple[Element, int, str]] = []
        root = Element("", None, 0, 0, False, False, False, False)
        stack, pieces, place, at, total = [root], [], 0, 0, 0
        open_names: dict[str, list[int]] = defaultdict(list)

        def end_block():
            nonlocal pieces, place, total
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((stack[-1], place, text))
                    place += 1
                    total += len(text)
                    stack[-1].chars += len(text)
                pieces = []

        def push(element):
            open_names[element.name].append(len(stack))
            stack.append(element)

        def close(depth):
            while len(stack) > depth:
                done = stack.pop()
                open_names[done.name].pop()
                # what an element holds also counts for the one around it
                if done.parent is not None:
                    done.parent.chars += done.chars
                    done.parent.holds_main |= done.holds_main

        for match in _TOKEN.finditer(page):
            tag = match[0]
            if at < match.start():
                pieces.append(html.unescape(page[at:match.start()]))
            at = match.end()
            named = _NAME.match(tag)
            if match[1] or not named or not tag.endswith(">"):
                if match[1] and match[1].lower() in ("title", "textarea", "xmp"):
                    end_block()
                continue
            name = named[1].lower()
            container = name in CONTAINERS
            if name == "br":
                pieces.append(" ")
                continue
            if name not in INLINE:
                end_block()
            if tag[1] == "/":
                if open_names.get(name):
                    if name in INLINE:
                        end_block()  # a marked inline element
                    close(open_names[name][-1])
                continue
            if name not in INLINE and (stack[-1].name in _PARAGRAPHS or stack[-1].name == name not in CONTAINERS):
                close(len(stack) - 1)  # a block ends a marked paragraph or heading that is still open
            parent = stack[-1]
            if not container and (name in VOID or " " not in tag):
                continue
            excluded, role_main, names = _role(tag, container)
            if not container:
                if excluded and name != "h1":
                    end_block()
                    push(Element(name, parent, parent.path, parent.token, parent.named, True, parent.gone, parent.inside))
                continue
            path = _hash(f"{parent.path}/{name} {names}")
            if parent.like is None:
                parent.like = {}
            parent.like[path] = nth = parent.like.get(path, 0) + 1
            gone = parent.gone or name in EXCLUDED or name == "header" and not parent.inside
            main = (name in MAIN or role_main) and not gone
            element = Element(name, parent, path, _hash(f"{parent.token} {path} {nth}"), bool(names),
                              excluded and name not in ("html", "body", "article", "main"), gone, parent.inside or main)
            element.holds_main = main
            if not gone:
                self.tags.append((element.token, place))
                place += 1
            if not tag.endswith("/>"):
                push(element)
        if at < len(page):
            pieces.append(html.unescape(page[at:]))
        end_block()
        close(1)
        self.size, self.nearly_all = place, NEARLY_ALL * total

    def _outside(self, spared) -> list[tuple[Element, int, str]]:
        """The blocks in no excluded element; marked elements for which ``spared`` holds are not excluded."""
        known: dict[int, bool] = {}
        left = []
        for block in self.blocks:
            chain, element = [], block[0]
            while element is not None and id(element) not in known:
                chain.append(element)
                element = element.parent
            out = known[id(element)] if element is not None else False
            for inner in reversed(chain):
                known[id(inner)] = out = out or inner.gone or inner.marked and not spared(inner)
            if not out:
                left.append(block)
        return left

    def kept(self) -> list[tuple[Element, int, str]]:
        """The blocks in no excluded element, and if the page has a main element only those in it. Names
        exclude no element that holds the only main element or nearly all text."""
        left = self._outside(lambda element: False)
        inside = [block for block in left if block[0].inside]
        if not inside:
            inside = [block for block in self._outside(lambda element: element.holds_main) if block[0].inside]
        return inside or self._outside(lambda element: element.chars > self.nearly_all)


def text_token(element: Element, text: str) -> int:
    return _hash(f"{element.path}\x00{text}")


# --- occurrence vectors ----------------------------------------------------------------------------

_FACTS = "site long, page long, tokens array<long>, places array<float>"


def _occurrences(batches):
    """A page's distinct tokens with their first places (0 to 1)."""
    for batch in batches:
        tokens, places = [], []
        for source in batch.column("html").to_pylist():
            page, seen = Page(source or ""), {}
            for token, place in page.tags:
                seen.setdefault(token, place)
            for element, place, text in page.kept():
                seen.setdefault(text_token(element, text), place)
            tokens.append(list(seen))
            places.append([place / page.size for place in seen.values()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("site"), batch.column("page"), pa.array(tokens, pa.list_(pa.int64())),
             pa.array(places, pa.list_(pa.float32()))], ["site", "page", "tokens", "places"])


def classes(facts: DataFrame) -> DataFrame:
    """``site, token, vector, pages, place`` of the tokens of at least ``MIN_SUPPORT`` pages: tokens of one
    class have the same ``vector`` and ``pages``; ``place`` is the average."""
    return facts.groupBy("site", "token").agg(
        F.bit_xor(F.xxhash64("page")).alias("vector"), F.count("*").alias("pages"),
        F.avg("place").cast("float").alias("place")).where(F.col("pages") >= MIN_SUPPORT)


def page_classes(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``site, page, marks`` from ``site, page, html``, where ``page`` tells pages apart: what is known of
    each page's tokens, as a list of ``token, vector, pages, place``. Pages without such a token are left
    out."""
    rows = pages.mapInArrow(_occurrences, _FACTS).groupBy("site", "page").agg(
        F.first("tokens").alias("tokens"), F.first("places").alias("places"))
    saved = scratch.save(rows, "tokens")
    facts = saved.select("site", "page", F.explode(F.arrays_zip("tokens", "places")).alias("t")).select(
        "site", "page", F.col("t.tokens").alias("token"), F.col("t.places").alias("place"))
    known = facts.drop("place").join(classes(facts), ["site", "token"])
    return known.groupBy("site", "page").agg(
        F.collect_list(F.struct("token", "vector", "pages", "place")).alias("marks"))


# --- extraction ------------------------------------------------------------------------------------

def nested_classes(places: dict[int, int], marks: dict[int, tuple]) -> set[tuple]:
    """The classes, as ``(vector, pages)``, that are valid on a page and nest in each other. ``places`` has
    the first place of each token on the page."""
    members = defaultdict(list)
    for token, (vector, pages, place) in marks.items():
        if token in places:
            members[vector, pages].append((place, places[token]))
    accepted, named = [], set()
    for name, found in sorted(members.items(), key=lambda m: (-m[0][1], m[0][0])):
        at = [here for _, here in sorted(found)]
        if any(a > b for a, b in zip(at, at[1:])):
            continue
        if all(bisect(other, at[0]) == bisect(other, at[-1]) or bisect(at, other[0]) == bisect(at, other[-1])
               for other in accepted):
            accepted.append(at)
            named.add(name)
    return named


def main_text(source: str | None, marks: dict[int, tuple] | None = None) -> str:
    """The main text of a page, its blocks in page order with a space between them. ``marks`` has
    ``vector, pages, place`` of the page's known tokens."""
    page = Page(source or "")
    blocks = page.kept()
    if marks:
        blocks = [block for block, fixed in zip(blocks, template_blocks(page, blocks, marks)) if not fixed]
    return " ".join(text for _, _, text in blocks)


def template_blocks(page: Page, blocks: list, marks: dict[int, tuple]) -> list[bool]:
    """Which of a page's blocks belong to the template."""
    tokens = [text_token(element, text) for element, _, text in blocks]
    places: dict[int, int] = {}
    for token, place in page.tags:
        places.setdefault(token, place)
    tags = set(places)
    for token, (_, place, _) in zip(tokens, blocks):
        places.setdefault(token, place)
    nested = nested_classes(places, marks)
    class_of = {token: name for token in places if token in marks and (name := marks[token][:2]) in nested}
    with_tags = {class_of[t] for t in tags if t in class_of}
    fixed, alone = [], []
    for token, (element, _, _) in zip(tokens, blocks):
        name = class_of.get(token)
        same = name is not None and class_of.get(element.token) == name
        if element.inside:
            same = same and name[1] >= MIN_TEXT_SUPPORT and (element.named or element.name in MAIN)
        fixed.append(same or not element.inside and name in with_tags)
        alone.append(name is not None and not element.inside)
    chars, recurring = defaultdict(int), defaultdict(int)
    for is_alone, (element, _, text) in zip(alone, blocks):
        chars[element.path] += len(text)
        recurring[element.path] += len(text) * is_alone
    more = [done or is_alone and 2 * recurring[element.path] >= chars[element.path]
            for done, is_alone, (element, _, _) in zip(fixed, alone, blocks)]
    return next((found for found in (more, fixed) if not all(found)), [False] * len(blocks))


def _extract(batches):
    for batch in batches:
        texts = []
        for source, marks in zip(batch.column("html").to_pylist(), batch.column("marks")):
            known = {m["token"]: (m["vector"], m["pages"], m["place"]) for m in marks.as_py() or ()}
            texts.append(main_text(source, known))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; other columns are left out.

    A null or empty page, and one without main text, gives an empty text. A null URL, or one without
    a host, counts as a host of its own. Equal rows give equal results. No page is cut.
    """
    scratch = Scratch(pages.sparkSession, "html")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html_col).alias("html"),
                        F.xxhash64(host).alias("site"), F.xxhash64(F.coalesce(F.col(html_col), F.lit(""))).alias("page"))
    found = page_classes(rows.select("site", "page", "html"), scratch)
    joined = rows.join(found, ["site", "page"], "left").select("page_id", "url", "html", "marks")
    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long") \
        .withColumnsRenamed({"page_id": id_col, "url": url})
