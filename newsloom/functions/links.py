"""Link expressions. Links come from the raw text, before cleaning removes them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed as v

_NO_LINKS = "array<string>"


def no_links() -> Column:
    return F.array().cast(_NO_LINKS)


def find_urls(text: Column) -> Column:
    """Every ``http(s)://…`` and ``www.…`` run of the text, in order, as found."""
    found = F.regexp_extract_all(text, F.lit(v.LINK_PATTERN), F.lit(0))
    # Byte search first: most messages have no link and skip the pattern.
    may_have = F.contains(text, F.lit("http")) | F.contains(text, F.lit("www."))
    return F.when(may_have, found).otherwise(no_links())


def add_scheme(url: Column) -> Column:
    """``www.…`` gets ``https://``."""
    return F.when(url.startswith("www."), F.concat(F.lit("https://"), url)).otherwise(url)


def trim_tail(url: Column) -> Column:
    """Drop closing brackets, quotes and sentence marks at the end."""
    return F.rtrim(url, F.lit(v.LINK_TAIL_CHARS))


def is_link(url: Column) -> Column:
    return F.contains(url, F.lit(".")) & (F.length(url) >= v.LINK_MIN_LENGTH)


def links_from_text(text: Column) -> Column:
    """Links of a text: found, given a scheme, trimmed at the end, implausible ones left out."""
    urls = F.transform(find_urls(text), lambda u: trim_tail(add_scheme(u)))
    return F.filter(urls, is_link)


def links_from_entities(entities: Column) -> Column:
    """Addresses behind linked words. They come from the platform and are not checked."""
    linked = F.filter(entities, lambda e: (e["kind"] == "text_url") & e["url"].isNotNull())
    return F.coalesce(F.transform(linked, lambda e: F.trim(e["url"])), no_links())


def links_from_embeds(embeds: Column) -> Column:
    """Addresses of embedded previews, blank ones left out."""
    urls = F.transform(embeds, lambda e: F.trim(e["url"]))
    return F.coalesce(F.filter(urls, lambda u: u != ""), no_links())


def concat_links(*parts: Column, distinct: bool = False) -> Column:
    """Links in order of the parts; repeats stay unless ``distinct``."""
    links = F.concat(*parts)
    return F.array_distinct(links) if distinct else links


def links_or_empty(links: Column) -> Column:
    return F.coalesce(links, no_links())
