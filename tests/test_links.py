import re

import pytest
from pyspark.sql import functions as F

from newsloom.functions import links as ln


@pytest.mark.parametrize("text, links", [
    ("see https://a.io/x). and www.foo.com, http://x", ["https://a.io/x", "https://www.foo.com"]),
    ('www.a.b "https://q.com/z";', ["https://www.a.b", "https://q.com/z"]),
    ("www.x.y", ["https://www.x.y"]),
    ("none here", []), ("", []), ("http and www. alone", []),
    ("a https://a.example.com/é　b", ["https://a.example.com/é"]),
    ("<https://t.example.com/a>,<www.b.example.com>", ["https://t.example.com/a", "https://www.b.example.com"]),
    ("HTTPS://A.IO/X", []), ("https://dup.io/a https://dup.io/a", ["https://dup.io/a"] * 2),
    ("https://a.io/x!!!'", ["https://a.io/x"]), ("https://a.io/(x)", ["https://a.io/(x"]),
])
def test_links_from_text(one, text, links):
    assert one(ln.links_from_text, text) == [links]
    by_hand = []
    for url in re.findall(r'https?://[^\s<>"]+|www\.[^\s<>"]+', text):
        url = ("https://" + url if url.startswith("www.") else url).rstrip(")]\"',.!;")
        by_hand += [url] if "." in url and len(url) > 10 else []
    assert links == by_hand


def test_long_tails_and_many_links(one):
    tail, many = "https://a.io/x" + ")" * 300_000, "www.foo.com " * 20_000
    got = one(ln.links_from_text, tail, tail + "x", many)
    assert got[0] == ["https://a.io/x"] and got[1] == [tail + "x"]
    assert got[2] == ["https://www.foo.com"] * 20_000


def test_entities_embeds_and_concat(spark):
    rows = spark.sql("""SELECT
        array(named_struct('kind','text_url','url',' https://e.io '),
              named_struct('kind','bold','url',CAST(NULL AS STRING)),
              named_struct('kind','text_url','url','x.y')) AS entities,
        array(named_struct('url',' https://m.io '), named_struct('url',' '),
              named_struct('url',CAST(NULL AS STRING))) AS embeds,
        'https://e.io https://e.io/long' AS text,
        CAST(NULL AS ARRAY<STRUCT<kind:STRING,url:STRING>>) AS none""")
    got = rows.select(
        ln.links_from_entities(F.col("entities")).alias("entities"),
        ln.links_from_embeds(F.col("embeds")).alias("embeds"),
        ln.links_from_entities(F.col("none")).alias("none"),
        ln.concat_links(ln.links_from_entities(F.col("entities")),
                        ln.links_from_text(F.col("text"))).alias("all"),
        ln.concat_links(F.array(F.lit("a"), F.lit("a")), distinct=True).alias("distinct"),
    ).first()
    assert got["entities"] == ["https://e.io", "x.y"]
    assert got["embeds"] == ["https://m.io"]
    assert got["none"] == []
    assert got["all"] == ["https://e.io", "x.y", "https://e.io", "https://e.io/long"]
    assert got["distinct"] == ["a"]
