"""Exact and near deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from newsloom.llm import exact, simhash
from newsloom.llm.common import Scratch
from newsloom.llm.components import components


def by_text(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    return groups


def check_exact(rows, found, **_):
    groups = by_text(rows)
    assert len(found) == len(rows)
    stays = defaultdict(int)
    for r in found:
        ids = groups[r["text"] or ""]
        best = max((i for i in ids if i is not None), default=None)
        assert r["keep_id"] == best and r["group_size"] == len(ids)
        assert r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert not r["kept"] or r["doc_id"] == best
        stays[r["text"] or ""] += r["kept"]
    assert set(stays.values()) == {1}


def test_exact_odd_rows(spark, documents, odd_rows):
    found = exact.exact_groups(documents(*odd_rows))
    assert {"rid", "name", "n"} <= set(found.columns)
    check_exact(odd_rows, found.collect())
    kept = exact.drop_exact_copies(documents(*odd_rows))
    assert kept.columns == documents(*odd_rows).columns
    assert kept.count() == len(by_text(odd_rows))


def test_exact_small_blocks_need_several_levels(spark, documents):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        rows.append((i, "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 9, 16, 33]))),
                     "en", "s"))
    check_exact(rows, exact.exact_groups(documents(*rows), block_bytes=2).collect())


def test_exact_equal_blocks_in_other_order(spark, documents):
    rows = [(1, "aabb", "e", "s"), (2, "bbaa", "e", "s"), (3, "aabb", "e", "s"), (4, "aabbaa", "e", "s"),
            (5, "bb", "e", "s"), (6, "aa", "e", "s"), (7, "aabbaa", "e", "s"), (8, "aabba", "e", "s")]
    check_exact(rows, exact.exact_groups(documents(*rows), block_bytes=2).collect())


def test_exact_empty_table_and_native_plan(spark, documents):
    found = exact.exact_groups(documents().limit(0))
    assert found.count() == 0
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


# --- SimHash ---------------------------------------------------------------------------------------

def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\n\t\x1c\xa0😀", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def slow_components(prints, radius=4):
    keys = sorted(set(prints.values()))
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i, k in prints.items():
        least[find(k)].append(i)
    return {i: min(least[find(k)]) for i, k in prints.items()}


def test_simhash_odd_rows(spark, documents, odd_rows):
    near = odd_rows + [(20, odd_rows[9][1] + " tail", "en", "a")]
    found = simhash.near_duplicates(documents(*near)).collect()
    assert len(found) == len(near)
    texts = {(r[0]): r[1] for r in near}
    for r in found:
        assert int(r["fingerprint"], 16) == slow_fingerprint(texts[r["doc_id"]])
    expected = slow_components({r[0]: slow_fingerprint(r[1]) for r in near if r[0] is not None})
    assert all(r["component_id"] == expected[r["doc_id"]] for r in found if r["doc_id"] is not None)
    kept = simhash.drop_near_copies(documents(*near))
    assert kept.columns == documents(*near).columns and kept.count() == len(set(expected.values()))


@pytest.mark.parametrize("parts,tile", [(2, 4096), (2, 7), (4, 16), (8, 64)])
def test_links_in_tiles_lose_nothing(spark, parts, tile):
    rng = random.Random(parts * 100 + tile)
    prints = {}
    for i in range(60):
        centre = rng.getrandbits(64)
        for j in range(rng.choice([1, 1, 4, 12])):
            moved = centre
            for _ in range(rng.randint(0, 5)):
                moved ^= 1 << rng.randrange(64)
            prints[len(prints)] = moved
            centre = moved if rng.random() < 0.5 else centre
    signed = sorted({int(np.uint64(v).view(np.int64)) for v in prints.values()})
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    scratch = Scratch(spark, "test")
    links = simhash.near_links(table, scratch, tile=tile, parts=parts)
    roots = {r[0]: r[1] for r in components(links, scratch).collect()}
    got = defaultdict(set)
    for i, v in prints.items():
        key = int(np.uint64(v).view(np.int64))
        got[roots.get(key, key)].add(i)
    expected = defaultdict(set)
    for i, root in slow_components(prints).items():
        expected[root].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_links_are_a_forest():
    same = np.arange(500, dtype=np.uint64) % np.uint64(4)
    a, b = simhash.spanning_links(np.unique(same), np.unique(same), 4)
    assert len(a) <= 8


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, i) for i in range(1001, 1400)]
    table = spark.createDataFrame(chain + hub + chain[:5], "a long, b long")
    found = {r[0]: r[1] for r in components(table, Scratch(spark, "test")).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1400)}}


def test_simhash_empty_table(spark, documents):
    assert simhash.near_duplicates(documents().limit(0)).count() == 0
