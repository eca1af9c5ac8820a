"""Fill-in-middle, centroid clusters and exact top-k against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import centroids, fim, voronoi

from llm_prose import prose


# --- boundaries ------------------------------------------------------------------------------------

def slow_boundaries(text, units):
    data = text.encode()
    if units == "chars":
        cuts = [len(text[:i].encode()) for i in range(len(text))] if len(text) < 3000 else \
            np.cumsum([0] + [len(c.encode()) for c in text])[:-1].tolist()
    elif units == "lines":
        cuts = [i for i in range(len(data)) if i == 0 or data[i - 1] == 10]
    else:
        space = set(b" \t\n\x0b\x0c\r")
        cuts = [i for i in range(len(data)) if i == 0 or (data[i] in space and data[i - 1] not in space)]
    return cuts + [len(data)]


MIXED = "".join(random.Random(3).choice("aé漢😀 \n") for _ in range(90_000))


@pytest.mark.parametrize("units", ["chars", "words", "lines"])
@pytest.mark.parametrize("text", [
    "", "a", " ", "\n", "ab cd", "  ab\tcd \n\nef ", "é漢😀", "x" * 65536, "x" * 65535, "x" * 200_000, MIXED,
    "漢" * 50_000, "a " * 70_000, "a\n\n" * 100, "x" * 65535 + "é" + "y" * 70_000,
], ids=range(15))
def test_boundaries_are_all_found(text, units):
    found, expected = fim.boundaries(text.encode(), units), slow_boundaries(text, units)
    assert found.size == len(expected)
    places = range(found.size) if found.size < 3000 else random.Random(1).sample(range(found.size), 2000)
    assert all(found.select(i) == expected[i] for i in [*places, 0, found.size - 1])
    with pytest.raises(IndexError):
        found.select(found.size)


def test_each_kind_of_container():
    kinds = lambda text, units="chars": {type(c).__name__ for c in fim.boundaries(text.encode(), units).containers}
    assert kinds("x" * 200_000) == {"RunContainer"}
    assert kinds(MIXED) == {"BitmapContainer"}
    assert kinds("word " * 50_000, "lines") <= {"ArrayContainer", "RunContainer"}
    assert kinds("some words here " * 500, "words") == {"ArrayContainer"}


# --- fill in middle --------------------------------------------------------------------------------

def slow_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = text[:low], text[low:high], text[high:]
    if d % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


def test_fim_against_brute_force(spark, documents, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, i % 40) + "é😀" * (i % 3), "en", "s") for i in range(300)]
    rows += [(1000, "a <P> b", "en", "s"), (1001, "<S>", "en", "s"), (1002, "<M", "en", "s"), (1003, "< P>" * 9 + "<", "en", "s")]
    made = fim.restore(fim.transform(documents(*rows)))
    assert made.columns == ["doc_id", "n", "form", "prefix_units", "middle_units", "prefix_bytes", "middle_bytes",
                            "output", "restored"]
    got = made.collect()
    key = ("doc_id", "n", "form", "prefix_units", "middle_units", "output")
    assert Counter(tuple(r[c] for c in key) for r in got) == Counter(slow_fim(r[0], r[1]) for r in rows)
    assert Counter((r["doc_id"], r["restored"]) for r in got) == Counter((r[0], r[1] or "") for r in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        if r["form"] != "plain":
            prefix = r["restored"].encode()[:r["prefix_bytes"]].decode()
            assert len(prefix) == r["prefix_units"]


def test_fim_units_seed_and_empty(spark, documents):
    rows = [(i, prose(i, 60) + "\nline two\n" + prose(i + 1, 9), "en", "s") for i in range(60)]
    for units in ("words", "lines"):
        made = fim.restore(fim.transform(documents(*rows), units=units, fim_percent=100)).collect()
        assert {r["doc_id"]: r["restored"] for r in made} == {r[0]: r[1] for r in rows}
        for r in made:
            cut = r["restored"].encode()[:r["prefix_bytes"]].decode()
            assert units != "lines" or cut == "" or cut.endswith("\n") or cut == r["restored"]
    one = [r["output"] for r in fim.transform(documents(*rows)).orderBy("doc_id").collect()]
    assert one == [r["output"] for r in fim.transform(documents(*reversed(rows))).orderBy("doc_id").collect()]
    assert one != [r["output"] for r in fim.transform(documents(*rows), seed=5).orderBy("doc_id").collect()]
    assert {r["form"] for r in fim.transform(documents(*rows), fim_percent=0).collect()} == {"plain"}
    assert fim.restore(fim.transform(documents().limit(0))).count() == 0


def test_fim_with_other_sentinels(spark, documents):
    rows = [(i, "f(x) | y $ " * 5, "en", "s") for i in range(30)]
    marks = ("|pre|", "|suf|", "$mid$")
    made = fim.restore(fim.transform(documents(*rows), sentinels=marks), marks).collect()
    assert all(r["restored"] == "f(x) | y $ " * 5 for r in made)
    assert any("|pre|" in r["output"] for r in made)


# --- vectors ---------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, row long, id string, ints string, cluster int, rank int, score int, cell int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2, 3, 4, 5) for i, v in rows], VECTORS)


def whole(rows, scale, dims=None):
    return [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and None not in v and all(map(math.isfinite, v)) and dims in (None, len(v))]


def odd_vectors(dims, n=300, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dims))
    rows = [(i, (middles[i % 6] + spread * rng.normal(size=dims)).tolist()) for i in range(n)]
    rows += [(10_000 + i, middles[0].tolist()) for i in range(n // 2)]  # one vector in a third of the rows
    rows += [(1, None), (2, []), (20, [None] * dims), (40, [float("nan")] * dims), (60, [float("inf")] + [0.0] * (dims - 1)),
             (80, [1.0] * (dims - 1)), (100, [0.5] * (dims + 1)), (None, middles[1].tolist()), (7, rows[7][1]),
             (40, rows[40][1]), (40, rows[41][1])]
    random.Random(seed).shuffle(rows)
    return rows


def slow_clusters(rows, k, rounds, dims, scale=256):
    kept = whole(rows, scale, dims)
    ranked = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    middles = [v for _, v in ranked[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middles))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        middles = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(middles)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = Counter()
    for _, c, d in found:
        sums[c] += d
    return Counter((i, c, d, sums[c], sum(sums.values()),
                    hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest()) for i, c, d in found)


@pytest.mark.parametrize("k, rounds, block", [(5, 5, 8192), (12, 3, 50), (1000, 1, 64), (3, 0, 100)])
def test_clusters_against_brute_force(spark, k, rounds, block):
    rows = odd_vectors(8)
    got = centroids.describe(centroids.fit(vector_table(spark, rows).repartition(5), dims=8, k=k, rounds=rounds, block=block))
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == slow_clusters(rows, k, rounds, 8)


def test_clusters_many_centroids_in_steps(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = [np.unique(rng.integers(-50, 50, 30)) for _ in range(5)]
    codes = np.stack([rng.integers(0, len(v), 200) for v in values])
    middles = rng.integers(-50, 50, (77, 5))
    middles[50] = middles[3]
    whole_table = centroids.nearest(values, codes, middles)
    monkeypatch.setattr(centroids, "CELLS", 1000)
    in_steps = centroids.nearest(values, codes, middles)
    vectors = np.stack([v[c] for v, c in zip(values, codes)], axis=1)
    away = ((vectors[:, None] - middles) ** 2).sum(axis=2)
    for cluster, distance in (whole_table, in_steps):
        assert (cluster == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()


def test_clusters_empty_equal_and_too_large(spark):
    empty = centroids.describe(centroids.fit(vector_table(spark, [(1, None), (2, [1.0])]), dims=2))
    assert empty.collect() == [] and len(empty.columns) == 6
    same = centroids.describe(centroids.fit(vector_table(spark, [(i, [0.5, -0.25]) for i in range(50)]), dims=2, k=4)).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in same} == {(0, 0, 0)} and len(same) == 50
    with pytest.raises(ValueError, match="too large"):
        centroids.fit(vector_table(spark, [(1, [1e12, 1.0])]), dims=2)


def slow_top(rows, k, scale=64, every=20):
    kept = whole(rows, scale)
    out = Counter()
    for at, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), math.inf if j is None else j)
                         for other, (j, v) in enumerate(kept) if other != at))[:k]
        for rank, (score, j) in enumerate(scored, 1):
            out[i, rank, None if j == math.inf else j, -score] += 1
    return out


@pytest.mark.parametrize("k, pivots, block, spread", [(20, 64, 8192, 0.3), (5, 6, 7, 0.02), (3, 1, 50, 0.1), (1000, 16, 64, 0.3)])
def test_top_k_against_brute_force(spark, k, pivots, block, spread):
    rows = odd_vectors(6, spread=spread)
    got = voronoi.top_k(vector_table(spark, rows).repartition(4), k=k, pivots=pivots, block=block)
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert Counter(map(tuple, got.collect())) == slow_top(rows, k)


def test_top_k_copies_only_what_is_needed(spark):
    rows = [(i, v) for i, v in odd_vectors(16, 600, spread=0.02) if v and None not in v and all(map(math.isfinite, v)) and len(v) == 16]
    ints = np.array([v for _, v in whole(rows, 64)], "f8")
    pivots = np.unique(ints, axis=0)[::25]
    queries = spark.createDataFrame([(v.astype(int).tolist(),) for v in ints[::20]], "ints array<long>")
    cells = {}
    for r in voronoi.with_cells(queries, pivots).collect():
        cells.setdefault(r["cell"], []).append((r["away"], r["square"]))
    cells = [(c, len(x), max(a for a, _ in x), min(s for _, s in x), max(s for _, s in x)) for c, x in cells.items()]
    data = spark.createDataFrame([(v.astype(int).tolist(),) for v in ints], "ints array<long>")
    plan = voronoi.make_plan(pivots, cells, voronoi.nearest_data(data, pivots, 6), 5, 4)
    needed = voronoi.count_needed(data, plan)
    assert len(needed) > 3 and needed.sum() < 0.5 * len(needed) * len(ints)


def test_top_k_large_numbers_ties_and_empty(spark):
    rows = [(20 * (i % 3), [float(2 ** 20 + i % 5), float(-(2 ** 22))]) for i in range(40)]
    got = voronoi.top_k(vector_table(spark, rows), k=7, scale=64)
    assert Counter(map(tuple, got.collect())) == slow_top(rows, 7)
    assert voronoi.top_k(vector_table(spark, [(20, None), (3, [1.0])])).collect() == []
    assert voronoi.top_k(vector_table(spark, [(20, [1.0])])).collect() == []
    assert voronoi.top_k(vector_table(spark, [(i, []) for i in range(0, 60, 20)]), k=1).count() == 3
    assert voronoi.top_k(vector_table(spark, []).limit(0)).collect() == []
    with pytest.raises(ValueError, match="too long"):
        voronoi.top_k(vector_table(spark, [(20, [1e12]), (3, [1.0])]))


def test_best_of_beyond_the_short_form():
    rng = np.random.default_rng(2)
    data = rng.integers(-2 ** 29, 2 ** 29, (40, 3))
    data[10:20] = data[0]
    rows = np.arange(40)
    places, scores = voronoi.best_of(data[:6], rows[:6], data, rows, 5)
    for i in range(6):
        expected = sorted((-int(sum(int(a) * int(b) for a, b in zip(data[i], v))), j) for j, v in enumerate(data) if j != i)[:5]
        assert [(-s, p) for s, p in zip(scores[i].tolist(), places[i].tolist())] == expected
