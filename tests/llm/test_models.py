"""Language model, mixing, toxicity, the registered queries and the pipeline."""

import hashlib
import importlib.util
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import language, lm, mixing, queries, toxicity
from newsloom.session import shared_dir

SF = "/root/testdata/sf0.001"
TABLES = os.path.isdir(SF)


# --- language model --------------------------------------------------------------------------------

def words(text):
    return (text or "").encode().lower().split() + [b" "]


def sentences(n, seed=1):
    rng = random.Random(seed)
    languages = [("le la chat chien est sur table".split(), "ais"), ("the a cat dog is on mat".split(), "ing")]
    rows = []
    for i in range(n):
        common, ending = languages[i % 2]
        text = " ".join(rng.choice(common) if rng.random() < 0.7 else rng.choice("abcdefgh") * 2 + ending
                        for _ in range(rng.randint(5, 60)))
        rows.append((i, text, "en", "s"))
    return rows


def test_lm_base_and_model(spark, documents, odd_rows):
    rows = sentences(300) + [(1000 + (r[0] or 0) if r[0] is not None else None, *r[1:]) for r in odd_rows]
    got = lm.score(documents(*rows), block_bytes=20_000).collect()
    assert len(got) == len(rows)
    held = {r[0]: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 10 == 0 for r in rows}
    counts = Counter(w for i, text, *_ in rows if not held[i] for w in words(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, text, *_ in rows:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words(text))
        expected[i, held[i], len(words(text)), sum(w in counts for w in words(text)), total, round(base, 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))
                   for r in got) == expected
    plain = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert sum(r["score"] for r in plain) > sum(r["base_score"] for r in plain)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def small_model(seed=1):
    """A block of a small corpus and a model with random weights."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}{e}" for i in range(60) for e in ("a", "ing")]
    texts = [[rng.choice(vocabulary[: 5 + 20 * (i % 7)]).encode() for _ in range(rng.randint(0, 30))] for i in range(60)]
    block = lm._Block()
    for i, words_ in enumerate(texts):
        block.add(i, i % 5 == 0, words_, 1)
    row = next(lm._rows([block.row(pa.int64())]))
    row["totals"] = row["counts"].copy()
    gen = np.random.default_rng(seed)
    weights = lambda n: gen.normal(size=(lm.TABLES, lm.BUCKETS, n)).astype("f4")
    top = np.argsort(-row["totals"])[:lm.HEADS + 1]
    heads = {(int(row["hashes"][i]) >> 32, int(row["totals"][i])): 2 + n for n, i in enumerate([i for i in top if i][:lm.HEADS])}
    total, distinct = int(row["totals"].sum()), int((row["totals"] > 0).sum())
    model = lm.Model(total, distinct, np.arange(lm.ENDINGS) % lm.GROUPS, heads, None, gen.normal(size=lm.CLASSES).astype("f4"),
                     weights(lm.CLASSES), gen.normal(size=(lm.CLASSES, lm.PARTS)).astype("f4"), weights(lm.PARTS))
    endings = np.frombuffer(row["endings"], np.uint8)
    classes, parts = lm._classes(model, row["totals"], row["hashes"], endings, False), lm._parts(row["hashes"])
    model.mass = np.zeros((lm.CLASSES, lm.PARTS))
    np.add.at(model.mass, (classes, parts), row["totals"])
    return texts, [w for w in block.words], row, model, classes, parts


def softmax(x):
    x = np.exp(np.asarray(x, float) - np.max(x))
    return x / x.sum()


def test_lm_scores_against_brute_force():
    texts, vocabulary, row, model, classes, parts = small_model()
    number = {w: i for i, w in enumerate(vocabulary)}
    mix, top = 0x9E3779B97F4A7C15, (1 << 64) - 1
    hashed = {w: int(row["hashes"][i]) & top for w, i in number.items()}

    def probabilities(before, second):
        """Of every class, and of every part of every class of many words."""
        keys = [before * mix & top, (second ^ 0x5BD1) * mix & top, ((before * mix & top) ^ second) * mix & top]
        of_class = softmax(model.bias + sum(model.weights[i][k >> 51] for i, k in enumerate(keys)))
        of_part = {}
        for c in range(2 + lm.HEADS, lm.CLASSES):
            rows = [((k ^ (c + 1)) * mix & top) >> 51 for k in keys]
            of_part[c] = softmax(model.part_bias[c] + sum(model.part_weights[i][r] for i, r in enumerate(rows)))
        return of_class, of_part

    def of_word(w, found):
        i, (of_class, of_part) = number[w], found
        c = classes[i]
        share = 1.0 if c < 2 + lm.HEADS else of_part[c][parts[i]] * max(row["totals"][i], 1) / max(model.mass[c, parts[i]], 1)
        return of_class[c] * share

    known, base, scores = lm._score(row, model)
    for n, words_ in enumerate(texts):
        log, slow_base, history = 0.0, 0.0, [1, 2]
        for w in [*words_, b" "]:
            log += math.log10(of_word(w, probabilities(*history)))
            slow_base += math.log10((row["totals"][number[w]] + 0.1) / (model.total + 0.1 * (model.distinct + 1)))
            history = [hashed[w], history[0]]
        assert scores[n] == pytest.approx(log, abs=1e-3) and base[n] == pytest.approx(slow_base, abs=1e-6)
        assert known[n] == sum(row["totals"][number[w]] > 0 for w in [*words_, b" "])
    for history in ((1, 2), (hashed[vocabulary[3]], hashed[vocabulary[9]])):
        found = probabilities(*history)
        unseen = found[0][lm._UNSEEN]
        empty = sum(found[0][c] for c in range(1, lm.CLASSES) if not (classes == c).any())
        missing = sum(found[0][c] * sum(p for k, p in enumerate(found[1][c]) if not ((classes == c) & (parts == k)).any())
                      for c in range(2 + lm.HEADS, lm.CLASSES) if (classes == c).any())
        whole = sum(of_word(w, found) for w in vocabulary if row["totals"][number[w]] > 0)
        assert whole + unseen + empty + missing == pytest.approx(1, abs=1e-5)


def test_lm_every_training_token_trains_both_factors(monkeypatch):
    texts, _, row, model, *_ = small_model()
    monkeypatch.setattr(lm, "BATCH", 64)
    used, part_used = np.zeros((lm.TABLES, lm.BUCKETS), np.int64), np.zeros((lm.TABLES, lm.BUCKETS), np.int64)
    classes = lm._classes(model, row["totals"], row["hashes"], np.frombuffer(row["endings"], np.uint8), True)
    codes, learned = lm._codes(row), np.repeat(~row["held"], row["lengths"])
    lm._learn(row, model, used, part_used)
    assert (used.sum(axis=1) == sum(len(t) + 1 for i, t in enumerate(texts) if i % 5)).all()
    assert (part_used.sum(axis=1) == (classes[codes[learned]] >= 2 + lm.HEADS).sum()).all()


def test_lm_gradient_sums_against_brute_force():
    gen = np.random.default_rng(3)
    rows, step = gen.integers(0, 40, (lm.TABLES, 500)).astype(np.int32), gen.normal(size=(500, lm.PARTS)).astype("f4")
    before = gen.normal(size=(lm.TABLES, lm.BUCKETS, lm.PARTS)).astype("f4")
    weights, used = before.copy(), np.full((lm.TABLES, lm.BUCKETS), 7, np.int64)
    lm._step(weights, used, rows, step)
    for i in range(lm.TABLES):
        for bucket in range(41):
            mine = rows[i] == bucket
            n = int(mine.sum())
            rate = lm.RATE / math.sqrt((7 + n) * max(n, 1))
            assert used[i, bucket] == 7 + n
            assert weights[i, bucket] == pytest.approx(before[i, bucket] - rate * step[mine].sum(axis=0), abs=1e-5)


def test_lm_second_factor_learns(spark, documents):
    """Which word of a class follows depends on the word before: only the second softmax can tell."""
    rng = random.Random(2)
    pairs = [(f"key{i}", f"val{(i * 7) % 40}x") for i in range(40)]
    rows = [(i, " ".join(w for _ in range(40) for w in rng.choice(pairs)), "en", "s") for i in range(400)]
    def gain(**options):
        held = [r for r in lm.score(documents(*rows), block_bytes=8_000, **options).collect() if r["held_out"]]
        return sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)

    assert gain() > gain(rounds=0) + 0.1  # log10 for each token


def test_lm_without_training_documents_and_empty(spark, documents):
    only_held = [(i, "a b", "en", "s") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    got = lm.score(documents(*only_held)).collect()
    assert {r["n_known"] for r in got} == {0} and {r["train_tokens"] for r in got} == {0}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert lm.score(documents().limit(0)).count() == 0


# --- mixing ----------------------------------------------------------------------------------------

def slow_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by raising the level until the whole is reached."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, low, high = sum(sizes.values()), 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(epochs * sizes[s], weight[s] * level) for s in names) < total:
            low = level
        else:
            high = level
    return {s: min(epochs * sizes[s], weight[s] * high) for s in names}


def slow_mix(rows):
    """``(id, size, source) -> taken`` by going along each source's shuffle document by document."""
    key = lambda i: hashlib.md5(f"mix-1:{'' if i is None else i}".encode()).hexdigest()
    by_source = {}
    for i, text, source in rows:
        by_source.setdefault(source, []).append((key(i), len((text or "").encode().split()), i))
    goals, out = slow_targets({s: sum(d[1] for d in docs) for s, docs in by_source.items()}), Counter()
    for source, docs in by_source.items():
        total = sum(d[1] for d in docs)
        whole = math.floor(goals[source] / total + 1e-9) if total else 0
        rest = goals[source] - whole * total
        for _, size, i in sorted(docs, key=lambda d: d[:2]):
            fits = size <= rest + 1e-6
            rest -= size * fits
            out[i, size, source] += size * (whole + fits)
    return out


def check_mix(rows, got):
    size = {}
    for i, text, _, source in rows:
        size[source] = size.get(source, 0) + len((text or "").encode().split())
    targets = slow_targets(size)
    taken, shortest = Counter(), {}
    for r in got:
        s = r["source"]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(targets[s], rel=1e-9, abs=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    by_row = Counter()
    for r in got:
        by_row[r["doc_id"], r["size"], r["source"]] += r["taken"]
    assert by_row == slow_mix([(i, text, source) for i, text, _, source in rows])
    for s in size:
        assert taken[s] <= targets[s] + 1e-6
        room = [r["size"] for r in got if r["source"] == s and r["copies"] < min(3, math.ceil(targets[s] / max(1, size[s])))]
        assert targets[s] - taken[s] < max([1.0, *room])


def test_mix_odd_rows(spark, documents, odd_rows):
    check_mix(odd_rows, mixing.mix(documents(*odd_rows)).collect())
    check_mix([], mixing.mix(documents().limit(0)).collect())
    repeated = mixing.repeat_by_mix(documents(*odd_rows))
    assert repeated.columns == documents(*odd_rows).columns


def test_mix_hot_source_and_rerun(spark, documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "a", "a", "b", "c", "é", None, "d"])) for i in range(900)]
    rows += [(2000, "w " * 5000, "en", "d"), (2001, "w", "en", "z"), (2002, "", "en", "y")]
    first = mixing.mix(documents(*rows)).collect()
    check_mix(rows, first)
    again = mixing.mix(documents(*rows).repartition(5)).collect()
    assert Counter(map(str, first)) == Counter(map(str, again))
    total = mixing.repeat_by_mix(documents(*rows)).count()
    assert total == sum(r["copies"] for r in first)


def test_mix_goes_on_past_a_document_that_does_not_fit(spark, documents):
    def key(i):
        return hashlib.md5(f"mix-1:{i}".encode()).hexdigest()

    first, *others = sorted(range(1000), key=key)
    rows = [(first, "w " * 60_000, "en", "z")]                       # the shuffle begins with it
    rows += [(i, "w " * (25 + i % 50), "en", "z") for i in others]
    rows += [(others[500], "w " * 40, "en", "z")] * 3 + [(10_000, "w " * 40_000, "en", "a")]
    everything = mixing.mix(documents(*rows)).collect()
    check_mix(rows, everything)
    got = [r for r in everything if r["source"] == "z"]
    rest = got[0]["target"]
    assert rest < 60_000 and all(r["copies"] in (0, 1) for r in got)
    rest -= sum(r["taken"] for r in got)
    left_out = min(r["size"] for r in got if not r["copies"])
    assert 0 <= rest < left_out and rest < got[0]["target"] / 500
    order = sorted(got, key=lambda r: (key(r["doc_id"]), r["size"]))
    late = [r["copies"] for r in order if r["size"] < 1000]
    assert len(late) > 1000 and sum(late) > 500 and sum(late[:450]) > 445  # along the shuffle


# --- toxicity --------------------------------------------------------------------------------------

def test_chain_learns_and_passes_on(spark, documents, odd_rows):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice("abcdefghij") * 3 for _ in range(rng.randint(5, 80))]
        bad, worse = rng.random() < 0.3, False
        if bad:
            text[rng.randrange(len(text))] = rng.choice(["insultone", "insulttwo"])
            worse = rng.random() < 0.5
            if worse:
                text.append("threat")
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, int(bad), int(worse)))
    table = spark.createDataFrame(labels, "doc_id long, insult int, threat int")
    chain = toxicity.fit(documents(*rows), table.where("doc_id < 450"), ["insult", "threat"])
    assert [len(link.chain) for link in chain] == [0, 1]
    got = {r["doc_id"]: r for r in toxicity.predict(documents(*rows, *[(5000 + n, *r[1:]) for n, r in enumerate(odd_rows)]), chain).collect()}
    test = [label for label in labels if label[0] >= 450]
    for n, name in ((1, "insult"), (2, "threat")):
        right = sum(got[label[0]][f"{name}_pred"] == bool(label[n]) for label in test)
        assert right / len(test) > 0.93
    assert all(0 <= r["insult_score"] <= 1 for r in got.values())
    assert not got[5000]["insult_pred"] and not got[5001]["insult_pred"]


def test_chain_against_brute_force(monkeypatch):
    """Out-of-fold probabilities and the chain, by plain gradient steps over dense tables."""
    monkeypatch.setattr(toxicity, "STEPS", 3000)
    rng = np.random.default_rng(6)
    n, d = 120, 9
    x = (rng.random((n, d)) < 0.4).astype(float)
    first = (x[:, 0] + 0.6 * rng.random(n) > 0.8).astype(float)
    second = (first + x[:, 1] + 0.8 * rng.random(n) > 1.6).astype(float)
    second[rng.random(n) < 0.1] = np.nan
    folds = rng.integers(0, toxicity.FOLDS, n)
    documents = [np.flatnonzero(row) for row in x]
    links = toxicity.fit_chain(documents, {"a": first, "b": second}, folds)

    def slow_fit(features, dense, target, include):
        w, v, b, rows = np.zeros(d), np.zeros(dense.shape[1]), 0.0, np.flatnonzero(include)
        for _ in range(30_000):
            p = 1 / (1 + np.exp(-(features[rows] @ w + dense[rows] @ v + b)))
            error = (p - target[rows]) / len(rows)
            w = w - 0.5 * features[rows].T @ error
            w = np.sign(w) * np.maximum(np.abs(w) - 0.5 * toxicity.PENALTY, 0)
            v, b = v - 0.5 * dense[rows].T @ error, b - 0.5 * error.sum()
        return w, v, b

    chain = np.zeros((n, 0))
    for link, label in zip(links, (first, second)):
        known = ~np.isnan(label)
        inside = np.zeros(n)
        for fold in range(toxicity.FOLDS):
            w, v, b = slow_fit(x, chain, np.nan_to_num(label), known & (folds != fold))
            out = folds == fold
            inside[out] = 1 / (1 + np.exp(-(x[out] @ w + chain[out] @ v + b)))
        w, v, b = slow_fit(x, chain, np.nan_to_num(label), known)
        got = np.array([link.weights.get(i, 0.0) for i in range(d)])
        slow = 1 / (1 + np.exp(-(x @ w + chain @ v + b)))
        fast = 1 / (1 + np.exp(-(x @ got + chain @ np.array(link.chain) + link.bias)))
        assert np.abs(slow - fast).max() < 0.02
        assert link.threshold == pytest.approx(toxicity._threshold(label[known] > 0, inside[known]), abs=0.02)
        chain = np.column_stack((chain, inside))


def test_predictions_against_brute_force(spark, documents, odd_rows):
    rng = random.Random(8)
    words = ["alpha", "beta", "gammadelta", "épsilon", "zetazeta", "eta"]
    links = [toxicity.Link("a", {toxicity._bucket(w): rng.uniform(-2, 2) for w in words}, [], -0.3, 0.4),
             toxicity.Link("b", {toxicity._bucket("gamma*"): 1.5, toxicity._bucket("eta"): -1}, [2.0], 0.1, 0.7)]
    rows = odd_rows + [(100 + i, " ".join(rng.choice([*words, "Alpha,", "other"]) for _ in range(rng.randint(0, 9))), "en", "s")
                       for i in range(60)]
    got = Counter((r["doc_id"], round(r["a_score"], 9), r["a_pred"], round(r["b_score"], 9), r["b_pred"])
                  for r in toxicity.predict(documents(*rows), links).collect())
    expected = Counter()
    for i, text, *_ in rows:
        scores = []
        for link in links:
            found = set()
            for word in set(re.findall(r"[^\W_]+", (text or "").lower())):
                found |= {word, word[:5] + "*"} if len(word) > 5 else {word}
            z = link.bias + sum(c * s for c, s in zip(link.chain, scores))
            z += sum(link.weights.get(f, 0.0) for f in {zlib.crc32(f.encode("utf-8", "replace")) % toxicity.BUCKETS for f in found})
            scores.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
        expected[i, round(scores[0], 9), scores[0] >= 0.4, round(scores[1], 9), scores[1] >= 0.7] += 1
    assert got == expected


def test_known_languages_are_kept_and_named(spark, documents, odd_rows):
    rows = sentences(200) + [(1000 + i, text, "fr" if "la" in text.split() else None, "s") for i, text, *_ in sentences(50, 9)]
    rows = [(i, text, "fr" if i < 200 and i % 2 == 0 else lang, s) for i, text, lang, s in rows] + odd_rows
    table = documents(*rows)
    kept = language.keep_known(table)
    assert kept.columns == table.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter((r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert all(r["lang"] for r in kept.collect())
    assert {r["lang"] for r in language.keep_known(table, ["fr"]).where("doc_id BETWEEN 20 AND 199").collect()} == {"fr"}
    assert language.keep_known(documents().limit(0)).count() == 0


def test_chain_without_labels(spark, documents, odd_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    chain = toxicity.fit(documents(*odd_rows), none, ["toxic"])
    assert not any(r["toxic_pred"] for r in toxicity.predict(documents(*odd_rows), chain).collect())
    assert toxicity.predict(documents().limit(0), chain).count() == 0


# --- queries and pipeline --------------------------------------------------------------------------

@pytest.mark.skipif(not TABLES, reason="benchmark tables not present")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in found.select(*columns).collect()) == sorted(str(tuple(r)) for r in result.fetchall())


@pytest.mark.skipif(not TABLES or not importlib.util.find_spec("corpus_pipeline"), reason="no tables or no pipeline")
def test_pipeline_equals_its_stages_by_brute_force(spark):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline
    from newsloom.llm import bpe, simhash

    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    known = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    last = {}
    for i, text, source in known:
        last[text] = max(last.get(text, (-1,)), (i, text, source))
    prints = {i: simhash.fingerprint(text) for i, text, _ in last.values()}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4 and find(i) != find(j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    kept = {i: (text, source) for i, text, source in last.values() if find(i) == i}
    before = set(os.listdir(shared_dir(spark) + "/newsloom"))
    got = corpus_pipeline.run(spark, SF).collect()
    left = set(os.listdir(shared_dir(spark) + "/newsloom")) - before
    assert len(left) == 1 and all(len(os.listdir(f"{shared_dir(spark)}/newsloom/{name}")) == 1 for name in left)
    copies = Counter(r["doc_id"] for r in got)
    taken = slow_mix([(i, text, source) for i, (text, source) in kept.items()])
    assert copies == Counter({i: n // size for (i, size, _), n in taken.items() if n})
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(kept[r["doc_id"]][0])
