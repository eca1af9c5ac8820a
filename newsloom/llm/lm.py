"""Language-model scoring by a hashed maximum-entropy model with class-factored softmax.

    P(token | history) = P(class | history) * P(part | class, history) * P(token | part)

``P(class | history)`` is a softmax over 32 classes whose weights are looked up in hashed tables: one
for the token before (bigram), one for the two before together (trigram) and one for the token two
before alone (skip), besides a bias. Inside a class of many tokens the tokens are dealt by hash to 32
parts, and ``P(part | class, history)`` is a second softmax with tables of its own, looked up by class and
history. ``P(token | part)`` is the token's share of the part's training tokens. Tokens that training
has not seen are one event with a class of its own, so the probabilities of all known tokens and that
event sum to one.

Classes are: unseen, end of text, each of the most frequent tokens, and for the others the group
of their ending and the band of their count. Groups are found by clustering endings by how often
they stand in the same documents, which tells languages and registers apart. In training a token
is classed by its count without itself, as a held-out token would be; what occurs once stands for the unseen.

How it runs:

1. Texts are packed into blocks of about ``BLOCK_BYTES``: the block's distinct words, as 64-bit hashes,
   and the text as numbers of these words. Everything later reads numbers, in numpy batches of
   thousands of tokens; texts are read once and are never shuffled.
2. A word's training count is a sum over the blocks' words, added up in the map tasks first. The sums
   are joined back to the blocks' words; a join's skewed partitions are split, so a word that every
   block has is no burden for one task.
3. Weights are trained in ``ROUNDS`` rounds over disjoint shares of all training blocks; every training
   token trains the softmax over classes and, in a class of many tokens, that over parts. In a round every task starts from the broadcast weights, makes gradient
   steps over its blocks, and returns its weights and how often it used each row; these are added up
   as a tree deep enough that a few states reach the driver, and averaged by use. The weights have a
   fixed size (about 6 MB), whatever the data; what grows with the data are the counts.
4. Blocks are scored with the final weights.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from dataclasses import dataclass, replace
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, words_of
from .language import held_out

BLOCK_BYTES = 8 << 20
ENDINGS = 128
GROUPS = 5
HEADS = 10
BANDS = (3, 16, 256)
CLASSES = 2 + HEADS + GROUPS * (len(BANDS) + 1)
PARTS = 32
BUCKETS = 8192
TABLES = 3
ROUNDS = 4
BATCH = 8192
RATE = 0.5
LIMIT = 60.0
END = b" "  # no word has a space
_UNSEEN, _END = 0, 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: bytes) -> int:
    """A word's hash as a signed number."""
    value = xxhash.xxh64_intdigest(word)
    return value - (value >> 63 << 64)


END_HASH = _hash(END)
_ZSTD = pa.Codec("zstd", compression_level=1)


# --- blocks ----------------------------------------------------------------------------------------

def _ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


class _Block:
    def __init__(self):
        self.ids, self.held, self.codes, self.lengths, self.bytes = [], [], [], [], 0
        self.words: dict[bytes, int] = defaultdict(count(1).__next__, {END: 0})  # a new word gets the next number

    def add(self, doc_id, held: bool, words: list[bytes], size: int) -> None:
        codes = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        self.codes += (codes, np.zeros(1, np.int32))
        self.ids.append(doc_id)
        self.held.append(held)
        self.lengths.append(len(words) + 1)
        self.bytes += size

    def row(self, id_type: pa.DataType) -> pa.RecordBatch:
        words, codes = list(self.words), np.concatenate(self.codes)
        lengths = np.array(self.lengths, np.int64)
        learned = np.repeat(~np.array(self.held, bool), lengths)
        counts = np.bincount(codes[learned], minlength=len(words))
        endings = np.fromiter(map(_ending, words), np.uint8, len(words))
        together = np.zeros((ENDINGS, ENDINGS))
        ends, of = np.cumsum(lengths), endings[codes]
        learn = [(a, b) for a, b, held in zip(ends - lengths, ends, self.held) if not held and b - a > 1]
        for at in range(0, len(learn), 1024):
            shares = np.stack([np.bincount(of[a:b - 1], minlength=ENDINGS) / (b - a - 1) for a, b in learn[at:at + 1024]])
            together += shares.T @ shares
        hashes = np.fromiter(map(_hash, words), np.int64, len(words))
        return pa.RecordBatch.from_arrays(
            [pa.array([self.ids], pa.list_(id_type)), pa.array([self.held], pa.list_(pa.bool_())),
             _one_list(lengths), pa.array([_packed(codes)], pa.binary()),
             _one_list(hashes), _one_list(counts),
             pa.array([endings.tobytes()], pa.binary()), pa.array([together.astype("<f8").tobytes()], pa.binary())],
            ["ids", "held", "lengths", "codes", "hashes", "counts", "endings", "together"])


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int64)))


def _packed(codes: np.ndarray) -> bytes:
    """Numbers compressed byte by byte: all lowest bytes, then all second ones, and so on."""
    return _ZSTD.compress(np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes(), asbytes=True)


def _codes(row: dict) -> np.ndarray:
    """The numbers of the words of a block's texts."""
    n = int(row["lengths"].sum())
    planes = np.frombuffer(_ZSTD.decompress(row["codes"], 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def _rows(batches):
    """The rows of batches of blocks, lists as numpy arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns):
                value = column[i]
                row[name] = value.values if pa.types.is_list(column.type) else value.as_py()
            for name in ("lengths", "hashes", "counts", "totals", "held"):
                if name in row:
                    row[name] = row[name].to_numpy(zero_copy_only=False)
            if row["hashes"].dtype == np.int32:  # only the upper half is kept with the totals
                row["hashes"] = row["hashes"].astype(np.int64) << 32
            yield row


def _pack(block_bytes: int):
    def run(batches):
        block, id_type = _Block(), None
        for batch in batches:
            id_type = batch.column("id").type
            for doc_id, held, text in zip(batch.column("id").to_pylist(), batch.column("held").to_pylist(),
                                          batch.column("text").to_pylist()):
                block.add(doc_id, held, words_of(text), len(text or "") + 16)
                if block.bytes >= block_bytes:
                    yield block.row(id_type)
                    block = _Block()
        if block.ids:
            yield block.row(id_type)
    return run


# --- model -----------------------------------------------------------------------------------------

@dataclass
class Model:
    total: int                 # training tokens
    distinct: int              # distinct training tokens
    groups: np.ndarray         # group of each ending
    heads: dict                # (upper half of the hash, count) of a frequent token -> its class
    mass: np.ndarray           # training tokens of each class and part
    bias: np.ndarray           # of the classes
    weights: np.ndarray        # table, bucket, class
    part_bias: np.ndarray      # class, part
    part_weights: np.ndarray   # table, bucket, part


def _grouped(together: np.ndarray) -> np.ndarray:
    """Clusters of endings by the company they keep; fixed start, so reruns agree."""
    mass = together.sum(axis=1)
    lift = together / np.maximum(np.sqrt(np.outer(mass, mass)), 1e-12)
    lift /= np.maximum(np.linalg.norm(lift, axis=1, keepdims=True), 1e-12)
    centres = [lift[int(mass.argmax())]]
    weight = np.sqrt(mass)
    while len(centres) < GROUPS:
        far = (1 - (lift @ np.array(centres).T).max(axis=1)) * weight
        centres.append(lift[int(far.argmax())])
    centres = np.array(centres)
    for _ in range(20):
        of = (lift @ centres.T).argmax(axis=1)
        for g in range(GROUPS):
            if (of == g).any():
                centre = (lift[of == g] * mass[of == g, None]).sum(axis=0)
                centres[g] = centre / max(np.linalg.norm(centre), 1e-12)
    return (lift @ centres.T).argmax(axis=1)


def _classes(model: Model, counts: np.ndarray, hashes: np.ndarray, endings: np.ndarray,
             without_itself: bool) -> np.ndarray:
    """The class of each word of a block; the first word is the end of text."""
    left = np.maximum(counts - 1, 0) if without_itself else counts
    found = 2 + HEADS + model.groups[endings] * (len(BANDS) + 1) + np.searchsorted(BANDS, left, side="right")
    found[left == 0] = _UNSEEN
    for (head, count), number in model.heads.items():
        found[(counts == count) & (hashes >> 32 == head)] = number
    found[0] = _END
    return found


def _parts(hashes: np.ndarray) -> np.ndarray:
    """The part of its class that each word is dealt to."""
    return (hashes.view(np.uint64) >> np.uint64(40)).astype(np.int64) % PARTS


def _histories(hashes: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each table a hash of what it looks at before each token; what lies before a text counts as its
    start."""
    of = hashes.view(np.uint64)[codes]
    starts = np.cumsum(lengths) - lengths
    before = np.empty_like(of)
    before[1:], before[starts] = of[:-1], 1
    second = np.empty_like(of)
    second[1:], second[starts] = before[:-1], 2
    return np.stack((before * _MIX, (second ^ np.uint64(0x5BD1)) * _MIX, ((before * _MIX) ^ second) * _MIX))


def _buckets(histories: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """The weight rows for the histories, or for histories and classes."""
    if classes is not None:
        histories = (histories ^ (classes.astype(np.uint64) + np.uint64(1))) * _MIX
    return (histories >> np.uint64(51)).astype(np.int32)  # the 13 highest bits


def _tokens(row: dict, model: Model, without_itself: bool):
    hashes, counts, lengths = row["hashes"], row["totals"], row["lengths"]
    endings = np.frombuffer(row["endings"], np.uint8)
    codes = _codes(row)
    classes = _classes(model, counts, hashes, endings, without_itself)
    return counts, codes, lengths, classes, _parts(hashes), _histories(hashes, codes, lengths)


def _logits(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One row for each token; ``bias`` has one row for all tokens or one for each. Within ``LIMIT`` no sum
    of their exponentials overflows."""
    scores = np.take(weights[0], rows[0], axis=0)
    scores += bias
    more = np.empty_like(scores)
    for i in range(1, TABLES):
        np.take(weights[i], rows[i], axis=0, out=more, mode="clip")
        scores += more
    return np.clip(scores, -LIMIT, LIMIT, out=scores)


def _error(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The gradient of the negative log likelihood by the logits."""
    step = np.exp(logits, out=logits)
    step /= (step @ np.ones(step.shape[1], np.float32))[:, None]
    step[np.arange(len(step)), wanted] -= 1
    return step


def _log_probability(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The natural logarithm of the wanted outcomes' probabilities."""
    of_wanted = logits[np.arange(len(logits)), wanted].astype(np.float64)
    return of_wanted - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def _step(weights: np.ndarray, used: np.ndarray, rows: np.ndarray, step: np.ndarray) -> None:
    """Move the weight rows against the gradient; ``used`` counts the uses of each row."""
    sorted_step = np.empty_like(step)
    for i in range(TABLES):
        order = np.argsort(rows[i].astype(np.uint16), kind="stable")  # a radix sort
        bucket = rows[i][order]
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        number = np.diff(first, append=len(bucket))
        bucket = bucket[first]
        used[i, bucket] += number
        rate = RATE / np.sqrt(used[i, bucket] * number)
        # two neighbouring numbers are added up as one complex number: half the additions
        np.take(step, order, axis=0, out=sorted_step, mode="clip")
        sums = np.add.reduceat(sorted_step.view(np.complex64), first).view(np.float32)
        sums *= rate.astype(np.float32)[:, None]
        weights[i][bucket] -= sums


def _learn(row: dict, model: Model, used: np.ndarray, part_used: np.ndarray) -> None:
    """Gradient steps over a block's training documents: every token trains the classes, and every token of
    a class of many tokens the parts."""
    _, codes, lengths, classes, parts, histories = _tokens(row, model, without_itself=True)
    keep = np.nonzero(np.repeat(~row["held"], lengths))[0]
    target = classes[codes]
    for at in range(0, len(keep), BATCH):
        some = keep[at:at + BATCH]
        wanted, rows = target[some], _buckets(histories[:, some])
        step = _error(_logits(model.bias, model.weights, rows), wanted)
        model.bias -= RATE / 10 * step.mean(axis=0)
        _step(model.weights, used, rows, step)
        some = some[wanted >= 2 + HEADS]
        if len(some):
            of, wanted = target[some], parts[codes[some]]
            rows = _buckets(histories[:, some], of)
            step = _error(_logits(model.part_bias[of], model.part_weights, rows), wanted)
            _step(model.part_weights, part_used, rows, step)


def _score(row: dict, model: Model) -> tuple:
    counts, codes, lengths, classes, parts, histories = _tokens(row, model, without_itself=False)
    of_word = np.log10((counts + 0.1) / (model.total + 0.1 * (model.distinct + 1)))
    single = classes < 2 + HEADS
    in_part = np.where(single, 0.0, np.log10(np.maximum(counts, 1) / np.maximum(model.mass[classes, parts], 1)))
    of_token, target = in_part[codes], classes[codes]
    for at in range(0, len(codes), BATCH):
        some = slice(at, at + BATCH)
        logits = _logits(model.bias, model.weights, _buckets(histories[:, some]))
        of_token[some] += _log_probability(logits, target[some]) / np.log(10)
        many = at + np.flatnonzero(~single[codes[some]])
        of = target[many]
        logits = _logits(model.part_bias[of], model.part_weights, _buckets(histories[:, many], of))
        of_token[many] += _log_probability(logits, parts[codes[many]]) / np.log(10)
    starts = np.cumsum(lengths) - lengths
    return (np.add.reduceat((counts > 0)[codes].astype(np.int64), starts),
            np.add.reduceat(of_word[codes], starts), np.add.reduceat(of_token, starts))


# --- training and scoring --------------------------------------------------------------------------

def _added_up(parts, nothing: tuple) -> tuple:
    """The sum of an RDD of tuples of arrays, as a tree whose last level has about four members."""
    def add(a, b):
        return tuple(x + y for x, y in zip(a, b))

    depth = max(2, math.ceil(math.log(max(parts.getNumPartitions(), 2), 4)))
    return parts.treeAggregate(nothing, add, add, depth)


def _statistics(blocks: DataFrame, totals: DataFrame, together: np.ndarray) -> Model:
    """The model before training, from sums of fixed size over blocks and distinct words."""
    known = totals.where("total > 0")
    total, distinct, singles = known.agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.count("*"), F.count_if(F.col("total") == 1)).first()
    top = known.where(F.col("hash") != END_HASH).orderBy(F.desc("total"), "hash").limit(HEADS).collect()
    heads = {(r["hash"] >> 32, r["total"]): 2 + i for i, r in enumerate(top)}
    model = Model(total, distinct, _grouped(together), heads, None, None, None, None, None)

    def run(batches):
        mass = np.zeros((CLASSES, PARTS))
        for row in _rows(batches):
            classes = _classes(model, row["totals"], row["hashes"], np.frombuffer(row["endings"], np.uint8), False)
            learned = _codes(row)[np.repeat(~row["held"], row["lengths"])]
            np.add.at(mass, (classes, _parts(row["hashes"])), np.bincount(learned, minlength=len(classes)))
        yield pa.RecordBatch.from_arrays([pa.array([mass.astype("<f8").tobytes()], pa.binary())], ["mass"])

    found = blocks.drop("ids", "round").mapInArrow(run, "mass binary")
    mass = _added_up(found.rdd.map(lambda r: (np.frombuffer(r[0], "<f8"),)), (np.zeros(CLASSES * PARTS),))[0]
    mass = mass.reshape(CLASSES, PARTS)
    of_class = mass.sum(axis=1)
    of_class[_UNSEEN] = singles
    bias = np.log((of_class + 1) / (of_class + 1).sum()).astype(np.float32)
    part_bias = np.log((mass + 0.5) / (mass + 0.5).sum(axis=1, keepdims=True)).astype(np.float32)
    return replace(model, mass=mass, bias=bias, weights=np.zeros((TABLES, BUCKETS, CLASSES), np.float32),
                   part_bias=part_bias, part_weights=np.zeros((TABLES, BUCKETS, PARTS), np.float32))


def _train_round(blocks: DataFrame, model: Model, number: int) -> Model:
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    share = blocks.where(F.col("round") == number).drop("round")
    shapes = (model.weights.shape, model.part_weights.shape)

    def run(batches):
        start = shared.value
        mine = replace(start, bias=start.bias.copy(), weights=start.weights.copy(), part_weights=start.part_weights.copy())
        used, part_used, tokens = np.zeros((TABLES, BUCKETS), np.int64), np.zeros((TABLES, BUCKETS), np.int64), 0
        for row in _rows(batches):
            _learn(row, mine, used, part_used)
            tokens += int(row["lengths"][~row["held"]].sum())
        if tokens:
            state = ((mine.weights * used[:, :, None]).astype("<f4"), (mine.part_weights * part_used[:, :, None]).astype("<f4"),
                     used.astype("<i8"), part_used.astype("<i8"), (mine.bias * tokens).astype("<f8"))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x.tobytes()], pa.binary()) for x in state), pa.array([tokens], pa.int64())],
                ["weights", "part_weights", "used", "part_used", "bias", "tokens"])

    parts = share.mapInArrow(
        run, "weights binary, part_weights binary, used binary, part_used binary, bias binary, tokens long")
    kinds = ("<f4", "<f4", "<i8", "<i8", "<f8")
    sizes = (*(math.prod(shape) for shape in shapes), TABLES * BUCKETS, TABLES * BUCKETS, CLASSES)
    nothing = (*(np.zeros(size, kind) for size, kind in zip(sizes, kinds)), 0)
    weights, part_weights, used, part_used, bias, tokens = _added_up(
        parts.rdd.map(lambda r: (*(np.frombuffer(x, kind) for x, kind in zip(r, kinds)), r[5])), nothing)
    shared.unpersist()
    if not tokens:
        return model

    def mean(sums, uses, before):
        uses = uses.reshape(TABLES, BUCKETS, 1)
        return np.where(uses > 0, sums.reshape(before.shape) / np.maximum(uses, 1), before).astype(np.float32)

    return replace(model, bias=(bias / tokens).astype(np.float32), weights=mean(weights, used, model.weights),
                   part_weights=mean(part_weights, part_used, model.part_weights))


def score(docs: DataFrame, text: str = "text", id_col: str = "doc_id", held_out_of: int = 10,
          rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Documents whose crc32 of the id is not a multiple of ``held_out_of`` are learned from; all are
    scored. Null and empty texts are an end of text only. Without training documents every token
    is unseen. Equal rows are scored each. An empty table gives no rows. Other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col), held_out_of).alias("held"),
                       F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"ids array<{id_type}>, held array<boolean>, lengths array<long>, codes binary, " \
             "hashes array<long>, counts array<long>, endings binary, together binary"
    blocks = scratch.save(rows.mapInArrow(_pack(block_bytes), schema).select(
        F.monotonically_increasing_id().alias("block"), "*"), "blocks")

    zipped = F.arrays_zip("hashes", "counts")
    totals = scratch.save(
        blocks.select(F.explode(zipped).alias("w")).groupBy(F.col("w.hashes").alias("hash"))
        .agg(F.sum("w.counts").alias("total")), "totals")
    places = blocks.select("block", F.posexplode("hashes").alias("no", "hash"))
    per_block = places.join(totals, "hash").groupBy("block").agg(
        F.collect_list("no").alias("nos"), F.collect_list("total").alias("found")).select(
        "block", F.col("found").alias("totals"), "nos")
    # a folder for each round, so that its tasks read whole shares and few states have to be added up
    upper = F.transform("hashes", lambda h: F.shiftright(h, 32).cast("int"))
    in_order = F.transform(F.sort_array(F.arrays_zip("nos", "totals")), lambda t: t["totals"])
    numbered = scratch.save(blocks.drop("together", "counts").withColumn("hashes", upper).join(
        per_block, "block").withColumn("totals", in_order).drop("nos").withColumn(
        "round", F.pmod(F.xxhash64("block"), F.lit(max(rounds, 1))).cast("int")), "numbered", by=("round",))

    def summed(batches):
        total = np.zeros(ENDINGS * ENDINGS)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob, "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["together"])

    together = _added_up(blocks.select("together").mapInArrow(summed, "together binary").rdd.map(
        lambda r: (np.frombuffer(r[0], "<f8"),)), (np.zeros(ENDINGS * ENDINGS),))[0].reshape(ENDINGS, ENDINGS)
    model = _statistics(numbered, totals, together)
    scratch.drop(blocks, totals)
    for number in range(rounds if model.total else 0):
        model = _train_round(numbered, model, number)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for row in _rows(batches):
            known, base, found = _score(row, model)
            yield pa.RecordBatch.from_arrays(
                [row["ids"], pa.array(row["held"], pa.bool_()), pa.array(row["lengths"], pa.int64()),
                 pa.array(known, pa.int64()), pa.array(np.full(len(known), model.total)), pa.array(base), pa.array(found)],
                [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return numbered.drop("round").mapInArrow(
        run, f"{id_col} {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
