"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors are packed once into blocks: for each dimension the integer values that occur in the block, in
ascending order, and for each vector the places of its components in those lists, 16 bits each.
In a round, a task tabulates for each block, dimension, occurring value and centroid the squared
difference once; the distances of the block's vectors are sums of rows gathered from these tables. All
numbers are 64-bit integers, so distances, sums and the centroids made of them are exact and do not
depend on the order of rows or tasks.

Each task hands back the counts and component sums of the clusters it met, so what is shuffled in a
round is at most one row for each task and cluster, also if one cluster holds most vectors. Only the
centroids, ``k`` times the number of dimensions, pass through the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import Scratch
from .vectors import integer_vectors, matrix

DIMS = 64
K = 40
ROUNDS = 5
SCALE = 256
#: Vectors in a block, at most 65,536.
BLOCK = 8192
#: Distances held at once, vectors of a block times centroids; also bounds the entries of a table.
CELLS = 1 << 19


def _pack(ids: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
    values, codes = zip(*(np.unique(column, return_inverse=True) for column in vectors.T))
    codes = np.stack([c.astype("<u2") for c in codes])
    lists = pa.array([v.tolist() for v in values], pa.list_(pa.int64()))
    one = pa.array([0, len(ids)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(one, ids),
         pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), lists),
         pa.array([codes.tobytes()], pa.binary())], ["ids", "values", "codes"])


def pack(vectors: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """Rows ``id, ints`` as blocks ``ids, values, codes``."""
    schema = StructType([StructField("ids", ArrayType(vectors.schema["id"].dataType)),
                         StructField("values", ArrayType(ArrayType(LongType()))), StructField("codes", BinaryType())])

    def run(batches):
        ids, held, n = [], [], 0
        for batch in batches:
            ids.append(batch.column(0))
            held.append(matrix(batch.column(1), dims, "i8")[0])
            n += len(batch.column(0))
            if n >= block:
                all_ids, found = pa.concat_arrays(ids), np.concatenate(held)
                whole = n - n % block
                for at in range(0, whole, block):
                    yield _pack(all_ids.slice(at, block), found[at:at + block])
                ids, held, n = [all_ids.slice(whole)], [found[whole:]], n - whole
        if n:
            yield _pack(pa.concat_arrays(ids), np.concatenate(held))

    return vectors.select("id", "ints").mapInArrow(run, schema)


def nearest(values: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector of a block; of equal distances the smaller cluster."""
    n, line = codes.shape[1], np.arange(codes.shape[1])
    cluster, distance = np.zeros(n, np.int32), np.full(n, np.iinfo(np.int64).max)
    step = max(1, CELLS // n)
    for first in range(0, len(centroids), step):
        some = centroids[first:first + step]
        total, gathered = np.zeros((n, len(some)), np.int64), np.empty((n, len(some)), np.int64)
        for occurring, places, middle in zip(values, codes, some.T):
            table = (occurring[:, None] - middle) ** 2
            np.take(table, places, axis=0, out=gathered, mode="clip")
            total += gathered
        best = total.argmin(axis=1)
        least = total[line, best]
        nearer = least < distance
        cluster[nearer], distance[nearer] = first + best[nearer], least[nearer]
    return cluster, distance


def _blocks(batches, dims: int):
    """``ids, values, codes`` of each block of an iterator of batches."""
    for batch in batches:
        for ids, values, codes in zip(*(batch.column(name) for name in ("ids", "values", "codes"))):
            lists = [np.asarray(v, np.int64) for v in values.as_py()]
            yield ids.values, lists, np.frombuffer(codes.as_py(), "<u2").reshape(dims, -1)


def _round(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over all blocks."""
    k, dims = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, values, codes in _blocks(batches, dims):
            cluster, _ = nearest(values, codes, centroids)
            counts += np.bincount(cluster, minlength=k)
            for d, (v, places) in enumerate(zip(values, codes)):
                # whole numbers below 2**53, so these sums are exact
                sums[:, d] += np.bincount(cluster, v[places].astype("f8"), k).astype(np.int64)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(counts[met], pa.int64()),
             pa.array(sums[met].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    met = blocks.mapInArrow(run, "cluster int, n long, sums array<long>")
    new = centroids.copy()
    for row in met.groupBy("cluster").agg(F.sum("n"), *(F.sum(F.col("sums")[d]) for d in range(dims))).collect():
        new[row[0]] = [total // row[1] for total in row[2:]]
    return new


def _assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims, id_type = centroids.shape[1], blocks.schema["ids"].dataType.elementType
    schema = StructType([StructField("id", id_type), StructField("cluster", IntegerType()),
                         StructField("distance", LongType())])

    def run(batches):
        for ids, values, codes in _blocks(batches, dims):
            cluster, distance = nearest(values, codes, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], schema.names)

    return blocks.mapInArrow(run, schema)


@dataclass
class Clustering:
    """``assigned``: one row per kept vector, ``id, cluster, distance``; ``centroids``: one row each."""

    assigned: DataFrame
    centroids: np.ndarray


def fit(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = K,
        rounds: int = ROUNDS, scale: float = SCALE, seed: int = 2, block: int = BLOCK) -> Clustering:
    """Cluster the vectors with exactly ``dims`` finite components, as integers ``floor(scale * x)``.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id`` (a null id counts
    as empty; equal hashes go by the vector), fewer if there are fewer vectors. After each round a
    centroid is the floor of its vectors' mean; one without vectors stays. Rounds that would change
    nothing are not run. Other vectors are left out, without any there is nothing to return; repeated
    rows count as often as they occur. Integers beyond what squared distances in 64 bits allow raise a
    ``ValueError``: about 2**27 for 64 dimensions.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    kept, ints = integer_vectors(vectors, vector, scale, dims)
    rows = vectors.where(kept).select(F.col(id_col).alias("id"), ints.alias("ints"))
    largest = rows.agg(F.max(F.array_max(F.transform("ints", lambda x: F.abs(x.cast("double")))))).first()[0]
    if dims * (2 * (largest or 0)) ** 2 >= 2 ** 62:
        raise ValueError(f"a component of {largest:g} is too large for distances in 64 bits")
    blocks = scratch.save(pack(rows, dims, block), "blocks")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(hashed.alias("hash"), "ints").orderBy("hash", "ints").limit(k).collect()
    centroids = np.array([r["ints"] for r in first], np.int64).reshape(-1, dims)
    for _ in range(rounds if first else 0):
        before, centroids = centroids, _round(blocks, centroids)
        if (before == centroids).all():
            break
    if not first:
        return Clustering(rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids)
    assigned = scratch.save(_assign(blocks, centroids), "assigned")
    scratch.drop(blocks)
    return Clustering(assigned, centroids)


def describe(found: Clustering) -> DataFrame:
    """``id, cluster, distance``, the sum of distances over the vector's cluster (``cluster_inertia``) and
    over all (``inertia``), and ``centroid_sha256`` of the centroid's components joined by commas.

    What is joined to the vectors has one row per cluster, at most ``k``.
    """
    spark = found.assigned.sparkSession
    by_cluster = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in by_cluster.collect()}
    rows = [(c, total, sum(sums.values()),
             hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest())
            for c, total in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(facts), "cluster") \
        .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
