"""Exact top-k by inner product, as a Voronoi join of queries with data.

Some vectors serve as pivots. Queries and data go to the cell of their nearest pivot, and the cells are
summed up: of its queries the number, the radius and the shortest and longest vector; of its data the
``k + 1`` vectors nearest to the pivot. As 2 q.s = |q|^2 + |s|^2 - |q - s|^2, a distance bounds a score:

- a query of cell i is no further from such a vector than the cell's radius, the way between the two
  pivots and that vector's distance to its own pivot together. The (k+1)-th best of the scores this
  grants is a score that k candidates of every query of the cell reach (one of k + 1 may be the query
  itself);
- a vector cannot score better with any query of the cell than its distance to pivot i less the radius
  allows. If that is below the cell's bound, no query of the cell needs it.

Cells near each other form groups of queries, and a vector is copied to a group only if one of its cells
needs it. Each task then compares at most about ``block`` queries of one group with at most about
``block`` vectors: a cell with many queries is dealt over several subgroups and the vectors a group
needs over several parts, so a cell that holds a third of all rows is no burden. The parts' best are
merged by score; only ``k`` rows for each query and part are shuffled.

Only the summaries, a bounded number of rows for each pivot, pass through the driver. In many
dimensions without clusters the bounds spare little and nearly all vectors are needed by all groups;
the result is exact either way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import Scratch
from .vectors import integer_vectors, matrix

K = 20
SCALE = 64
PIVOTS = 64
#: Queries of a subgroup and vectors of a part.
BLOCK = 8192
#: Scores held at once.
CELLS = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _spread(rows: np.ndarray, n: int) -> np.ndarray:
    """Row numbers dealt evenly over n."""
    return ((rows.astype(np.uint64) * _MIX) >> np.uint64(33)).astype(np.int64) % n


# --- cells and bounds ------------------------------------------------------------------------------

def to_pivots(column: pa.Array, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner products with all pivots, distances to them, and the squared lengths of the vectors."""
    found, squares = matrix(column, pivots.shape[1])
    dots = found @ pivots.T
    away = squares[:, None] - 2 * dots + (pivots ** 2).sum(axis=1)
    return dots, np.sqrt(np.maximum(away, 0)), squares


def _least(cells: np.ndarray, away: np.ndarray, squares: np.ndarray, k: int) -> tuple:
    """Of each cell the k vectors nearest to the pivot."""
    order = np.lexsort((away, cells))
    cells, away, squares = cells[order], away[order], squares[order]
    first = np.searchsorted(cells, cells, side="left")
    kept = np.arange(len(cells)) - first < k
    return cells[kept], away[kept], squares[kept]


def with_cells(queries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the ``cell`` of the nearest pivot, the distance ``away`` and the squared length ``square``."""
    schema = StructType([*queries.schema.fields, StructField("cell", IntegerType()),
                         StructField("away", DoubleType()), StructField("square", DoubleType())])

    def run(batches):
        for batch in batches:
            _, away, squares = to_pivots(batch.column("ints"), pivots)
            cell = away.argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away[np.arange(len(cell)), cell]), pa.array(squares)],
                schema.names)

    return queries.mapInArrow(run, schema)


def nearest_data(rows: DataFrame, pivots: np.ndarray, k: int) -> list:
    """``cell, away, square`` of the ``k`` vectors of each cell that are nearest to its pivot."""
    def run(batches):
        near = (np.zeros(0, np.int32), np.zeros(0), np.zeros(0))
        for batch in batches:
            _, away, squares = to_pivots(batch.column(0), pivots)
            cell = away.argmin(axis=1).astype(np.int32)
            new = (cell, away[np.arange(len(cell)), cell], squares)
            near = _least(*(np.concatenate(x) for x in zip(near, new)), k)
        yield pa.RecordBatch.from_arrays(list(map(pa.array, near)), ["cell", "away", "square"])

    rank = F.row_number().over(W.partitionBy("cell").orderBy("away", "square"))
    near = rows.select("ints").mapInArrow(run, "cell int, away double, square double")
    return [tuple(r)[:3] for r in near.withColumn("rank", rank).where(F.col("rank") <= k).collect()]


@dataclass
class Plan:
    """What decides where rows go, of a size that depends on the number of pivots only.

    ``cells``: the cells that hold queries; ``radius, most, bound``: their radius, longest squared length
    and the score below which a vector is of no use; ``group``: their group; ``subgroups``: by group."""

    pivots: np.ndarray
    cells: np.ndarray
    radius: np.ndarray
    most: np.ndarray
    bound: np.ndarray
    group: np.ndarray
    subgroups: np.ndarray

    def needed(self, column: pa.Array) -> np.ndarray:
        """Vectors by groups: whether a query of the group can need the vector."""
        dots, away, squares = to_pivots(column, self.pivots)
        dots, away = dots[:, self.cells], away[:, self.cells]
        by_distance = (self.most + squares[:, None] - np.maximum(away - self.radius, 0) ** 2) / 2
        by_product = dots + self.radius * np.sqrt(squares)[:, None]
        best = np.minimum(by_distance, by_product)
        # rounding of these sums stays far below one part in a million
        some = best >= self.bound - 1 - 1e-6 * (np.abs(best) + self.most + squares[:, None])
        out = np.zeros((len(some), len(self.subgroups)), bool)
        for i, group in enumerate(self.group):
            out[:, group] |= some[:, i]
        return out


def make_plan(pivots: np.ndarray, queries: list, near: list, k: int, block: int) -> Plan:
    """Bounds for each cell with queries, and groups of neighbouring cells of up to ``block`` queries."""
    cells, counts, radius, least, most = (np.array(x) for x in zip(*queries))
    at, away, squares = (np.array(x) for x in zip(*near))
    lengths = np.sqrt((pivots ** 2).sum(axis=1))
    bound = np.full(len(cells), -np.inf)
    for i, cell in enumerate(cells):
        between = np.sqrt(((pivots[at] - pivots[cell]) ** 2).sum(axis=1))
        by_distance = (least[i] + squares - (radius[i] + between + away) ** 2) / 2
        by_product = pivots[at] @ pivots[cell] - lengths[cell] * away - radius[i] * (lengths[at] + away)
        granted = np.sort(np.maximum(by_distance, by_product))[::-1]
        if len(granted) > k:
            bound[i] = granted[k]
    group, subgroups, left = np.zeros(len(cells), np.int64), [], 0
    todo = list(range(len(cells)))
    here = todo[0]
    while todo:
        # a chain from each cell to the nearest one left
        here = min(todo, key=lambda i: ((pivots[cells[i]] - pivots[cells[here]]) ** 2).sum())
        todo.remove(here)
        if not subgroups or counts[here] > left:
            subgroups.append(-(-int(counts[here]) // block))
            left = subgroups[-1] * block
        group[here] = len(subgroups) - 1
        left -= counts[here]
    return Plan(pivots, cells, radius, most, bound, group, np.array(subgroups))


# --- replication -----------------------------------------------------------------------------------

def _copies(rows: DataFrame, route) -> DataFrame:
    """Rows with the task that is to get them, as often as ``route`` says: for a batch it yields the places
    of rows with their ``grp``, ``sub`` and ``part``."""
    schema = StructType([StructField(c, LongType()) for c in ("grp", "sub", "part")] + rows.schema.fields)

    def run(batches):
        for batch in batches:
            for places, *target in route(batch):
                if len(places):
                    some = batch.take(pa.array(places))
                    key = [pa.array(np.broadcast_to(t, len(places)).astype(np.int64)) for t in target]
                    yield pa.RecordBatch.from_arrays([*key, *some.columns], schema.names)

    return rows.mapInArrow(run, schema)


def copy_data(rows: DataFrame, plan: Plan, parts: np.ndarray) -> DataFrame:
    """Each vector to every subgroup of the groups that can need it, in one of the group's parts."""
    def route(batch):
        needed, row = plan.needed(batch.column("ints")), batch.column("row").to_numpy()
        for group, subgroups in enumerate(plan.subgroups):
            places = np.flatnonzero(needed[:, group])
            for sub in range(subgroups):
                yield places, group, sub, _spread(row[places], parts[group])
    return _copies(rows, route)


def copy_queries(queries: DataFrame, plan: Plan, parts: np.ndarray) -> DataFrame:
    """Each query to all parts of its subgroup."""
    group_of = np.full(len(plan.pivots), -1)
    group_of[plan.cells] = plan.group

    def route(batch):
        group = group_of[batch.column("cell").to_numpy()]
        row = batch.column("row").to_numpy()
        for g in np.unique(group):
            places = np.flatnonzero(group == g)
            for part in range(parts[g]):
                yield places, g, _spread(row[places], plan.subgroups[g]), part
    return _copies(queries, route)


def count_needed(rows: DataFrame, plan: Plan) -> np.ndarray:
    """How many vectors each group needs."""
    n = len(plan.subgroups)

    def run(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            total += plan.needed(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], ["grp", "n"])

    out = np.zeros(n, np.int64)
    for group, total in rows.select("ints").mapInArrow(run, "grp long, n long").groupBy("grp").agg(F.sum("n")).collect():
        out[group] = total
    return out


# --- the local join --------------------------------------------------------------------------------

def best_of(queries: np.ndarray, query_rows: np.ndarray, data: np.ndarray, data_rows: np.ndarray, k: int) -> tuple:
    """For each query the places of its ``k`` best rows of ``data``, which is in the order of ties, and their
    scores; the query's own row left out. Places and scores of missing ones are -1 and 0."""
    n, m = len(queries), len(data)
    exact = queries.astype("f8")
    largest = np.sqrt((exact ** 2).sum(axis=1).max() * (data.astype("f8") ** 2).sum(axis=1).max())
    if largest < 2 ** 52:  # whole numbers that a double holds exactly
        queries, data = exact, data.astype("f8")
    k = min(k, m)
    places, scores = np.empty((n, k), np.int64), np.empty((n, k), np.int64)
    own_order = np.argsort(data_rows)
    step, shift = max(1, CELLS // m), max(1, (m - 1).bit_length())
    for at in range(0, n, step):
        found = (queries[at:at + step] @ data.T).astype(np.int64)
        spot = np.searchsorted(data_rows, query_rows[at:at + step], sorter=own_order)
        own = own_order[np.minimum(spot, m - 1)]
        is_own = data_rows[own] == query_rows[at:at + step]
        line = np.arange(len(found))
        if largest < 2 ** (61 - shift):
            # score and place in one number: all differ, and ties go to the earlier row
            key = (found << shift) - np.arange(m)
            key[line[is_own], own[is_own]] = np.iinfo(np.int64).min
            top = np.argpartition(key, m - k, axis=1)[:, m - k:]
            order = np.argsort(np.take_along_axis(key, top, 1), axis=1)[:, ::-1]
            top = np.take_along_axis(top, order, 1)
        else:
            top = np.empty((len(found), k), np.int64)
            for i in line:
                order = np.lexsort((np.arange(m), -found[i]))
                if is_own[i]:
                    order = np.append(order[order != own[i]], own[i])
                top[i] = order[:k]
        own_found = is_own[:, None] & (top == own[:, None])
        places[at:at + step] = np.where(own_found, -1, top)
        scores[at:at + step] = np.where(own_found, 0, np.take_along_axis(found, top, 1))
    return places, scores


def _solve(k: int, schema: StructType):
    names = schema.names

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not (queries.num_rows and data.num_rows):
            return pa.table([pa.array([], t) for t in (pa.int64(), *[data.schema.field("id").type] * 2, pa.int64())], names)
        data = data.take(pc.sort_indices(data, sort_keys=[("id", "ascending")], null_placement="at_end"))
        asked, held = (t.column("ints").combine_chunks() for t in (queries, data))
        width = int(pc.max(pc.list_value_length(asked)).as_py())
        places, scores = best_of(
            matrix(asked, width, "i8")[0], queries.column("row").to_numpy(),
            matrix(held, width, "i8")[0], data.column("row").to_numpy(), k)
        at, column = np.nonzero(places >= 0)
        return pa.table([queries.column("row").take(pa.array(at)), queries.column("id").take(pa.array(at)),
                         data.column("id").take(pa.array(places[at, column])), pa.array(scores[at, column])], names)
    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", query: Column | None = None,
          k: int = K, scale: float = SCALE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` best rows for each query by the inner product of the integers
    ``floor(scale * x)``, all if there are fewer; ties go to the smaller id, null ids last.

    ``query`` tells which rows ask (default: ids divisible by 20); a null id does not. Every other row
    is a candidate, also one with an id or vector equal to the query's. Null vectors and those with a null
    or non-finite component take no part. Components that one of two vectors does not have count as
    zero. Integers whose squares add up to 2**62 or more in one vector raise a ``ValueError``, as scores
    would not fit 64 bits. Other columns of ``vectors`` are left out.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "voronoi")
    kept, ints = integer_vectors(vectors, vector, scale)
    asks = F.col(id_col) % 20 == 0 if query is None else query
    rows = scratch.save(vectors.where(kept).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(asks, F.lit(False)).alias("is_query"), ints.alias("ints")), "vectors")
    id_type = rows.schema["id"].dataType
    schema = StructType([StructField("query_row", LongType()), StructField("query_id", id_type),
                         StructField("id", id_type), StructField("score", LongType())])
    length = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = rows.agg(F.max(length)).first()[0]
    if (longest or 0) >= 2 ** 62:
        raise ValueError("a vector is too long for scores in 64 bits")
    drawn = rows.orderBy(F.xxhash64(F.col("ints"), F.lit(13)), "row").select("ints").limit(pivots).collect()
    chosen = list(dict.fromkeys(tuple(r["ints"]) for r in drawn))
    found = spark.createDataFrame([], schema)
    if chosen:
        width = max(map(len, chosen)) or 1
        centres = np.array([c + (0,) * (width - len(c)) for c in chosen], "f8")
        queries = scratch.save(with_cells(rows.where("is_query").select("row", "id", "ints"), centres), "queries")
        cells = [tuple(r) for r in queries.groupBy("cell").agg(
            F.count("*"), F.max("away"), F.min("square"), F.max("square")).collect()]
        if cells:
            plan = make_plan(centres, cells, nearest_data(rows, centres, k + 1), k, block)
            parts = np.maximum(1, -(-count_needed(rows, plan) // block))
            key = ("grp", "sub", "part")
            found = copy_queries(queries, plan, parts).groupBy(*key) \
                .cogroup(copy_data(rows.select("row", "id", "ints"), plan, parts).groupBy(*key)) \
                .applyInArrow(_solve(k, schema), schema)
    order = W.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "id", "score")
