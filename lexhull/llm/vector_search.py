"""Nearest neighbours by stable projections, kd-trees and a chi-square stopping test.

Unit vectors are projected by a Gaussian matrix to PROJECTED dimensions. For two vectors at
distance d, the squared projected distance over d*d follows a chi-square distribution. So vectors are
compared in full in the order of their projected distance, and once that lies beyond d_k, the k-th distance
found so far, times the root of the CONFIDENCE quantile, the search stops: a vector as near as the k-th
would have come up before with that probability, and a nearer one with a larger one.

A kd-tree fitted on a bounded sample deals all vectors out to cells, and large cells are split
into blocks by hash, so that many equal vectors do not gather in one task. A query first searches
one block of its own cell; the k-th distance found there bounds the cells that it must visit.
Inside a block, a kd-tree yields the projected neighbours leaf by leaf.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut, hash_sample

PROJECTED = 32
CONFIDENCE = 0.92
#: Rows that fit the tree of cells, rows of a block, queries that meet a block at once, cells at most, rows of a leaf.
SAMPLE, BLOCK, QUERIES, MOST_CELLS, LEAF = 16384, 16384, 512, 2048, 256


def chi_square_quantile(p: float, m: int) -> float:
    """Wilson and Hilferty's approximation."""
    return m * (1 - 2 / (9 * m) + NormalDist().inv_cdf(p) * (2 / (9 * m)) ** 0.5) ** 3


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of packed floats or doubles as doubles, each scaled by a power of two to components of at most 1.

    The scale leaves cosines as they are and keeps squares of very large or small components in range.
    """
    packed = b"".join(column.to_pylist())
    width = len(packed) // (dim * max(len(column), 1))
    x = np.frombuffer(packed, np.float32 if width == 4 else np.float64).astype(np.float64).reshape(-1, dim)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def norms(x: np.ndarray) -> np.ndarray:
    # a sum along contiguous rows gives equal rows equal results, wherever they stand
    return np.sqrt((x * x).sum(axis=1))


def projection(dim: int, m: int) -> np.ndarray:
    return np.random.default_rng(20).normal(size=(dim, m))


def projected(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return (x / norms(x)[:, None]) @ to


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) to (id, dimension, packed components) of the vectors that can have a cosine."""
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy().astype(np.int64)
        flat = vectors.flatten()
        x = flat.to_numpy(zero_copy_only=False)
        kind = np.float32 if pa.types.is_float32(flat.type) else np.float64
        ends = np.cumsum(size)
        # nulls come as NaN
        odd = np.r_[0, np.cumsum(~np.isfinite(x.astype(np.float64)))]
        filled = np.r_[0, np.cumsum(x != 0)]
        good = (size > 0) & (odd[ends] == odd[ends - size]) & (filled[ends] > filled[ends - size]) & ids.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(good)
        x = x.astype(kind)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(size[rows].astype(np.int32)), pa.array([x[ends[i] - size[i] : ends[i]].tobytes() for i in rows], pa.binary())], names=["id", "dim", "vec"])


def splits(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """A balanced kd-tree as a heap: node i splits an axis at a value, its children are 2i+1 and 2i+2."""
    tree = [(0, np.inf)] * ((1 << depth) - 1)
    work = [(0, points)]
    while work:
        node, own = work.pop()
        if node < len(tree):
            if len(own) > 1:
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                tree[node] = (axis, float(np.median(own[:, axis])))
            axis, at = tree[node]
            low = own[:, axis] < at
            work += [(2 * node + 1, own[low]), (2 * node + 2, own[~low])]
    return tree


def cells_of(points: np.ndarray, tree: list[tuple[int, float]], depth: int) -> np.ndarray:
    axis, at = np.array([a for a, _ in tree] or [0]), np.array([v for _, v in tree] or [0.0])
    node = np.zeros(len(points), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] >= at[node])
    return node - ((1 << depth) - 1)


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree over the points."""
    out, work = [], [np.arange(len(points))]
    while work:
        own = work.pop()
        if len(own) <= size:
            if len(own):
                out.append(own)
            continue
        x = points[own]
        axis = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
        order = np.argpartition(x[:, axis], len(own) // 2)
        work += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return out


class Block:
    """Vectors with a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, to: np.ndarray):
        self.ids, self.x, self.size, self.p = ids, x, norms(x), projected(x, to)
        self.parts = leaves(self.p)
        self.low, self.high = np.array([self.p[i].min(axis=0) for i in self.parts]), np.array([self.p[i].max(axis=0) for i in self.parts])
        self.compared = 0

    def scores(self, rows: np.ndarray, q: np.ndarray, q_size: float) -> np.ndarray:
        return (self.x[rows] * q).sum(axis=1) / (self.size[rows] * q_size)

    def search(self, qid: int, q: np.ndarray, q_size: float, at: np.ndarray, k: int, bound: float, limit: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of the block for a query, best first; bound is the squared distance of the k-th known elsewhere."""
        near = (np.maximum(np.maximum(self.low - at, at - self.high), 0) ** 2).sum(axis=1)
        order, best = np.argsort(near), np.zeros(0, np.int64)
        place, step = 0, 1
        reach = lambda: bound * limit * (1 + 1e-9) + 1e-12
        while place < len(order) and near[order[place]] <= reach():
            own = np.concatenate([self.parts[j] for j in order[place : place + step]])
            place, step = place + step, step * 2
            far = ((self.p[own] - at) ** 2).sum(axis=1)
            some = np.flatnonzero((far <= reach()) & (self.ids[own] != qid))
            some = some[np.argsort(far[some], kind="stable")]
            own, far, start, chunk = own[some], far[some], 0, 64
            while start < len(own) and far[start] <= reach():  # else the chi-square test holds
                rows = own[start : start + chunk]
                start, chunk = start + chunk, chunk * 2
                self.compared += len(rows)
                rows = np.r_[best, rows]
                score = self.scores(rows, q, q_size)
                ranked = np.lexsort((self.ids[rows], -score))
                rows, score = rows[ranked], score[ranked]
                # of rows that repeat an id the best stands first
                first = np.sort(np.unique(self.ids[rows], return_index=True)[1])[:k]
                best = rows[first]
                if len(best) == k:
                    bound = min(bound, max(0.0, 2 - 2 * score[first[-1]]))
        return self.ids[best], self.scores(best, q, q_size)


def searcher(dim: int, m: int, k: int, limit: float) -> Callable:
    """Queries (qid, qvec, bound) against the vectors (id, vec) of one block: the k best of the block for each query."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if asked.num_rows and held.num_rows:
            to = projection(dim, m)
            block = Block(held.column("id").to_numpy(), matrix(held.column("vec").combine_chunks(), dim), to)
            q = matrix(asked.column("qvec").combine_chunks(), dim)
            q_size, q_at = norms(q), projected(q, to)
            for i, (qid, bound) in enumerate(zip(asked.column("qid").to_pylist(), asked.column("bound").to_pylist())):
                ids, score = block.search(qid, q[i], q_size[i], q_at[i], k, bound, limit)
                found[0].extend([qid] * len(ids))
                found[1].extend(ids.tolist())
                found[2].extend(score.tolist())
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, asks: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", m: int = PROJECTED, confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by cosine of each row that asks.

    asks makes a condition of the id column. A query's candidates are all rows of another id; fewer
    than k candidates are all returned; ties go to the smaller id. Vectors that are null, empty,
    zero or hold null or non-finite components, and null ids take no part; nor do vectors of another
    length than the commonest, which have no cosine with the others. Any other vector does, however
    long, large or small its components. Rows that repeat an id count as one candidate, with the best of
    their scores. Other input columns are ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    packed = cut(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).mapInArrow(pack, "id long, dim int, vec binary"))
    sizes = packed.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    dim, n = sizes["dim"], sizes["count"]
    packed = packed.filter(F.col("dim") == dim).select("id", "vec")
    sample = hash_sample(packed, "id", SAMPLE, n).toArrow()
    to = projection(dim, m)
    depth = 0
    while (BLOCK << depth) < n and (1 << depth) < min(MOST_CELLS, sample.num_rows // 8):
        depth += 1
    tree = splits(projected(matrix(sample.column("vec").combine_chunks(), dim), to), depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = projection(dim, m)
        for batch in batches:
            if batch.num_rows:
                p = projected(matrix(batch.column(1), dim), to)
                points = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, m, dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells_of(p, tree, depth).astype(np.int32)), points], names=["id", "vec", "cell", "point"])

    placed = cut(packed.mapInArrow(place, "id long, vec binary, cell int, point array<double>"))
    point = [F.get("point", F.lit(i)) for i in range(m)]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.array(*[F.min(c) for c in point]).alias("low"), F.array(*[F.max(c) for c in point]).alias("high")).toArrow()  # one row for each of MOST_CELLS at most
    cell = boxes.column("cell").to_numpy()
    blocks = np.maximum(1, -(-boxes.column("n").to_numpy() // BLOCK))
    low, high = np.array(boxes.column("low").to_pylist()), np.array(boxes.column("high").to_pylist())
    limit = chi_square_quantile(confidence, m)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(qid, qvec, point, bound) to one row for each cell that may hold a nearer vector."""
        for batch in batches:
            if not batch.num_rows:
                continue
            q = np.array(batch.column(2).to_pylist()).reshape(-1, m)
            bound = batch.column(3).to_numpy(zero_copy_only=False)
            for start in range(0, len(q), 64):
                own = q[start : start + 64, None, :]
                near = (np.maximum(np.maximum(low[None] - own, own - high[None]), 0) ** 2).sum(axis=2)
                row, at = np.nonzero(near <= bound[start : start + 64, None] * limit * (1 + 1e-9) + 1e-12)
                pick = pa.array(row + start)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), batch.column(3).take(pick), pa.array(cell[at].astype(np.int32))], names=["qid", "qvec", "bound", "cell"])

    n_blocks = spark.createDataFrame([(int(c), int(b)) for c, b in zip(cell, blocks)], "cell int, blocks int")
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    held = placed.join(F.broadcast(n_blocks), "cell").select("cell", block.alias("block"), "id", "vec")
    queries = placed.filter(asks(F.col("id"))).select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), "cell", "point")

    def search(asked: DataFrame) -> DataFrame:
        """asked: (qid, qvec, bound, cell, block). Many queries of a block are parted, the block repeated."""
        loads = asked.groupBy("cell", "block").count().select("cell", "block", F.ceil(F.col("count") / QUERIES).cast("int").alias("shares"))
        loads = cut(loads)
        ours = asked.join(loads, ["cell", "block"]).withColumn("share", F.pmod(F.xxhash64("qid"), F.col("shares")).cast("int"))
        theirs = held.join(loads, ["cell", "block"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        keys = ["cell", "block", "share"]
        ours = ours.select(*keys, "qid", "qvec", "bound").toDF("c", "b", "s", "qid", "qvec", "bound")
        theirs = theirs.select(*keys, "id", "vec").toDF(*keys, "id", "vec")
        return ours.groupBy("c", "b", "s").cogroup(theirs.groupBy(*keys)).applyInArrow(searcher(dim, m, k, limit), "query_id long, vec_id long, score double")

    home = queries.join(F.broadcast(n_blocks), "cell").select("qid", "qvec", F.lit(4.0).alias("bound"), "cell", F.pmod(F.xxhash64("qid", F.lit(1)), F.col("blocks")).cast("int").alias("block"))
    first = search(home).groupBy("query_id").agg(F.when(F.count("*") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))).otherwise(4.0).alias("bound"))
    bounded = queries.join(first.withColumnRenamed("query_id", "qid"), "qid", "left").select("qid", "qvec", "point", F.coalesce("bound", F.lit(4.0)).alias("bound"))
    routed = bounded.mapInArrow(visits, "qid long, qvec binary, bound double, cell int")
    routed = cut(routed.join(F.broadcast(n_blocks), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))
    best = search(routed).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

