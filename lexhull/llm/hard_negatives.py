"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors are turned by a fixed isometry into BITS or more dimensions, and of each the signs are kept: its code. With the code go the
vector's length, the length of the code's vector turned back, and the alignment, the cosine of the two. A vector is then
its share along the code's vector plus a rest at a right angle to it, of known length; so the inner product with an anchor is the
anchor's product with the code's vector, scaled, give or take at most the product of both rests (Cauchy-Schwarz). The anchor's product with a
code is estimated by popcounts: the anchor's turned components are rounded to LEVELS bits, and each bit is one plane of a code.
What rounding loses is bounded by Cauchy-Schwarz, too. So every interval surely holds the product: rows whose interval can't
reach the result are left out, and the rest is scored in integers. The results are exact.

Anchors meet all rows in blocks: groups of ANCHORS anchors by BLOCK rows. Each meeting returns at most k rows
for each anchor (or anchor and positive), so what travels on grows with the number of blocks, not of rows.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut

#: Least bits of a code, bits of an anchor's turned components.
BITS, LEVELS = 256, 6
#: Rows of a block, anchors that meet it at once.
BLOCK, ANCHORS = 4096, 512
#: A vector's component becomes floor(UNIT * x).
UNIT = 256
#: A negative scores at least NEAR hundredths of the positive, and at most as much as it.
NEAR = 80


def isometry(dim: int) -> np.ndarray:
    """dim x bits, rows at right angles and of equal length 1: stacked random rotations."""
    rng, turns = np.random.default_rng(12), -(-max(BITS, dim) // dim)
    made = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(turns)]
    return np.concatenate(made, axis=1) / turns**0.5


class Codes:
    """One-bit codes of integer vectors, and what bounds their inner products."""

    def __init__(self, x: np.ndarray, to: np.ndarray):
        turned = x.astype(np.float64) @ to
        self.bits = turned.shape[1]
        signs = np.where(turned >= 0, 1.0, -1.0)
        back = signs @ to.T
        self.size, self.code_size = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)), np.sqrt((back * back).sum(axis=1))
        whole = self.size * self.code_size
        # rounding must not make an alignment of more than 1
        self.alignment = np.clip(np.divide((back * x).sum(axis=1), whole, out=np.zeros(len(x)), where=whole > 0), -1, 1)
        self.rest = np.sqrt(1 - self.alignment**2)
        packed = np.packbits(signs > 0, axis=1, bitorder="little")
        words = np.zeros((len(x), -(-packed.shape[1] // 8) * 8), np.uint8)
        words[:, : packed.shape[1]] = packed
        self.words = np.ascontiguousarray(words.view(np.uint64).T)

    def interval(self, q: np.ndarray, to: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) of the inner products of q with some rows."""
        q = q.astype(np.float64)
        turned, size = q @ to, float(np.sqrt((q * q).sum()))
        lowest, top = float(turned.min()), (1 << LEVELS) - 1
        step = max((float(turned.max()) - lowest) / top, 1e-300)
        level = np.clip(np.rint((turned - lowest) / step), 0, top).astype(np.int64)
        lost = turned - (lowest + step * level)
        words, total = self.words[:, rows], np.zeros(len(rows), np.int64)
        ones = np.bitwise_count(words).sum(axis=0, dtype=np.int64)
        for j in range(LEVELS):
            plane = np.packbits(level >> j & 1, bitorder="little")
            plane = np.pad(plane, (0, len(self.words) * 8 - len(plane))).view(np.uint64)
            total += np.bitwise_count(words & plane[:, None]).sum(axis=0, dtype=np.int64) << j
        with_code = lowest * (2 * ones - self.bits) + step * (2 * total - int(level.sum()))
        # the same vector as with_code, turned back: what the code's vector sees of the rounded anchor
        spread = float(np.sqrt((lost * lost).sum())) * np.sqrt(self.bits)
        along = np.divide(with_code, self.code_size[rows], out=np.zeros(len(rows)), where=self.code_size[rows] > 0)
        off = np.divide(spread, self.code_size[rows], out=np.zeros(len(rows)), where=self.code_size[rows] > 0)
        own, rest = self.size[rows], self.rest[rows]
        nearest = np.maximum(np.abs(along) - off, 0)
        across = np.sqrt(np.maximum(size * size - nearest * nearest, 0))
        middle, half = own * self.alignment[rows] * along, own * (np.abs(self.alignment[rows]) * off + rest * across)
        half = half + 1e-9 * size * own + 1e-6  # what floating point may lose
        return middle - half, middle + half


def products(x: np.ndarray, q: np.ndarray, sizes: float) -> np.ndarray:
    """Exact integer inner products; doubles hold them while they stay below 2**53."""
    if sizes < 2**52:
        return np.rint(x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return (x * q).sum(axis=1)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def unpacked(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) to (id, label, dimension, packed integer components); rows that take no part are left out."""
    for batch in batches:
        ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
        size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy().astype(np.int64)
        flat = vectors.flatten()
        x = np.floor(UNIT * flat.to_numpy(zero_copy_only=False).astype(np.float64)) if len(flat) else np.zeros(0)
        # a score must fit 64 bits
        limit = np.repeat(np.sqrt((2.0**63 - 1024) / np.maximum(size, 1)), size)
        ends = np.cumsum(size)
        odd = np.r_[0, np.cumsum(~(np.abs(x) <= limit))]  # nulls come as NaN
        good = (size > 0) & (odd[ends] == odd[ends - size]) & ids.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(good)
        packed = [x[ends[i] - size[i] : ends[i]].astype(np.int64).tobytes() for i in rows]
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays([ids.take(at), labels.take(at), pa.array(size[rows].astype(np.int32)), pa.array(packed, pa.binary())], names=["id", "label", "dim", "vec"])


class Held:
    """The rows of a block, with their codes."""

    def __init__(self, table: pa.Table, dim: int):
        self.ids, self.labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        self.x, self.to = unpacked(table.column("vec"), dim), isometry(dim)
        self.codes = Codes(self.x, self.to)
        self.most = float(self.codes.size.max(initial=0))
        self.scored = 0

    def score(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        self.scored += len(rows)
        return products(self.x[rows], q, self.most * float(np.sqrt((q.astype(np.float64) ** 2).sum())))

    def positives(self, qid: int, label: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best other rows of the label."""
        rows = np.flatnonzero((self.labels == label) & (self.ids != qid))
        if len(rows) > k:
            low, high = self.codes.interval(q, self.to, rows)
            rows = rows[high >= np.partition(low, len(low) - k)[len(low) - k]]
        score = self.score(rows, q)
        top = best(score, self.ids[rows], k)
        return self.ids[rows][top], score[top]

    def negatives(self, label: int, q: np.ndarray, goals: list[int], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each positive's score: (ids, scores) of the k best rows of other labels between NEAR hundredths of it and it."""
        rows = np.flatnonzero(self.labels != label)
        low, high = self.codes.interval(q, self.to, rows)
        for goal in goals:
            least, most = -(-NEAR * goal // 100), goal
            own = np.flatnonzero((high >= least) & (low <= most))
            # rows surely in range: what k of these surely reach, none below can take from them
            sure = low[own][(low[own] >= least) & (high[own] <= most)]
            if len(sure) > k:
                own = own[high[own] >= np.partition(sure, len(sure) - k)[len(sure) - k]]
            score = self.score(rows[own], q)
            within = np.flatnonzero((score >= least) & (score <= most))
            top = within[best(score[within], self.ids[rows[own[within]]], k)]
            yield self.ids[rows[own[top]]], score[top]


def meeting(dim: int, k: int, of_positives: bool) -> Callable:
    """Anchors (id, label, vec, and for negatives their positives) against one block."""

    def run(asked: pa.Table, table: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if asked.num_rows and table.num_rows:
            held = Held(table, dim)
            q = unpacked(asked.column("qvec"), dim)
            goals = asked.column("goals").to_pylist() if of_positives else [None] * len(q)
            for i, (qid, label, own) in enumerate(zip(asked.column("qid").to_pylist(), asked.column("qlabel").to_pylist(), goals)):
                if own is None:
                    found = [(-1, 0, *held.positives(qid, label, q[i], k))]
                else:
                    found = [(g["id"], g["score"], *f) for g, f in zip(own, held.negatives(label, q[i], [g["score"] for g in own], k))]
                for positive, goal, ids, score in found:
                    for column, values in zip(out, ([qid] * len(ids), [positive] * len(ids), [goal] * len(ids), ids.tolist(), score.tolist())):
                        column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor_id", "positive_id", "positive_score", "id", "score"])

    return run


FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def mine(vectors: DataFrame, anchors: Callable[[Column], Column], k: int = 5, negatives: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank int, negative_id, positive_score long, negative_score long) for the rows that are anchors.

    Components become floor(UNIT * x). An anchor's positives are the k other rows of its label of highest integer inner
    product; each one's negatives are the first rows of other labels that score between NEAR hundredths of the positive and the positive. Higher
    scores come first, ties by smaller id. The result is exact (see the module). anchors makes a condition of the id column.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part, nor do vectors of another
    length than the commonest, which have no product with the others, and vectors whose components are so large (3e9 / UNIT and more over the root of
    their number) that a score wouldn't fit a long. Zero vectors do take part. Rows that repeat an id are one row, the one of smallest label, then
    smallest packed vector. Labels must be integers; other columns are ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    packed = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vec_col}`").alias("v")).mapInArrow(pack, "id long, label long, dim int, vec binary")
    packed = cut(packed.groupBy("id").agg(F.min(F.struct("label", "dim", "vec")).alias("r")).select("id", "r.*"))
    sizes = packed.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim, n = sizes["dim"], sizes["count"]
    blocks = max(1, -(-n // BLOCK))
    rows = packed.filter(F.col("dim") == dim).select("id", "label", "vec")
    held = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asking = rows.filter(anchors(F.col("id"))).select(F.col("id").alias("qid"), F.col("label").alias("qlabel"), F.col("vec").alias("qvec"))
    groups = max(1, -(-asking.count() // ANCHORS))
    asking = asking.withColumn("grp", F.pmod(F.xxhash64("qid", F.lit(1)), F.lit(groups)).cast("int"))

    def met(asked: DataFrame, of_positives: bool, most: int) -> DataFrame:
        ours = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        theirs = held.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("block", F.col("grp").alias("g"), "id", "label", "vec")
        found = ours.groupBy("b", "grp").cogroup(theirs.groupBy("block", "g")).applyInArrow(meeting(dim, most, of_positives), FOUND)
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    near = met(asking, False, k).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("goals"))
    asked = cut(asking.join(near.withColumnRenamed("anchor_id", "qid"), "qid"))
    return met(asked, True, negatives).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
