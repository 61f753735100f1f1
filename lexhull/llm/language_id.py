"""Language identification by a byte convolutional network trained in numpy.

Texts are cut into windows of WINDOW bytes. Filters of several widths run over the bytes, each
filter keeps its largest response in the window, and a softmax layer turns these into a
probability per language. A convolution over bytes is a sum of table rows, one table for each
place in the filter, so applying the network to a window is a few gathers and a maximum. The
windows of a text cover all of it; their log-probabilities, weighted by length, are averaged.

The network is trained on the driver, on all windows of a sample of labelled rows: those of smallest id hash, at most
TRAIN_ROWS of them and with at most TRAIN_WINDOWS windows; everything else runs over all rows on the workers.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import cut, hash_sample, row_key, without

WINDOW = 256
#: Widths of the filters and filters of each width.
WIDTHS, FILTERS = (2, 3, 4), 16
#: Bounds of the training sample: rows, and windows of all of them together.
TRAIN_ROWS, TRAIN_WINDOWS = 4000, 1 << 17
STEPS, BATCH, RATE = 600, 128, 0.01
UNKNOWN = "und"
#: Fixed value: digits, punctuation and white space of ASCII all look the same to the network, and case is folded.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123] = np.arange(1, 27)
CLASS[65:91] = np.arange(1, 27)
CLASS[128:256] = np.arange(27, 155)
CLASSES = 155


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x WINDOW byte classes, row, bytes held) covering all bytes of all rows; the last of a row is padded."""
    sizes = np.diff(offsets)
    each = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), each)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    start = offsets[:-1][row] + nth * WINDOW
    held = np.minimum(sizes[row] - nth * WINDOW, WINDOW)
    at = start[:, None] + np.arange(WINDOW)
    out = CLASS[data[np.minimum(at, max(len(data) - 1, 0))]] if len(data) else np.zeros((0, WINDOW), np.uint8)
    out[np.arange(WINDOW) >= held[:, None]] = 0
    return out, row, held


class Network:
    """Multi-width byte filters, the maximum over a window, and a softmax layer."""

    def __init__(self, labels: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def pooled(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """(largest response of each filter, on demand the places of these)."""
        best, places = [], []
        for w, table in zip(WIDTHS, self.tables):
            n = x.shape[1] - w + 1
            total = np.take(table[0], x[:, :n], axis=0)
            for j in range(1, w):
                total += np.take(table[j], x[:, j : j + n], axis=0)
            if where:
                at = total.argmax(axis=1)
                places.append(at)
                best.append(np.take_along_axis(total, at[:, None], axis=1)[:, 0])
            else:
                best.append(total.max(axis=1))
        return np.concatenate(best, axis=1), places

    def log_probabilities(self, x: np.ndarray, part: int = 64) -> np.ndarray:
        made = [np.maximum(self.pooled(x[i : i + part])[0], 0) @ self.out + self.bias for i in range(0, len(x), part)]
        z = np.concatenate(made) if made else np.zeros((0, len(self.labels)), np.float32)
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 2) -> None:
        """Adam on the cross-entropy, classes drawn evenly."""
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        params = [*self.tables, self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, STEPS + 1):
            kinds = rng.integers(0, len(by), BATCH)
            pick = np.array([by[k][rng.integers(len(by[k]))] for k in kinds])
            xb = x[pick]
            h, places = self.pooled(xb, True)
            a = np.maximum(h, 0)
            z = a @ self.out + self.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(BATCH), kinds] -= 1
            p /= BATCH
            grads = [np.zeros_like(t) for t in self.tables] + [a.T @ p, p.sum(axis=0)]
            back = (p @ self.out.T) * (h > 0)
            for i, (w, at) in enumerate(zip(WIDTHS, places)):
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(w):
                    np.add.at(grads[i][j], (xb[np.arange(BATCH)[:, None], at + j], np.arange(FILTERS)[None, :]), own)
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for q, g, m, s in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)


def all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, window) for each window of each text."""
    for piece in tb.pieces(batches, 1):
        x, row, _ = windows(*tb.column_bytes(piece.column(1)))
        yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(row)), pa.array([w.tobytes() for w in x], pa.binary())], names=["y", "x"])


def learn(labelled: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = TRAIN_ROWS, most: int = TRAIN_WINDOWS) -> Network | None:
    """A network trained on a sample of the labelled rows with a letter; None without any.

    The sample takes rows by their id hash, `rows` at most, and leaves out those that would bring it above `most` windows; what is taken is
    learnt from as a whole, every window of it. Rows that repeat are learnt from once, rows with a null id not at all.
    """
    labelled = labelled.filter(F.col(label_col).isNotNull())
    keys = [F.col(id_col).alias("i"), row_key(id_col, text_col).alias("k"), F.col(label_col).cast("string").alias("y")]
    held = labelled.filter(F.col(text_col).rlike(r"\p{L}")).select(*keys, F.ceil(F.octet_length(text_col) / WINDOW).cast("long").alias("n"))
    # one small row for each of the rows of the sample
    sample = hash_sample(held, "i", rows, labelled.count()).distinct().withColumn("h", F.xxhash64("i", "k", "y")).orderBy("h", "k", "y").collect()
    taken, total = [], 0
    for r in sample:
        if r["i"] is not None and total + r["n"] <= most:
            taken.append((r["i"], r["k"], r["y"]))
            total += r["n"]
    if not taken:
        return None
    kinds = {f.name: f.dataType.simpleString() for f in held.schema.fields}
    chosen = labelled.sparkSession.createDataFrame(taken, ", ".join(f"{c} {kinds[c]}" for c in ("i", "k", "y")))
    texts = labelled.select(*keys, F.col(text_col).alias("x")).join(F.broadcast(chosen), ["i", "k", "y"]).dropDuplicates(["i", "k", "y"])
    drawn = texts.select("y", "x").mapInArrow(all_windows, "y string, x binary").toArrow()
    if not drawn.num_rows:
        return None
    # in an order that doesn't depend on the tasks
    label, bytes_ = drawn.column("y").to_pylist(), drawn.column("x").to_pylist()
    labels = sorted(set(label))
    number = np.array([labels.index(y) for y in label])
    x = np.frombuffer(b"".join(bytes_), np.uint8).reshape(-1, WINDOW)
    order = np.lexsort((*x.view(">u8").T[::-1], number))
    network = Network(labels)
    if len(labels) > 1:
        network.train(x[order], number[order])
    return network


def identify(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = TRAIN_ROWS) -> DataFrame:
    """Input columns plus lang_pred string and score double (0 to 1).

    train tells which rows may be learnt from; null labels never are. score is the mean
    probability of the predicted label over the text's windows, each weighted by its bytes.
    Only the text enters a prediction. Null texts and texts without a letter, and all texts when
    nothing was learnt, give 'und' and 0. Equal scores go to the label first in alphabetical
    order. Repeated rows are each returned; input columns named lang_pred or score are replaced.
    """
    network = learn(docs.filter(train), id_col, text_col, label_col, rows)
    kept = without(docs, "lang_pred", "score")
    at = len(kept.columns)
    frame = kept.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)], F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    text = [c.lower() for c in kept.columns].index(text_col.lower())
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)], "lang_pred string, score double"])
    sent = docs.sparkSession.sparkContext.broadcast(network and (network.labels, network.tables, network.out, network.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        if sent.value:
            own = Network(sent.value[0])
            own.labels, own.tables, own.out, own.bias = sent.value
        for piece in tb.pieces(batches, text):
            m = piece.num_rows
            name, score = np.full(m, UNKNOWN, object), np.zeros(m)
            if own:
                data, offsets = tb.column_bytes(piece.column(text))
                x, row, held = windows(data, offsets)
                logs = own.log_probabilities(x)
                share = held[:, None] / np.maximum(np.diff(offsets)[row], 1)[:, None]
                total, mean = np.zeros((m, len(own.labels))), np.zeros((m, len(own.labels)))
                for k in range(len(own.labels)):
                    total[:, k] = np.bincount(row, logs[:, k] * share[:, 0], minlength=m)
                    mean[:, k] = np.bincount(row, np.exp(logs[:, k]) * share[:, 0], minlength=m)
                best = total.argmax(axis=1)
                lettered = np.asarray(piece.column(at))
                name = np.where(lettered, np.array(own.labels, object)[best], UNKNOWN)
                score = np.where(lettered, np.clip(mean[np.arange(m), best], 0, 1), 0)
            yield pa.RecordBatch.from_arrays([*piece.columns[:at], pa.array(list(name), pa.string()), pa.array(score, pa.float64())], names=[*[f"c{i}" for i in range(at)], "lang_pred", "score"])

    return frame.mapInArrow(run, schema).toDF(*kept.columns, "lang_pred", "score")
