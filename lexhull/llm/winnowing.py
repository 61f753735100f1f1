"""Benchmark decontamination by winnowing.

Each text is reduced to the smallest hash of every run of GRAMS_IN_VIEW consecutive k-word
grams. A run of `window` shared words always holds one fingerprint in common, so only windows
around a shared fingerprint are extended: their words are compared in full with the windows of
the benchmark. Items shorter than a window are looked up whole, by their own length.

The fingerprints of the benchmark reach the workers as a Bloom filter of bounded size, which
only saves work; what passes it is joined with the benchmark's windows, broadcast while these
are few and shuffled otherwise.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import cut, row_key, without

WINDOW = 13
GRAM = 5
#: Bits of the Bloom filter at most (16 MB), and bits for each entry below that.
FILTER_BITS_MOST, FILTER_BITS_EACH = 1 << 27, 32
#: Windows of the benchmark up to which they are broadcast (about 100 bytes each).
BROADCAST_WINDOWS = 400_000


def sliding(values: np.ndarray, n: int, pick: Callable = np.minimum) -> np.ndarray:
    """Minimum (or maximum) of each n consecutive values."""
    if len(values) < n:
        return values[:0]
    out, done = values, 1
    while done < n:
        step = min(done, n - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def window_mins(hashes: np.ndarray, row: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, fingerprint) of each window of words that lies within one row."""
    least = sliding(tb.gram_hashes(hashes, gram), window - gram + 1)
    whole = np.flatnonzero(row[: len(least)] == row[window - 1 :][: len(least)])
    return whole, least[whole]


class Filter:
    """Bloom filter over 64-bit hashes with three probes, made by bit_or in Spark."""

    PROBES = 3

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def __contains__(self, hashes: np.ndarray) -> bool:
        raise TypeError("use has()")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for j in range(self.PROBES):
            at = tb.mix(hashes + np.uint64(j)) & self.mask
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def benchmark_scan(window: int, gram: int) -> Callable:
    """(item, text) batches to (item, n_words, words of a window, fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tb.pieces(batches, 1):
            data, offsets = tb.column_bytes(piece.column(1))
            starts, ends, row = tb.words(data, offsets, tb.LOWER_ALNUM, lower=True)
            hashes, low = tb.span_hashes(data, starts, ends), tb.lowered(data)
            at, prints = window_mins(hashes, row, window, gram)
            size = np.full(len(at), window)
            counts = np.bincount(row, minlength=piece.num_rows)
            first = np.cumsum(counts) - counts
            for r in np.flatnonzero((counts > 0) & (counts < window)):
                n = int(counts[r])
                at, size = np.append(at, first[r]), np.append(size, n)
                prints = np.append(prints, tb.gram_hashes(hashes[first[r] : first[r] + n], n))
            text = [b" ".join(low[s:e] for s, e in zip(starts[i : i + n].tolist(), ends[i : i + n].tolist())).decode() for i, n in zip(at.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(row[at] if len(at) else at)), pa.array(size, pa.int32()), pa.array(text, pa.string()), pa.array(prints.view(np.int64))], names=["item", "size", "win", "print"])

    return run


def document_scan(window: int, gram: int, short: list[int], sent, pass_through: int) -> Callable:
    """Batches ending in a text column to the other columns, n_words and candidate windows (start, end, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(np.frombuffer(sent.value, np.uint64))
        for piece in tb.pieces(batches, pass_through):
            data, offsets = tb.column_bytes(piece.column(pass_through))
            starts, ends, row = tb.words(data, offsets, tb.LOWER_ALNUM, lower=True)
            hashes = tb.span_hashes(data, starts, ends)
            at, prints = window_mins(hashes, row, window, gram)
            new = np.ones(len(prints), bool)
            new[1:] = prints[1:] != prints[:-1]  # neighbours mostly share their fingerprint
            met = known.has(prints[new])[np.cumsum(new) - 1] if len(prints) else new
            found = [(at[met], window)]
            for n in short:
                each = tb.gram_hashes(hashes, n)
                each_met = known.has(each) & (row[: len(each)] == row[n - 1 :][: len(each)])
                found.append((np.flatnonzero(each_met), n))
            begin = np.concatenate([x for x, _ in found])
            size = np.concatenate([np.full(len(x), n) for x, n in found])
            order = np.lexsort((size, begin))
            begin, size = begin[order], size[order]
            low = tb.lowered(data) if len(begin) else b""
            text = [b" ".join(low[s:e] for s, e in zip(starts[i : i + n].tolist(), ends[i : i + n].tolist())).decode() for i, n in zip(begin.tolist(), size.tolist())]
            counts = np.bincount(row, minlength=piece.num_rows)
            first = np.cumsum(counts) - counts
            own = row[begin] if len(begin) else begin
            local = begin - first[own] if len(begin) else begin
            held = pa.StructArray.from_arrays([pa.array(local, pa.int32()), pa.array(local + size, pa.int32()), pa.array(text, pa.string())], names=["s", "e", "win"])
            at_list = np.zeros(piece.num_rows + 1, np.int32)
            np.cumsum(np.bincount(own, minlength=piece.num_rows) if len(own) else np.zeros(piece.num_rows, int), out=at_list[1:])
            lists = pa.ListArray.from_arrays(pa.array(at_list), held)
            yield pa.RecordBatch.from_arrays([*[piece.column(i) for i in range(pass_through)], pa.array(counts, pa.int64()), lists], names=[*[f"c{i}" for i in range(pass_through)], "n_words", "near"])

    return run


def bloom_words(prints: DataFrame, entries: int) -> bytes:
    """The filter's 64-bit words; at most FILTER_BITS_MOST bits reach the driver, whatever the benchmark's size."""
    bits = 1 << 12
    while bits < min(FILTER_BITS_MOST, FILTER_BITS_EACH * entries):
        bits *= 2

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate([tb.mix(hashes + np.uint64(j)) & np.uint64(bits - 1) for j in range(Filter.PROBES)]))
            one = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(one.view(np.int64))], names=["at", "bits"])

    table = prints.mapInArrow(probes, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out.tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Overlap of every document with a benchmark.

    Returns one row per input row: the id, n_words, n_hit (words inside any occurrence of a
    window of an item), items (sorted array of the item ids as strings, each once) and spans
    (sorted array of struct<s,e>, the word positions of the occurrences).

    Words are runs of letters and digits (any byte above 0x7F counts as a letter) after
    lower-casing A-Z. Null or empty texts have no words and no hits; an empty benchmark or item
    hits nothing; items that share a window all count; a null item id is never listed but its
    windows still hit; repeated rows are each returned; further input columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    wins = cut(items.mapInArrow(benchmark_scan(window, gram), "item string, size int, win string, print long"))
    facts = wins.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("size") < window, F.col("size"))).alias("short")).first()
    sent = spark.sparkContext.broadcast(bloom_words(wins.select("print"), facts["n"]))
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scan = rows.mapInArrow(document_scan(window, gram, sorted(facts["short"]), sent, 2), f"c0 {kind}, c1 long, n_words long, near array<struct<s:int,e:int,win:string>>")
    near = scan.select("c0", "c1", "n_words", F.posexplode_outer("near").alias("pos", "hit")).select(
        "c0", "c1", "n_words", F.coalesce("pos", F.lit(0)).alias("pos"), F.col("hit.s").alias("s"), F.col("hit.e").alias("e"),
        # rows without a candidate get a key of their own, which no window has, so that a shuffled join spreads them
        F.coalesce("hit.win", F.concat(F.lit("\0"), F.col("c1").cast("string"))).alias("win"),
    )
    of = wins.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("of"))
    joined = near.join(F.broadcast(of) if facts["n"] <= BROADCAST_WINDOWS else of, "win", "left")
    each = joined.groupBy("c0", "c1", "n_words").agg(
        F.sum((F.col("pos") == 0).cast("int")).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("of").isNotNull(), F.struct("s", "e")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("of")))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["e"] - F.greatest(acc["upto"], x["s"]), F.lit(0))).alias("n"), F.greatest(acc["upto"], x["e"]).alias("upto"))
    each = each.withColumn("n_hit", F.aggregate("spans", start, step, lambda acc: acc["n"]))
    return each.select(F.col("c0").alias(id_col), F.col("c1").alias("row_hash"), "n_words", "n_hit", "items", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def contaminated() -> "F.Column":
    """At least one word in twenty lies in a shared window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The documents, all columns, without the contaminated ones (see contamination()).

    Null or empty texts and rows with a null id have no part in what goes wrong elsewhere: the former have no words and
    stay, the latter are judged by their own text. Rows that repeat stay or go together; an empty benchmark takes nothing.
    """
    bad = contamination(docs, benchmark, id_col, text_col, **more).filter(contaminated()).select(F.col(id_col).alias("_bad_id"), F.col("row_hash").alias("_bad_hash")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("_bad_id")) & (row_key(id_col, text_col) == F.col("_bad_hash")), "left_anti")
