"""Language-model scoring from a log-frequency Bloom filter.

Training tokens and bigrams are counted over the whole corpus. Each task sums its own counts,
and what it shuffles are packed arrays of (hash, count) by bucket of the hash, not rows; the number of
buckets follows the size of the training text, so a bucket's sums stay small. A count c enters the
filter as its level 1 + floor(log2 c): the keys (gram, 1) .. (gram, level) are set. Each bucket owns
a slice of the filter with KEY_BITS for each of its keys, so the filter grows with the corpus and its
error rate does not. A level is read by probing 1, 2, ... until a key is missing or the slice's highest
level is passed.

Texts are dealt out to groups of some megabytes by hash. A group asks each bucket for the exact counts of its
distinct tokens; the answers meet the group again by its number, so no key is ever common. Up to
BROADCAST_BITS the slices are also laid end to end and broadcast; a larger filter stays in its slices,
and the groups ask these for their levels along with the counts. Both ways give the same scores.

A group and a bucket exchange one row each way, so there are as many rows as pairs of these, and
nothing runs row by row: a bucket is a range of hashes, so what a group asks is its sorted hashes cut
at the buckets' bounds; a bucket answers all rows of a batch in one pass; and what it answers, put in order of
bucket, lies beside the sorted hashes again, which therefore don't travel back.

The score of a word after another is (c(h, w) + T(h) * P(w)) / (c(h) + T(h)), with the middle of each
level's range for the counts, the smoothed unigram probability for P, and c(h)**FOLLOWERS for T(h), the number of
different words that follow h.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import cut, partitions

#: Bits of the filter for a key and probes for it: a level that isn't there is read as set in 1.2 of 100 cases.
KEY_BITS, PROBES = 10, 4
#: The filter is broadcast up to this size (128 MB), else the probes go to its slices.
BROADCAST_BITS = 1 << 30
#: Bytes of training text for a bucket of hashes, and of texts that are scored at once: the larger, the fewer rows between them.
BUCKET_BYTES, GROUP_BYTES = 8 << 20, 4 << 20
#: Power of a word's count that tells how many different words follow it.
FOLLOWERS = 0.9
#: Entries a task holds before it sends them on.
HELD = 1_500_000
#: Bytes of text that are cut into tokens at once, and hashes that are looked up in the filter at once: what a processor's own cache holds.
PIECE_BYTES, PROBED = 1 << 18, 1 << 15
END = np.uint64(0x5D1E)
SALT = np.uint64(0x9E3779B97F4A7C15)


def text_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all tokens of a piece, an end token after each row's words."""
    data, offsets = tb.column_bytes(column)
    starts, ends, row = tb.words(data, offsets)
    hashes = tb.span_hashes(data, starts, ends)
    n = np.bincount(row, minlength=len(column))
    at = np.cumsum(n)
    return np.insert(hashes, at, END), np.insert(row, at, np.arange(len(column)))


def bigrams(hashes: np.ndarray) -> np.ndarray:
    return tb.mix(hashes[:-1] * SALT + hashes[1:]) if len(hashes) else hashes


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Which of these stand first among their equals."""
    out = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=out[1:])
    return out


def distinct(hashes: np.ndarray) -> np.ndarray:
    """In order."""
    ordered = np.sort(hashes)
    return ordered[firsts(ordered)]


def summed(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with their counts."""
    if counts is None:
        ordered = np.sort(hashes)
        first = np.flatnonzero(firsts(ordered))
        return ordered[first], np.diff(np.r_[first, len(ordered)])
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(firsts(hashes))
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes, in order."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def bounds(ordered: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes, and their number."""
    low = ((np.arange(buckets, dtype=np.uint64) << np.uint64(32)) + np.uint64(buckets - 1)) // np.uint64(buckets)
    return np.r_[np.searchsorted(ordered, low << np.uint64(32)), len(ordered)]


def narrowed(counts: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes each (1, 2, 4 or 8) that hold all of them."""
    most = int(counts.max(initial=0))
    return counts.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def narrow(counts: np.ndarray) -> bytes:
    return narrowed(counts).tobytes()


def wide(packed: bytes, n: int) -> np.ndarray:
    """n counts back from narrow()."""
    return np.frombuffer(packed, f"u{len(packed) // n}" if n else np.uint8).astype(np.int64)


def spans(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of values[at[0]:at[1]], values[at[1]:at[2]], ... as a binary column."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def packed_counts(buckets: int) -> Callable:
    """Text batches to (bucket, kind, hashes, counts): the sums of a task, packed by bucket; kind 1 words, 2 bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {1: [], 2: []}

        def send(kind: int) -> Iterator[pa.RecordBatch]:
            parts = held[kind]
            hashes, counts = summed(np.concatenate([h for h, _ in parts]), np.concatenate([c for _, c in parts])) if parts else (np.zeros(0, np.uint64), np.zeros(0, int))
            held[kind] = []
            at = bounds(hashes, buckets)
            filled = np.flatnonzero(np.diff(at))
            if len(filled):
                at = np.r_[at[filled], len(hashes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filled), pa.array([kind] * len(filled), pa.int32()), spans(hashes, at), pa.array([narrow(counts[s:e]) for s, e in zip(at, at[1:])], pa.binary())],
                    names=["bucket", "kind", "hashes", "counts"],
                )

        for piece in tb.pieces(batches, 0, PIECE_BYTES):
            hashes, row = text_tokens(piece.column(0))
            pairs = bigrams(hashes)[row[1:] == row[:-1]]
            for kind, grams in ((1, hashes), (2, pairs)):
                held[kind].append(summed(grams))
                if sum(len(h) for h, _ in held[kind]) > HELD:
                    yield from send(kind)
        for kind in (1, 2):
            yield from send(kind)

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(counts.astype(np.float64))[1]


class Places:
    """The bits of each key (gram, level): all probes of a gram follow from two hashes of it."""

    def __init__(self, hashes: np.ndarray, bits: int | np.ndarray):
        # the high bits of a bucket's hashes are alike; those of the product are not
        self.first, self.step = tb.mix(hashes + SALT), hashes * SALT | np.uint64(1)
        self.bits = np.broadcast_to(np.asarray(bits, np.uint64), hashes.shape)

    def of(self, rows: np.ndarray, level: int, probe: int) -> np.ndarray:
        x = self.first[rows] + self.step[rows] * np.uint64(level * PROBES + probe)
        # the high half, scaled to the slice, which has less than 2**32 bits
        return ((x >> np.uint64(32)) * self.bits[rows] >> np.uint64(32)).astype(np.int64)


MERGED = pa.schema([("bucket", pa.int64()), ("top", pa.int32()), ("n", pa.int64()), ("v", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary()), ("bits", pa.binary())])


def merge_bucket(table: pa.Table) -> pa.Table:
    """All packed sums of one bucket to its tokens' counts (n of v tokens) and its slice of the filter, whose highest level is top."""
    found = {}
    for kind in (1, 2):
        own = table.filter(pc.equal(table.column("kind"), kind))
        hashes = [np.frombuffer(h, np.uint64) for h in own.column("hashes").to_pylist()]
        counts = [wide(c, len(h)) for c, h in zip(own.column("counts").to_pylist(), hashes)]
        found[kind] = summed(np.concatenate(hashes), np.concatenate(counts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    level = {kind: levels(counts) for kind, (_, counts) in found.items()}
    keys = sum(int(x.sum()) for x in level.values())
    bits = np.zeros(-(-keys * KEY_BITS // 64) * 64, bool)
    top = max((int(x.max(initial=0)) for x in level.values()))
    for kind, (hashes, _) in found.items():
        places = Places(hashes, len(bits))
        for j in range(1, top + 1):
            rows = np.flatnonzero(level[kind] >= j)
            for probe in range(PROBES):
                bits[places.of(rows, j, probe)] = True
    hashes, counts = found[1]
    return pa.table([[table.column("bucket")[0].as_py()], [top], [int(counts.sum())], [len(hashes)], [hashes.tobytes()], [narrow(counts)], [np.packbits(bits, bitorder="little").tobytes()]], schema=MERGED)


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of a level's range of counts; 0 for level 0."""
    return np.where(level > 1, 1.5 * 2.0 ** (level - 1.0) - 0.5, np.minimum(level, 1.0))


class Levels:
    """Levels out of the filter by repeated membership probes: of each bucket the highest level and the bytes of its slice, then all slices end to end."""

    def __init__(self, top: np.ndarray, size: np.ndarray, bits: np.ndarray):
        self.top, self.start, self.size, self.bits = top, np.cumsum(size) - size, size, bits

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """0 for what was never set."""
        return np.concatenate([self.probed(hashes[i : i + PROBED]) for i in range(0, max(len(hashes), 1), PROBED)])

    def probed(self, hashes: np.ndarray) -> np.ndarray:
        bucket = bucket_of(hashes, len(self.top)).astype(np.int64)
        base, top, places = self.start[bucket] * 8, self.top[bucket], Places(hashes, np.maximum(self.size[bucket] * 8, 1))
        level, left, j = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 0
        while len(left):
            j += 1
            left = left[top[left] >= j]
            for probe in range(PROBES):
                at = base[left] + places.of(left, j, probe)
                left = left[(self.bits[at >> 3] >> (at & 7) & 1).astype(bool)]
            level[left] = j
        return level


def nothing() -> Levels:
    return Levels(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint8))


def places_in(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where hashes stand in sorted keys, or would stand; sorted first, which is faster than to look each up at random."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = firsts(ordered)
    out = np.empty(len(hashes), np.int64)
    out[order] = np.searchsorted(keys, ordered[new])[np.cumsum(new) - 1]
    return out


def lookup(keys: np.ndarray, values: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Values of hashes in a sorted table, 0 for what it doesn't hold."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(places_in(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, values[at], 0)


SCORES = ["id", "n_tokens", "n_known", "base_score", "score"]


def piece_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, rows, follows, pairs): the tokens of some texts, which of them follow another one, and the bigrams these end."""
    hashes, row = text_tokens(texts)
    follows = np.flatnonzero(row[1:] == row[:-1]) + 1
    return hashes, row, follows, bigrams(hashes)[follows - 1]


def ask(buckets: int, routed: bool) -> Callable:
    """(group, id, text) in order of group to (bucket, group, words, pairs): what a group asks, cut at the buckets' bounds."""

    def questions(group: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        words, pairs = (distinct(np.concatenate(grams)) for grams in zip(*parts))
        by_word, by_pair = bounds(words, buckets), bounds(pairs, buckets)
        filled = np.flatnonzero(np.diff(by_word) + np.diff(by_pair))
        columns = [spans(grams, np.r_[at[filled], len(grams)]) for grams, at in ((words, by_word), (pairs, by_pair))]
        return pa.RecordBatch.from_arrays([pa.array(filled), pa.array(np.full(len(filled), group)), *columns], names=["bucket", "group", "words", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for piece in tb.pieces(batches, 2, PIECE_BYTES):
            groups = piece.column(0).to_numpy()
            ends = np.r_[np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups)]
            for s, e in zip(np.r_[0, ends[:-1]], ends):
                if groups[s] != at:
                    if parts:
                        yield questions(at, parts)
                    at, parts = int(groups[s]), []
                hashes, _, _, pairs = piece_tokens(piece.column(2).slice(s, e - s))
                parts.append((distinct(hashes), distinct(pairs) if routed else pairs[:0]))
        if parts:
            yield questions(at, parts)

    return run


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a binary column, and where each row's begin and end."""
    data, offsets = tb.column_bytes(column)
    return data.view(np.uint64), offsets // 8


def answer(routed: bool) -> Callable:
    """Rows in order of bucket, a bucket's own tokens, counts and slice before what it is asked, to (bucket, group, asked, counts, words, pairs): the number of tokens asked for, their counts, levels of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known, exact, model = -1, np.zeros(0, np.uint64), np.zeros(0, np.int64), nothing()
        for batch in batches:
            at, own = batch.column("bucket").to_numpy(), pc.is_null(batch.column("group")).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(firsts(at) | own | np.r_[False, own[:-1]])
            for s, e in zip(cuts, np.r_[cuts[1:], len(at)]):
                rows = batch.slice(s, e - s)
                if own[s]:
                    bucket, known = at[s], numbers(rows.column("words"))[0]
                    exact = wide(rows.column("counts")[0].as_py(), len(known))
                    if routed:
                        bits = np.frombuffer(rows.column("bits")[0].as_py(), np.uint8)
                        model = Levels(np.array([rows.column("top")[0].as_py()]), np.array([len(bits)]), bits)
                    continue
                if at[s] != bucket:  # nothing was learnt for it
                    bucket, known, exact, model = at[s], known[:0], exact[:0], nothing()
                (words, word_cuts), (pairs, pair_cuts) = numbers(rows.column("words")), numbers(rows.column("pairs"))
                told = [spans(model.levels(x).astype(np.uint8), x_cuts) if routed else pa.nulls(e - s, pa.binary()) for x, x_cuts in ((words, word_cuts), (pairs, pair_cuts))]
                counts = spans(narrowed(lookup(known, exact, words)), word_cuts)
                yield pa.RecordBatch.from_arrays([rows.column("bucket"), rows.column("group"), pa.array(np.diff(word_cuts)), counts, *told], names=["bucket", "group", "asked", "counts", "words", "pairs"])

    return run


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_tokens, n_known, train_tokens (long), base_score, score (double).

    train tells which rows the model learns from, by the id. Tokens are runs of characters other
    than ASCII white space, A-Z lower-cased, and one end per text. base_score sums
    log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens with exact counts; score is the
    model's log10 probability of the text (see the module).

    A null or empty text is its end token alone. Repeated rows count each, in training too, and
    are each returned. With no training rows, N and V are 0 and every token is unknown. Other
    input columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), train.alias("train"), F.col(text_col).alias("text"))
    taught, size = rows.filter("train").select("text"), F.octet_length("text")
    sizes = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum(F.when(F.col("train"), size)), F.lit(0))).first()
    groups, buckets = max(partitions(spark), -(-sizes[0] // GROUP_BYTES)), max(partitions(spark), -(-sizes[1] // BUCKET_BYTES))
    sums = taught.mapInArrow(packed_counts(buckets), "bucket long, kind int, hashes binary, counts binary")
    merged = cut(sums.groupBy("bucket").applyInArrow(merge_bucket, "bucket long, top int, n long, v long, hashes binary, counts binary, bits binary"))
    total = merged.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum(F.octet_length("bits").cast("long")), F.lit(0))).first()
    n, v = total[0], total[1]
    whole = n + 0.5 * (v + 1)
    routed = total[2] * 8 > BROADCAST_BITS
    laid = None
    if not routed:  # at most BROADCAST_BITS come to the driver, one slice at a time
        top, size = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for r in merged.select("bucket", "top", F.octet_length("bits").alias("size")).toLocalIterator():
            top[r["bucket"]], size[r["bucket"]] = r["top"], r["size"]
        filter_ = Levels(top, size, np.zeros(total[2], np.uint8))
        for r in merged.select("bucket", "bits").toLocalIterator():
            at = filter_.start[r["bucket"]]
            filter_.bits[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
        laid = (top, size, filter_.bits)
    sent = spark.sparkContext.broadcast(laid)
    kind = rows.schema["id"].dataType.simpleString()
    # dealt out once: what asks and what is scored read the same exchange, as long as both take all of its columns
    grouped = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(groups)).alias("group"), "id", "text").repartition(partitions(spark), "group")
    none = F.lit(None)
    asked = grouped.sortWithinPartitions("group").mapInArrow(ask(buckets, routed), "bucket long, group long, words binary, pairs binary")
    asked = asked.select("*", none.cast("binary").alias("counts"), none.cast("int").alias("top"), none.cast("binary").alias("bits"))
    held = merged.select("bucket", none.cast("long").alias("group"), F.col("hashes").alias("words"), none.cast("binary").alias("pairs"), "counts", "top", "bits" if routed else none.cast("binary").alias("bits"))
    meeting = asked.unionByName(held).repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", F.col("group").isNotNull())
    answers = meeting.mapInArrow(answer(routed), "bucket long, group long, asked long, counts binary, words binary, pairs binary")

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """A group of texts and its answers to the scores of the texts."""
        answers = answers.sort_by("bucket")
        exact = np.concatenate([wide(c, n) for c, n in zip(answers.column("counts").to_pylist(), answers.column("asked").to_pylist())])
        kinds = (texts.schema.field("id").type, pa.int64(), pa.int64(), pa.float64(), pa.float64())
        pieces = list(tb.pieces(texts.select(["id", "text"]).to_batches(), 1, PIECE_BYTES))
        tokens = [piece_tokens(piece.column(1)) for piece in pieces]
        words, grams = (distinct(np.concatenate([distinct(x[i]) for x in tokens])) for i in (0, 3))
        if routed:
            one, two = (np.frombuffer(b"".join(answers.column(k).to_pylist()), np.uint8).astype(np.int64) for k in ("words", "pairs"))
        else:
            model = Levels(*sent.value)
            one, two = model.levels(words), model.levels(grams)
        one, two = middle(one), middle(two)
        parts = []
        for piece, (hashes, row, follows, pairs) in zip(pieces, tokens):
            at = places_in(words, hashes)
            c, unigram, pair = exact[at], one[at], two[places_in(grams, pairs)]
            p = np.minimum((unigram + 0.5) / whole, 1.0)
            history = unigram[follows - 1]
            pair = np.minimum(pair, np.minimum(history, unigram[follows]))
            spread = np.maximum(history, 1.0) ** FOLLOWERS
            p[follows] = np.minimum((pair + spread * p[follows]) / (history + spread), 1.0)
            sums = lambda x, row=row, m=piece.num_rows: np.bincount(row, x, minlength=m)
            made = (piece.column(0), sums(None).astype(np.int64), sums(c > 0).astype(np.int64), sums(np.log10((c + 0.5) / whole)), sums(np.log10(p)))
            parts.append(pa.table([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, kinds)], names=SCORES))
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in kinds], names=SCORES)

    scored = grouped.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(score, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
