"""Byte-level BPE by replaying merges over a corpus.

The distinct words (matches of the split pattern) of a batch are laid out as one array of
tokens with links to their neighbours. An inverted index from the rank of a token pair to the
positions of the pair is worked off in rank order: all places of the lowest rank merge at once,
and only the pairs with the two touched neighbours are looked up anew. Texts are then encoded by
gathering the token lists of their words. Words seen before in the same task are not replayed.
"""
from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import without

NONE = np.int32(1 << 30)
#: Bytes of text encoded at once, and words a task remembers at most.
BATCH_BYTES, WORDS_KEPT = 8 << 20, 500_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a .tiktoken file."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class Merges:
    """The pairs of tokens that merge, with the rank of the token they make."""

    def __init__(self, vocab: list[bytes]):
        self.vocab = vocab
        self.rank = {t: r for r, t in enumerate(vocab) if t}
        self.first = np.array([self.rank.get(bytes([b]), NONE) for b in range(256)], np.int32)
        if (self.first == NONE).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [(a << 32 | b, r) for t, r in self.rank.items() for i in range(1, len(t)) if (a := self.rank.get(t[:i])) is not None and (b := self.rank.get(t[i:])) is not None]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.made = np.ascontiguousarray(table[:, 0]), table[:, 1].astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it doesn't merge."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def one(self, word: bytes) -> list[int]:
        """A single word by the definition: the leftmost pair of the lowest rank merges first."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            best, i = min((self.rank.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if best == NONE:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]


def unmarked(found: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of sorted places, those a scan from the left takes when a taken pair hides the next one."""
    if len(found) < 2:
        return found
    linked = nxt[found[:-1]] == found[1:]
    if not linked.any():
        return found
    index = np.arange(len(found))
    start = np.ones(len(found), bool)
    start[1:] = ~linked
    return found[(index - np.maximum.accumulate(np.where(start, index, 0))) % 2 == 0]


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, count for each word) of distinct words, all merged together in rank order."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    tok = merges.first[np.frombuffer(b"".join(words), np.uint8)]
    n = len(tok)
    ends = np.cumsum(sizes)
    nxt, prev = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    filled = sizes > 0
    nxt[ends[filled] - 1] = -1
    prev[(ends - sizes)[filled]] = -1
    alive = np.ones(n, bool)
    rank = np.full(n, NONE, np.int32)
    has = np.flatnonzero(nxt >= 0)
    rank[has] = merges.ranks(tok[has], tok[has + 1])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    odd: list[np.ndarray] = []

    def post(places: np.ndarray) -> None:
        values = rank[places]
        places, values = places[values != NONE], values[values != NONE]
        if not len(places):
            return
        order = np.argsort(values, kind="stable")
        places, values = places[order], values[order]
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for r, part in zip(values[np.r_[0, cuts]].tolist(), np.split(places, cuts) if len(cuts) else [places]):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    post(has)
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        found = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        found = unmarked(found[rank[found] == r], nxt)
        if not len(found):
            continue
        gone = nxt[found]
        after = nxt[gone]
        tok[found], nxt[found] = r, after
        alive[gone], rank[gone] = False, NONE
        inner = after >= 0
        prev[after[inner]] = found[inner]
        rank[found[~inner]] = NONE
        left = prev[found]
        left = left[left >= 0]
        touched = np.concatenate([found[inner], left])
        rank[touched] = merges.ranks(tok[touched], tok[nxt[touched]])
        if (low := touched[rank[touched] < r]).size:
            odd.append(low)
        post(np.unique(touched))
    count = np.add.reduceat(np.r_[alive, False], (ends - sizes)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    count[~filled] = 0
    out = tok[alive]
    if odd:  # a new pair of lower rank than the one at work: other places of the same word might have come later
        redo = np.unique(np.searchsorted(ends, np.concatenate(odd), "right"))
        lists = np.split(out, np.cumsum(count)[:-1])
        for w in redo.tolist():
            lists[w] = np.array(merges.one(words[w]), np.int32)
        count[redo] = [len(lists[w]) for w in redo.tolist()]
        out = np.concatenate(lists)
    return out, count


class Encoder:
    """Encodes texts; keeps the tokens of the words it has met."""

    def __init__(self, merges: Merges, pattern: str):
        import regex

        self.merges, self.find = merges, regex.compile(pattern).findall
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.tokens, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, count for each text)."""
        if len(self.number) > WORDS_KEPT:
            self.clear()
        number, found, sizes = self.number, [], []
        for text in texts:
            words = self.find(text) if text else []
            sizes.append(len(words))
            found.append(words)
        new = list(set().union(*found).difference(number)) if found else []
        if new:
            tokens, count = replay([w.encode("utf-8", "surrogatepass") for w in new], self.merges)
            number.update(zip(new, range(len(number), len(number) + len(new))))
            self.tokens = np.concatenate([self.tokens, tokens])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(count)])
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64, sum(sizes))
        first, lengths = self.start[ids], self.start[ids + 1] - self.start[ids]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        flat = self.tokens[np.repeat(first - (upto - lengths), lengths) + np.arange(total)]
        row = np.repeat(np.arange(len(texts)), sizes)
        return flat, np.bincount(row, lengths, minlength=len(texts)).astype(np.int64)


class Decoder:
    """Token ids to bytes, by one gather from the vocabulary."""

    def __init__(self, vocab: list[bytes]):
        self.vocab = pa.array(vocab, pa.binary())
        self.sizes = np.array([len(t) for t in vocab], np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> pa.Array:
        ends = np.cumsum(np.r_[0, self.sizes[ids]])[np.r_[0, np.cumsum(count)]]
        data = self.vocab.take(pa.array(ids)).buffers()[2] if len(ids) else pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(ends.astype(np.int64)), data]).cast(pa.binary())


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", decode: bool = True) -> DataFrame:
    """Input columns without the text, plus token_ids array<int> and, on demand, decoded binary.

    Each match of the pattern is encoded by itself, without special tokens, as tiktoken does.
    The rank file must be readable on every worker under the given path. Null or empty texts give
    no tokens and no bytes; repeated rows are each returned; input columns named token_ids or
    decoded are replaced; texts are never cut, and one text may be larger than a batch.
    """
    kept = without(docs, text_col, "token_ids", "decoded")
    frame = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)], F.col(text_col).alias("text"))
    at = len(kept.columns)
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)], "token_ids array<int>", *["decoded binary"] * decode])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = read_ranks(ranks_path)
        encoder, decoder = Encoder(Merges(vocab), pattern), Decoder(vocab)
        for piece in tb.pieces(batches, at, BATCH_BYTES):
            ids, count = encoder.encode(piece.column(at).to_pylist())
            out = [*[piece.column(i) for i in range(at)], tb.list_array(ids, count, pa.int32()), *([decoder.decode(ids, count)] if decode else [])]
            yield pa.RecordBatch.from_arrays(out, names=[*[f"c{i}" for i in range(at)], "token_ids", *["decoded"] * decode])

    return frame.mapInArrow(run, schema).toDF(*kept.columns, "token_ids", *["decoded"] * decode)


def decode_ids(df: DataFrame, ranks_path: str, ids_col: str = "token_ids") -> DataFrame:
    """Input columns plus decoded binary; null ids give null. A column named decoded is replaced."""
    kept = without(df, "decoded")
    frame = kept.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)])
    at = [c.lower() for c in kept.columns].index(ids_col.lower())
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)], "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks_path))
        for batch in batches:
            lists = batch.column(at)
            count = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            bytes_ = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), count)
            blank = pa.array(np.asarray(lists.is_null()))
            bytes_ = pc.if_else(blank, pa.scalar(None, pa.binary()), bytes_)
            yield pa.RecordBatch.from_arrays([*batch.columns, bytes_], names=[*batch.schema.names, "decoded"])

    return frame.mapInArrow(run, schema).toDF(*kept.columns, "decoded")


def token_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")

