"""Vectorised words and hashes over the UTF-8 buffer of an Arrow string column.

A batch of texts is one byte array plus offsets, so words of thousands of texts are found
and hashed by a few numpy passes, without a Python object per word.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth table over byte values: true outside of the given inclusive ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Bytes of `[^\x20\x09-\x0D]` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`.
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER_ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER_KEYS = BYTE_KEYS[LOWER]
BASE = 0xD1342543DE82EF95
#: A second polynomial over the field of this prime, with a base that has nothing to do with the first one.
PRIME, PRIME_BASE = (1 << 31) - 1, 1_237_940_039
PRIME_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) % np.uint64(PRIME)
LOWER_PRIME_KEYS = PRIME_KEYS[LOWER]
POWERS: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}


def prime_powers(base: int, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo PRIME, by doubling."""
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, PRIME)) % np.uint64(PRIME)
        done += more
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base and of its inverse modulo 2**64, and of the second base and its inverse modulo PRIME."""
    if not POWERS or next(iter(POWERS)) < n:
        size = max(n, PIECE_BYTES) + 1
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        made += [prime_powers(PRIME_BASE, size), prime_powers(pow(PRIME_BASE, -1, PRIME), size)]
        POWERS.clear()
        POWERS[size - 1] = tuple(made)
    return next(iter(POWERS.values()))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: int, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes of text each, whole rows only."""
    for batch in batches:
        _, offsets = column_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of maximal runs of bytes of a kind; no word crosses rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = kind[LOWER[data]] if lower else kind[data]
    filled = offsets[:-1][np.diff(offsets) > 0]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[filled] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[filled[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, blind to the case of A-Z unless told otherwise.

    A polynomial modulo 2**64 alone gives some long regular words the same hash whatever its base; the
    one modulo a prime tells these apart.
    """
    power, inverse, small, small_inverse = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    each = (LOWER_KEYS if lower else BYTE_KEYS)[data]
    each *= power[: len(data)]
    np.cumsum(each, out=total[1:])
    first = (total[ends] - total[starts]) * inverse[starts]
    np.take(LOWER_PRIME_KEYS if lower else PRIME_KEYS, data, out=each)
    each *= small[: len(data)]
    # folded once, a product is below 2**32, and sums of them fit as long as a piece has less than 2**32 bytes
    high = each >> np.uint64(31)
    each &= np.uint64(PRIME)
    each += high
    np.cumsum(each, out=total[1:])
    second = (total[ends] - total[starts]) % np.uint64(PRIME) * small_inverse[starts] % np.uint64(PRIME)
    return mix(first + mix(second))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (rows are not looked at)."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    factor = 1
    for j in range(n):
        out += hashes[j : j + count] * np.uint64(factor)
        factor = factor * BASE % (1 << 64)
    return mix(out + np.uint64(n))


def lowered(data: np.ndarray) -> bytes:
    return LOWER[data].tobytes()


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from a flat numpy array and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
