"""Near-duplicate documents by HyperMinHash.

A document's distinct 5-word shingles are hashed; the hash's top bits choose one of REGISTERS
buckets, and of the smallest remaining value each bucket stores the count of leading zeros and a
few bits after the leading one. Empty buckets borrow from a fixed sequence of others. Equal sets
are one class, so copies never meet each other.

Bands of compressed registers bring classes together. First each bucket of a band pairs its classes
with one hub, the class that is in the most and largest buckets: linear in the bucket's size, and
enough to tie most groups of copies into components. Then only pairs across components are left:
buckets of up to SMALL classes form them all, and the classes of larger buckets are joined exactly by
prefixes of their sets. Two sets of sizes n and m are linked only if they share need(n, m) shingles;
in any order that is the same for all, a shared one is then among the first n - need(n, m) + 1 of
the one and the first m - need(n, m) + 1 of the other. The order puts shingles first that only one
component holds, which can't be shared, then the rarer ones. A pair is also left out when too few
shingles follow, or when marks of their shingles (128 bits) show that too many differ; both are exact.
A class takes part in this if any one of its large buckets holds another component.

Pairs pass the Jaccard estimate (share of equal registers, less those equal by chance) with a margin
of several standard deviations, then the full shingle sets decide. Components come from the links by
repeated minimum over neighbours.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import HOT, cut, row_key, spread_join

SHINGLE = 5
#: Links need 100 * shared >= PERCENT * union.
PERCENT = 75
REGISTERS, MANTISSA = 64, 10
#: Registers in a band; classes in a bucket up to which all pairs across components are formed.
BAND, SMALL = 2, 16
#: Sizes of sets are compared by steps, each this much larger than the one below.
STEP = 1.06
#: Standard deviations by which an estimate may fall short before a pair is given up.
MARGIN = 6.0


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of each row, in order of row and hash."""
    data, offsets = tb.column_bytes(column)
    starts, ends, row = tb.words(data, offsets)
    hashes = tb.span_hashes(data, starts, ends)
    grams = tb.gram_hashes(hashes, n)
    whole = row[: len(grams)] == row[n - 1 :][: len(grams)]
    grams, at = grams[whole], row[: len(whole)][whole]
    counts = np.bincount(row, minlength=len(column))
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        grams = np.r_[grams, np.array([tb.gram_hashes(hashes[first[r] : first[r] + counts[r]], int(counts[r]))[0] for r in short], np.uint64)]
        at = np.r_[at, short]
    order = np.lexsort((grams, at))
    grams, at = grams[order], at[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (at[1:] != at[:-1])
    return grams[new], at[new]


def orders() -> np.ndarray:
    """For each bucket, the fixed sequence of buckets it borrows from when empty."""
    rng = np.random.default_rng(64)
    return np.array([[i, *rng.permutation([j for j in range(REGISTERS) if j != i])] for i in range(REGISTERS)])


def registers(grams: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
    """rows x REGISTERS of 16 bits: leading zeros and mantissa of the least value of each bucket."""
    shift = np.uint64(64 - REGISTERS.bit_length() + 1)
    bucket = (grams >> shift).astype(np.int64)
    slot = at * REGISTERS + bucket
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]  # sorted, so the first of a bucket is its least
    value = grams[first] << np.uint64(64 - int(shift))
    # float64 holds the leading bit and 52 more: exponent and mantissa can be read off it
    fraction, exponent = np.frexp(np.maximum(value, np.uint64(1)).astype(np.float64))
    zeros = np.maximum(64 - exponent, 0)
    code = (zeros << MANTISSA | (((fraction - 0.5) * 2 * (1 << MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1))).astype(np.int64)
    out = np.full(rows * REGISTERS, -1, np.int64)
    out[slot[first]] = code
    out = out.reshape(rows, REGISTERS)
    filled = np.flatnonzero((out >= 0).any(axis=1))
    own, sequence = out[filled], orders()
    dense = own.copy()
    for step in range(1, REGISTERS):
        empty = dense < 0
        if not empty.any():
            break
        lent = own[:, sequence[:, step]]
        dense = np.where(empty, lent, dense)
    out[filled] = dense
    return np.where(out < 0, 0, out).astype(np.uint16)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, text) to (id, key, size, s1, s2, regs); s1 and s2 tell sets apart."""
    for piece in tb.pieces(batches, 2):
        m = piece.num_rows
        grams, at = shingle_sets(piece.column(2))
        size = np.bincount(at, minlength=m)
        sums = []
        for k in range(2):
            total = np.zeros(len(grams) + 1, np.uint64)
            np.cumsum(tb.mix(grams + np.uint64(k)), out=total[1:])
            ends = np.cumsum(size)
            sums.append((total[ends] - total[ends - size]).view(np.int64))
        regs = registers(grams, at, m)
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), piece.column(1), pa.array(size, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), pa.array([r.tobytes() for r in regs], pa.binary())],
            names=["id", "key", "size", "s1", "s2", "regs"],
        )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, text) to (id, label, size, packed shingle hashes in order), without empty sets."""
    for piece in tb.pieces(batches, 2):
        grams, at = shingle_sets(piece.column(2))
        size = np.bincount(at, minlength=piece.num_rows)
        ends = np.cumsum(size)
        packed = pa.array([grams[e - n : e].tobytes() for n, e in zip(size, ends)], pa.binary())
        yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(size, pa.int64()), packed], names=["id", "label", "size", "grams"]).filter(pa.array(size > 0))


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, regs) to one row for each band: id and the band's key."""
    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(m, REGISTERS).astype(np.uint64)
        bands = REGISTERS // BAND
        total = np.zeros((m, bands), np.uint64)
        for j in range(BAND):
            column = np.arange(bands) * BAND + j
            total = tb.mix(total + regs[:, column] + np.uint64(1) + column.astype(np.uint64) * np.uint64(1 << 20))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(m), bands))), pa.array(total.ravel().view(np.int64))], names=["id", "key"])


def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, size_a, size_b, regs_a, regs_b) to the (a, b) that may reach the threshold."""
    by_chance = 2.0**-MANTISSA / 3
    goal = PERCENT / 100
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
        jaccard = ((x == y).mean(axis=1) - by_chance) / (1 - by_chance)
        n = np.minimum(batch.column(2).to_numpy(), batch.column(3).to_numpy())
        m = np.maximum(batch.column(2).to_numpy(), batch.column(3).to_numpy())
        slack = MARGIN * np.sqrt(goal * (1 - goal) / np.minimum(n, REGISTERS))
        may = (jaccard >= goal - slack) & (100 * n >= PERCENT * m)
        yield batch.select([0, 1]).filter(pa.array(may))


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, grams_a, grams_b) to the (a, b) whose full sets reach the threshold."""
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def stars(held: DataFrame, hot: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of each id of a bucket with the bucket's hub; held has key, n (its ids), id."""
    weight = held.groupBy("id").agg(F.sum("n").alias("w"))
    hubs = cut(held.select("key", "id").join(weight, "id").groupBy("key").agg(F.max(F.struct("w", (-F.col("id")).alias("id"))).alias("best")).select("key", (-F.col("best.id")).alias("hub")))
    met = spread_join(held.select("key", "id"), hubs, "key", hot).filter("id <> hub")
    return met.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def across(labelled: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of ids of a bucket that have different labels; labelled has key, id, label, and SMALL ids a bucket."""
    groups = labelled.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "label"))).alias("all"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    one = groups.select("all", F.posexplode("all").alias("at", "a")).select("a", F.explode(F.slice("all", F.col("at") + 2, SMALL)).alias("b"))
    return one.filter("a.label <> b.label").select("a.id", "b.id").toDF("a", "b").filter("a < b").distinct()


def set_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, label, packed shingle hashes) to one row for each shingle: set, label, g."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            grams = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(2)]
            at = pa.array(np.repeat(np.arange(len(grams)), [len(x) for x in grams]))
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(np.concatenate(grams))], names=["set", "label", "g"])


def marks(g: np.ndarray, largest: int) -> tuple[int, int]:
    """Two words of 64 bits, in which each shingle sets one; of sets much larger than these only a share of the shingles do, the same one for all."""
    v = g.view(np.uint64)
    v = v[(v >> np.uint64(8)) % np.uint64(max(1, -(-largest // 96))) == 0] & np.uint64(127)
    words = [np.bitwise_or.reduce(np.uint64(1) << (part & np.uint64(63)), initial=np.uint64(0)) for part in (v[v < 64], v[v >= 64])]
    return tuple(int(np.uint64(w).astype(np.int64)) for w in words)


PREFIX = {"g": "long", "lo": "int", "hi": "int", "id": "long", "label": "long", "size": "long", "after": "long", "shared": "long", "m0": "long", "m1": "long"}


def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, size, shared shingles, rarer ones first) to the rows that may meet a linked set, with the columns of PREFIX.

    lo and hi are the steps of both sets' sizes, so that either side takes a prefix for just the
    sizes it is compared with; after counts the shared shingles from this one on, shared all of them, and m0 and m1 are
    their marks.
    """
    for batch in batches:
        out: list[list] = [[] for _ in PREFIX]
        for id_, label, size, shared in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
            g = np.asarray(shared.values)
            own = size_step(size)
            for step in range(size_step(max(1, size * PERCENT // 100)), size_step(-(-size * 100 // PERCENT)) + 1):
                # the smallest size of that step that can be linked needs the fewest
                least = max(step_floor(step), -(-size * PERCENT // 100))
                take = len(g) - shared_need(size, least) + 1
                if take > 0:
                    lo, hi = min(own, step), max(own, step)
                    same = (lo, hi, id_, label, size, len(g), *marks(g, step_floor(hi)))
                    rows = [g[:take].tolist(), *[[v] * take for v in same]]
                    rows.insert(6, range(len(g), len(g) - take, -1))
                    for column, values in zip(out, rows):
                        column.extend(values)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if t == "int" else pa.int64()) for c, t in zip(out, PREFIX.values())], names=list(PREFIX))


def shared_need(n: int, m: int) -> int:
    """The fewest shingles that linked sets of these sizes share."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def size_step(n: int) -> int:
    return int(math.log(n, STEP) + 1e-9)


def step_floor(step: int) -> int:
    """No size of the step is below."""
    return int(STEP**step)


def left_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of ids of different labels that may be linked; none that is linked is missing. sets: id, label, size, grams."""
    own_key = F.xxhash64("id", "grams").alias("set")
    shingles = sets.select(own_key, "label", "grams").mapInArrow(set_shingles, "set long, label long, g long")
    shared = cut(shingles.groupBy("g").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("g", "n"))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = shared.filter(F.col("n") * HOT >= total)
    listed = spread_join(shingles.select("set", "g"), shared, "g", hot).groupBy("set").agg(F.sort_array(F.collect_list(F.struct("n", "g"))).alias("gs"))
    listed = sets.select(own_key, "id", "label", "size").join(listed, "set").select("id", "label", "size", F.col("gs.g").alias("gs"))
    prefix = cut(listed.mapInArrow(prefixes, ", ".join(f"{c} {t}" for c, t in PREFIX.items())))
    keys = ["g", "lo", "hi"]
    # the label that holds most of a key's sets meets the others, not itself
    main = prefix.groupBy(*keys, "label").count().groupBy(*keys).agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1").select(*keys, "main")
    mixed = cut(prefix.join(main, keys))
    left = mixed.filter("label <> main").select(*keys, *[F.col(c).alias(f"{c}_x") for c in PREFIX if c not in keys])
    need = F.ceil(PERCENT * (F.col("size_x") + F.col("size")) / (100 + PERCENT))
    near = (F.col("label_x") != F.col("label")) & (100 * F.least("size_x", "size") >= PERCENT * F.greatest("size_x", "size")) & (F.least("after_x", "after") >= need)
    # each mark of one set that the other lacks stands for a shingle at least that it lacks
    lacks = lambda one, other: sum(F.bit_count(F.col(f"{m}{one}").bitwiseAND(F.bitwise_not(F.col(f"{m}{other}")))) for m in ("m0", "m1"))
    near = near & (F.col("shared_x") - lacks("_x", "") >= need) & (F.col("shared") - lacks("", "_x") >= need)
    return left.join(mixed, keys).filter(near).select(F.least("id_x", "id").alias("a"), F.greatest("id_x", "id").alias("b")).distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, component): the smallest id reachable, for the ids in links (a, b).

    Each round, every id takes the smallest label among its own and its neighbours', then the
    label of its label. After a given number of rounds ids of one label are surely
    connected, but a component may still have several labels.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a").toDF("a", "b")).distinct())
    n = both.count()
    hubs = both.groupBy("b").count().filter(F.col("count") * HOT >= n).select("b")
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("id"), F.lit(None).cast("long").alias("old"), "label"))
    done = 0
    while True:
        known = labels.select("id", "label")
        seen = spread_join(both, known.toDF("b", "near"), "b", hubs).groupBy("a").agg(F.min("near").alias("near")).toDF("id", "near")
        lower = known.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        many = known.groupBy("label").count().filter(F.col("count") * HOT >= n).select("label")
        labels = cut(spread_join(lower, known.toDF("label", "next"), "label", many, "left").select("id", "old", F.least("label", F.coalesce("next", "label")).alias("label")))
        done += 1
        if done == rounds or labels.filter("old <> label").isEmpty():
            return labels.select("id", F.col("label").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_shingles long, component_id, kept boolean.

    Words are runs of characters other than ASCII white space, with A-Z lower-cased; shingles are
    SHINGLE words, a shorter text is one shingle. Documents are linked when their sets reach
    PERCENT; component_id is the smallest id reachable and kept marks the row that holds it.

    Buckets of any size lose no link (see the module); what the method itself may miss is a pair that agrees in no band (3e-12 of the pairs
    just at the threshold). Null, empty and blank texts have no shingles and are their own component. Rows that repeat
    an id are one document, linked through any of their texts. Rows with a null id are never
    linked, have a null component and are kept. Other input columns are ignored; an empty table
    gives an empty table. Ids must be integers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    sketched = cut(rows.mapInArrow(sketch, "id long, key long, size long, s1 long, s2 long, regs binary"))
    real = sketched.filter("size > 0 and id is not null")
    # equal sets are one class, named by its smallest id
    classes = cut(real.groupBy("s1", "s2", "size").agg(F.min("id").alias("rep"), F.first("regs").alias("regs")))
    own_class = real.join(classes.select("s1", "s2", "size", "rep"), ["s1", "s2", "size"]).select("id", "rep")
    regs = classes.select(F.col("rep").alias("id"), "size", "regs")
    keys = regs.select("id", "regs").mapInArrow(band_keys, "id long, key long")
    counts = cut(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    hot = counts.filter(F.col("n") * HOT >= counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    held = cut(spread_join(keys, counts, "key", hot))

    def linked(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The pairs whose sets reach PERCENT; sets gives the full sets of a table of ids."""
        pairs = pairs.join(regs.toDF("a", "size_a", "regs_a"), "a").join(regs.toDF("b", "size_b", "regs_b"), "b")
        pairs = cut(pairs.select("a", "b", "size_a", "size_b", "regs_a", "regs_b").mapInArrow(estimate, "a long, b long"))
        found = sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()).select("id", "grams")
        checked = pairs.join(found.toDF("a", "grams_a"), "a").join(found.toDF("b", "grams_b"), "b").select("a", "b", "grams_a", "grams_b")
        return checked.mapInArrow(confirm, "a long, b long")

    def sets_of(ids: DataFrame) -> DataFrame:
        """Full sets of a table of (id, label); the texts are dealt out by id at every size."""
        return rows.select("id", "text").join(ids.hint("shuffle_hash"), "id").select("id", "label", "text").mapInArrow(full_sets, "id long, label long, size long, grams binary").distinct()

    links = linked(stars(held, hot), lambda ids: cut(sets_of(ids.withColumn("label", F.col("id")))))
    # an id with several classes ties them together
    several = own_class.groupBy("id").agg(F.collect_set("rep").alias("reps")).filter(F.size("reps") > 1)
    ties = several.select(F.col("id").alias("a"), F.explode("reps").alias("b")).filter("a <> b")
    links = cut(links.union(ties))
    reached = components(links, rounds=2)
    labelled = cut(held.join(reached, "id", "left").select("key", "n", "id", F.coalesce("component", "id").alias("label")))
    pairs = cut(across(labelled.filter(F.col("n") <= SMALL)))
    large = labelled.filter(F.col("n") > SMALL)
    mixed = large.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    left = cut(spread_join(large, mixed, "key", hot).groupBy("id").agg(F.first("label").alias("label")))
    needed = left.union(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().join(left, "id", "left_anti").withColumn("label", F.lit(None).cast("long")))
    sets = cut(sets_of(needed))
    if not left.isEmpty():
        pairs = cut(pairs.union(left_pairs(sets.filter("label is not null"))).distinct())
    reached = components(links.union(linked(pairs, lambda ids: sets)))
    named = own_class.groupBy("id").agg(F.min("rep").alias("rep")).join(reached.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select(F.col("id").alias("_id"), F.coalesce("component", "rep").alias("component"))
    out = sketched.select("id", "size").join(named, F.col("id") == F.col("_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
