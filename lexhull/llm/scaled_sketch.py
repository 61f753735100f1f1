"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A sketch holds every hash of a text's distinct shingles of SHINGLE words that lies below a fixed fraction, 1 in
2**SCALE, of the range of hashes; a text with none below keeps its smallest. What is kept of a shingle
doesn't depend on the text around it. So sketches of parts merge into the sketch of the whole, sets of very
unequal sizes are compared on equal terms, and the share of a sketch that another one holds estimates the share of the
text's shingles that the other text holds.

What belongs to a document's neighbour in the order of ids is found by a range exchange of ids alone; then
each document gives away the stretch of text that its neighbour asks for, and its sketch.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut, without

SHINGLE = 5
#: Of 2**SCALE hashes one is kept.
SCALE = 3
#: Fixed value: the white space between words.
SPACE = " \t\n\x0b\x0c\r"
NO_HASHES = "array<bigint>"


def bound(value: Column, use) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """array<long>: the hash (0 to 2**63 - 1) of each run of n words; a text of fewer words is one run, one without words has none.

    Words are runs of characters other than ASCII white space, in lower case.
    """
    trimmed = F.btrim(F.lower(text), F.lit(SPACE))
    words = F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    positive = lambda h: h.bitwiseAND(F.lit((1 << 63) - 1))

    def runs(h: Column) -> Column:
        long = F.transform(F.slice(h, F.lit(1), F.size(h) - (n - 1)), lambda x, i: positive(F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)])))
        return F.when(F.size(h) < n, F.array(positive(F.xxhash64(h)))).otherwise(long)

    return F.when(F.length(trimmed) > 0, bound(words, runs)).otherwise(F.array().cast(NO_HASHES))


def kept_hashes(hashes: Column, scale: int = SCALE) -> Column:
    """Of a set of hashes those below the fraction, or the smallest alone; each once, in order."""

    def keep(h: Column) -> Column:
        low = F.filter(h, lambda x: x < F.lit(1 << (63 - scale)))
        return F.when((F.size(low) > 0) | (F.size(h) == 0), F.sort_array(F.array_distinct(low))).otherwise(F.array(F.array_min(h)))

    return bound(hashes, keep)


def sketch(text: Column, n: int = SHINGLE, scale: int = SCALE) -> Column:
    """array<long>: the sketch of a text; null counts as empty, and texts without words have an empty sketch."""
    return kept_hashes(shingle_hashes(F.coalesce(text, F.lit("")), n), scale)


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of all shingles of either side."""
    return kept_hashes(F.array_union(a, b), scale)


def containment(a: Column, b: Column) -> Column:
    """Estimated share (0 to 1) of a's shingles that b holds; an empty sketch is contained in an empty one only."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.when(F.size(b) == 0, 1.0).otherwise(0.0))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share (0 to 1) of the shingles of either side that both hold; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) > 0, both / (F.size(a) + F.size(b) - both)).otherwise(1.0)


def written(hashes: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits a hash, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def fingerprints(docs: DataFrame, text_col: str = "text", n: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Input columns plus sketch array<long>. Repeated rows are each returned; an input column named sketch is replaced."""
    return without(docs, "sketch").withColumn("sketch", sketch(F.col(f"`{text_col}`"), n, scale))


def before_each(keys: DataFrame, id_col: str, tie: str, *more: str) -> DataFrame:
    """keys, one row each, plus the row before in the order of descending id, as a struct `asker` of id, tie and more; the row before the first is the last.

    Rows are dealt out by range; the only thing looked at across ranges is one row of each, so no task
    sees all keys. Null ids come last.
    """
    order = [F.col(id_col).desc_nulls_last(), F.col(tie)]
    ranged = cut(keys.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    own = F.struct(id_col, tie, *more)
    within = Window.partitionBy("_part").orderBy(*order)
    # the last row of each range, and which range comes before which: one row a partition
    least = F.struct(F.coalesce(F.col(id_col), F.lit(-(1 << 63))).alias("_i"), F.col(id_col).isNotNull().alias("_n"), F.when(F.col(tie) == F.lit(-(1 << 63)), F.lit((1 << 63) - 1)).otherwise(-F.col(tie)).alias("_t"))
    ends = ranged.groupBy("_part").agg(F.min_by(own, least).alias("_end"))
    every = Window.orderBy("_part")
    whole = Window.partitionBy()
    joints = ends.select("_part", F.coalesce(F.lag("_end").over(every), F.max_by("_end", "_part").over(whole)).alias("_joint"))
    return ranged.withColumn("_lag", F.lag(own).over(within)).join(F.broadcast(joints), "_part").withColumn("asker", F.coalesce("_lag", "_joint")).drop("_lag", "_joint", "_part")


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """One row per input row: the id, n_chars long, edited string, sketch, edited_sketch and next_sketch array<long>.

    The next document is the one of the next smaller id (after the last, the first; a lone document is its own next). An
    edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next document's.

    A null text is an empty one. Rows that repeat an id over different texts are different documents, ordered by
    a hash of the text; rows that repeat id and text are one, and are each returned. Null ids come last. Ids must be
    integers; other columns are ignored; an empty table gives an empty table.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = F.col(f"`{id_col}`").cast("long")
    # ids that are null can't be joined on; the hash tells them from 0
    rows = docs.select(F.coalesce(given, F.lit(0).cast("long")).alias("i"), F.xxhash64(given.isNull(), text).alias("k"), given.alias("id"), text.alias("text"))
    keys = rows.groupBy("id", "k").agg(F.first(F.char_length("text").cast("long")).alias("chars"))
    asked = before_each(keys, "id", "k", "chars").select(F.coalesce("id", F.lit(0).cast("long")).alias("i"), "k", F.coalesce("asker.id", F.lit(0).cast("long")).alias("ask_i"), F.col("asker.k").alias("ask_k"), F.col("asker.id").isNull().alias("nameless"), F.expr("asker.chars div 3").cast("int").alias("reach"))
    # texts are dealt out once, by their keys; what is given away holds a third of them at most
    dealt = rows.select("i", "k", "text")
    given_away = dealt.join(asked.hint("shuffle_hash"), ["i", "k"])
    given_away = given_away.select(F.col("ask_i").alias("i"), F.col("ask_k").alias("k"), "nameless", F.expr("substring(text, 1, reach)").alias("patch"), sketch(F.col("text"), n, scale).alias("next_sketch"))
    patches = given_away.groupBy("i", "k").agg(F.first("nameless").alias("nameless"), F.first("patch").alias("patch"), F.first("next_sketch").alias("next_sketch"))
    met = dealt.join(patches.hint("shuffle_hash"), ["i", "k"]).withColumn("chars", F.char_length("text").cast("long"))
    edited = F.concat(F.expr("substring(text, 1, cast(chars - chars div 3 as int))"), F.col("patch"))
    met = met.select(F.when(~F.col("nameless"), F.col("i")).alias(id_col), F.col("chars").alias("n_chars"), edited.alias("edited"), sketch(F.col("text"), n, scale).alias("sketch"), "next_sketch")
    return met.withColumn("edited_sketch", sketch(F.col("edited"), n, scale))
