"""Removal of lines that several documents share.

Lines are exploded, normalised and hashed; the smallest and largest document id of each hash
tell whether at least two documents hold it (partial aggregation leaves one row per hash and
task, however common a line is). Shared hashes are joined back to the exploded lines as a
plain equi join, whose large keys adaptive execution splits, and each document is put together
again from the positions that stay.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import ascii_lower, cut, row_key, without

MIN_CHARS = 10
#: Fixed value: the characters of `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """The lines of a text, each normalised; null counts as empty."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1)


def exploded(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, key, pos, h1, h2) of every line long enough; 128 bits of hash."""
    lines = rows.select("id", "key", F.posexplode(line_keys(F.col("text"))).alias("pos", "line"))
    lines = lines.select("id", "key", "pos", F.btrim("line", F.lit(BLANKS)).alias("line")).filter(F.char_length("line") >= min_chars)
    return lines.select("id", "key", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents without the lines that a document of smaller id holds too.

    Returns all input columns, the text rewritten, and n_lines (before), n_dropped. A line's key
    is the line stripped of ASCII white space and with A-Z lower-cased; keys shorter than
    min_chars code points never count. All lines of a key stay in the smallest id that holds it
    and go elsewhere; the others are joined by newlines, in order.

    Null or empty text: one empty line, kept, and the text becomes empty. Rows of one id are one
    document: repeated rows keep or lose the same lines. Rows with a null id are returned as they
    are (null text as empty) and count for no other. Input columns named as a result column are
    replaced. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")).filter(F.col("id").isNotNull())
    shared = exploded(rows, min_chars).groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter(F.col("first") < F.col("last"))
    shared = cut(shared.select("h1", "h2", "first"))
    gone = exploded(rows, min_chars).join(shared, ["h1", "h2"]).filter(F.col("id") > F.col("first")).groupBy("id", "key").agg(F.collect_set("pos").alias("_gone"))
    gone = gone.select(F.col("id").alias("_gone_id"), F.col("key").alias("_gone_key"), "_gone")
    text, kept = F.coalesce(F.col(text_col), F.lit("")), F.col("_gone")
    lines = F.split(text, "\n", -1)
    # the lambda binds the lines once; named twice in one expression they would be split anew for each line
    joined = F.transform(F.array(lines), lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), kept), lambda i: F.get(x, i)), "\n"))
    out = without(docs, "n_lines", "n_dropped", "_gone_id", "_gone_key", "_gone")
    names = out.columns
    out = out.join(gone, (F.col(id_col) == F.col("_gone_id")) & (row_key(id_col, text_col) == F.col("_gone_key")), "left")
    text = F.when(kept.isNull(), text).otherwise(joined[0])
    return out.select(
        *[text.alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in names],
        F.size(lines).cast("long").alias("n_lines"), F.when(kept.isNull(), 0).otherwise(F.size(kept)).cast("long").alias("n_dropped"),
    )
