"""Column functions over rule texts, headings and names. None of them runs Python on the workers but decode_entities()."""
from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexhull.rules import names as rules

#: Java's engine made to read a pattern as the rules mean it: Unicode classes and case, "\n" as the only line end.
FLAGS, ANY_CASE = "(?dU)", "(?iudU)"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def filled(text: Column) -> Column:
    """Stripped; null where nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def split_code(code: Column) -> tuple[Column, Column]:
    """(dossier part, indication part) at the first dot; the second is null without one."""
    parts = F.split(code, r"\.", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def content_hash(*texts: Column) -> Column:
    """md5 of the texts joined by a bar, null as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(t, F.lit("")) for t in texts]))


def code_type(is_fallback: Column, code: Column) -> Column:
    return F.when(is_fallback, "FALLBACK").when(code.ilike("%.xx"), "CROSS_INDICATION").otherwise("REAL_CODE")


def to_number(text: Column) -> Column:
    """A plain decimal as double, else null."""
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def is_structural(name: Column, connectives: list[str] = rules.CONNECTIVES, prefixes: list[str] = rules.STRUCTURAL_PREFIXES) -> Column:
    """Whether a bold name only structures a text: none, a connective, a listed beginning, a number, or a very short lower-case word."""
    bare = F.regexp_replace(strip(name), ":+$", "")
    begins = F.lit(False)
    for p in prefixes:
        begins = begins | bare.startswith(p)
    number = F.regexp_replace(bare, "[.,]", "").rlike(r"(?U)^\d+$")
    short = (F.length(bare) <= 3) & (F.lower(bare) == bare) & bare.rlike(r"\p{Ll}")
    return F.coalesce((name == "") | bare.isin(connectives) | begins | number | short, F.lit(True))


def text_codes(texts: list[Column], patterns: list[str] = rules.CODE_CONTEXTS) -> Column:
    """Distinct codes that any pattern finds in any of the texts, in order of text and pattern."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(F.regexp_extract_all(t, F.lit(ANY_CASE + p), F.lit(1)), empty) for t in texts for p in patterns])))


def bold_names(text: Column) -> Column:
    """All bold stretches, joined by ' | '; null where there are none."""
    return F.nullif(F.array_join(F.regexp_extract_all(text, F.lit("(?d)<b>(.+?)</b>"), F.lit(1)), " | "), F.lit(""))


#: A bold stretch at the start of the text or of a line, or after line breaks.
HEADER = r"(?dm)(?:^|<br\s*/?>\s*(?:<br\s*/?>\s*)*)(<b>.+?</b>)"


def segments(text: Column) -> Column:
    """array<struct<name, body>>: the text cut at bold headers that begin a paragraph; what precedes the first is left out."""
    heads = F.regexp_extract_all(text, F.lit(HEADER), F.lit(1))
    bodies = F.split(text, HEADER, -1)
    found = F.zip_with(heads, F.slice(bodies, 2, F.greatest(F.size(bodies) - 1, F.lit(0))), lambda h, b: F.struct(F.regexp_extract(h, "(?d)<b>(.+?)</b>", 1).alias("name"), strip(b).alias("body")))
    return F.when(text.isNotNull() & (text != ""), found).otherwise(F.array().cast("array<struct<name:string,body:string>>"))


def aligned(*parts: Column) -> Column:
    """Arrays side by side by position, the shorter ones filled up with null."""
    return F.arrays_zip(*parts)


def clean_markup(text: Column) -> Column:
    """Line breaks to blanks, bold and underline dropped, non-breaking blanks and runs of white space to one blank."""
    text = F.regexp_replace(text, "<br/?>|&nbsp;", " ")
    return strip(F.regexp_replace(F.regexp_replace(text, "</?[bu]>", ""), r"(?U)\s+", " "))


def clean_export(text: Column) -> Column:
    """All tags dropped, the four common entities decoded, line ends and runs of blanks to one blank."""
    text = F.regexp_replace(F.regexp_replace(text, r"<br\s*/?>", " "), "<[^>]+>", "")
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return strip(F.regexp_replace(F.translate(text, "\n\r", "  "), " {2,}", " "))


#: A character reference as Python's html module reads one.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescaped(references: pd.Series) -> pd.Series:
    return references.map(lambda each: [html.unescape(r) for r in each], na_action="ignore")


def decode_entities(text: Column) -> Column:
    """All character references; only the different ones of a text are sent to Python, never the text."""
    each = F.when(text.contains("&"), F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))))
    told = F.struct(text.alias("t"), F.map_from_arrays(each, unescaped(each)).alias("known"))

    def filled_in(x: Column) -> Column:
        parts = F.zip_with(F.split(x["t"], REFERENCE, -1), F.regexp_extract_all(x["t"], F.lit(REFERENCE), F.lit(0)), lambda s, r: F.concat(s, F.coalesce(x["known"][r], F.lit(""))))
        return F.array_join(parts, "")

    return F.when(text.contains("&"), F.transform(F.array(told), filled_in)[0]).otherwise(text)


def first_sentence(text: Column, n: int = 120) -> Column:
    """Up to the first full stop if it comes within n characters, else the first n with '...'."""
    stop = F.instr(text, ".")
    cut = F.concat(strip(F.substring(text, 1, n)), F.when(F.length(text) > n, "...").otherwise(""))
    return F.when((stop > 1) & (stop <= n), strip(F.substring(text, 1, stop))).otherwise(cut)


def normalised(name: Column, lower: bool = False) -> Column:
    """Stripped, without closing colons, white space as one blank; null as empty."""
    out = F.regexp_replace(strip(F.regexp_replace(strip(F.coalesce(name, F.lit(""))), ":+$", "")), r"(?U)\s+", " ")
    return F.lower(out) if lower else out


def canonical_brands(name: Column, brands: dict[str, str] = rules.BRANDS) -> Column:
    """Brand names replaced by canonical ones, the longest first; a later rule sees what an earlier one made."""

    def replaced(n: Column) -> Column:
        for brand, canonical in sorted(brands.items(), key=lambda p: -len(p[0])):
            n = F.replace(n, F.lit(brand), F.lit(canonical))
        return n

    # bound once, so that the many replacements are no part of generated code, whose size is limited
    return F.transform(F.array(name), replaced)[0]


def combination_rewritten(name: Column) -> Column:
    """'Kombination X, Y' to 'X in Kombination mit Y'."""
    return F.regexp_replace(name, r"(?dU)^Kombination\s+(\S*[^\s,]),*(?:\s+|$)(.*)", "$1 in Kombination mit $2")


def embedded_code(name: Column, pattern: str = rules.EMBEDDED_CODE) -> Column:
    return F.nullif(F.regexp_extract(name, FLAGS + pattern, 1), F.lit(""))
