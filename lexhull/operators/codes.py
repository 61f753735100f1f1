"""Indication codes of limitations and the segments of their texts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexhull.functions import text as tx
from lexhull.rules import names as rules
from lexhull.sources.tables import dealt


def structured_codes(preferred: Column, other: Column) -> Column:
    """Trimmed, non-blank codes of the first list, or of the second if the first has none."""

    def trimmed(codes: Column) -> Column:
        return F.filter(F.transform(F.coalesce(codes, F.array().cast("array<string>")), tx.strip), lambda c: c != "")

    return F.when(F.size(trimmed(preferred)) > 0, trimmed(preferred)).otherwise(trimmed(other))


def assign_codes(df: DataFrame, structured: str, texts: list[str], kind: str, dossier: str, suffix: str = ".xx", patterns: list[str] = rules.CODE_CONTEXTS) -> DataFrame:
    """One row per limitation and code, with code_source and the two parts of the code.

    Codes given in structure win over codes found in the texts, these over the fallback
    `<dossier><suffix>`, which only limitations of kind DIA with a known dossier get.
    """
    decoded = [tx.decode_entities(F.col(t)) for t in texts]
    out = df.withColumn("_given", F.coalesce(F.col(structured), F.array().cast("array<string>"))).withColumn("_found", tx.text_codes(decoded, patterns))
    fallback = F.when((F.col(kind) == "DIA") & tx.filled(F.col(dossier)).isNotNull(), F.array(F.concat(F.col(dossier), F.lit(suffix))))
    codes = F.when(F.size("_given") > 0, F.col("_given")).when(F.size("_found") > 0, F.col("_found")).otherwise(fallback)
    source = F.when(F.size("_given") > 0, "STRUCTURED_XML").when(F.size("_found") > 0, "TEXT_PARSED").otherwise("FALLBACK_XX")
    out = out.withColumn("code_source", source).withColumn("code_value", F.explode(codes)).drop("_given", "_found")
    head, tail = tx.split_code(F.col("code_value"))
    return out.withColumn("dossier_part", head).withColumn("indication_part", tail)


def named_limitations(df: DataFrame, kind: str = "limitation_type", code: str = "limitation_code", texts: dict[str, str] | None = None) -> DataFrame:
    """Adds indication_name_<language> for limitations of kind DIA."""
    for lang, col in (texts or {x: f"description_{x}" for x in ("de", "fr", "it")}).items():
        df = df.withColumn(f"indication_name_{lang}", F.when(F.col(kind) == "DIA", tx.bold_names(F.col(col))))
    return df


def segment_table(df: DataFrame, key: str, texts: dict[str, str], renumber: bool = True, name_by: list[str] | None = None) -> DataFrame:
    """One row per segment: key, segment_order, indication_name_<lang> and segment_text_<lang>.

    Languages are aligned by position. A segment is left out when its heading only structures the
    text; the heading looked at is the first filled one of name_by (default: the first language).
    With renumber, orders run from 0 without gaps, else they keep the position in the text. Texts of few row groups are dealt out first.
    """
    langs = list(texts)
    zipped = dealt(df).select(key, F.posexplode(F.arrays_zip(*[tx.segments(F.col(c)).alias(f"s{i}") for i, c in enumerate(texts.values())])).alias("segment_order", "_s"))
    fields = []
    for i, lang in enumerate(langs):
        fields += [F.col(f"_s.s{i}.name").alias(f"indication_name_{lang}"), F.col(f"_s.s{i}.body").alias(f"segment_text_{lang}")]
    out = zipped.select(key, "segment_order", *fields)
    out = out.filter(~tx.is_structural(tx.first_filled(*[F.col(f"indication_name_{x}") for x in (name_by or langs[:1])])))
    if renumber:
        out = out.withColumn("segment_order", F.row_number().over(Window.partitionBy(key).orderBy("segment_order")) - 1)
    return out


def mappable(df: DataFrame, kind: str = "limitation_type", name: str = "indication_name_de", code: str = "limitation_code", unnamed: list[str] = rules.UNNAMED_CODES) -> DataFrame:
    """Limitations of kind DIA with a name, whose code is not known to name no indication."""
    return df.filter((F.col(kind) == "DIA") & F.col(name).isNotNull() & ~F.coalesce(F.col(code), F.lit("")).isin(unnamed))
