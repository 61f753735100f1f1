"""Model replies in JSON as label tables, and their comparison with mined rules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .history import latest_wins, unprocessed

# What a reply may say.
CALC_TYPES = ["percentage", "chf_fixed", "chf_per_mg", "chf_per_box", "full_refund", "undisclosed_fixed", "unknown"]
UNITS = ["per_box", "per_mg", "per_cycle", "per_month", "per_patient", "per_year", "per_treatment", "per_dose", "per_week", "per_flacon", "per_syringe", "per_pen", "unknown"]
LARGE, BEFORE_YEAR = 2000, 2023


def route(text: Column, large: int = LARGE) -> Column:
    return F.when(F.length(text) >= large, "large").otherwise("small")


def targets(texts: DataFrame, segments: DataFrame, done: DataFrame, before: int = BEFORE_YEAR, force: bool = False, limit: int | None = None) -> DataFrame:
    """Texts of earlier years with a refund and no segments that have not been labelled yet, each with its route; the first by id if a limit is asked for."""
    open_ = texts.filter((F.col("file_year") < before) & F.col("is_cashback")).join(segments.select("text_id").distinct(), "text_id", "left_anti")
    out = unprocessed(open_, done, "text_id", force).withColumn("route", route(F.col("text")))
    return out if limit is None else out.orderBy("text_id").limit(limit)


def unfenced(raw: Column) -> Column:
    """The reply without a code fence around it."""
    body = F.regexp_replace(raw, r"^\s+|\s+$", "")
    return F.when(body.startswith("```"), F.regexp_replace(F.regexp_replace(body, r"^```(?:json)?\s*\n?", ""), r"\n?```\s*$", "")).otherwise(body)


def parse_replies(replies: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds reply (typed; vocabulary checked) and error: why a reply is of no use, else null.

    A segment must have the keys of a name and of a verdict; either may be null. Values of another type than the
    reply's are null, words that are not known become unknown.
    """
    out = replies.withColumn("_v", F.try_parse_json(unfenced(F.col(raw)).cast("string")))
    parts = F.expr("try_variant_get(_v, '$.segments', 'array<variant>')")
    # a null in JSON is a value here, a missing key is none
    has = lambda s, key: F.try_variant_get(s, f"$.{key}", "variant").isNotNull()
    error = (
        F.when(F.col("_v").isNull(), "no JSON").when(~F.schema_of_variant("_v").startswith("OBJECT"), "no object").when(~has(F.col("_v"), "segments"), "no segments").when(F.col("_parts").isNull(), "segments are no list")
        .when(F.size("_parts") == 0, "empty segments").when(F.exists("_parts", lambda s: F.coalesce(~has(s, "indication_name_fr"), F.lit(True))), "segment without a name").when(F.exists("_parts", lambda s: ~has(s, "is_cashback")), "segment without a verdict")
    )
    got = lambda s, key, kind: F.try_variant_get(s, f"$.{key}", kind).alias(key)

    def known(s: Column, key: str, words: list[str]) -> Column:
        word = F.try_variant_get(s, f"$.{key}", "string")
        told = F.try_variant_get(s, f"$.{key}", "variant")
        return F.when(told.isNull() | F.is_variant_null(told), None).when(word.isin(words), word).otherwise("unknown").alias(key)

    typed = F.transform("_parts", lambda s: F.struct(
        got(s, "order", "int"), got(s, "indication_name_fr", "string"), got(s, "is_cashback", "boolean"), got(s, "cashback_company", "string"),
        known(s, "cashback_calc_type", CALC_TYPES), got(s, "cashback_calc_value", "double"), known(s, "cashback_unit", UNITS),
    ))
    reply = F.struct(got(F.col("_v"), "is_multi_indication", "boolean"), got(F.col("_v"), "comment", "string"), typed.alias("segments"))
    out = out.withColumn("_parts", parts).withColumn("error", error)
    return out.withColumn("reply", F.when(F.col("error").isNull(), reply)).select(*replies.columns, "reply", "error")


def reply_segments(replies: DataFrame, key: str = "text_id", at: str = "processed_at") -> DataFrame:
    """One row per segment of the latest usable reply of each text."""
    good = latest_wins(parse_replies(replies).filter("error is null").select(key, at, "reply"), [key], [at, F.to_json("reply")])
    return good.select(key, F.col("reply.is_multi_indication").alias("is_multi_indication"), F.posexplode("reply.segments").alias("segment_order", "s")).select(key, "is_multi_indication", "segment_order", "s.indication_name_fr", "s.is_cashback", "s.cashback_company", "s.cashback_calc_type", "s.cashback_calc_value", "s.cashback_unit")


def judged(labels: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, a, b): whether labels and rules found a refund in a text that both judged. Both have key and is_cashback, once or more per text."""
    a = labels.groupBy(key).agg(F.max(F.col("is_cashback").cast("int")).alias("a"))
    return a.join(rules.groupBy(key).agg(F.max(F.col("is_cashback").cast("int")).alias("b")), key)


def concordance(labels: DataFrame, rules: DataFrame, key: str = "text_id") -> DataFrame:
    """One row: texts that both judged, how many agree, the rate."""
    agree = F.coalesce(F.sum((F.col("a") == F.col("b")).cast("int")), F.lit(0))
    return judged(labels, rules, key).agg(F.count("*").alias("n_texts"), agree.alias("n_agree"), F.when(F.count("*") > 0, agree / F.count("*")).otherwise(0.0).alias("rate"))


def disagreements(labels: DataFrame, rules: DataFrame, key: str = "text_id") -> DataFrame:
    """(key, by_label, by_rule) of the texts that labels and rules judge differently."""
    return judged(labels, rules, key).filter("a <> b").select(key, F.col("a").alias("by_label"), F.col("b").alias("by_rule"))


def label_calculations(segments: DataFrame) -> DataFrame:
    """Segments with a refund by calculation; null where a reply names none."""
    return segments.filter("is_cashback").groupBy("cashback_calc_type").agg(F.count("*").alias("n"))


def multi_indication_sample(segments: DataFrame, n: int = 10, key: str = "text_id") -> DataFrame:
    """(key, n_segments, names) of the n texts of several indications with the most segments; ties by key."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_order", "indication_name_fr"))), lambda x: x["indication_name_fr"]), " | ")
    out = segments.filter("is_multi_indication").groupBy(key).agg(F.count("*").alias("n_segments"), listed.alias("names"))
    return out.orderBy(F.desc("n_segments"), key).limit(n)
