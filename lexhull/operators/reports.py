"""Counts, coverage and lists for reports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexhull.functions.text import code_type
from lexhull.rules import refunds as refund_rules


def distribution(df: DataFrame, *by: str) -> DataFrame:
    """Rows per category."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and for each condition how many meet it and their share (0 for no rows)."""
    aggs = [F.count("*").alias("n")]
    for name, test in conditions.items():
        hits = F.count_if(test)
        aggs += [hits.alias(f"n_{name}"), F.when(F.count("*") > 0, hits / F.count("*")).otherwise(0.0).alias(f"share_{name}")]
    return df.agg(*aggs)


def keys_having(df: DataFrame, key: str, *, rows: int | None = None, distinct: str | None = None, least: int | None = None) -> DataFrame:
    """Keys with so many rows, or with so many distinct values of a column; exactly or at least."""
    n = F.countDistinct(distinct) if distinct else F.count("*")
    wanted = (F.col("_n") >= least) if least is not None else (F.col("_n") == rows)
    return df.groupBy(key).agg(n.alias("_n")).filter(wanted).select(key)


def joined_list(df: DataFrame, by: list[str], value: str, name: str, sep: str = ",", order: str | None = None) -> DataFrame:
    """Distinct values of a group in one string, sorted; with order, all values in that order."""
    listed = F.array_sort(F.collect_set(F.col(value).cast("string"))) if order is None else F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(value).cast("string").alias("_v")))), lambda x: x["_v"])
    return df.groupBy(*by).agg(F.array_join(listed, sep).alias(name))


def code_summary(links: DataFrame, code: str = "indication_code", entity: str = "gtin", fallback: str = "is_fallback") -> DataFrame:
    """Rows, distinct codes and distinct entities by type of code."""
    return links.groupBy(code_type(F.col(fallback), F.col(code)).alias("code_type")).agg(F.count("*").alias("n_rows"), F.countDistinct(code).alias("n_codes"), F.countDistinct(entity).alias("n_entities"))


def unmatched_names(segments: DataFrame, packs: DataFrame, key: str = "preparation_id") -> DataFrame:
    """Names of segments without a code by dossier; each segment counts once for every pack of its product, or once without any."""
    left = segments.filter(F.col("matched_code_value").isNull() & F.col("indication_name_de").isNotNull()).join(packs.select(key, "bag_dossier_no"), key, "left")
    return left.groupBy("indication_name_de", "bag_dossier_no").agg(F.count("*").alias("n_segments"))


def map_quality(names: DataFrame, links: DataFrame, code: str = "indication_code", source: str = "match_source") -> DataFrame:
    """One row per source of names and one for all of them (source null): mappings, codes, and the codes' share of all codes."""
    all_codes = links.agg(F.countDistinct(code).alias("_all"))
    counted = names.rollup(source).agg(F.count("*").alias("n_mappings"), F.countDistinct(code).alias("n_codes"))
    # one row, whatever the input
    return counted.join(F.broadcast(all_codes)).select(source, "n_mappings", "n_codes", F.when(F.col("_all") > 0, F.col("n_codes") / F.col("_all")).otherwise(0.0).alias("share"))


def refund_report(rules: DataFrame, n_texts: int | None = None) -> DataFrame:
    """(kind, name, n): how many refunds were found, by calculation, primary threshold and condition, with several thresholds and with drugs given along."""
    flags = ["cond_treatment_stop", "cond_adverse_effects", "cond_treatment_failure"]
    threshold = F.col("rule_threshold_type")
    entries = [F.struct(F.lit("detected").alias("kind"), F.lit("refund").alias("name")), F.struct(F.lit("calc").alias("kind"), F.col("rule_calc_type").alias("name"))]
    entries += [F.when(threshold.isNotNull(), F.struct(F.lit(k).alias("kind"), v.alias("name"))) for k, v in (("with_threshold", F.lit("any")), ("threshold", threshold))]
    entries.append(F.when(F.size("thresholds") > 1, F.struct(F.lit("with_threshold").alias("kind"), F.lit("several").alias("name"))))
    entries += [F.when(F.col(c), F.struct(F.lit("condition").alias("kind"), F.lit(c.removeprefix("cond_")).alias("name"))) for c in flags]
    entries.append(F.when(F.size("cotreatments") > 0, F.struct(F.lit("with_cotreatments").alias("kind"), F.lit("any").alias("name"))))
    out = rules.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).groupBy("e.kind", "e.name").agg(F.count("*").alias("n"))
    if n_texts is None:
        return out
    seen = rules.agg(F.count("*").alias("_d")).select(F.lit("detected").alias("kind"), F.lit("none").alias("name"), (F.lit(n_texts) - F.col("_d")).alias("n"))
    return out.unionByName(seen)


def watched_refunds(rules: DataFrame, name: str = "refunds") -> tuple[DataFrame, Observation]:
    """The rules with counters that fill while they are written, so that a report needs no second pass. watched_report() reads them afterwards."""
    flags = ["cond_treatment_stop", "cond_adverse_effects", "cond_treatment_failure"]
    counted = {("detected", "refund"): F.lit(True), ("with_threshold", "any"): F.col("rule_threshold_type").isNotNull(), ("with_threshold", "several"): F.size("thresholds") > 1, ("with_cotreatments", "any"): F.size("cotreatments") > 0}
    counted |= {("condition", c.removeprefix("cond_")): F.col(c) for c in flags}
    counted |= {("calc", kind): F.col("rule_calc_type") == kind for kind in dict.fromkeys([*(k for k, _, _ in refund_rules.CALCULATIONS), "unknown"])}
    counted |= {("threshold", kind): F.col("rule_threshold_type") == kind for kind in dict.fromkeys(k for k, _, _ in refund_rules.THRESHOLDS)}
    seen = Observation(name)
    return rules.observe(seen, *[F.count_if(test).alias(f"{kind}:{what}") for (kind, what), test in counted.items()]), seen


def watched_report(seen: Observation, n_texts: int | None = None) -> list[tuple[str, str, int]]:
    """(kind, name, n) of what has been written, as refund_report() counts it; waits until it has been."""
    out = [(*key.split(":", 1), n) for key, n in seen.get.items() if n or key == "detected:refund"]
    return out if n_texts is None else [*out, ("detected", "none", n_texts - seen.get["detected:refund"])]


def codes_without_names(links: DataFrame, names: DataFrame, code: str = "indication_code") -> DataFrame:
    return links.select(code).distinct().join(names.select(code).distinct(), code, "left_anti")


def names_without_codes(segments: DataFrame, names: DataFrame, name: str = "indication_name_de") -> DataFrame:
    return segments.filter(F.col(name).isNotNull()).select(name).distinct().join(names.select(name).distinct(), name, "left_anti")


def top(df: DataFrame, n: int, by: str) -> DataFrame:
    """The n rows with the largest values; ties by the other columns."""
    return df.orderBy(F.desc(by), *[c for c in df.columns if c != by]).limit(n)
