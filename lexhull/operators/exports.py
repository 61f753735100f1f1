"""Denormalised tables for analysis."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexhull.functions import text as tx

from .history import grows, resolve_dates
from .intervals import earliest, latest, overlap_join


def item_indications(codes: DataFrame, limitations: DataFrame, preparations: DataFrame, packs: DataFrame, extracts: DataFrame) -> DataFrame:
    """Codes of limitations x packs of the code's product and dossier that were listed while the code was, with the dates of each.

    codes: limitation_id, preparation_id, bag_dossier_no, code_value, ..., first_seen, last_seen; limitations:
    limitation_id, ..., first_seen, last_seen; preparations: preparation_id and names; packs: preparation_id,
    bag_dossier_no, gtin, ..., first_seen, last_seen; extracts: extract_id, release_date. A code without
    such a pack stays, once, with null pack columns. The effective interval is shared by pack and code.
    """
    lims = limitations.select("limitation_id", F.col("first_seen").alias("_lf"), F.col("last_seen").alias("_ll"), *[c for c in limitations.columns if c not in ("limitation_id", "preparation_id", "first_seen", "last_seen", *codes.columns)])
    # all of these grow with the input
    base = codes.join(grows(lims), "limitation_id").join(grows(preparations.select("preparation_id", *[c for c in preparations.columns if c not in (*codes.columns, *lims.columns)])), "preparation_id")
    out = overlap_join(base, grows(packs.select(*[c for c in packs.columns if c in ("preparation_id", "bag_dossier_no", "first_seen", "last_seen") or c not in base.columns])), ["preparation_id", "bag_dossier_no"])
    dossier, indication = tx.split_code(F.col("code_value"))
    out = out.withColumn("dossier_part", dossier).withColumn("indication_part", indication)
    return resolve_dates(
        out, extracts, code_first_seen="first_seen", code_last_seen="last_seen", limitation_first_seen="_lf", limitation_last_seen="_ll",
        pack_first_seen="first_seen_right", pack_last_seen="last_seen_right", effective_from="valid_from", effective_to="valid_thru",
    ).drop("first_seen", "last_seen", "_lf", "_ll", "first_seen_right", "last_seen_right", "valid_from", "valid_thru")


def segment_listing(segments: DataFrame, limitations: DataFrame, preparations: DataFrame) -> DataFrame:
    """All segments with product name and limitation code, in order of these."""
    out = segments.join(grows(limitations.select("limitation_id", "limitation_code")), "limitation_id").join(grows(preparations.select("preparation_id", F.col("name_de").alias("product_name"))), "preparation_id")
    return out.orderBy("product_name", "limitation_code", "segment_order")


def segment_rules(rules: DataFrame, segments: DataFrame) -> DataFrame:
    """Refund rules of segments (segment_id) with the segment's place and name, in order of product, limitation and place."""
    names = segments.select("segment_id", "segment_order", "product_name", "limitation_code", "indication_name_fr")
    return rules.join(names, "segment_id").orderBy("product_name", "limitation_code", "segment_order")


def limitation_rules(rules: DataFrame, limitations: DataFrame, preparations: DataFrame) -> DataFrame:
    """Refund rules of whole limitations (limitation_id), in order of product."""
    named = limitations.select("limitation_id", "preparation_id", "limitation_code").join(preparations.select("preparation_id", F.col("name_de").alias("product_name")), "preparation_id")
    return rules.join(named, "limitation_id").orderBy("product_name", "limitation_id")


def with_packs(df: DataFrame, packs: DataFrame) -> DataFrame:
    """Left join with the packs of a product; their hull becomes pack_first and pack_last."""
    return df.join(grows(packs.select("preparation_id", *[c for c in packs.columns if c not in ("first_seen", "last_seen", *df.columns)], F.col("first_seen").alias("pack_first"), F.col("last_seen").alias("pack_last"))), "preparation_id", "left")


def refund_analysis(segments: DataFrame, packs: DataFrame, rules: DataFrame, extracts: DataFrame, texts: list[str] = ("segment_text_fr",)) -> DataFrame:
    """All segments x packs of their product, if any, with the rule mined from the segment, if any, and cleaned texts; dates of packs and limitations."""
    out = with_packs(segments, packs).join(grows(rules.withColumn("_rule", F.lit(True))), "segment_id", "left")
    out = out.withColumn("has_cashback", F.col("_rule").isNotNull().cast("int")).drop("_rule").withColumns({t: tx.clean_export(F.col(t)) for t in texts})
    return resolve_dates(out, extracts, pack_from="pack_first", pack_thru="pack_last", limitation_from="first_seen", limitation_thru="last_seen")


def unsegmented_analysis(limitations: DataFrame, segments: DataFrame, packs: DataFrame, rules: DataFrame, extracts: DataFrame, texts: list[str] = ("description_fr",)) -> DataFrame:
    """The same for limitations that have a rule and no segment."""
    rest = limitations.join(segments.select("limitation_id").distinct(), "limitation_id", "left_anti").join(rules, "limitation_id")
    out = with_packs(rest, packs).withColumn("has_cashback", F.lit(1)).withColumns({t: tx.clean_export(F.col(t)) for t in texts})
    return resolve_dates(out, extracts, pack_from="pack_first", pack_thru="pack_last", limitation_from="first_seen", limitation_thru="last_seen")


def flat_links(links: DataFrame, items: DataFrame, texts: DataFrame) -> DataFrame:
    """Item x code links with item and text columns and the type of code."""
    out = links.join(items, "gtin").join(texts, "content_hash", "left")
    return out.withColumn("code_type", tx.code_type(F.col("is_fallback"), F.col("indication_code")))


def shared_validity(first_a: str, last_a: str, first_b: str, last_b: str) -> tuple:
    """(from, thru) of two hulls; null where either side is."""
    return latest(F.col(first_a), F.col(first_b)), earliest(F.col(last_a), F.col(last_b))
