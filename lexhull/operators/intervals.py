"""Joins over validity intervals [first_seen, last_seen]."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexhull.sources.tables import cut

from .history import grows


def overlaps(a_first: Column, a_last: Column, b_first: Column, b_last: Column) -> Column:
    return (a_first <= b_last) & (a_last >= b_first)


def latest(a: Column, b: Column) -> Column:
    """The larger of two; null if either is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def earliest(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", first: str = "first_seen", last: str = "last_seen") -> DataFrame:
    """Equi join on the keys where the intervals overlap; adds valid_from and valid_thru, the shared interval.

    The interval test is a residual of the equi join, so the join is dealt out by the keys and
    adaptive execution splits keys with many rows. Right columns of the same name get the
    suffix _right.
    """
    names = {c: c if c not in left.columns else f"{c}_right" for c in right.columns}
    other = right.select(*[F.col(c).alias(f"_k{keys.index(c)}" if c in keys else names[c]) for c in right.columns])
    test = overlaps(F.col(first), F.col(last), F.col(f"{first}_right"), F.col(f"{last}_right"))
    for i, k in enumerate(keys):
        test = (F.col(k) == F.col(f"_k{i}")) & test
    out = left.join(other, test, how).drop(*[f"_k{i}" for i in range(len(keys))])
    return out.withColumn("valid_from", latest(F.col(first), F.col(f"{first}_right"))).withColumn("valid_thru", earliest(F.col(last), F.col(f"{last}_right")))


def bucket_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, how: str = "inner", row: list[str] = (), first: str = "first_seen", last: str = "last_seen") -> DataFrame:
    """What overlap_join() gives, for keys with so many intervals that most of their pairs don't overlap.

    Time is cut into buckets of a width, and each interval stands in all the buckets it covers, so only intervals of one bucket are
    compared; a pair is reported in the first bucket that both cover. A width near the usual length of an interval is best: then an interval stands in
    about two buckets. A left join needs row, columns that tell the left rows apart; its pairs are written to the shared folder once, as the rows without one are
    found from them. An exploded side is many times what the planner takes it for, and is never broadcast. Ends are integers; intervals with a null end, or that end before they begin, meet nothing.
    """
    if how not in ("inner", "left") or (how == "left" and not row):
        raise ValueError("how is inner or left, and a left join needs the columns of row")
    names = {c: c if c not in left.columns else f"{c}_right" for c in right.columns}
    span = lambda a, b: F.when(F.col(a) <= F.col(b), F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    ours = left.withColumn("_bucket", F.explode(span(first, last)))
    other = right.select(*[F.col(c).alias(f"_k{keys.index(c)}" if c in keys else names[c]) for c in right.columns])
    other = other.withColumn("_other", F.explode(span(f"{first}_right", f"{last}_right")))
    test = F.col("_bucket") == F.col("_other")
    for i, k in enumerate(keys):
        test = (F.col(k) == F.col(f"_k{i}")) & test
    test = test & overlaps(F.col(first), F.col(last), F.col(f"{first}_right"), F.col(f"{last}_right"))
    test = test & (F.col("_bucket") == F.floor(F.greatest(first, f"{first}_right") / width))
    out = ours.join(grows(other), test).drop("_bucket", "_other", *[f"_k{i}" for i in range(len(keys))])
    if how == "left":
        out = cut(out)
        met = grows(out.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(row)]).distinct())
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_m{i}")) for i, c in enumerate(row)])
        out = out.unionByName(left.join(met, same, "left_anti"), allowMissingColumns=True)
    return out.withColumn("valid_from", latest(F.col(first), F.col(f"{first}_right"))).withColumn("valid_thru", earliest(F.col(last), F.col(f"{last}_right")))


def fan_out(links: DataFrame, items: DataFrame, key: str, level: str = "limitation_level", dossier: str = "bag_dossier_no", code: str = "indication_code", keep: list[str] = ()) -> DataFrame:
    """Links of a product carried to its items for the time both are valid.

    links has key, level, code, first_seen, last_seen; items has key, item, dossier, first_seen,
    last_seen. A link of level PACK reaches only items whose dossier is that of its code. Of
    several links of one (item, code, *keep), the first in order of level and interval stays.
    """
    i = items.select(F.col(key).alias("_key"), "item", F.col(dossier).alias("_dossier"), F.col("first_seen").alias("_first"), F.col("last_seen").alias("_last"))
    met = links.join(i, (F.col(key) == F.col("_key")) & overlaps(F.col("first_seen"), F.col("last_seen"), F.col("_first"), F.col("_last")))
    met = met.filter((F.col(level) != "PACK") | (F.col("_dossier") == F.substring_index(F.col(code), ".", 1)))
    found = met.select("item", code, *keep, F.struct(F.col(level).alias("level"), F.greatest("first_seen", "_first").alias("valid_from"), F.least("last_seen", "_last").alias("valid_thru")).alias("_v"))
    return found.groupBy("item", code, *keep).agg(F.min("_v").alias("_v")).select("item", code, *keep, F.col("_v.level").alias(level), "_v.valid_from", "_v.valid_thru")
