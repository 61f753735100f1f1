"""Matching names to codes through layers of exact, normalised, fuzzy and positional joins."""
from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexhull.functions import text as tx
from lexhull.sources.tables import cut, dealt

from .history import grows, union_first_wins

#: Ratio, lead over the second best, and ratio that a name needs which begins with the other.
BEST, LEAD, PREFIX_BEST = 0.90, 0.05, 0.92
#: So many characters of candidates, with all their runs and letters, are held by every task; more are joined by merge.
FEW = 1 << 16
#: Pairs below this can neither win nor take the winner's lead.
PRUNE = 0.85


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2M / (len a + len b) by longest matching blocks; the order of the arguments matters."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def letters(name: Column) -> Column:
    """array<long>: the characters of a name, each with its number among those alike, the higher numbers first.

    Two names share as many of these as they have characters in common. The order is the same for all names; letters that come late
    in it stand in most names.
    """
    each = F.transform(F.filter(F.split(name, ""), lambda c: c != ""), lambda c: F.ascii(c))
    # equal characters stand together once sorted
    numbered = F.transform(F.sort_array(each), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(-1).alias("c"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        at = F.when(x["c"] == acc["c"], acc["at"]).otherwise(x["i"])
        own = (x["i"] - at).cast("bigint") * (1 << 21) + (1 << 21) - 1 - x["c"]
        return F.struct(F.concat(acc["out"], F.array(own)).alias("out"), x["c"].alias("c"), at.alias("at"))

    return F.sort_array(F.aggregate(numbered, start, step, lambda acc: acc["out"]), asc=False)


def shared_letters(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def needed_letters(size: Column, other: Column, least: float) -> Column:
    """The fewest characters that names of these lengths share if their ratio is not below least."""
    return F.ceil(least * (size + other) / 2 - 1e-9).cast("int")


def first_letters(own: Column, size: Column, lowest: Column, least: float) -> Column:
    """Those of a name's letters of which one is shared with any name of at least `lowest` characters that reaches the ratio."""
    return F.slice(own, F.lit(1), F.greatest(size - needed_letters(size, lowest, least) + 1, F.lit(0)))


def similar_pairs(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, least: float, small: bool = False) -> DataFrame:
    """Pairs of names of the same keys whose ratio can reach least; none that does is missing. left has keys and a, right keys and b.

    An inverted index of letters: a pair shares so many that one of them is among the first few of both names,
    so names meet by these alone. A pair is let through at the first letter that its firsts have in common, once;
    then the count of all shared letters decides. small says that right is short enough for every task to hold its index.
    """
    short = (least / (2 - least)) - 1e-9
    sized = lambda df, n, s: df.filter(F.length(n) > 0).withColumn(f"_l{s}", letters(F.col(n))).withColumn(f"_n{s}", F.length(n)).withColumn(f"_f{s}", first_letters(F.col(f"_l{s}"), F.col(f"_n{s}"), F.ceil(F.col(f"_n{s}") * short).cast("int"), least))
    ours = sized(left, a, "a").withColumn("_x", F.explode("_fa"))
    theirs = sized(right, b, "b").withColumn("_x", F.explode("_fb"))
    # an exploded side is many times what the planner takes it for, and is broadcast only where the caller knows that it is small
    met = ours.join(F.broadcast(theirs) if small else grows(theirs), [*keys, "_x"]).filter((2 * F.least("_na", "_nb") >= least * (F.col("_na") + F.col("_nb")) - 1e-9) & (F.array_max(F.array_intersect("_fa", "_fb")) == F.col("_x")))
    met = met.filter(shared_letters(F.col("_la"), F.col("_lb")) >= needed_letters(F.col("_na"), F.col("_nb"), least))
    return met.drop("_la", "_lb", "_na", "_nb", "_fa", "_fb", "_x")


def fuzzy_best(left: DataFrame, right: DataFrame, block: list[str], key: str, name: str, other: str, prune: bool = True, others: bool = False) -> DataFrame:
    """The best right name of the same block for each left key, if it is good enough and clear.

    left has block, key, name; right has block, other and what goes with it, each row an entry of its
    own. A pair needs a ratio of BEST, and a lead of LEAD over the second best entry or else to be a
    prefix pair of PREFIX_BEST; a name that two entries hold leaves itself no lead. Pairs meet by block
    and rare letters, and the letters they share prune them before Python scores them. Equal scores go to the smaller name.
    others leaves out the name itself, for a table against its own names.
    """
    names = left.select(*block, key, name).distinct()
    entries = right.groupBy(*block, other).agg(F.count("*").alias("_copies"))
    # equal names of a block are scored once
    asked = names.select(*block, name).distinct()
    test = (F.length(name) > 0) & (F.length(other) > 0)
    if others:
        test = test & (F.col(name) != F.col(other))
    met = (similar_pairs(asked, entries, block, name, other, PRUNE) if prune else asked.join(entries, block)).filter(test)
    scored = names.join(met.withColumn("score", ratio(F.col(name), F.col(other))).hint("merge"), [*block, name])
    # the two first rows of a key are kept before the shuffle
    place = F.row_number().over(Window.partitionBy(*block, key, name).orderBy(F.desc("score"), other))
    best = scored.withColumn("_place", place).filter("_place <= 2").groupBy(*block, key, name).agg(
        F.max(F.when(F.col("_place") == 1, F.struct(other, "score", "_copies"))).alias("_best"), F.max(F.when(F.col("_place") == 2, F.col("score"))).alias("_next")
    )
    second = F.when(F.col("_best._copies") > 1, F.col("_best.score")).otherwise(F.coalesce("_next", F.lit(0.0)))
    best = best.select(*block, key, name, F.col(f"_best.{other}").alias(other), F.col("_best.score").alias("score"), second.alias("second"))
    prefix = F.col(name).startswith(F.col(other)) | F.col(other).startswith(F.col(name))
    return best.filter((F.col("score") >= BEST) & ((F.col("score") - F.col("second") >= LEAD) | (prefix & (F.col("score") >= PREFIX_BEST))))


def best_candidate(df: DataFrame, key: str, name: str, candidates: DataFrame, candidate: str, threshold: float = 0.85) -> DataFrame:
    """The best of a list of candidates for each text: equal, else one holding the other (4 characters or more), else by ratio; ties alphabetically.

    Equal names meet by an equi join. What holds or is held in another meets by shared runs of three characters, the
    texts of 4 characters or more by all of their runs, shorter candidates by themselves. Only what
    then is left is scored, against candidates of a length that can reach the threshold. A short list of candidates is sent to all tasks, so that texts
    don't travel by their letters, of which there are few kinds; a longer one is joined by merge.
    """
    names = df.select(key, F.upper(F.col(name)).alias("_a")).filter(F.length("_a") > 0)
    c = candidates.select(F.col(candidate).alias("candidate"), F.upper(F.col(candidate)).alias("_b")).distinct().filter(F.length("_b") > 0)
    small = (c.agg(F.sum(F.length("_b") + F.length("candidate"))).first()[0] or 0) <= FEW
    side = F.broadcast if small else grows
    equal = names.join(side(c), F.col("_a") == F.col("_b")).select(key, "candidate", F.lit(3).alias("level"), F.lit(1.0).alias("score"))
    # what is left out here and below can't win any more: the best level of a key counts
    open_ = names.join(side(c.select("_b")), F.col("_a") == F.col("_b"), "left_anti")

    def runs(text: Column, size: int) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size))))

    first = lambda text, size: F.substring(text, 1, size)
    long = open_.filter(F.length("_a") >= 4)
    # a candidate inside the text: its first run is one of the text's runs; the text inside a candidate: the other way round
    sized = [(size, F.length("_b") == size) for size in (1, 2)] + [(3, F.length("_b") >= 3)]
    inside = [long.withColumn("_r", F.explode(runs(F.col("_a"), size))).join(side(c.filter(fits).withColumn("_r", first(F.col("_b"), size))), "_r").filter(F.contains("_a", "_b")) for size, fits in sized]
    around = long.withColumn("_r", first(F.col("_a"), 4)).join(side(c.filter(F.length("_b") >= 4).withColumn("_r", F.explode(runs(F.col("_b"), 4)))), "_r").filter(F.contains("_b", "_a"))
    held = around.select(key, "candidate")
    for part in inside:
        held = held.union(part.select(key, "candidate"))
    held = held.select(key, "candidate", F.lit(2).alias("level"), F.lit(1.0).alias("score"))
    # few candidates leave few pairs to score, which costs less than finding and joining the keys that are held
    rest = open_ if small else open_.join(grows(held.select(key).distinct()), key, "left_anti")
    # one key for all: here names meet by their letters only
    one = lambda df: df.withColumn("_all", F.lit(0))
    near = similar_pairs(one(rest), one(c), ["_all"], "_a", "_b", threshold, small).select(key, "candidate", F.lit(1).alias("level"), ratio(F.col("_a"), F.col("_b")).alias("score")).filter(F.col("score") >= threshold)
    scored = equal.unionByName(held).unionByName(near)
    return scored.groupBy(key).agg(F.min(F.struct((-F.col("level")).alias("l"), (-F.col("score")).alias("s"), "candidate")).alias("_b")).select(key, F.col("_b.candidate").alias("candidate"), (-F.col("_b.s")).alias("score"))


def ordinal_pairs(names: DataFrame, codes: DataFrame, group: str, name_order: str, code: str, least: int = 2, after_dot: bool = True) -> DataFrame:
    """Names and codes of a group paired by order, where there are as many of one as of the other, and at least `least`.

    Codes are ordered by the part after their last dot, then by themselves.
    """
    sized = lambda df, n: df.withColumn(n, F.count("*").over(Window.partitionBy(group)))
    order = [F.substring_index(code, ".", -1), F.col(code)] if after_dot else [F.col(code)]
    left = sized(names, "_n").withColumn("_i", F.row_number().over(Window.partitionBy(group).orderBy(name_order)))
    right = sized(codes.select(group, code).distinct(), "_m").withColumn("_i", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return left.join(right, [group, "_i"]).filter((F.col("_n") == F.col("_m")) & (F.col("_n") >= least)).drop("_n", "_m", "_i")


def name_code_map(limitations: DataFrame, codes: DataFrame, key: str = "limitation_id") -> DataFrame:
    """Names that stand beside a structured code; of one (name, code) the first limitation counts."""
    given = codes.filter(F.col("code_source") == "STRUCTURED_XML").select(key, "code_value", "bag_dossier_no")
    named = limitations.filter(F.col("indication_name_de").isNotNull()).select(key, "indication_name_de").join(grows(given), key)
    return union_first_wins([named.select("indication_name_de", "code_value", key, "bag_dossier_no")], ["indication_name_de", "code_value"], [key])


def retro_map(codes: DataFrame, limitations: DataFrame, names: DataFrame, key: str = "limitation_id") -> DataFrame:
    """Fallback codes of single-named limitations replaced by the mapped code of the same name and dossier.

    A fallback goes when a mapped code is already on the limitation; of several mapped codes the
    largest is taken.
    """
    single = limitations.filter(~F.col("indication_name_de").contains("|")).select(key, "indication_name_de")
    fallback = codes.filter(F.col("code_source") == "FALLBACK_XX")
    own = codes.filter(F.col("code_source") != "FALLBACK_XX").select(key, F.col("code_value").alias("_new")).distinct().withColumn("_has", F.lit(True))
    mapped = names.select("indication_name_de", "bag_dossier_no", F.col("code_value").alias("_new")).distinct()
    met = fallback.join(grows(single), key).join(mapped, ["indication_name_de", "bag_dossier_no"]).join(grows(own), [key, "_new"], "left")
    pick = met.groupBy(key, "code_value").agg(F.max("_new").alias("_new"), F.max(F.coalesce("_has", F.lit(False))).alias("_has"))
    out = codes.join(grows(pick), [key, "code_value"], "left").filter(~F.coalesce("_has", F.lit(False)))
    changed = F.col("_new").isNotNull()
    return out.select(*[F.when(changed, F.col("_new")).otherwise(F.col(c)).alias(c) if c == "code_value" else F.when(changed, "NAME_MAPPED").otherwise(F.col(c)).alias(c) if c == "code_source" else c for c in codes.columns])


def segment_map(segments: DataFrame, codes: DataFrame, names: DataFrame, key: str = "limitation_id") -> tuple[DataFrame, DataFrame]:
    """(segments with matched codes, codes with the fallback of a matched limitation replaced by one row per segment code)."""
    mapped = names.groupBy("indication_name_de", "bag_dossier_no").agg(F.min("code_value").alias("_code"))
    fallback = codes.filter(F.col("code_source") == "FALLBACK_XX")
    met = segments.join(fallback.select(key, "bag_dossier_no", F.col("code_value").alias("_old")), key).join(mapped, ["indication_name_de", "bag_dossier_no"])
    hit = met.select(key, "segment_order", F.col("_code").alias("matched_code_value")).distinct()
    marked = segments.join(hit, [key, "segment_order"], "left").withColumn("matched_code_source", F.when(F.col("matched_code_value").isNotNull(), "SEGMENT_MAPPED"))
    new = met.select(key, "_old", "_code").distinct().join(fallback.withColumnRenamed("code_value", "_old"), [key, "_old"])
    new = new.select(*[F.col("_code").alias(c) if c == "code_value" else F.lit("SEGMENT_MAPPED").alias(c) if c == "code_source" else F.col(c) for c in codes.columns])
    new = new.join(codes.filter(F.col("code_source") != "FALLBACK_XX").select(key, "code_value").distinct(), [key, "code_value"], "left_anti").select(*codes.columns)
    gone = met.select(key, F.col("_old").alias("code_value")).distinct().withColumn("code_source", F.lit("FALLBACK_XX"))
    return marked, codes.join(gone, [key, "code_value", "code_source"], "left_anti").select(*codes.columns).unionByName(new.distinct())


def existing_map(segments: DataFrame, codes: DataFrame, names: DataFrame, key: str = "limitation_id") -> DataFrame:
    """Unmatched segments get the code of their name that is already on their limitation."""
    met = segments.filter(F.col("matched_code_value").isNull()).select(key, "segment_order", "indication_name_de").join(names.select("indication_name_de", "code_value").distinct(), "indication_name_de")
    met = met.join(codes.filter(F.col("code_source") != "FALLBACK_XX").select(key, "code_value").distinct(), [key, "code_value"], "left_semi")
    found = met.groupBy(key, "segment_order").agg(F.min("code_value").alias("_code"))
    out = segments.join(found, [key, "segment_order"], "left")
    return out.withColumn("matched_code_source", F.coalesce("matched_code_source", F.when(F.col("_code").isNotNull(), "EXISTING"))).withColumn("matched_code_value", F.coalesce("matched_code_value", "_code")).drop("_code")


def indication_part(code: Column) -> Column:
    """What follows the first dot, up to the next one; the whole code without a dot."""
    return F.when(code.contains("."), F.split(code, r"\.")[1]).otherwise(code)


#: Layers of the cascade that look a form of the name up among the known names: rank of a match of the own dossier (one of another
#: dossier ranks next), form, kind of known names, and the type and score of either match. Types and scores.
KEYED_LAYERS = [
    (10, "norm", "single", ("NORMALIZED_MATCH", 1.0), ("NORMALIZED_CROSS", 0.95)),
    (20, "norm", "piece", ("PIPE_PART_MATCH", 0.95), ("PIPE_PART_CROSS", 0.90)),
    (30, "combined", "piece", ("PIPE_PART_MATCH", 0.95), ("PIPE_PART_CROSS", 0.90)),
    (40, "rewritten", "brand", ("KOMBI_NORMALIZED", 0.90), ("KOMBI_CROSS", 0.85)),
    (50, "brand", "brand", ("BRAND_NORMALIZED", 0.9), ("BRAND_CROSS", 0.85)),
]


def looked_up(asks: DataFrame, known: DataFrame, layers: list[tuple]) -> DataFrame:
    """Candidates of all layers by shared keys: of the same dossier, else of any when their indication part is unique.

    asks has segment, dossier and asked, an array of (rank, kind, key); known has code_value, dossier and kinds, an array of (kind, key). All
    known names are one index by kind and key, summed up once for each dossier and once for all, and each of these is joined once. A
    code of another dossier is the segment's own dossier with the indication part of the known code. matched_to says what was met.
    """
    index = known.select("code_value", F.col("dossier").alias("_d"), F.explode("kinds").alias("_k")).select("code_value", "_d", "_k.kind", "_k.key").filter("key <> ''")
    part = indication_part(F.col("code_value"))
    own = index.groupBy("kind", "key", "_d").agg(F.min("code_value").alias("_own"), F.min(part).alias("_p"), F.max(part).alias("_q"))
    every = own.groupBy("kind", "key").agg(F.min("_own").alias("_ref"), F.min("_p").alias("_p"), F.max("_q").alias("_q"))
    asked = asks.select("segment", "dossier", F.explode("asked").alias("_a")).select("segment", "dossier", "_a.rank", "_a.kind", "_a.key").filter("key <> ''")
    # asks are several times the segments, and by the size of the file the planner would send them all to every task
    met = asked.join(grows(every), ["kind", "key"]).join(grows(own.select("kind", "key", F.col("_d").alias("dossier"), "_own")), ["kind", "key", "dossier"], "left")
    same = reduce(lambda c, x: c.when(F.col("rank") == x[0], F.struct(F.lit(x[3][0]).alias("type"), F.lit(x[3][1]).alias("score"))), layers[1:], F.when(F.col("rank") == layers[0][0], F.struct(F.lit(layers[0][3][0]).alias("type"), F.lit(layers[0][3][1]).alias("score"))))
    cross = reduce(lambda c, x: c.when(F.col("rank") == x[0], F.struct(F.lit(x[4][0]).alias("type"), F.lit(x[4][1]).alias("score"))), layers[1:], F.when(F.col("rank") == layers[0][0], F.struct(F.lit(layers[0][4][0]).alias("type"), F.lit(layers[0][4][1]).alias("score"))))
    of_own, crossed = F.col("_own").isNotNull(), F.when(F.col("_p") == F.col("_q"), F.concat("dossier", F.lit("."), "_p"))
    met = met.withColumns({
        "code_value": F.when(of_own, F.col("_own")).otherwise(crossed), "_t": F.when(of_own, same).otherwise(cross), "rank": F.when(of_own, F.col("rank")).otherwise(F.col("rank") + 1),
        "matched_to": F.when(of_own, F.concat(F.lit("same dossier "), "dossier")).otherwise(F.concat(F.lit("ind_part ."), "_p", F.lit(" from "), "_ref")),
    })
    return met.filter("code_value is not null").select("segment", "code_value", F.col("_t.type").alias("match_type"), F.col("_t.score").alias("score"), "matched_to", "rank")


def cascade(segments: DataFrame, known: DataFrame, codes: DataFrame, fuzzy: bool = True, whole: DataFrame | None = None) -> DataFrame:
    """One match at most for each segment: (segment, code_value, match_type, score, matched_to).

    segments has segment, group, position, name, dossier; known has name, code_value, dossier; codes
    has group, code_value. Layers in order: a code inside the name; equal normalised names; parts
    of piped names, as they are, then with combinations rewritten and brands made canonical; known single
    names by that form, where it differs from the plain one; names with canonical brands; fuzzy
    names of one dossier; the only code of a group with one segment; codes and segments of a group
    paired in order. Each layer gives candidates, the first one wins, and the last two look only
    at what the others left, and only where a group has no other segments: whole (group) has a row for each
    segment of a group, those that have a code already too (default: segments). Segments and known names of few
    row groups are dealt out first: their forms cost more than that, and the planner then knows how large they are.
    """
    segments, known = dealt(segments), dealt(known)
    # a code holds a full stop, and most names don't
    inside = F.when(F.col("name").contains("."), tx.embedded_code(F.col("name")))
    found = segments.filter(inside.isNotNull()).select("segment", inside.alias("code_value"), F.lit("EMBEDDED_IN_NAME").alias("match_type"), F.lit(1.0).alias("score"), F.col("name").alias("matched_to"), F.lit(0).alias("rank"))
    # all forms of a name at once, and null for a key that is the same as another one
    forms = lambda n: F.struct(F.lower(n).alias("norm"), F.lower(tx.canonical_brands(n)).alias("brand"), F.lower(tx.canonical_brands(tx.combination_rewritten(n))).alias("combined"))
    formed = lambda df: df.withColumn("_f", F.transform(F.array(tx.normalised(F.col("name"))), forms)[0])
    form = {"norm": F.col("_f.norm"), "brand": F.col("_f.brand"), "combined": F.col("_f.combined"), "rewritten": F.when(F.col("_f.combined") != F.col("_f.norm"), F.col("_f.combined"))}
    kinds = lambda *ks: F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in ks])
    asks = formed(segments.select("segment", "dossier", "name")).withColumn("asked", F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), form[f].alias("key")) for rank, f, kind, _, _ in KEYED_LAYERS]))
    # a name without a bar is known as a whole, one with bars by its pieces
    barred = F.col("name").contains("|")
    entries = formed(known.select("code_value", "dossier", barred.alias("_piece"), F.explode(F.when(barred, F.split("name", r"\|")).otherwise(F.array("name"))).alias("name")))
    entries = entries.withColumn("kinds", F.when(F.col("_piece"), kinds(("piece", form["norm"]), ("piece", form["brand"]))).otherwise(kinds(("single", form["norm"]), ("brand", form["brand"]), ("brand", form["combined"]))))
    found = found.unionByName(looked_up(asks, entries, KEYED_LAYERS))
    if fuzzy:
        left = asks.select("dossier", "segment", form["norm"].alias("_a"))
        right = entries.filter("not _piece").select("dossier", form["norm"].alias("_b"), "name", "code_value").distinct()
        first = right.groupBy("dossier", "_b").agg(F.min(F.struct("code_value", F.col("name").alias("matched_to"))).alias("_m"))
        near = fuzzy_best(left, right, ["dossier"], "segment", "_a", "_b").join(grows(first), ["dossier", "_b"])
        found = found.unionByName(near.select("segment", "_m.code_value", F.lit("FUZZY_MATCHED").alias("match_type"), "score", "_m.matched_to", F.lit(60).alias("rank")))
    best = found.groupBy("segment").agg(F.min(F.struct("rank", "code_value", "match_type", "score", "matched_to")).alias("_m"))
    # each segment once, with what the layers by name found, the size of its group and the codes of it
    sizes = (segments if whole is None else whole).groupBy("group").agg(F.count("*").alias("_all"))
    given = codes.select("group", "code_value").distinct().groupBy("group").agg(F.count("*").alias("_codes"), F.min("code_value").alias("_only"))
    all_ = segments.select("segment", "group", "position").join(grows(best), "segment", "left").join(grows(sizes), "group").join(grows(given), "group", "left")
    own = all_.filter("_m is not null").select("segment", "_m.code_value", "_m.match_type", "_m.score", "_m.matched_to")
    left = all_.filter("_m is null")
    said = lambda kind, score, what: [F.lit(kind).alias("match_type"), F.lit(score).alias("score"), F.concat(F.lit(what), F.col("group").cast("string")).alias("matched_to")]
    alone = left.filter("_all = 1 and _codes = 1").select("segment", F.col("_only").alias("code_value"), *said("SINGLE_SEGMENT_CODE", 1.0, "only code for lim "))
    # a group of which no segment has a code pairs them in order, if there are as many codes
    ordered = left.filter("_all >= 2 and _codes = _all").withColumn("_i", F.row_number().over(Window.partitionBy("group").orderBy("position"))).withColumn("_left", F.count("*").over(Window.partitionBy("group"))).filter("_left = _all")
    numbered = codes.select("group", "code_value").distinct().withColumn("_i", F.row_number().over(Window.partitionBy("group").orderBy("code_value")))
    paired = ordered.select("segment", "group", "_i").join(grows(numbered), ["group", "_i"]).select("segment", "code_value", *said("ORDINAL_POSITION", 0.80, "position in lim "))
    return own.unionByName(alone).unionByName(paired)


def match_log(segments: DataFrame, matches: DataFrame) -> DataFrame:
    """The matches with the names they were found for."""
    # both grow with the input, so neither is broadcast
    return matches.join(segments.select("segment", F.col("name").alias("segment_name")).hint("merge"), "segment").select("segment", "segment_name", F.col("code_value").alias("matched_code"), "match_type", "matched_to", "score")


#: Layers of the code-to-name map in order, with their confidence.
MAP_LAYERS = {
    "REF_MAP": 1.0, "DIRECT_STRUCT": 1.0, "DIRECT_TEXT": 0.95, "SHARED_TEXT": 0.9, "ORDINAL_POSITION": 0.8, "NORM_SAME": 0.95, "NORM_CROSS": 0.9,
    "BRAND_SAME": 0.9, "BRAND_CROSS": 0.85, "LLM_SEGMENT": 0.85, "BOLD_EXTRACT": 0.7, "DESC_TRUNCATED": 0.5,
}


REAL = ("STRUCTURED_XML", "TEXT_PARSED")


def code_names(links: DataFrame, segments: DataFrame, texts: DataFrame, reference: DataFrame | None = None, replies: DataFrame | None = None) -> DataFrame:
    """Names for codes: (indication_code, indication_name_de, _fr and _it, bag_dossier_no, match_source, match_confidence, source_text_id, source_segment_order).

    links has text_id, indication_code, code_source; segments has text_id, segment_order, indication_name_de
    (and _fr, _it); texts has text_id, text (and text_fr); reference has indication_code, indication_name_de (and _fr, _it), bag_dossier_no, replies
    text_id, indication_name_fr (and segment_order). The source columns say which text and segment a name is from; a reference name is from none, one read from a text from no segment. A later layer adds only (code, name) pairs that no earlier one has, and
    the last two only codes that still have no name. A direct layer takes one row per code, that of
    the smallest text. Codes are counted by source: one structured code of a text is paired with its only segment
    whatever else stands there; one parsed code if it is the only code of both sources. In the two layers by normalised name
    a segment asks once, with the smallest code of its text, and segments of the same names and dossier ask as one. segments has one row per
    text_id and segment_order. Links and segments are dealt out by text once each, and what is known of a text goes with its rows, so the layers
    join them without moving them again. Some steps are persisted, as several later ones read them.
    """
    names, origin = ["indication_name_de", "indication_name_fr", "indication_name_it"], ["text_id", "segment_order"]
    missing = lambda df, columns, kind: df.withColumns({c: F.lit(None).cast(kind) for c in columns if c not in df.columns})
    segments = missing(segments, names, "string")
    kinds = dict(segments.dtypes)
    code = F.col("indication_code")
    head = lambda c: F.when(c.contains("."), F.substring_index(c, ".", 1))
    of_text = Window.partitionBy("text_id")
    # each code of a text once, with the sources it has there
    is_from = lambda *sources: F.coalesce(F.max(F.col("code_source").isin(*sources)), F.lit(False))
    coded = links.select("text_id", "indication_code", "code_source").repartition("text_id").groupBy("text_id", "indication_code").agg(
        is_from(REAL[0]).alias("_structured"), is_from(REAL[1]).alias("_parsed"), is_from(*REAL).alias("_real"), is_from("FALLBACK_XX").alias("_fallback"))
    one_of = lambda kind: F.count(F.when(F.col(kind), code)).over(of_text) == 1
    real_head = F.when(F.col("_real"), head(code))
    coded = coded.withColumn("_row", F.row_number().over(of_text.orderBy("indication_code"))).withColumns({
        "_one_structured": one_of("_structured"), "_one_real": one_of("_real"), "_one_fallback": one_of("_fallback"), "_codes": F.count(F.when(F.col("_real"), F.lit(1))).over(of_text),
        "_one_dossier": F.min(real_head).over(of_text) == F.max(real_head).over(of_text), "_first": head(F.min(code).over(of_text)),
    }).persist()
    whole = coded.filter("_row = 1").select("text_id", "_codes", "_one_dossier", "_first")
    parted = segments.select(*origin, *names).withColumn("_n", F.count("*").over(of_text)).join(grows(whole), "text_id").persist()

    def named(df: DataFrame, source: str | Column, of: Column = head(code)) -> DataFrame:
        df = missing(missing(df, names, "string"), origin, "string").select("*", of.alias("_of"), (F.lit(source) if isinstance(source, str) else source).alias("_source"))
        came = [F.col(c).cast(kinds[c]).alias(f"source_{c}") for c in origin]
        trust = F.create_map(*[F.lit(x) for layer in MAP_LAYERS.items() for x in layer])[F.col("_source")]
        return df.select("indication_code", *names, F.col("_of").alias("bag_dossier_no"), F.col("_source").alias("match_source"), trust.alias("match_confidence"), *came)

    parts = []
    if reference is not None:
        parts.append(named(reference.select(*[c for c in reference.columns if c not in origin]), "REF_MAP", F.col("bag_dossier_no")))
    # one row per code and layer: a named one before one without, then the smallest text
    pick = F.struct(F.col("indication_name_de").isNull().alias("a"), "text_id", *names, "segment_order")
    picked = coded.filter("_real").join(grows(parted.filter("_n = 1").select(*origin, *names)), "text_id").groupBy("indication_code").agg(
        F.min(F.when(F.col("_structured") & F.col("_one_structured"), pick)).alias("DIRECT_STRUCT"), F.min(F.when(F.col("_parsed") & F.col("_one_real"), pick)).alias("DIRECT_TEXT"), F.min(pick).alias("SHARED_TEXT"))
    layers = F.explode(F.array(*[F.struct(F.lit(x).alias("layer"), F.col(x).alias("p")) for x in ("DIRECT_STRUCT", "DIRECT_TEXT", "SHARED_TEXT")]))
    direct = picked.select("indication_code", layers.alias("_l")).filter("_l.p is not null").select("indication_code", "_l.layer", *[F.col(f"_l.p.{c}").alias(c) for c in (*names, *origin)])
    parts.append(named(direct, F.col("layer")))
    ordered = parted.filter("_one_dossier and _n = _codes and _n >= 2").select(*origin, *names)
    pairs = ordinal_pairs(ordered, coded.filter("_real").join(grows(ordered.select("text_id").distinct()), "text_id", "left_semi"), "text_id", "segment_order", "indication_code")
    parts.append(named(pairs, "ORDINAL_POSITION"))
    keys = ["indication_code", "indication_name_de"]
    rest = [c for c in parts[0].columns if c not in keys]

    def first_layer(frames: list[DataFrame]) -> DataFrame:
        return union_first_wins([reduce(DataFrame.unionByName, frames)], keys, [F.array_position(F.lit(list(MAP_LAYERS)), F.col("match_source")), *rest])

    found = first_layer(parts).persist()
    # segments whose name no code has yet, each with a code of its text, against the names that are there
    wanted = parted.filter(F.col("indication_name_de").isNotNull()).groupBy(*names, F.col("_first").alias("_dossier")).agg(F.min(F.struct(*origin)).alias("_o")).select(*names, "_dossier", "_o.*")
    wanted = wanted.join(found.select("indication_name_de").distinct(), "indication_name_de", "left_anti")
    left, asked = [], wanted
    for same, cross, form in (("NORM_SAME", "NORM_CROSS", lambda c: tx.normalised(c, True)), ("BRAND_SAME", "BRAND_CROSS", lambda c: F.lower(tx.canonical_brands(tx.normalised(c))))):
        name = F.col("indication_name_de")
        k = found.filter(name.isNotNull()).select(form(name).alias("_key"), F.col("bag_dossier_no").alias("_d"), F.col("indication_code").alias("_code"))
        own = k.groupBy("_key", "_d").agg(F.min("_code").alias("_own"))
        any_ = k.groupBy("_key").agg(F.min("_code").alias("_any"))
        met = asked.withColumn("_key", form(name))
        if same == "BRAND_SAME":
            met = met.filter(F.col("_key") != tx.normalised(name, True))
        met = met.join(any_, "_key", "left").join(own.withColumnRenamed("_d", "_dossier"), ["_key", "_dossier"], "left")
        crossed = F.when(F.col("_any").contains(".") & F.col("_dossier").isNotNull(), F.concat("_dossier", F.lit("."), indication_part(F.col("_any"))))
        met = met.withColumn("indication_code", F.coalesce("_own", crossed)).persist()
        left.append(named(met.filter("indication_code is not null"), F.when(F.col("_own").isNotNull(), same).otherwise(cross)))
        asked = met.filter("indication_code is null").select(asked.columns)
    if replies is not None:
        one = missing(replies, ["segment_order"], kinds["segment_order"]).filter(F.col("indication_name_fr").isNotNull()).groupBy("text_id").agg(F.count("*").alias("_n"), F.min("indication_name_fr").alias("indication_name_fr"), F.min("segment_order").alias("segment_order")).filter("_n = 1").drop("_n")
        replied = coded.filter("_fallback and _one_fallback").select("text_id", "indication_code").join(grows(one), "text_id")
        left.append(named(replied.groupBy("indication_code").agg(F.min(F.struct("text_id", "indication_name_fr", "segment_order")).alias("_p")).select("indication_code", "_p.*"), "LLM_SEGMENT"))
    found = first_layer([found, *left]).persist()
    # the codes without a name are few rows beside the links, which stay where they are; the planner is to know how few
    unnamed = cut(coded.filter("_real").select("indication_code").distinct().join(found.select("indication_code").distinct(), "indication_code", "left_anti")).withColumnRenamed("indication_code", "_open")
    still = coded.filter("_real").select("text_id", "indication_code").join(unnamed, code.eqNullSafe(F.col("_open")), "left_semi")
    bold = lambda c: F.nullif(F.regexp_extract(c, "(?d)<b>(.+?)</b>", 1), F.lit(""))
    # a text is read once, not once for each of its codes, and only what it names is joined
    told = missing(texts, ["text_fr"], "string").filter(F.col("text") != "").select("text_id", "text", "text_fr").join(grows(still.select("text_id").distinct()), "text_id", "left_semi")
    told = told.withColumns({"text": tx.decode_entities(F.col("text")), "text_fr": tx.decode_entities(F.col("text_fr"))}).withColumn("_bold", bold("text"))
    told = told.withColumn("_usable", F.col("_bold").isNotNull() & ~tx.is_structural(F.col("_bold")))
    said = F.when(F.col("_usable"), F.col("_bold")).otherwise(F.nullif(tx.first_sentence(tx.clean_markup(F.col("text"))), F.lit("")))
    told = told.select("text_id", "_usable", F.when(F.col("_usable"), bold("text_fr")).alias("indication_name_fr"), said.alias("indication_name_de"))
    told = told.withColumn("layer", F.when(F.col("_usable"), "BOLD_EXTRACT").when(F.col("indication_name_de").isNotNull(), "DESC_TRUNCATED"))
    # no layer: no name. Such rows go last, for a filter on names would be moved to the texts and read them twice
    return found.unionByName(first_layer([named(told.join(grows(still), "text_id"), F.col("layer"))]).filter("match_source is not null"))
