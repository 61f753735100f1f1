"""Pack descriptions into typed columns, as one expression over an ordered list of shapes."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexhull.functions import text as tx
from lexhull.rules import packs as rules

from .history import first_per_key

NUMBER = r"(\d+(?:\.\d+)?)"


def shape_pattern(shape: str, forms: list[str], units: list[str]) -> tuple[str, list[str]]:
    """(anchored pattern, what its groups hold) of a shape such as 'F a x b u'."""
    alternation = "(" + "|".join(re.escape(f).replace(r"\ ", " ").replace(r"\-", "-") for f in sorted(forms, key=len, reverse=True)) + ")"
    known = {"F": alternation, "a": NUMBER, "b": NUMBER, "c": NUMBER, "u": "(" + "|".join(units) + ")", "v": "(ml|g)", "Dos": "(Dos|Dosen)", "à": "[àa]", "text": "(.+)"}
    out, groups, before = "^", [], ""
    for token in shape.split():
        gap = "" if not before else r"\s*" if "x" in (token, before) else r"\s+"
        out += gap + known.get(token, token)
        if token in "Fabcuv" or token in ("Dos", "text"):
            groups.append(token)
        before = token
    return out + "$", groups


def parse_packs(description: Column, shapes: list[tuple[str, str, str]] = rules.SHAPES, forms: dict[str, list[str]] = rules.FORMS, units: list[str] = rules.UNITS) -> Column:
    """A struct of the typed fields of a pack description; the first shape that fits decides.

    Annotations in brackets are taken off first: 'alt' and 'ancien' mark an old pack, sub-packs such
    as '3x 50 Stk' are dropped, the rest is kept. Null and unknown descriptions are UNMATCHED, LOW.
    """
    raw = tx.strip(F.coalesce(description, F.lit("")))
    notes = F.transform(F.regexp_extract_all(raw, F.lit(r"\s*\(([^)]+)\)"), F.lit(1)), tx.strip)
    old = F.exists(notes, lambda a: F.lower(a).isin("alt", "ancien"))
    kept = F.filter(notes, lambda a: ~F.lower(a).isin("alt", "ancien") & ~a.rlike(r"(?U)^\d+\s*x\s*\d+"))
    note = F.nullif(F.array_join(kept, "; "), F.lit(""))
    clean = tx.strip(F.regexp_replace(raw, r"\s*\([^)]+\)", ""))
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean, r"\.\s*$", ""), r"(?U)(\w)\.\s", "$1 "), r"\.$", "")
    clean = F.regexp_replace(clean, "(" + "|".join(rules.QUALIFIED) + r")\s+\S+-\S+\s+", "$1 ")
    kind_of = F.create_map(*[F.lit(x) for kind, tokens in forms.items() for t in tokens for x in (t, kind)])
    every_form = [t for tokens in forms.values() for t in tokens]
    # bound once as lambda variables: each shape would otherwise repeat the cleaning
    return F.transform(F.array(F.struct(clean.alias("d"), note.alias("note"), old.cast("int").alias("old"))), lambda x: shaped(x["d"], x["note"], x["old"], kind_of, shapes, every_form, units))[0]


FIELDS = {
    "form_type": "string", "form_type_raw": "string", "container_count": "int", "unit_count": "int", "volume_per_unit": "double", "volume_unit": "string",
    "total_volume": "double", "dose_count": "int", "multiplier": "int", "multiplied_count": "int", "total_units": "int", "is_alt": "int", "annotation": "string",
    "parse_confidence": "string", "parse_pattern": "string",
}


def shaped(d: Column, note: Column, old: Column, kind_of: Column, shapes: list[tuple[str, str, str]], forms: list[str], units: list[str]) -> Column:
    def record(**set_: Column) -> Column:
        return F.struct(*[set_.get(f, F.lit(None)).cast(t).alias(f) for f, t in FIELDS.items()])

    out = None
    for name, confidence, shape in shapes:
        pattern, groups = shape_pattern(shape, forms, units)
        part = {g: F.regexp_extract(d, pattern, i + 1) for i, g in enumerate(groups)}
        form = {"form_type_raw": part["F"], "form_type": F.try_element_at(kind_of, part["F"])} if "F" in part else {}
        n = {g: part[g].cast("double").cast("int") for g in "abc" if g in part}
        x = {g: part[g].cast("double") for g in "abc" if g in part}
        values = {**form, "is_alt": old, "annotation": note, "parse_confidence": F.lit(confidence), "parse_pattern": F.lit(name)}
        fitted = record(**values, **amounts(shape, part, n, x))
        if name == "P11_VOL_ZUR":
            values["annotation"] = F.concat_ws("; ", note, F.concat(F.lit("zur "), part["text"]))
            fitted = record(**values, **amounts(shape, part, n, x))
        if name == "P14_MONODOS_BTL":
            values["annotation"] = F.concat(n["b"].cast("string"), F.lit(" Btl à "), n["c"].cast("string"), F.lit(" Stk"))
            fitted = record(**values, **amounts(shape, part, n, x))
        test = d.rlike(pattern)
        out = F.when(test, fitted) if out is None else out.when(test, fitted)
    return out.otherwise(record(is_alt=old, annotation=note, parse_confidence=F.lit("LOW"), parse_pattern=F.lit("UNMATCHED")))


def amounts(shape: str, part: dict[str, Column], n: dict[str, Column], x: dict[str, Column]) -> dict[str, Column]:
    """Counts and volumes of a shape; what a number means depends on whether the unit counts pieces, doses or a volume."""
    one = F.lit(1)

    def by_unit(pieces: dict, doses: dict, volume: dict) -> dict[str, Column]:
        u = part["u"]
        return {f: F.when(u.isin(rules.PIECES), pieces.get(f)).when(u.isin(rules.DOSES), doses.get(f)).otherwise(volume.get(f)) for f in {*pieces, *doses, *volume}}

    def packs_of(times: Column, each: str, doses_each: bool = True) -> dict[str, Column]:
        return by_unit(
            {"unit_count": n[each], "total_units": times * n[each]},
            {"dose_count": times * n[each], "total_units": times},
            {"volume_per_unit": x[each], "volume_unit": part["u"], "total_volume": x["a"] * x[each], "total_units": times},
        )

    if shape == "F a x b x c u":
        total = n["a"] * n["b"] * n["c"]
        return {"multiplier": n["a"], "multiplied_count": n["b"]} | by_unit(
            {"unit_count": n["c"], "total_units": total}, {"dose_count": total, "total_units": total},
            {"volume_per_unit": x["c"], "volume_unit": part["u"], "total_volume": x["a"] * x["b"] * x["c"], "total_units": n["a"] * n["b"]},
        )
    if shape in ("F a x b u", "a x b u"):
        return {"multiplier": n["a"], "multiplied_count": n["b"]} | packs_of(n["a"], "b")
    if shape == "a x b F":
        return {"multiplier": n["a"], "container_count": n["b"], "total_units": n["a"] * n["b"]}
    if shape == "a x F b u":
        return {"multiplier": n["a"]} | packs_of(n["a"], "b") | {"container_count": F.when(~part["u"].isin(rules.PIECES + rules.DOSES), n["a"])}
    if shape in ("a F b u", "a b u"):
        return {"container_count": n["a"]} | packs_of(n["a"], "b")
    if shape == "F a Stk":
        return {"unit_count": n["a"], "container_count": n["a"], "total_units": n["a"]}
    if shape == "F a Dos":
        return {"dose_count": n["a"], "container_count": one, "total_units": one}
    if shape == "F a u":
        return {"volume_per_unit": x["a"], "volume_unit": part["u"], "total_volume": x["a"], "container_count": one, "total_units": one}
    if shape == "a F":
        return {"container_count": n["a"], "total_units": n["a"]}
    if shape == "a v zur text":
        return {"volume_per_unit": x["a"], "volume_unit": part["v"], "total_volume": x["a"], "total_units": one}
    if shape == "a u":
        return by_unit(
            {"unit_count": n["a"], "total_units": n["a"]}, {"dose_count": n["a"], "total_units": one},
            {"volume_per_unit": x["a"], "volume_unit": part["u"], "total_volume": x["a"], "total_units": one},
        )
    if shape == "a F b Btl à c Stk":
        return {"container_count": n["a"], "unit_count": n["c"], "total_units": n["a"]}
    if shape == "F a Stk b u":
        return {"container_count": n["a"], "total_units": n["a"], "volume_per_unit": x["b"], "volume_unit": part["u"], "total_volume": x["a"] * x["b"]}
    if shape == "a v b Stk":
        return {"volume_per_unit": x["a"], "volume_unit": part["v"], "container_count": n["b"], "total_units": n["b"], "total_volume": x["a"] * x["b"]}
    return {"container_count": one, "total_units": one}


def substance_quantity(quantity: Column) -> Column:
    """A quantity without its '<', 'ca.', 'min.', 'max.' or '~', as double; null if it is no number."""
    return tx.to_number(F.regexp_replace(tx.strip(quantity), r"^(<|ca\.\s*|min\.\s*|max\.\s*|~\s*)", ""))


def total_substance(quantity: Column, unit: Column, units: Column, computable: list[str] = rules.COMPUTABLE) -> Column:
    return F.when(unit.isin(computable) & quantity.isNotNull() & units.isNotNull(), quantity * units)


def normalise_packs(packs: DataFrame, substances: DataFrame) -> DataFrame:
    """packs with parsed fields, the first substance of the product and the total amount of it."""
    first = first_per_key(substances, ["preparation_id"], ["substance_id"]).select("preparation_id", "description_la", "quantity", "quantity_unit")
    out = packs.withColumn("_p", parse_packs(F.col("description_de"))).select("*", "_p.*").drop("_p").join(first, "preparation_id", "left")
    out = out.withColumn("substance_qty", substance_quantity(F.col("quantity")))
    return out.withColumn("total_substance", total_substance(F.col("substance_qty"), F.col("quantity_unit"), F.col("total_units")))
