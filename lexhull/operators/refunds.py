"""Mining refund rules from texts, as column expressions over rule tables.

Company names are looked for in runs of name characters only: the texts are split at all other
characters and just the runs that hold the key word are matched, by patterns without nested
repetition. So no text, however long, can exhaust the stack of Java's regex engine.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexhull.functions import text as tx
from lexhull.rules import refunds as rules

ANY = tx.ANY_CASE
FORMS = "(?:" + "|".join(rules.LEGAL_FORMS) + ")"
TITLE = r"(?:la\s+)?(?:société|entreprise|firme)?\s*"
#: A name of at least one word, then a legal form; the words between are one flat run.
COMPANY = rf"[A-Z][A-Za-zÀ-ÿ\-]+\s(?:[{rules.NAME_CLASS}\s]*\s)?{FORMS}"
AFTER = r"(?:\s+[A-Za-zÀ-ÿ\-()]+)?"
# Who pays, who is paid by, who is billed.
PAYS = rf"{ANY}{TITLE}({COMPANY}{AFTER})\s+rembourse(?:ra)?"
PAYS_SIGN = rf"{ANY}\s{FORMS}{AFTER}\s+rembourse"
PAID_BY = rf"{ANY}remboursé(?:s|e|es)?\s+par\s+{TITLE}({COMPANY}{AFTER})"
BILLED = rf"{ANY}assureur\s+facture\s+à\s+{TITLE}({COMPANY})(?=\s+le\s|\s+un|\s+la\s|\s+les\s|\s*$|\s*\.)"


def either(text: Column, patterns: list[str], flags: str = ANY) -> Column:
    """Whether any pattern is found; one alternation."""
    return text.rlike(flags + "(?:" + "|".join(patterns) + ")")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def first_in_runs(text: Column, word: str, pattern: str, sign: str) -> Column:
    """The pattern's group in the first run of name characters that holds the word and matches.

    sign is a short stretch that every match holds; runs without it, in which the pattern would be
    tried in vain from every character, are left out.
    """
    # a run is read from its first character only, once
    whole = rf"{ANY}(?<![{rules.NAME_CLASS}\s])[{rules.NAME_CLASS}\s]*?{word}[{rules.NAME_CLASS}\s]*"
    runs = F.filter(F.regexp_extract_all(text, F.lit(whole), F.lit(0)), lambda r: r.rlike(sign))
    return F.get(F.filter(F.transform(runs, lambda r: F.regexp_extract(r, pattern, 1)), lambda c: c != ""), F.lit(0))


def from_word(text: Column, word: str) -> Column:
    """The text from the first place of a word, in any case, to its end; null without the word."""
    return F.nullif(F.regexp_extract(text, rf"(?siu){word}.*", 0), F.lit(""))


def run_of_word(text: Column, word: str) -> Column:
    """The text from the run of name characters on in which a word first stands, in any case; empty without the word."""

    def cut(rest: Column) -> Column:
        before = F.substring(text, F.lit(1), F.length(text) - F.length(rest))
        return F.concat(F.reverse(F.regexp_extract(F.reverse(before), rf"^[{rules.NAME_CLASS}\s]*", 0)), rest)

    return F.when(text.isNotNull(), F.coalesce(bound(from_word(text, word), cut), F.lit("")))


def billed_company(text: Column) -> Column:
    """The company an insurer bills; the character that ends a run of the name decides with."""
    marked = F.regexp_replace(text, rf"[^{rules.NAME_CLASS}\s.]+", "\u0001")
    runs = F.filter(F.split(marked, "(?<=[.\u0001])"), lambda r: F.lower(r).contains("facture"))
    return F.when(F.lower(text).contains("facture"), F.get(F.filter(F.transform(runs, lambda r: F.regexp_extract(r, BILLED, 1)), lambda c: c != ""), F.lit(0)))


def detect(text: Column) -> Column:
    """struct<is_cashback, company, pattern>: the first detector of the cascade that fires."""
    paid_sign = ANY + r"remboursé(?:s|e|es)?\s+par\s"
    # what begins with a word is looked for from the word's first place on
    places = F.struct(run_of_word(text, "rembours").alias("run"), from_word(text, "titulaire").alias("holder"), from_word(text, "rembourse").alias("verb"))
    names = lambda x: F.struct(x.alias("x"), first_in_runs(x["run"], "rembours", PAYS, PAYS_SIGN).alias("pays"), first_in_runs(x["run"], "rembours", PAID_BY, paid_sign).alias("paid"), billed_company(text).alias("billed"))

    def decide(n: Column) -> Column:
        found = F.when(n["pays"].isNotNull(), "company_rembourse").when(n["paid"].isNotNull(), "rembourse_par").when(n["billed"].isNotNull(), "assureur_facture")
        found = found.when(n["x"]["holder"].rlike(ANY + rules.HOLDER), "titulaire_rembourse").when(n["x"]["verb"].rlike(ANY + rules.TO_INSURER), "rembourse_assurance")
        for name, pattern in rules.WEAKER:
            found = found.when(n["x"]["verb"].rlike(ANY + pattern), name)
        return F.struct(found.isNotNull().alias("is_cashback"), tx.strip(F.coalesce(n["pays"], n["paid"], n["billed"])).alias("company"), found.alias("pattern"))

    return bound(bound(places, names), decide)


def no_refund_phrase(text: Column) -> Column:
    """Whether the text speaks of reimbursement by the insurer; reported beside the detection, not part of it."""
    return either(text, rules.NO_REFUND)


def cost_section(text: Column) -> Column:
    """What follows a heading of therapy costs, or the whole text."""
    heading = r"<u>Co[ûu]ts?\s+th[ée]rapeutiques?</u>|Co[ûu]ts?\s+th[ée]rapeutiques?\s*[:\n]"
    return bound(text, lambda t: F.when(t.rlike(ANY + heading), F.regexp_extract(t, f"(?siudU)(?:{heading})(.*)", 1)).otherwise(t))


#: Stands for a full stop that ends no sentence.
DOT = "\ue000"
# Where a full stop ends no sentence: dates, amounts, percentages, abbreviations; with literals of which each match holds one.
NO_END = [
    (r"(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2}(?!\d))", f"$1{DOT}$2{DOT}$3", []),
    (r"Fr\.\s*([\d'’]+)\.(\d+)", f"Fr{DOT} $1{DOT}$2", ["Fr."]),
    (r"CHF\s*([\d'’]+)\.(\d+)", f"CHF $1{DOT}$2", ["CHF"]),
    (r"Fr\.\s+(?=\d)", f"Fr{DOT} ", ["Fr."]),
    (r"([\d'’]+)\.(\d+)\s+francs", f"$1{DOT}$2 francs", ["francs"]),
    (r"(\d+['’]\d+)\.(\d{2})(?!\d)", f"$1{DOT}$2", []),
    (r"(\d+)\.(\d+)\s*%", f"$1{DOT}$2%", ["%"]),
    (r"T\.V\.A\.?", f"T{DOT}V{DOT}A{DOT}", ["T.V.A"]),
    # before a capitalised word it does, unless that is an amount
    (r"(?<!\w)(etc|max|art|al)\.(?!\w)(?!\s+(?!Fr\b)\p{Lu}\p{Ll})", f"$1{DOT}", ["etc.", "max.", "art.", "al."]),
]


def protected(text: Column) -> Column:
    """Each replacement runs only on texts that hold one of its literals."""

    def replaced(pattern: str, by: str, literals: list[str]) -> Callable[[Column], Column]:
        return lambda t: F.when(reduce(or_, [t.contains(x) for x in literals]), F.regexp_replace(t, tx.FLAGS + pattern, by)).otherwise(t)

    for pattern, by, literals in NO_END:
        text = bound(text, replaced(pattern, by, literals)) if literals else F.regexp_replace(text, tx.FLAGS + pattern, by)
    return text


def restored(text: Column) -> Column:
    return F.replace(text, F.lit(DOT), F.lit("."))


def sentence(text: Column, clean: bool = True) -> Column:
    """The sentence that states a refund with those that follow on; null if there is none."""
    # one flat run for the words of a name, where nested repetition would exhaust the engine
    words, flat = r"(?:\s+[A-Za-zÀ-ÿ\-\(\)&]+)*\s+", rf"\s(?:[{rules.NAME_CLASS}\s]*\s)?"
    tax = rf"(?:TVA|T[.{DOT}]?V[.{DOT}]?A[.{DOT}]?)"
    follow = [ANY + r"^\s*(" + p.replace(r"T\.?V\.?A\.?", rf"T[.{DOT}]?V[.{DOT}]?A[.{DOT}]?") + ")" for p in rules.FOLLOW_ON]

    def locate(t: Column) -> Column:
        # a match holds one full stop, its last character, so it lies in one piece between two of them, and only pieces with a verb can hold one
        stopped = F.split(t, r"\.")
        pieces = F.transform(F.filter(F.slice(stopped, F.lit(1), F.size(stopped) - 1), lambda s: s.rlike(ANY + "rembourse|restitue")), lambda s: F.concat(s, F.lit(".")))

        def hit(pattern: str) -> Callable[[Column], Column]:
            full = ANY + pattern.replace(words, flat)
            if words in pattern:
                return lambda s: F.when(s.rlike(ANY + r"\s(?:SA|AG|GmbH|Sàrl)\s+(?:rembourse|restitue)"), F.regexp_extract(s, full, 0))
            return lambda s: F.regexp_extract(s, full, 0)

        first = lambda ps: F.coalesce(*[F.get(F.filter(F.transform(ps, hit(p)), lambda h: h != ""), F.lit(0)) for p in rules.SENTENCES])
        # the first place of the matched words is that of the match: they would have matched there, too
        place = lambda h: F.when(h.isNotNull(), F.struct(F.call_function("locate", h, t).alias("at"), h.alias("hit"), t.alias("t")))
        return bound(bound(pieces, first), place)

    def grow(x: Column) -> Column:
        before = F.substring(x["t"], F.lit(1), x["at"] - 1)
        head = F.when(before.contains(". "), F.substring_index(before, ". ", -1)).otherwise(before)
        rest = F.substring(x["t"], x["at"] + F.length(x["hit"]), F.lit(rules.FOLLOW_REACH))
        start = F.struct(tx.strip(F.concat(head, x["hit"])).alias("said"), rest.alias("rest"), F.lit(True).alias("go"))

        def step(acc: Column, _: Column) -> Column:
            hit = F.coalesce(*[F.nullif(F.regexp_extract(acc["rest"], p, 0), F.lit("")) for p in follow])
            longer = F.transform(F.array(hit), lambda h: F.struct(F.concat(acc["said"], F.lit(" "), tx.strip(h)).alias("said"), F.substring(acc["rest"], F.length(h) + 1, F.lit(rules.FOLLOW_REACH)).alias("rest"), F.lit(True).alias("go")))[0]
            stop = F.struct(acc["said"].alias("said"), acc["rest"].alias("rest"), F.lit(False).alias("go"))
            return F.when(acc["go"] & longer["said"].isNotNull(), longer).otherwise(stop)

        grown = F.aggregate(F.sequence(F.lit(1), F.lit(rules.FOLLOW_MOST)), start, step)

        def with_tax(g: Column) -> Column:
            next_ = F.filter(F.slice(F.split(F.substring(g["rest"], 1, rules.VAT_REACH), r"(?<=[.!?])\s+"), 1, rules.VAT_SENTENCES), lambda s: s.rlike(ANY + tax))
            lacks = ~F.upper(g["said"]).contains("TVA") & ~g["said"].contains(f"T{DOT}V{DOT}A")
            return F.when(lacks & (F.size(next_) > 0), F.concat(g["said"], F.lit(" "), tx.strip(F.get(next_, F.lit(0))))).otherwise(g["said"])

        return F.transform(F.array(grown), with_tax)[0]

    section = cost_section(tx.clean_markup(text) if clean else text)
    ready = F.transform(F.array(protected(tx.clean_markup(section))), locate)
    return restored(F.transform(ready, lambda x: F.when(x.isNotNull(), grow(x)))[0])


def sentence_company(text: Column) -> Column:
    """A capitalised name before a legal form in a sentence; case counts."""
    return F.nullif(tx.strip(F.regexp_extract(text, rf"(?dU)([A-ZÀÂÄÉÈÊËÏÎÔÖÙÛÜŸÇ][a-zA-ZÀ-ÿ\-]*(?:[\s\-][{rules.NAME_CLASS}\s]*)?(?:\s*\([^)]+\))?\s*(?:SA|AG|GmbH|Sàrl))", 1)), F.lit(""))


def calculation(text: Column, swiss: bool = True) -> Column:
    """struct<type, value>: the first calculation that fits; unknown if none does.

    swiss reads 3'581.40 as one number; without it the number ends at the apostrophe.
    """
    if swiss:
        text = F.regexp_replace(text, r"(?<=\d)['’](?=\d)", "")
    decimal = r"(\d+(?:[.,]\d+)?)"
    def read(t: Column) -> Column:
        out = None
        for kind, pattern, has_value in rules.CALCULATIONS:
            p = ANY + pattern.replace("N", decimal)
            hit = F.regexp_extract(t, p, 1 if has_value else 0)
            value = F.replace(hit, F.lit(","), F.lit(".")).try_cast("double") if has_value else F.lit(None).cast("double")
            this = F.when(hit != "", F.struct(F.lit(kind).alias("type"), value.alias("value")))
            out = this if out is None else F.coalesce(out, this)
        return F.coalesce(out, F.struct(F.lit("unknown").alias("type"), F.lit(None).cast("double").alias("value")))

    return F.transform(F.array(text), read)[0]


def refund_unit(text: Column) -> Column:
    low, out = F.lower(text), None
    for unit, pattern in rules.UNITS:
        test = low.rlike(tx.FLAGS + pattern)
        out = F.when(test, unit) if out is None else out.when(test, unit)
    return out.otherwise("unknown")


def number(word: Column) -> Column:
    """Digits or a French number word as int."""
    known = F.create_map(*[F.lit(x) for pair in rules.NUMBER_WORDS.items() for x in pair])
    low = F.lower(tx.strip(word))
    return F.coalesce(F.try_element_at(known, low), F.when(low.rlike(r"^\d+$"), low.try_cast("int")))


def number_pattern() -> str:
    """A number in digits or words, as one group; look-aheads spare most places the many alternatives."""
    longest_first = sorted(rules.NUMBER_WORDS, key=len, reverse=True)
    told = [w for w in longest_first if w[0].isalpha()]
    return rf"(\d+|(?=[{''.join(sorted({w[0] for w in told}))}])(?:{'|'.join(told)})|(?=\d)(?:{'|'.join(w for w in longest_first if not w[0].isalpha())}))"


def anchored(text: Column, there: Column, anchor: str, reach: int = rules.THRESHOLD_REACH) -> Column:
    """array<string>: the stretch around each place of an anchor, from the place before to the next one, and no further than a match can reach.

    A match holds the anchor just once, so it lies in the stretch of its own place; the first stretch
    with a match has the text's first match. there tells whether the anchor stands in the text at all.
    """
    alone = "|" not in anchor  # one word can be cut out and put back, which is quicker than looking ahead at every place

    def around(parts: Column) -> Column:
        def pair(part: Column, i: Column) -> Column:
            before = F.get(parts, i)
            near = [F.substring(before, F.greatest(F.length(before) - reach + 1, F.lit(1)), F.lit(reach)), F.substring(part, 1, reach)]
            whole = [before, part]
            if alone:
                near.insert(1, F.lit(anchor))
                whole.insert(1, F.lit(anchor))
            # what a match can't be without when it reaches further
            return bound(F.concat(*near), lambda x: F.when(x.rlike(rules.LONG_RUNS), F.concat(*whole)).otherwise(x))

        return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), pair)

    # a mark, so that no text begins with its anchor
    parts = F.split(F.concat(F.lit("\u0001"), text), anchor if alone else f"(?={anchor})")
    return F.when(there, bound(parts, around)).otherwise(F.array().cast("array<string>"))


def thresholds(text: Column) -> Column:
    """array<struct<type, value, unit, match>>: the first match of each threshold pattern not near a deadline for asking.

    Each anchor is looked for once a text; a pattern meets the stretches around its own anchor only. Value,
    place and unit are read from what it matched.
    """
    low = F.lower(text)
    n = number_pattern()
    nth = n + "(?:e|[èé]me|ème|eme)?"
    deadline = tx.FLAGS + "(?:" + "|".join(rules.DEADLINES) + ")"
    full = lambda pattern: tx.FLAGS + pattern.replace("NTH", "\0").replace("N", n).replace("\0", nth)
    matcher = lambda p: lambda s: F.regexp_extract(s, p, 0)
    anchors = {a: f"a{i}" for i, a in enumerate(dict.fromkeys(rules.THRESHOLD_ANCHORS.values()))}

    def every(around: Column) -> Column:
        """The first match of each pattern, in the order of the patterns."""
        found = []
        for kind, pattern, _ in rules.THRESHOLDS:
            hits = F.transform(around[anchors[rules.THRESHOLD_ANCHORS[kind]]], matcher(full(pattern)))
            found.append(F.struct(F.lit(kind).alias("type"), F.get(F.filter(hits, lambda h: h != ""), F.lit(0)).alias("match")))
        return F.array(*found)

    def read(x: Column, t: Column) -> Column:
        """The entry of one match; the first place of the matched words is that of the match."""
        at, size = F.call_function("locate", x["match"], t), F.length(x["match"])
        around = F.substring(t, F.greatest(at - rules.DEADLINE_REACH, F.lit(1)), size + rules.DEADLINE_REACH + F.least(at - 1, F.lit(rules.DEADLINE_REACH)))
        told = None
        for kind, pattern, has_value in rules.THRESHOLDS:
            if has_value:
                own = F.regexp_extract(x["match"], full(pattern), 1)
                told = F.when(x["type"] == kind, own) if told is None else told.when(x["type"] == kind, own)
        value = number(told)
        unit = None
        for u, marks in rules.THRESHOLD_UNITS:
            test = x["match"].rlike("|".join(marks))
            unit = F.when(test, u) if unit is None else unit.when(test, u)
        return F.when(~around.rlike(deadline), F.struct(x["type"].alias("type"), value.alias("value"), unit.alias("unit"), x["match"].alias("match")))

    def whole(x: Column) -> Column:
        there = lambda a: reduce(or_, [x["has"][words[w]] for w in a.split("|")])
        # without an anchor the text is the only stretch
        around = F.struct(*[(anchored(x["t"], there(a), a) if a else F.array(x["t"])).alias(name) for a, name in anchors.items()])
        hits = F.filter(bound(around, every), lambda h: h["match"].isNotNull())
        return F.filter(F.transform(hits, lambda h: read(h, x["t"])), lambda h: h.isNotNull())

    words = {w: f"w{i}" for i, w in enumerate(dict.fromkeys(w for a in anchors for w in a.split("|") if w))}
    looked = lambda t: F.struct(t.alias("t"), F.struct(*[F.contains(t, F.lit(w)).alias(name) for w, name in words.items()]).alias("has"))
    return F.when(text.isNotNull(), bound(bound(low, looked), whole))


def primary_threshold(found: Column) -> Column:
    """The first threshold with a value, else the first."""
    return F.coalesce(F.get(F.filter(found, lambda x: x["value"].isNotNull()), F.lit(0)), F.get(found, F.lit(0)))


def conditions(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    return {name: either(low, patterns, tx.FLAGS) for name, patterns in rules.CONDITIONS.items()}


def cotreatments(text: Column, drugs: list[str] = rules.DRUGS) -> Column:
    """Upper-case names of drugs given along: those that patterns find, then known names, each once."""
    def found(x: Column) -> Column:
        none = F.array().cast("array<string>")
        all_of = lambda p: F.regexp_extract_all(x["t"], F.lit(ANY + p), F.lit(1))
        return F.flatten(F.array(*[F.when(reduce(or_, [x["low"].contains(w) for w in rules.GIVEN_WORDS[p]]), all_of(p)).otherwise(none) if p in rules.GIVEN_WORDS else all_of(p) for p in rules.GIVEN_ALONG]))

    # in the letters that a pattern blind to case takes for the plain ones
    low = F.lower(F.translate(text, "ſıİ\u212a", "siik"))
    named = F.when(text.isNotNull(), bound(F.struct(text.alias("t"), low.alias("low")), found))
    named = F.filter(F.transform(named, lambda d: F.upper(tx.strip(d))), lambda d: (F.length(d) >= 4) & ~d.isin(rules.NO_DRUGS))
    # names by their first letter, as all are tried at each word
    firsts = [f"{c}(?:{'|'.join(d[1:] for d in drugs if d[0] == c)})" for c in sorted({d[0] for d in drugs})]
    present = F.regexp_extract_all(F.upper(text), F.lit(r"(?U)\b(" + "|".join(firsts) + r")®?\b"), F.lit(1))
    known = F.array_intersect(F.array(*map(F.lit, drugs)), present)
    return F.array_distinct(F.concat(named, known))


def mine(df: DataFrame, id_col: str, text_col: str, clean: bool = True, preparations: DataFrame | None = None, companies: DataFrame | None = None) -> DataFrame:
    """One row per text with a refund: detection, sentence and the rules read from it.

    Rules are read from the sentence, or from the whole text if no sentence was isolated; the
    company is the sentence's, else the detector's. Detection runs first and only texts that
    pass go on, so that the many rule patterns meet few rows. companies (company) adds texts that name one of these
    near a refund verb; preparations (name, stem) adds the drugs whose stem stands in the basis.
    """
    text = tx.clean_markup(F.col(text_col)) if clean else F.col(text_col)
    rows = df.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("found", detect(F.col("text")))
    if companies is not None:
        near = known_companies(rows.filter(~F.col("found.is_cashback")), "id", "text", companies).filter("near_refund").groupBy("id").agg(F.min("company").alias("known"))
        told = F.struct(F.lit(True).alias("is_cashback"), F.col("known").alias("company"), F.lit("fuzzy_company").alias("pattern"))
        rows = rows.join(near, "id", "left").withColumn("found", F.when(F.col("known").isNotNull(), told).otherwise(F.col("found"))).drop("known")
    rows = rows.filter("found.is_cashback")
    rows = rows.withColumn("said", sentence(F.col("text"), clean=False)).withColumn("basis", F.coalesce("said", "text"))
    basis, calc = F.col("basis"), calculation(F.col("basis"))
    rows = rows.select(
        "id", "basis", F.col("said").alias("cashback_extract"), F.coalesce(sentence_company(F.col("said")), F.col("found.company")).alias("cashback_company"),
        F.col("found.pattern").alias("detection_patterns"), calc.alias("calc"), refund_unit(basis).alias("rule_unit"), thresholds(basis).alias("thresholds"),
        *[c.alias(f"cond_{n.removeprefix('cond_')}") for n, c in conditions(basis).items()], cotreatments(basis).alias("cotreatments"), no_refund_phrase(F.col("text")).alias("no_refund_phrase"),
    ).withColumn("main", primary_threshold(F.col("thresholds")))
    if preparations is not None:
        known = contained_names(rows, "id", "basis", preparations, "name", "stem").groupBy("id").agg(F.sort_array(F.collect_set(F.upper("name"))).alias("prepared"))
        more = F.filter(F.col("prepared"), lambda d: (F.length(d) >= 5) & ~d.isin(rules.NO_DRUGS))
        rows = rows.join(known, "id", "left").withColumn("cotreatments", F.array_distinct(F.concat("cotreatments", F.coalesce(more, F.array().cast("array<string>")))))
    return rows.select(
        "id", "cashback_extract", "cashback_company", "detection_patterns", F.col("calc.type").alias("rule_calc_type"), F.col("calc.value").alias("rule_calc_value"), "rule_unit",
        F.col("main.type").alias("rule_threshold_type"), F.col("main.value").alias("rule_threshold_value"), F.col("main.unit").alias("rule_threshold_unit"), "thresholds",
        "cond_treatment_stop", "cond_adverse_effects", "cond_treatment_failure", "cotreatments", "no_refund_phrase",
    )


def text_flags(df: DataFrame, text_col: str) -> DataFrame:
    """Input columns plus what is kept beside a distinct text: is_cashback, cashback_company, cashback_patterns, cashback_calc_type, _value, cashback_unit, and has_cashback (1 or 0).

    Character references are decoded and markup cleaned first; for has_cashback the markup stays. The detector's company comes before the sentence's, and
    calculation and unit are read from a sentence only, never from the whole text.
    """
    plain = df.withColumn("_plain", tx.decode_entities(F.col(text_col)))
    rows = plain.withColumn("_text", tx.clean_markup(F.col("_plain"))).withColumn("_found", detect(F.col("_text"))).withColumn("_said", F.when(F.col("_found.is_cashback"), sentence(F.col("_text"), clean=False)))
    calc = F.when(F.col("_said").isNotNull(), calculation(F.col("_said")))
    rows = rows.withColumn("_calc", calc)
    return rows.select(
        *df.columns, F.coalesce("_found.is_cashback", F.lit(False)).alias("is_cashback"), F.coalesce("_found.company", sentence_company(F.col("_said"))).alias("cashback_company"), F.col("_found.pattern").alias("cashback_patterns"),
        F.col("_calc.type").alias("cashback_calc_type"), F.col("_calc.value").alias("cashback_calc_value"), F.when(F.col("_said").isNotNull(), refund_unit(F.col("_said"))).alias("cashback_unit"),
        F.coalesce(detect(F.col("_plain"))["is_cashback"], F.lit(False)).cast("int").alias("has_cashback"),
    )


def segments_and_rest(segments: DataFrame, limitations: DataFrame, id_col: str = "limitation_id") -> DataFrame:
    """Segment texts, and whole texts of the limitations that have no segment."""
    own = segments.select(id_col, F.col("segment_order"), F.col("segment_text_fr").alias("text"))
    rest = limitations.join(segments.select(id_col).distinct(), id_col, "left_anti").select(id_col, F.lit(None).cast("int").alias("segment_order"), F.col("description_fr").alias("text"))
    return own.unionByName(rest).filter(F.col("text").isNotNull())


def base_company(name: Column) -> Column:
    """A company's name without legal forms, upper case; null if two characters or fewer are left."""
    short = F.regexp_replace(F.regexp_replace(name, rf"{ANY}\s*{rules.COMPANY_SUFFIX}\s*", " "), "[()]", "")
    short = F.regexp_replace(F.regexp_replace(short, r"\s+", " "), r"^[ \-]+|[ \-]+$", "")
    return F.when(F.length(short) > 2, F.upper(short))


def base_drug(name: Column) -> Column:
    """A drug's name without strengths and release forms, upper case."""
    short = tx.strip(F.regexp_replace(F.regexp_replace(name, ANY + rules.DRUG_SUFFIX, ""), r"\s+", " "))
    return F.when(F.length(short) > 2, F.upper(short))


def company_set(refunds: DataFrame, partners: DataFrame, company: str = "cashback_company", partner: str = "name") -> DataFrame:
    """(company, base): companies of earlier refunds, without those that are no names, and partners, each with its short form."""
    names = refunds.select(F.col(company).alias("company")).filter((F.length("company") < rules.LONGEST_COMPANY) & ~either(F.lower("company"), rules.NO_COMPANY, ""))
    return names.union(partners.select(F.col(partner))).filter("company <> ''").distinct().withColumn("base", base_company(F.col("company")))


def drug_set(preparations: DataFrame, substances: DataFrame, name: str = "name_de", substance: str = "description_la") -> DataFrame:
    """(name, stem): preparations as they are and substances without their ending, by what is looked for in a text."""
    prepared = preparations.select(F.col(name).alias("name"), F.col(name).alias("stem"))
    stem = F.regexp_replace(F.col(substance), f"(?i){rules.STEM_ENDING}", "")
    made = substances.select(F.col(substance).alias("name"), stem.alias("stem")).filter(F.length("stem") >= 5)
    return prepared.union(made).filter("name <> ''").distinct()


#: So many beginnings of names are put into one pattern, and their names held by every task; more meet the texts by a join.
FEW_BEGINNINGS = 512


def any_of(words: list[str]) -> str:
    """A pattern that any of the words matches, by their first characters."""
    plain = lambda w: "".join(c if c.isalnum() or not c.isascii() else "\\" + c for c in w)
    ends: dict[str, list[str]] = {}
    for w in words:
        ends.setdefault(plain(w[0]), []).append(plain(w[1:]))
    return "|".join(f"{c}(?:{'|'.join(e)})" for c, e in ends.items())


def contained_names(df: DataFrame, id_col: str, text_col: str, names: DataFrame, name: str, looked_for: str) -> DataFrame:
    """(id, text, name): names whose looked_for stands anywhere in a text, blind to case.

    A text and a name meet by the name's first characters (up to four), which are among the runs
    of the text; what has met is compared in full. Few beginnings are one pattern and make no join of texts; with more, only ids travel with the runs.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = names.select(F.col(name).alias("name"), F.upper(F.col(looked_for)).alias("_n")).filter(F.length("_n") > 0).distinct()
    reach = F.least(F.length("_n"), F.lit(4))
    known = known.withColumn("_r", F.substring("_n", F.lit(1), reach))
    # which of the four lengths there are, and how many beginnings
    sizes = {size: n for size, n in known.groupBy(reach).agg(F.count_distinct("_r")).collect()}
    found = F.array().cast("array<string>")
    if sum(sizes.values()) <= FEW_BEGINNINGS:
        # texts are searched for these beginnings only, and what holds one is compared where it stands
        begun = sorted(r[0] for r in known.select("_r").distinct().collect())
        for size in sorted(sizes):
            found = F.concat(found, F.regexp_extract_all("_t", F.lit(f"(?s)(?=({any_of([r for r in begun if len(r) == size])}))"), F.lit(1)))
        asked = texts.filter("id is not null").withColumn("_t", F.upper("text")).withColumn("_r", F.explode(F.array_distinct(found)))
        met = asked.join(F.broadcast(known), "_r").filter(F.contains("_t", "_n"))
    else:
        # all stretches of so many characters, one from each place, in one pass
        for size in sorted(sizes):
            found = F.concat(found, F.regexp_extract_all("_t", F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))
        asked = texts.select("id", F.upper("text").alias("_t")).select("id", F.explode(F.array_distinct(found)).alias("_r"))
        met = asked.join(known, "_r").select("id", "name", "_n").distinct().join(texts, "id").filter(F.contains(F.upper("text"), F.col("_n")))
    # equal texts by their hash, so that no text travels for a caller who leaves it out
    return met.groupBy("id", F.sha2("text", 256), "name").agg(F.first("text").alias("text")).select("id", "text", "name")


def known_companies(df: DataFrame, id_col: str, text_col: str, companies: DataFrame, name: str = "company") -> DataFrame:
    """(id, company, near_refund): known companies that a text names, and whether a refund verb stands within 50 characters before and 100 after."""
    met = contained_names(df, id_col, text_col, companies, name, name).select("id", F.lower("text").alias("text"), F.col("name").alias("company"))
    # the place of the name's first ten characters counts
    place = F.expr("locate(substring(lower(company), 1, 10), text)")
    around = F.substring("text", F.greatest(place - 50, F.lit(1)), F.length("company") + 100 + F.least(place - 1, F.lit(50)))
    near = F.lit(False)
    for verb in rules.REFUND_VERBS:
        near = near | around.contains(verb)
    return met.select("id", "company", near.alias("near_refund")).distinct()
