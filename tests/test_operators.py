"""History, interval, pack, refund, matching and reply operators on hand-written rows."""
import time

import pytest
from pyspark.sql import functions as F

from lexhull.operators import codes, history, intervals, matching, packs, refunds, replies, reports


def test_history_rules(spark):
    df = spark.createDataFrame([(1, "k", "a", None, 5.0), (2, "k", "b", "x", None), (4, "k", None, None, 7.0), (3, None, "n", "m", None), (9, None, "o", "p", 1.0)], "e int, key string, first string, last string, price double")
    got = {r["key"]: tuple(r)[1:] for r in history.snapshot_history(df, ["key"], "e", first=["first"], last=["last"], last_non_null=["price"]).collect()}
    assert got == {"k": (1, 4, "a", None, 7.0), None: (3, 9, "n", "p", 1.0)}


def test_overlap_and_effective_validity(spark):
    a = spark.createDataFrame([("k", 1, 4), ("k", 9, 9), ("z", 1, 2)], "key string, first_seen int, last_seen int")
    b = spark.createDataFrame([("k", 4, 6, "touch"), ("k", 5, 8, "apart"), ("k", 2, 3, "inside")], "key string, first_seen int, last_seen int, name string")
    got = sorted((r["key"], r["first_seen"], r["name"] or "", r["valid_from"], r["valid_thru"]) for r in intervals.overlap_join(a, b, ["key"]).collect())
    assert got == [("k", 1, "inside", 2, 3), ("k", 1, "touch", 4, 4), ("k", 9, "", None, None), ("z", 1, "", None, None)]


def test_fan_out_pack_level_needs_the_dossier(spark):
    links = spark.createDataFrame([("p", "PACK", "11.1", 1, 5), ("p", "PREPARATION", "22.1", 4, 9)], "prep string, limitation_level string, indication_code string, first_seen int, last_seen int")
    items = spark.createDataFrame([("p", "a", "11", 3, 6), ("p", "b", "33", 1, 2)], "prep string, item string, bag_dossier_no string, first_seen int, last_seen int")
    got = sorted(tuple(r) for r in intervals.fan_out(links, items, "prep").collect())
    assert got == [("a", "11.1", "PACK", 3, 5), ("a", "22.1", "PREPARATION", 4, 6)]


PACKS = [
    ("Blist 10 x 10 x 1 Stk", "P1_TRIPLE", dict(multiplier=10, multiplied_count=10, unit_count=1, total_units=100, form_type="BLISTER")),
    ("Ds 3 x 30 Stk", "P1B_FORM_MULT", dict(multiplier=3, unit_count=30, total_units=90)),
    ("2 x 2 Fertspr", "P8B_MULT_FORM_BARE", dict(multiplier=2, container_count=2, total_units=4)),
    ("3 x Fl 5 ml", "P2_MULT_FORM_UNIT", dict(multiplier=3, container_count=3, volume_per_unit=5.0, total_volume=15.0, total_units=3)),
    ("2x Blist 14 Stk", "P2_MULT_FORM_UNIT", dict(unit_count=14, total_units=28, container_count=None)),
    ("3 x 30 Dosen", "P3_MULT_UNIT", dict(dose_count=90, total_units=3)),
    ("5 Fertspr 3 ml", "P4_N_FORM_VOL", dict(container_count=5, total_volume=15.0, total_units=5)),
    ("Fertspr Safe-Sys 4 Stk", "P5_FORM_STK", dict(unit_count=4, container_count=4, total_units=4)),
    ("Dosierspr 140 Dos", "P7_FORM_DOS", dict(dose_count=140, total_units=1)),
    ("Tb 30.5 g.", "P6_FORM_VOL", dict(volume_per_unit=30.5, volume_unit="g", total_units=1)),
    ("10 Durchstf", "P8_N_FORM", dict(container_count=10)),
    ("10 ml zur Prophylaxe", "P11_VOL_ZUR", dict(annotation="zur Prophylaxe", total_volume=10.0)),
    ("30 0.3 ml", "P10_N_N_UNIT", dict(container_count=30, volume_per_unit=0.3, total_units=30)),
    ("37 MBq", "P9_SIMPLE", dict(volume_unit="MBq", total_volume=37.0)),
    ("90 Monodos 9 Btl à 10 Stk", "P14_MONODOS_BTL", dict(container_count=90, unit_count=10, annotation="9 Btl à 10 Stk")),
    ("Durchstf 1 Stk 10 ml", "P12_FORM_STK_VOL", dict(container_count=1, total_volume=10.0)),
    ("3 ml 5 Stk", "P13_VOL_STK", dict(container_count=5, total_volume=15.0)),
    ("Act O Vial", "BARE_FORM", dict(form_type="VIAL", total_units=1)),
    ("30 Stk (alt) (3x 10 Stk) (Muster)", "P9_SIMPLE", dict(is_alt=1, annotation="Muster", unit_count=30)),
    ("something else", "UNMATCHED", dict(parse_confidence="LOW", form_type=None)),
    (None, "UNMATCHED", dict(is_alt=0)),
]


def test_pack_shapes(spark):
    df = spark.createDataFrame([(i, d) for i, (d, *_) in enumerate(PACKS)], "i int, d string").select("i", packs.parse_packs(F.col("d")).alias("p"))
    got = {r["i"]: r["p"].asDict() for r in df.collect()}
    for i, (text, name, fields) in enumerate(PACKS):
        assert got[i]["parse_pattern"] == name, text
        assert {f: got[i][f] for f in fields} == fields, text


def test_substance_quantities(spark):
    df = spark.createDataFrame([(x,) for x in ("150", "12.5", "<0.007", "ca. 100", "min. 30", None, "text", "1e3x")], "q string")
    assert [r[0] for r in df.select(packs.substance_quantity(F.col("q"))).collect()] == [150.0, 12.5, 0.007, 100.0, 30.0, None, None, None]


TEXTS = {
    "pays": "Coûts thérapeutiques: La société Example Pharma SA rembourse à l'assurance 12.5 % du prix. La TVA est incluse. Le reste suit.",
    "paid": "Ce montant est remboursé par Muster Schweiz GmbH.",
    "billed": "L'assureur facture à la firme Roche Example AG le montant.",
    "holder": "Le titulaire de l'autorisation restitue CHF 3'581.40 par emballage après 3 mois.",
    "insurer": "Ils remboursent à l'assurance-maladie une part.",
    "none": "L'assurance paie tout. Exclu du remboursement.",
    "deadline": "La demande de remboursement doit être faite après 6 mois. Example SA rembourse 5 francs.",
}


def mined(spark):
    return {r["id"]: r for r in refunds.mine(spark.createDataFrame(list(TEXTS.items()), "id string, text string"), "id", "text").collect()}


def test_refunds(spark):
    got = mined(spark)
    assert set(got) == set(TEXTS) - {"none"}
    assert {k: r["detection_patterns"] for k, r in got.items()} == {"pays": "company_rembourse", "paid": "rembourse_par", "billed": "assureur_facture", "holder": "titulaire_rembourse", "insurer": "rembourse_assurance", "deadline": "company_rembourse"}
    assert got["pays"]["cashback_company"] == "La société Example Pharma SA" and got["paid"]["cashback_company"] == "Muster Schweiz GmbH" and got["billed"]["cashback_company"] == "Roche Example AG"
    # protecting a percentage's point takes the blank before the sign, too
    assert got["pays"]["cashback_extract"] == "La société Example Pharma SA rembourse à l'assurance 12.5% du prix. La TVA est incluse."
    assert (got["pays"]["rule_calc_type"], got["pays"]["rule_calc_value"]) == ("percentage", 12.5)
    assert (got["holder"]["rule_calc_type"], got["holder"]["rule_calc_value"], got["holder"]["rule_unit"]) == ("chf_fixed", 3581.40, "per_box")
    assert (got["holder"]["rule_threshold_type"], got["holder"]["rule_threshold_value"], got["holder"]["rule_threshold_unit"]) == ("after_months", 3, "months")


def test_swiss_amounts_as_an_option(spark):
    df = spark.createDataFrame([("CHF 3'581.40",)], "t string")
    assert df.select(refunds.calculation(F.col("t"), swiss=False).alias("c")).first()["c"]["value"] == 3.0


def test_deadlines_are_no_thresholds(spark):
    df = spark.createDataFrame([(TEXTS["deadline"],), ("dès le troisième cycle et au-delà de douze semaines",)], "t string").select(refunds.thresholds(F.col("t")).alias("t")).collect()
    assert df[0]["t"] == []
    assert [(x["type"], x["value"], x["unit"]) for x in df[1]["t"]] == [("beyond", 12, "weeks"), ("from_nth", 3, "cycles")]


@pytest.mark.parametrize("word,want", [("douze", 12), ("1er", 1), ("2ème", 2), ("quatrième", 4), ("17", 17), ("vingt-et-un", 21), ("x", None)])
def test_number_words(spark, word, want):
    assert spark.createDataFrame([(word,)], "w string").select(refunds.number(F.col("w"))).first()[0] == want


def test_long_text_without_punctuation_is_safe(spark):
    text = "mot " * 20000 + "rembourse"
    start = time.time()
    assert spark.createDataFrame([(1, text)], "id int, text string").select(refunds.detect(F.col("text")).alias("d")).first()["d"]["is_cashback"] is False
    assert time.time() - start < 60


def test_known_companies_and_bases(spark):
    df = spark.createDataFrame([(1, "Hier verse Example Pharma AG un montant")], "id int, t string")
    names = spark.createDataFrame([("Example Pharma AG",), ("Other SA",)], "company string")
    assert [tuple(r) for r in refunds.known_companies(df, "id", "t", names).collect()] == [(1, "Example Pharma AG", True)]
    got = names.select(refunds.base_company(F.col("company")), refunds.base_drug(F.lit("Examplin 20 mg retard"))).first()
    assert tuple(got) == ("EXAMPLE", "EXAMPLIN")


def test_code_layers(spark):
    df = spark.createDataFrame([(1, ["1.01"], "x", "DIA", "9"), (2, None, "codice: 12345.67", "DIA", "9"), (3, [], "x", "DIA", "9"), (4, None, "x", "OTHER", "9"), (5, None, None, "DIA", None)], "i int, given array<string>, t string, kind string, dossier string")
    got = sorted((r["i"], r["code_value"], r["code_source"]) for r in codes.assign_codes(df, "given", ["t"], "kind", "dossier").collect())
    assert got == [(1, "1.01", "STRUCTURED_XML"), (2, "12345.67", "TEXT_PARSED"), (3, "9.xx", "FALLBACK_XX")]


def test_cascade_layers(spark):
    segs = [(1, "g1", 0, "Foo 11111.01", "D1"), (2, "g2", 0, "melanom :", "D1"), (3, "g3", 0, "Melanom", "D2"), (4, "g4", 0, "Teil", "D1"), (5, "g5", 0, "Kombination VIDAZA, Rest", "D1"), (6, "g6", 0, "REVLIMID allein", "D1"),
            (7, "g7", 0, "zzzz qqqq", "D7"), (8, "g8", 0, "first", "D8"), (9, "g8", 1, "second", "D8"), (10, "g9", 0, "Lungenkarzinom nichtkleinzellig Y", "D1")]
    known = [("Melanom", "D1.05", "D1"), ("Teil | Anderes", "D1.06", "D1"), ("VIDAZA in Kombination mit Rest", "D1.07", "D1"), ("LENALIDOMID allein", "D1.08", "D1"), ("Lungenkarzinom nichtkleinzellig X", "D1.09", "D1")]
    code = [("g7", "D7.03"), ("g8", "D8.02"), ("g8", "D8.01")]
    out = matching.cascade(
        spark.createDataFrame(segs, "segment int, group string, position int, name string, dossier string"), spark.createDataFrame(known, "name string, code_value string, dossier string"),
        spark.createDataFrame(code, "group string, code_value string"),
    )
    got = {r["segment"]: (r["code_value"], r["match_type"]) for r in out.collect()}
    assert got == {1: ("11111.01", "EMBEDDED_IN_NAME"), 2: ("D1.05", "NORMALIZED_MATCH"), 3: ("D2.05", "NORMALIZED_CROSS"), 4: ("D1.06", "PIPE_PART_MATCH"), 5: ("D1.07", "KOMBI_NORMALIZED"), 6: ("D1.08", "KOMBI_NORMALIZED"),
                   7: ("D7.03", "SINGLE_SEGMENT_CODE"), 8: ("D8.01", "ORDINAL_POSITION"), 9: ("D8.02", "ORDINAL_POSITION"), 10: ("D1.09", "FUZZY_MATCHED")}


def test_cascade_rewrites_brands_in_combinations_and_orders_whole_codes(spark):
    """Brands of rewritten combinations, a form met by its own layer only where it differs, codes of a group in order of all of the code."""
    segs = [(1, "g1", 0, "Kombination REVLIMID, X", "D1"), (2, "g2", 0, "Kombination VIDAZA und Y", "D2"), (3, "g3", 0, "a", "D3"), (4, "g3", 1, "b", "D3"), (5, "g4", 0, "Kombination IMNOVID, Z", "D5")]
    known = [("LENALIDOMID in Kombination mit X", "D1.01", "D1"), ("AZACITIDIN in Kombination mit und Y | mehr", "D2.02", "D2"), ("Kombination POMALIDOMID SANDOZ, Z", "D4.03", "D4")]
    codes_ = [("g3", "00002.01"), ("g3", "00001.02")]
    out = matching.cascade(spark.createDataFrame(segs, "segment int, group string, position int, name string, dossier string"), spark.createDataFrame(known, "name string, code_value string, dossier string"), spark.createDataFrame(codes_, "group string, code_value string"))
    got = {r["segment"]: (r["code_value"], r["match_type"], r["matched_to"]) for r in out.collect()}
    assert got == {1: ("D1.01", "KOMBI_NORMALIZED", "same dossier D1"), 2: ("D2.02", "PIPE_PART_MATCH", "same dossier D2"), 3: ("00001.02", "ORDINAL_POSITION", "position in lim g3"), 4: ("00002.01", "ORDINAL_POSITION", "position in lim g3"), 5: ("D5.03", "BRAND_CROSS", "ind_part .03 from D4.03")}


def test_code_names_by_source_and_one_row_per_code(spark):
    """A structured code is paired whatever parsed ones stand beside it; a code of several texts gets the name of the smallest."""
    links = [(1, "D1.10", "STRUCTURED_XML"), (1, "D1.11", "TEXT_PARSED"), (2, "D1.10", "STRUCTURED_XML"), (3, "D2.12", "TEXT_PARSED"), (4, "D3.XX", "FALLBACK_XX"), (5, "D5.13", "TEXT_PARSED"), (6, "D6.14", "TEXT_PARSED"), (7, "D1.15", "TEXT_PARSED")]
    segs = [(1, 0, "Eins"), (2, 0, "Zwei"), (3, 0, "eins :"), (3, 1, None), (7, 0, "zwei"), (7, 1, "eins")]
    texts = [(3, "x"), (5, "<b>Melanom</b> y"), (6, "<b>UND</b> Nur dies. Mehr"), (5, "z")]
    out = matching.code_names(
        spark.createDataFrame(links, "text_id int, indication_code string, code_source string"), spark.createDataFrame(segs, "text_id int, segment_order int, indication_name_de string"),
        spark.createDataFrame(texts, "text_id int, text string"), None, spark.createDataFrame([(4, "Trois")], "text_id int, indication_name_fr string"),
    )
    got = {(r["indication_code"], r["indication_name_de"], r["indication_name_fr"], r["match_source"]) for r in out.collect()}
    assert got == {
        ("D1.10", "Eins", None, "DIRECT_STRUCT"), ("D1.11", "Eins", None, "SHARED_TEXT"), ("D2.10", "eins :", None, "NORM_CROSS"), ("D1.10", "eins", None, "NORM_SAME"), ("D3.XX", None, "Trois", "LLM_SEGMENT"),
        ("D5.13", "Melanom", None, "BOLD_EXTRACT"), ("D5.13", "z", None, "DESC_TRUNCATED"), ("D6.14", "UND Nur dies.", None, "DESC_TRUNCATED"), ("D2.12", "x", None, "DESC_TRUNCATED"),
    } | {x for x in got if x[0] == "D1.15"}
    came = {(r["indication_code"], r["indication_name_de"]): (r["source_text_id"], r["source_segment_order"]) for r in out.collect()}
    assert (came["D1.10", "Eins"], came["D1.11", "Eins"], came["D2.10", "eins :"], came["D5.13", "Melanom"], came["D3.XX", None]) == ((1, 0), (1, 0), (3, 0), (5, None), (4, None))


def test_code_names_in_three_languages_and_by_brand(spark):
    links = [(1, "D1.10", "STRUCTURED_XML"), (2, "D1.11", "FALLBACK_XX"), (3, "D2.12", "FALLBACK_XX"), (5, "D5.13", "TEXT_PARSED")]
    segs = [(1, 0, "LENALIDOMID Lunge", "poumon", "polmone"), (2, 0, "Revlimid Lunge", "b", "c"), (3, 0, "REVLIMID Lunge", "e", "f")]
    texts = [(5, "<b>Haut</b> y", "x <b>Peau</b>")]
    out = matching.code_names(
        spark.createDataFrame(links, "text_id int, indication_code string, code_source string"), spark.createDataFrame(segs, "text_id int, segment_order int, indication_name_de string, indication_name_fr string, indication_name_it string"),
        spark.createDataFrame(texts, "text_id int, text string, text_fr string"), spark.createDataFrame([("R.1", "Ref", "réf", "rif", "R")], "indication_code string, indication_name_de string, indication_name_fr string, indication_name_it string, bag_dossier_no string"),
    )
    got = {(r["match_source"], r["indication_code"], r["indication_name_de"], r["indication_name_fr"], r["indication_name_it"], r["source_text_id"]) for r in out.collect()}
    assert {x for x in got if not x[0].startswith("BRAND")} == {("REF_MAP", "R.1", "Ref", "réf", "rif", None), ("DIRECT_STRUCT", "D1.10", "LENALIDOMID Lunge", "poumon", "polmone", 1), ("BOLD_EXTRACT", "D5.13", "Haut", "Peau", None, 5)}
    assert {x[:2] for x in got if x[0].startswith("BRAND")} == {("BRAND_CROSS", "D2.10")}


def test_cascade_broadcasts_nothing_that_grows(spark, tmp_path):
    """Asks are several times the segments, of which the file is small: by its size all of them would go to every task."""
    spark.range(2000).selectExpr("id as segment", "id div 2 as `group`", "id % 2 as position", "concat('name ', id % 7) as name", "concat('D', id % 3) as dossier", "concat('D', id % 3, '.', id % 90 + 10) as code_value").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    out = matching.cascade(t.drop("code_value"), t.select("name", "code_value", "dossier"), t.select("group", "code_value"))
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 2000


def test_code_names_reads_links_and_segments_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(x):
        seen.add(1)
        return x

    counted = F.udf(told).asNondeterministic()
    links = [(1, "D1.10", "STRUCTURED_XML"), (2, "D1.11", "TEXT_PARSED"), (2, "D1.12", "TEXT_PARSED"), (3, "D3.XX", "FALLBACK_XX"), (4, "D4.13", "TEXT_PARSED")]
    segs = [(1, 0, "Eins"), (2, 0, "Zwei"), (2, 1, "Drei"), (3, 0, "eins")]
    out = matching.code_names(
        spark.createDataFrame(links, "text_id int, indication_code string, code_source string").withColumn("indication_code", counted("indication_code")),
        spark.createDataFrame(segs, "text_id int, segment_order int, indication_name_de string").withColumn("indication_name_de", counted("indication_name_de")),
        spark.createDataFrame([(4, "<b>Haut</b>")], "text_id int, text string"), None, spark.createDataFrame([(3, "Trois")], "text_id int, indication_name_fr string"),
    )
    assert {(r["indication_code"], r["indication_name_de"] or r["indication_name_fr"], r["match_source"]) for r in out.collect()} == {
        ("D1.10", "Eins", "DIRECT_STRUCT"), ("D1.11", "Zwei", "ORDINAL_POSITION"), ("D1.12", "Drei", "ORDINAL_POSITION"), ("D3.10", "eins", "NORM_CROSS"), ("D3.XX", "Trois", "LLM_SEGMENT"), ("D4.13", "Haut", "BOLD_EXTRACT")}
    assert seen.value == len(links) + len(segs)


def test_two_entries_of_one_name_leave_no_lead(spark):
    left = spark.createDataFrame([("d", 1, "abcdefghij"), ("d", 2, "klmnopqrst")], "dossier string, segment int, a string")
    right = spark.createDataFrame([("d", "abcdefghix"), ("d", "abcdefghix"), ("d", "klmnopqrsx")], "dossier string, b string")
    assert {r["segment"] for r in matching.fuzzy_best(left, right, ["dossier"], "segment", "a", "b").collect()} == {2}


def test_unmatched_names_count_after_the_join_with_packs(spark):
    segs = spark.createDataFrame([(1, "A", None), (1, None, None), (2, "B", None), (3, "C", "x")], "preparation_id int, indication_name_de string, matched_code_value string")
    packs_ = spark.createDataFrame([(1, "D"), (1, "D"), (1, "E")], "preparation_id int, bag_dossier_no string")
    assert {tuple(r) for r in reports.unmatched_names(segs, packs_).collect()} == {("A", "D", 2), ("A", "E", 1), ("B", None, 1)}


def test_names_anywhere_in_a_text(spark):
    df = spark.createDataFrame([(1, "xEXAMPLEx und Ab"), (2, "nichts"), (3, None), (4, "ab " + "wort " * 30000 + "example")], "id int, t string")
    names = spark.createDataFrame([("Example", "example"), ("AB", "ab"), ("", ""), (None, None)], "name string, stem string")
    assert {(r["id"], r["name"]) for r in refunds.contained_names(df, "id", "t", names, "name", "stem").collect()} == {(1, "Example"), (1, "AB"), (4, "AB"), (4, "Example")}


def test_reference_sets_add_refunds_and_drugs(spark):
    df = spark.createDataFrame([(1, "Hier verse Example Pharma AG einen Teil, mit Examplinum"), (2, "Example Pharma AG, sonst nichts"), (3, "Muster SA rembourse 5 francs avec le Testpraep.")], "id int, t string")
    companies = refunds.company_set(spark.createDataFrame([("Example Pharma AG",), ("chaque SA",)], "cashback_company string"), spark.createDataFrame([("Partner GmbH",)], "name string"))
    assert {(r["company"], r["base"]) for r in companies.collect()} == {("Example Pharma AG", "EXAMPLE"), ("Partner GmbH", "PARTNER")}
    drugs = refunds.drug_set(spark.createDataFrame([("Testpraep",), ("AB",)], "name_de string"), spark.createDataFrame([("Examplinum",), ("Xum",)], "description_la string"))
    got = {r["id"]: (r["detection_patterns"], r["cashback_company"], r["cotreatments"]) for r in refunds.mine(df, "id", "t", preparations=drugs, companies=companies).collect()}
    assert got == {1: ("fuzzy_company", "Example Pharma AG", ["EXAMPLINUM"]), 3: ("company_rembourse", "Muster SA", ["TESTPRAEP"])}


def test_fuzzy_pruning_changes_nothing(spark):
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(6, 14)))
    base = [word() for _ in range(40)]
    near = [b[:-1] + rng.choice("abcde") for b in base]
    left = spark.createDataFrame([("d", i, n) for i, n in enumerate(near)], "dossier string, segment int, a string")
    right = spark.createDataFrame([("d", b) for b in base], "dossier string, b string")
    runs = [sorted((r["segment"], r["b"], round(r["score"], 9)) for r in matching.fuzzy_best(left, right, ["dossier"], "segment", "a", "b", prune=p).collect()) for p in (True, False)]
    assert runs[0] == runs[1] and runs[0]


def test_best_candidate(spark):
    df = spark.createDataFrame([(1, "Roche"), (2, "Rochee"), (3, "Novarti"), (4, "zzz")], "i int, n string")
    c = spark.createDataFrame([("ROCHE",), ("Novartis",), ("Pfizer",)], "c string")
    assert {r["i"]: r["candidate"] for r in matching.best_candidate(df, "i", "n", c, "c").collect()} == {1: "ROCHE", 2: "ROCHE", 3: "Novartis"}


def test_replies(spark):
    good = '```json\n{"is_multi_indication": true, "segments": [{"order": 1, "indication_name_fr": "A", "is_cashback": true, "cashback_calc_type": "bad", "cashback_unit": null}]}\n```'
    rows = [(1, good, "2"), (1, '{"segments": [{"indication_name_fr": "old", "is_cashback": false}]}', "1"), (2, "no", "1"), (3, '{"segments": []}', "1"), (4, '{"segments": [{"indication_name_fr": "B"}]}', "1"), (5, '{"segments": [{"indication_name_fr": null, "is_cashback": null}]}', "1"), (6, None, "1"), (7, '"segments"', "1"), (8, '{"segments": [7]}', "1")]
    df = spark.createDataFrame(rows, "text_id int, raw string, processed_at string")
    assert [(r["text_id"], r["indication_name_fr"], r["cashback_calc_type"], r["cashback_unit"]) for r in replies.reply_segments(df).collect()] == [(1, "A", "unknown", None), (5, None, None, None)]
    errors = [(2, "no JSON"), (3, "empty segments"), (4, "segment without a verdict"), (6, "no JSON"), (7, "no object"), (8, "segment without a name")]
    assert sorted((r["text_id"], r["error"]) for r in replies.parse_replies(df).filter("error is not null").collect()) == errors


def test_upserts(spark):
    old, new = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (1, "b"), (2, "c")], [(1, "n")]))
    assert sorted(tuple(r) for r in history.replaced(old, new, "k").collect()) == [(1, "n"), (2, "c")]
    assert sorted(tuple(r) for r in history.unprocessed(old, new, "k").collect()) == [(2, "c")]
    assert history.unprocessed(old, new, "k", force=True).count() == 3
    assert sorted(tuple(r) for r in history.union_first_wins([new, old], ["k"]).collect()) == [(1, "n"), (2, "c")]


def test_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    assert sorted(tuple(r) for r in reports.joined_list(df, ["k"], "v", "all", " | ").collect()) == [(1, "a | b"), (2, "a")]
    assert tuple(reports.coverage(df.limit(0), a=F.col("k") == 1).first()) == (0, 0, 0.0)
    assert [r["k"] for r in reports.keys_having(df, "k", rows=1).collect()] == [2]


def test_thresholds_around_their_anchors_are_those_of_whole_texts(spark):
    """Each pattern tried on the whole text, in Python, gives the same matches."""
    import random
    import re

    from lexhull.operators import refunds
    from lexhull.rules import refunds as rules

    rng = random.Random(4)
    words = "|".join(map(re.escape, sorted(rules.NUMBER_WORDS, key=len, reverse=True)))
    said = ["après 3ème mois", "au moins 2e cycles", "dès le premier flacon", "5 flacons par patient et par an", "les premiers deux mois", "jusqu'à 3 boîtes", "maximum de 4 emballages", "par année", "rechute", "forfait unique", "mois", "jour", "partir", "à partir du 3e", "flacon",
            "traitement de", "12 jours après", "si le patient a besoin de plus de 3", "récidive", "durée", "de thérapie de trois mois", "à", "plus de", "deux", "semaines", "> 3 cycles", "au-delà de dix cycles", " " * 300, "\n", "7" * 260, "la demande de remboursement", "mot " * 50]
    texts = ["", "mois", "après 2 mois", *[" ".join(rng.choice(said) for _ in range(rng.randrange(1, 14))) for _ in range(250)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: [(x["type"], x["match"]) for x in r["t"]] for r in df.select("id", refunds.thresholds(F.col("text")).alias("t")).collect()}
    for i, text in enumerate(texts):
        low, want = text.lower(), []
        for kind, pattern, _ in rules.THRESHOLDS:
            n = rf"(\d+|{words})"
            m = re.search(pattern.replace("NTH", "\0").replace("N", n).replace("\0", n + "(?:e|[èé]me|ème|eme)?"), low)
            near = low[max(0, m.start() - 150) : m.end() + 150] if m else ""
            if m and not any(re.search(p, near) for p in rules.DEADLINES):
                want.append((kind, m.group(0)))
        assert got[i] == want, text


def test_detection_from_the_place_of_its_words(spark):
    from lexhull.operators import refunds

    texts = ["Alpha Beta SA, puis. Gamma Delta AG rembourse 3 % du prix", "rembourse. Le titulaire rembourse", "Example Rembourse Pharma SA rembourse", "TITULAIRE restitue", "", None, "x" * 70000 + " On REMBOURSE complètement", "facture Remboursés par Muster Example GmbH."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = [tuple(r) for r in df.select("id", refunds.detect(F.col("text")).alias("f")).select("f.is_cashback", "f.company", "f.pattern").collect()]
    assert got == [(True, "Gamma Delta AG", "company_rembourse"), (True, None, "titulaire_rembourse"), (True, "Example Rembourse Pharma SA", "company_rembourse"), (True, None, "titulaire_rembourse"), (False, None, None), (False, None, None), (True, None, "full_refund"), (True, "Muster Example GmbH", "rembourse_par")]


def test_similar_pairs_lose_none(spark):
    import random

    from difflib import SequenceMatcher

    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeéß xy") for _ in range(rng.randrange(1, 30))) for _ in range(60)] + ["a" * 1500, "a" * 1400 + "b", "日本語🙂", "日本語🙂x"]
    names = sorted({*base, *["".join(c for c in n if rng.random() > 0.08) for n in base for _ in range(2)]})
    left, right = spark.createDataFrame([(i % 2, n) for i, n in enumerate(names)] + [(0, None), (0, "")], "k int, a string"), spark.createDataFrame([(k, n) for k in (0, 1) for n in names], "k int, b string")
    got = [(r["k"], r["a"], r["b"]) for r in matching.similar_pairs(left, right, ["k"], "a", "b", 0.85).collect()]
    assert len(got) == len(set(got)) < 0.2 * len(names) ** 2
    want = {(i % 2, a, b) for i, a in enumerate(names) if a for b in names if b and SequenceMatcher(None, a, b).ratio() >= 0.85}
    assert want <= set(got) and len(want) > 100


def test_bucket_join_equals_overlap_join(spark):
    import random

    rng = random.Random(6)
    rows = lambda n: [(i, rng.choice(["k", "k", "k", "m", None]), a := rng.randrange(-400, 400), a + rng.randrange(0, 30)) for i in range(n)]
    left = spark.createDataFrame([*rows(400), (900, "k", None, 5), (901, "k", 7, 3)], "a int, key string, first_seen int, last_seen int")
    right = spark.createDataFrame([*rows(400), (900, "k", 5, None)], "b int, key string, first_seen int, last_seen int")
    for how in ("inner", "left"):
        want = intervals.overlap_join(left.filter("first_seen <= last_seen or first_seen is null"), right, ["key"], how)
        got = intervals.bucket_join(left.filter("first_seen <= last_seen or first_seen is null"), right, ["key"], 16, how, row=["a"])
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    # one key with many intervals: what is compared is near what is found
    many = spark.range(20000).selectExpr("id as a", "1 as key", "id * 10 as first_seen", "id * 10 + 12 as last_seen")
    other = many.withColumnRenamed("a", "b")
    assert intervals.bucket_join(many, other, ["key"], 16).count() == 20000 + 2 * 19999


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    import pathlib

    path = str(tmp_path / "t")
    files = lambda: {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}
    rows = lambda: sorted(map(tuple, spark.read.parquet(path).select("id", "v", "at").collect()))
    old = spark.createDataFrame([(i, "old", 1) for i in range(200)], "id int, v string, at int")
    history.upsert(path, old, ["id"], ["at", "v"], buckets=16)
    before = files()
    new = spark.createDataFrame([(5, "new", 2), (5, "newer", 3), (6, "stale", 0), (1000, "more", 1)], "id int, v string, at int")
    history.upsert(path, new, ["id"], ["at", "v"], buckets=16)
    after, want = files(), sorted([*[(i, "old", 1) for i in range(200) if i != 5], (5, "newer", 3), (1000, "more", 1)])
    assert rows() == want and 10 <= len(before & after) < len(before)
    history.upsert(path, new, ["id"], ["at", "v"], buckets=16)
    assert rows() == want


def test_dates_are_looked_up_without_a_join(spark, monkeypatch):
    df, extracts = spark.createDataFrame([(1, 2), (None, 9)], "a int, b int"), spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "extract_id int, release_date string")
    out = history.resolve_dates(df, extracts, p="a", q="b")
    assert {tuple(r) for r in out.select("p", "q").collect()} == {("x", None), (None, None)}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(history, "MAPPED_SNAPSHOTS", 2)
    assert {tuple(r) for r in history.resolve_dates(df, extracts, p="a", q="b").select("p", "q").collect()} == {("x", None), (None, None)}
    assert history.resolve_dates(df, extracts.limit(0), p="a").select("p").distinct().collect()[0]["p"] is None


def test_counters_taken_while_writing_equal_the_report(spark, tmp_path):
    from lexhull.operators import refunds

    texts = ["Example SA rembourse 5 % du prix après 3 mois, au moins 2 cycles, en association avec Examplinib.", "Le titulaire rembourse 7 francs en cas de progression.", "On rembourse complètement en cas d'arrêt du traitement.", "nichts"]
    rules_ = refunds.mine(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text")
    watched, seen = reports.watched_refunds(rules_)
    watched.write.parquet(str(tmp_path / "r"))
    want = {tuple(r) for r in reports.refund_report(spark.read.parquet(str(tmp_path / "r")), len(texts)).collect()}
    assert set(reports.watched_report(seen, len(texts))) == want and ("detected", "none", 1) in want


def test_texts_by_the_callers_columns_and_dealing(spark, tmp_path, monkeypatch):
    from lexhull.sources import tables

    path = str(tmp_path / "texts")
    spark.createDataFrame([(3, "c", 1), (1, "a", 2), (2, None, 3)], "no long, said string, other int").coalesce(1).write.parquet(path)
    read = tables.read_texts(spark, path, "no", "said")
    assert sorted(map(tuple, read.collect())) == [(1, "a"), (2, None), (3, "c")]
    assert [tuple(r) for r in tables.read_texts(spark, path, "no", "said", limit=2).collect()] == [(1, "a"), (2, None)]
    # one file of one row group: dealt out; a large input stays as it is read
    cores = spark.sparkContext.defaultParallelism
    out = tables.dealt(read)
    assert out.rdd.getNumPartitions() == 2 * cores and sorted(map(tuple, out.collect())) == sorted(map(tuple, read.collect()))
    monkeypatch.setattr(tables, "ROW_GROUP_BYTES", 0)
    assert tables.dealt(read) is read


def test_growing_sides_of_the_cascade_are_not_broadcast(spark):
    segs = spark.createDataFrame([(1, 1, 0, "alpha beta", "D1"), (2, 2, 0, "alpha betb", "D1")], "segment long, `group` long, position int, name string, dossier string")
    known = spark.createDataFrame([("alpha beta", "D1.1", "D1")], "name string, code_value string, dossier string")
    codes = spark.createDataFrame([(1, "D1.1")], "`group` long, code_value string")
    plan = lambda df: df._jdf.queryExecution().toString()
    matches = matching.cascade(segs, known, codes)
    logged = matching.match_log(segs, matches)
    assert "strategy=merge" in plan(logged) and {r["segment"] for r in logged.collect()} == {1, 2}
    names = spark.createDataFrame([("D1", "alpha beta")], "d string, a string")
    met = matching.similar_pairs(names, names.withColumnRenamed("a", "b"), ["d"], "a", "b", 0.85)
    assert "SortMergeJoin" in plan(met) and "BroadcastHashJoin" not in plan(met) and met.count() == 1


def test_an_abbreviation_before_a_new_sentence_ends_one(spark):
    said = [
        ("Un mot de la al. Le titulaire rembourse 33 Fr. par mois", "Le titulaire rembourse 33 Fr."), ("Voir etc. La société Muster SA rembourse tout.", "La société Muster SA rembourse tout."),
        ("Avant. Selon l'art. 71 al. 2 le titulaire rembourse tout.", "Selon l'art. 71 al. 2 le titulaire rembourse tout."), ("Avant. Soit max. Fr. 30 que le titulaire rembourse ici.", "Soit max. Fr. 30 que le titulaire rembourse ici."),
    ]
    df = spark.createDataFrame(said, "t string, want string")
    assert [r["s"] for r in df.select(refunds.sentence(F.col("t")).alias("s")).collect()] == [w for _, w in said]


def test_sentences_are_matched_in_pieces_with_a_verb(spark):
    from lexhull.rules import refunds as rules

    assert all(p.endswith(r"[^.]*\.") and p.count(r"\.") == 1 for p in rules.SENTENCES)  # so a match lies between two full stops
    df = spark.createDataFrame([("Un. Deux 3 Fr. de plus. Eli Lilly rembourse 5 francs. Le titulaire restitue 6 francs. Fin",)], "t string")
    said = df.select(refunds.sentence(F.col("t")).alias("s"))
    assert said.first()["s"] == "Eli Lilly rembourse 5 francs." and "split(" in said._jdf.queryExecution().toString()


def test_given_along_words_stand_in_every_match(spark):
    from lexhull.rules import refunds as rules

    assert set(rules.GIVEN_WORDS) == set(rules.GIVEN_ALONG)
    # letters that a pattern blind to case takes for plain ones, and a name with its mark
    texts = [("en aſſociation avec Examplinib", ["EXAMPLINIB"]), ("EN ASSOCİATION AVEC Abcdef", ["ABCDEF"]), ("SCHÉMA avec Abcdef", ["ABCDEF"]), ("Keytruda®, opdivo, xkisqali", ["KEYTRUDA", "OPDIVO"]), (None, None)]
    df = spark.createDataFrame(texts, "t string, want array<string>").select(refunds.cotreatments(F.col("t")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in df.collect())


def test_growing_tables_of_the_exports_and_maps_are_not_broadcast(spark):
    from lexhull.operators import exports

    one = lambda schema, *row: spark.createDataFrame([row], schema)
    lims = one("limitation_id int, preparation_id int, limitation_code string, first_seen int, last_seen int", 1, 2, "L", 1, 9)
    segs = one("segment_id int, limitation_id int, preparation_id int, segment_order int, segment_text_fr string, first_seen int, last_seen int", 5, 1, 2, 0, "a<br>b", 1, 9)
    preps, extracts = one("preparation_id int, name_de string", 2, "P"), one("extract_id int, release_date string", 1, "on 1")
    packs = one("preparation_id int, gtin int, bag_dossier_no string, first_seen int, last_seen int", 2, 7, "D", 1, 3)
    codes = one("limitation_id int, preparation_id int, bag_dossier_no string, code_value string, first_seen int, last_seen int", 1, 2, "D", "D.1", 1, 4)
    held = one("limitation_id int, code_value string, code_source string, bag_dossier_no string", 1, "D.xx", "FALLBACK_XX", "D")
    names = one("indication_name_de string, code_value string, bag_dossier_no string", "n", "D.1", "D")
    made = [
        exports.item_indications(codes, lims, preps, packs, extracts), exports.segment_listing(segs, lims, preps),
        exports.refund_analysis(segs, packs, one("segment_id int, rule_calc_type string", 5, "percentage"), extracts),
        matching.retro_map(held, one("limitation_id int, indication_name_de string", 1, "n"), names),
    ]
    for df, joins in zip(made, (3, 2, 2, 3)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") >= joins and df.count() == 1


def test_bucket_join_asks_once_and_broadcasts_nothing(spark):
    left = spark.createDataFrame([("x", 1, 0, 500), (None, 1, 0, 40), (None, 2, 0, 5)], "a string, key int, first_seen int, last_seen int")
    right = spark.createDataFrame([(7, 1, 30, 90), (8, 1, 600, 700)], "b int, key int, first_seen int, last_seen int")
    out = intervals.bucket_join(left, right, ["key"], 16, "left", row=["a", "key"])
    # a row with a null among the columns of row has its pair, and no row without one beside it
    assert {tuple(r) for r in out.select("a", "key", "b", "valid_from", "valid_thru").collect()} == {("x", 1, 7, 30, 90), (None, 1, 7, 30, 40), (None, 2, None, None, None)} and out.count() == 3
    for how in ("inner", "left"):
        plan = intervals.bucket_join(left, right, ["key"], 16, how, row=["a", "key"])._jdf.queryExecution().toString()
        physical = plan[plan.index("== Physical Plan =="):]
        assert "Broadcast" not in physical and physical.count("Generate explode") == (2 if how == "inner" else 0)


def test_segment_table_is_dealt_out_to_all_cores(spark, tmp_path):
    # one file, one row group: a single task would read and cut all texts
    spark.range(64).selectExpr("id", "concat('<b>name ', id, '</b> body') as de").coalesce(1).write.parquet(f"{tmp_path}/t")
    out = codes.segment_table(spark.read.parquet(f"{tmp_path}/t"), "id", {"de": "de"}, renumber=False)
    assert out.count() == 64 and out.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism


def test_best_candidate_sends_no_texts_by_their_letters(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Roche"), (2, "bei Roche AG"), (3, "Novartiz"), (4, "xyz"), (5, None), (6, "vart"), (1, "Novartis")], "i int, n string")
    c = spark.createDataFrame([("Roche",), ("Novartis",), ("AG",)], "c string")
    few = matching.best_candidate(df, "i", "n", c, "c")
    got = sorted(map(tuple, few.collect()))
    assert {(i, x) for i, x, _ in got} == {(1, "Novartis"), (2, "AG"), (3, "Novartis"), (6, "Novartis")}
    # candidates are sent to all tasks, so no text is sorted for a join
    plan = few._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan[plan.index("== Physical Plan =="):]
    monkeypatch.setattr(matching, "FEW", 0)
    many = matching.best_candidate(df, "i", "n", c, "c")
    assert sorted(map(tuple, many.collect())) == got
    plan = many._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan[plan.index("== Physical Plan =="):]


def test_contained_names_of_few_beginnings_make_no_join_of_texts(spark, monkeypatch):
    rows = [(1, "a b.c* \\Q\nx Émile"), (1, "a b.c* \\Q\nx Émile"), (1, "other b.c"), (2, "bxc"), (3, None), (None, "b.c*"), (4, "\U0001F600ab \U0001F600"), (5, "(longer name)")]
    df = spark.createDataFrame(rows, "id int, t string")
    names = spark.createDataFrame([("dot", "b.c*"), ("dot", "b.c"), ("q", "\\q\n"), ("e", "émile"), ("s", "\U0001F600a"), ("p", "("), ("l", "(longer name)"), ("none", "")], "name string, stem string")
    few = refunds.contained_names(df, "id", "t", names, "name", "stem")
    got = sorted(map(tuple, few.collect()))
    assert [(i, n) for i, _, n in got] == [(1, x) for x in ("dot", "e", "q", "dot")] + [(4, "s"), (5, "l"), (5, "p")]
    plan = few.select("*")._jdf.queryExecution().toString()
    plan = plan[plan.index("== Physical Plan =="):]
    assert "SortMergeJoin" not in plan and plan.count("HashJoin") == 1
    monkeypatch.setattr(refunds, "FEW_BEGINNINGS", 0)
    assert sorted(map(tuple, refunds.contained_names(df, "id", "t", names, "name", "stem").collect())) == got
