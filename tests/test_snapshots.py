"""XML snapshots through the whole pipeline."""
import pytest
from pyspark.sql import functions as F

from lexhull.operators import history
from lexhull.plans import snapshot_pipelines as plans
from lexhull.sources import snapshots, tables


def pack(gtin, dossier, text="5 Fertspr 3 ml", price="10.5", inner=""):
    gtin = f"<GTIN>{gtin}</GTIN>" if gtin else ""
    dossier = f"<BagDossierNo>{dossier}</BagDossierNo>" if dossier else "<BagDossierNo/>"
    return f"<Pack>{gtin}{dossier}<DescriptionDe>{text}</DescriptionDe><Prices><PublicPrice><Price>{price}</Price><ValidFromDate>01.01.2020</ValidFromDate></PublicPrice></Prices><Partners><Partner><PartnerType>V</PartnerType><Description>Firma</Description><Street>Weg 1</Street><Phone>044</Phone></Partner></Partners><Status><StatusTypeCodeSl>0</StatusTypeCodeSl><FlagApd>N</FlagApd></Status><SizePack>5</SizePack>{inner}</Pack>"


def limitation(code, text, given="", kind="DIA"):
    code = f"<LimitationCode>{code}</LimitationCode>" if code else ""
    given = f'<IndicationsCodes><IndicationsCode Code="{given}"/></IndicationsCodes>' if given else ""
    return f"<Limitations><Limitation>{code}<LimitationType>{kind}</LimitationType><DescriptionDe>{text}</DescriptionDe>{given}</Limitation></Limitations>"


def prep(no, name, packs, extra=""):
    no = f"<SwissmedicNo5>{no}</SwissmedicNo5>" if no else ""
    return f"<Preparation><NameDe> {name} </NameDe>{no}<Substances><Substance><DescriptionLa>Substantia</DescriptionLa><Quantity>ca. 20</Quantity><QuantityUnit>mg</QuantityUnit></Substance></Substances><Packs>{packs}</Packs>{extra}</Preparation>"


@pytest.fixture(scope="module")
def ingested(spark, path, tmp_path_factory):
    return plans.ingest(spark, path, str(tmp_path_factory.mktemp("tables")))


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    top = tmp_path_factory.mktemp("snapshots")
    melanoma, both = "&lt;b&gt;Melanom&lt;/b&gt; Text eins", "&lt;b&gt;Melanom&lt;/b&gt; a&lt;br&gt;\n&lt;b&gt;UND&lt;/b&gt; b&lt;br&gt;&lt;b&gt;Lunge&lt;/b&gt; c"
    files = {
        "2019/Preparations-20190101.xml": prep("111", "Alt", pack("g1", "500") + pack("", "777")) + prep("", "Ohne", pack("gx", "1")),
        "2020/Preparations-20200101.xml": prep("111", "Neu", pack("g1", "500", price="kein") + pack("g2", "600"), limitation("L1", melanoma, "500.01")) + prep("222", "Zwei", pack("g3", "800", inner=limitation("", both)), f"<ItCodes><ItCode>{limitation('L9', 'x', kind='GEN')}</ItCode></ItCodes>"),
        "2020/Preparations-20200201.xml": prep("111", "Neu", pack("g2", "600"), limitation("L1", melanoma, "500.01")) + prep("333", "Drei", pack("g4", "500"), limitation("L3", "Indikationscode: 99999.09")),
    }
    for i, (name, body) in enumerate(files.items()):
        f = top / name
        f.parent.mkdir(exist_ok=True)
        f.write_text(f'<?xml version="1.0" encoding="utf-8"?><Preparations ReleaseDate="0{i + 1}.01.2020">{body}</Preparations>', encoding="utf-8")
    return str(top)


def test_snapshot_files_are_numbered_in_order(spark, path):
    extracts, records = snapshots.read_snapshots(spark, path)
    assert [(r["extract_id"], r["file_name"], r["file_year"], r["release_date"]) for r in extracts.orderBy("extract_id").collect()] == [(1, "Preparations-20190101.xml", 2019, "01.01.2020"), (2, "Preparations-20200101.xml", 2020, "02.01.2020"), (3, "Preparations-20200201.xml", 2020, "03.01.2020")]
    assert records.count() == 5  # the record without a number is left out


def test_a_new_snapshot_is_merged_without_reading_the_old_ones(spark, path, tmp_path):
    import pathlib
    import shutil

    top, out = tmp_path / "s", str(tmp_path / "o")
    shutil.copytree(path, top)
    late = top / "2020/Preparations-20200201.xml"
    text = late.read_text(encoding="utf-8")
    late.unlink()
    first = plans.ingest_new(spark, str(top), out)
    assert first["extract"].count() == 2
    for f in pathlib.Path(top).rglob("*.xml"):
        f.write_text("no longer XML")
    late.write_text(text, encoding="utf-8")
    got, want = plans.ingest_new(spark, str(top), out), plans.ingest(spark, path, str(tmp_path / "w"))
    assert set(got) == set(want)
    for name, df in want.items():
        if name == "extract":
            assert sorted(map(tuple, got[name].select(df.columns).collect())) == sorted(map(tuple, df.collect()))
            continue
        # places in a file differ between the two ways of reading, values don't
        assert sorted(map(str, got[name].select(df.columns).collect())) == sorted(map(str, df.collect())), name
    again = plans.ingest_new(spark, str(top), out)
    assert {n: df.count() for n, df in again.items()} == {n: df.count() for n, df in want.items()}
    early = top / "2018/Preparations-20180101.xml"
    early.parent.mkdir()
    early.write_text(text, encoding="utf-8")
    with pytest.raises(ValueError):
        plans.ingest_new(spark, str(top), out)


def test_history_tables(ingested):
    got = ingested
    preps = {r["swissmedic_no5"]: (r["first_seen"], r["last_seen"], r["name_de"]) for r in got["preparation"].collect()}
    assert preps == {"111": (1, 3, "Neu"), "222": (2, 2, "Zwei"), "333": (3, 3, "Drei")}
    packs = {r["gtin"]: (r["first_seen"], r["last_seen"], r["public_price"]) for r in got["pack"].collect()}
    assert packs == {"g1": (1, 2, None), "g2": (2, 3, 10.5), "g3": (2, 2, 10.5), "g4": (3, 3, 10.5)}
    assert {r["gtin"]: r["public_price"] for r in got["sku"].collect()} == {"g1": 10.5, "g2": 10.5, "g3": 10.5, "g4": 10.5}
    first = got["pack"].filter("gtin = 'g2'").first()
    assert (first["flag_apd"], first["size_pack"], first["status_type_code"], first["public_price_valid_from"], first["swissmedic_no5"]) == ("N", "5", "0", "01.01.2020", "111")
    assert {(r["gtin"], r["partner_type"], r["description"], r["street"], r["phone"]) for r in got["partner"].collect()} == {(g, "V", "Firma", "Weg 1", "044") for g in ("g1", "g2", "g3", "g4")}
    # one text of two limitations once, texts of ITCODE limitations not at all
    assert {(r["limitation_code"], r["first_seen"], r["last_seen"]) for r in got["limitation_text"].collect()} == {("L1", 2, 3), (None, 2, 2), ("L3", 3, 3)}
    assert {(r["code_value"], r["code_source"], r["bag_dossier_no"], r["first_seen"], r["last_seen"]) for r in got["code"].collect()} == {("500.01", "STRUCTURED_XML", "500", 2, 3), ("800.xx", "FALLBACK_XX", "800", 2, 2), ("99999.09", "TEXT_PARSED", "500", 3, 3)}
    lims = sorted((r["swissmedic_no5"], r["limitation_code"] or "", r["limitation_level"], r["first_seen"], r["last_seen"]) for r in got["limitation"].collect())
    assert lims == [("111", "L1", "PREPARATION", 2, 3), ("222", "", "PACK", 2, 2), ("222", "L9", "ITCODE", 2, 2), ("333", "L3", "PREPARATION", 3, 3)]
    dated = history.resolve_dates(got["pack"], got["extract"], since="first_seen", until="last_seen").filter("gtin = 'g1'").first()
    assert (dated["since"], dated["until"]) == ("01.01.2020", "02.01.2020")


def test_codes_segments_and_links(ingested, tmp_path):
    t = ingested
    made = plans.indications(t, str(tmp_path))
    assert sorted((r["code_value"], r["code_source"]) for r in made["code"].collect()) == [("500.01", "STRUCTURED_XML"), ("800.xx", "FALLBACK_XX"), ("99999.09", "TEXT_PARSED")]
    segs = sorted(((r["indication_name_de"], r["segment_order"], r["matched_code_value"], r["matched_code_source"]) for r in made["segment"].collect()), key=str)
    # what the cascade finds is on the segments; Lunge is no lone segment of its limitation, as Melanom stands beside it
    assert segs == [("Lunge", 1, None, None), ("Melanom", 0, "500.01", "EXISTING"), ("Melanom", 0, "800.01", "NORMALIZED_CROSS")]
    assert made["match"].count() == 1
    assert [(r["code_value"], r["match_type"]) for r in made["match"].collect() if r["segment"].endswith("#0")] == [("800.01", "NORMALIZED_CROSS")]
    log = {(r["segment_name"], r["matched_code"], r["matched_to"]) for r in made["match_log"].collect() if r["match_type"] == "NORMALIZED_CROSS"}
    assert log == {("Melanom", "800.01", "ind_part .01 from 500.01")}
    listed = sorted((r["code_value"], r["gtin"], r["product_name"], r["effective_from"], r["effective_to"], r["code_first_seen"]) for r in plans.item_codes(t, made).collect())
    assert listed == [("500.01", "g1", "Neu", "02.01.2020", "02.01.2020", "02.01.2020"), ("800.xx", "g3", "Zwei", "02.01.2020", "02.01.2020", "02.01.2020"), ("99999.09", "g4", "Drei", "03.01.2020", "03.01.2020", "03.01.2020")]
    links = sorted((r["item"], r["indication_code"], r["valid_from"], r["valid_thru"]) for r in plans.item_links(t).collect())
    assert links == [("g1", "500.01", 2, 2), ("g2", "500.01", 2, 3), ("g3", "800.XX", 2, 2), ("g4", "99999.09", 3, 3)]


def test_group_sizes_count_segments_that_have_a_code(spark):
    """A limitation of two segments, one with a code already: the other is neither alone nor paired with the codes in order."""
    from lexhull.operators import matching

    segments = spark.createDataFrame([("a#1", "a", 1, "x", "1"), ("b#0", "b", 0, "y", "1"), ("c#0", "c", 0, "z", "1"), ("c#1", "c", 1, "w", "1"), ("d#1", "d", 1, "v", "1"), ("d#2", "d", 2, "u", "1")], "segment string, group string, position int, name string, dossier string")
    codes = spark.createDataFrame([("a", "1.01"), ("b", "1.02"), ("c", "1.04"), ("c", "1.03"), ("d", "1.05"), ("d", "1.06")], "group string, code_value string")
    known = spark.createDataFrame([], "name string, code_value string, dossier string")
    whole = segments.select("group").unionByName(spark.createDataFrame([("a",), ("d",)], "group string"))
    got = {r["segment"]: (r["code_value"], r["match_type"]) for r in matching.cascade(segments, known, codes, whole=whole).collect()}
    assert got == {"b#0": ("1.02", "SINGLE_SEGMENT_CODE"), "c#0": ("1.03", "ORDINAL_POSITION"), "c#1": ("1.04", "ORDINAL_POSITION")}


def test_from_rules_to_exports(spark, ingested, tmp_path):
    made = plans.indications(ingested, str(tmp_path / "i"))
    # a French text for a segment and for a limitation without any
    made["segment"] = made["segment"].withColumn("segment_text_fr", F.when(F.col("indication_name_de") == "Lunge", "Firma verse 12 francs par emballage, en association avec Neu."))
    made["limitation"] = made["limitation"].withColumn("description_fr", F.when(F.col("limitation_code") == "L3", "Example Pharma SA rembourse 5 % du prix."))
    got = plans.refund_exports(ingested, made, str(tmp_path / "x"))
    own = got["segment_refund"].collect()
    # the partner's name near a verb tells a refund that no detector sees
    assert [(r["detection_patterns"], r["cashback_company"], r["rule_calc_type"], r["rule_calc_value"]) for r in own] == [("fuzzy_company", "Firma", "chf_fixed", 12.0)]
    assert [(r["product_name"], r["indication_name_fr"], r["segment_order"]) for r in got["segment_rules"].collect()] == [("Zwei", None, 1)]
    assert [(r["product_name"], r["cashback_company"], r["rule_calc_value"]) for r in got["limitation_rules"].collect()] == [("Drei", "Example Pharma SA", 5.0)]
    assert {(r["indication_name_de"], r["bag_dossier_no"], r["n_segments"]) for r in got["unmatched_names"].collect()} == {("Lunge", "800", 1)}
    analysed = {(r["product_name"], r["indication_name_de"], r["gtin"], r["has_cashback"], r["pack_from"]) for r in got["refund_analysis"].collect()}
    assert analysed == {("Neu", "Melanom", "g1", 0, "01.01.2020"), ("Neu", "Melanom", "g2", 0, "02.01.2020"), ("Zwei", "Melanom", "g3", 0, "02.01.2020"), ("Zwei", "Lunge", "g3", 1, "02.01.2020")}
    assert {(r["limitation_code"], r["gtin"], r["has_cashback"]) for r in got["unsegmented_analysis"].collect()} == {("L3", "g4", 1)}


def test_packs_and_sinks(spark, ingested, tmp_path):
    out = plans.normalised_packs(ingested).select("gtin", "form_type", "container_count", "substance_qty", "total_substance")
    assert {tuple(r) for r in out.collect()} == {(g, "SYRINGE", 5, 20.0, 100.0) for g in ("g1", "g2", "g3", "g4")}
    tables.write_tables({"packs": out}, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/packs")).count() == 4
    tables.write_csv(out.withColumn("thresholds", F.array(F.lit(1))), str(tmp_path / "c"), sep=";", order=["gtin"])
    back = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "c"))
    assert back.columns[-1] == "thresholds_count" and back.count() == 4


def test_refund_rules_of_equal_texts_are_mined_once(spark):
    df = spark.createDataFrame([(1, "Example SA rembourse 5 francs."), (2, "Example SA rembourse 5 francs."), (3, "nichts")], "id int, t string")
    assert sorted((r["id"], r["rule_calc_value"]) for r in plans.refund_rules(df, "id", "t").collect()) == [(1, 5.0), (2, 5.0)]


def test_flags_of_limitation_texts(spark):
    texts = {"a": "L'assureur facture &agrave; la firme Roche Example AG le montant.", "b": "<b>x</b> Example SA rembourse 5 francs par mois.", "c": "nichts", "d": None}
    df = spark.createDataFrame([(k, None, "DIA", None, None, v, None, 1, 1) for k, v in texts.items()], "content_hash string, limitation_code string, limitation_type string, limitation_niveau string, description_de string, description_fr string, description_it string, first_seen int, last_seen int")
    got = {r["content_hash"]: r for r in plans.limitation_texts({"limitation_text": df}).collect()}
    flags = {k: (r["has_cashback"], r["is_cashback"], r["cashback_company"], r["cashback_patterns"], r["cashback_calc_type"], r["cashback_calc_value"], r["cashback_unit"]) for k, r in got.items()}
    # without a sentence there is no calculation, though the text is one with a refund
    assert flags == {"a": (1, True, "Roche Example AG", "assureur_facture", None, None, None), "b": (1, True, "Example SA", "company_rembourse", "chf_fixed", 5.0, "per_month"), "c": (0, False, None, None, None, None, None), "d": (0, False, None, None, None, None, None)}
