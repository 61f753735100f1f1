"""The pipelines that chain the operators, from snapshots to tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexhull.functions import text as tx
from lexhull.operators import codes as cd
from lexhull.operators import exports, matching, packs, refunds, reports
from lexhull.operators.history import merged_history, partial_history, told_history
from lexhull.operators.intervals import fan_out
from lexhull.sources import snapshots as src
from lexhull.sources.tables import stored


#: What tells limitations apart.
KEYS = ["swissmedic_no5", "limitation_code", "limitation_level", "content_hash"]


def coded_rows(lims: DataFrame, order: list[str], suffix: str = ".xx") -> DataFrame:
    """A limitation's codes as rows, at the first and the last snapshot in which it was as it is.

    What repeats over snapshots is gathered before texts are searched for codes.
    """
    texts = ["description_de", "description_fr", "description_it"]
    same = lims.groupBy(*KEYS, "limitation_type", "dossier", "given_codes", *texts).agg(F.min(F.struct("extract_id", *[c for c in order if c != "extract_id"])).alias("_at"), F.max("extract_id").alias("_last"))
    coded = cd.assign_codes(same, "given_codes", texts, "limitation_type", "dossier", suffix).withColumnRenamed("dossier", "bag_dossier_no")
    # the last place comes after all others of its snapshot; nothing but the snapshot is taken from it
    ends = F.array(F.struct(F.col("_at.extract_id").alias("extract_id"), F.col("_at").alias("place")), F.struct(F.col("_last").alias("extract_id"), F.lit(None).alias("place")))
    return coded.withColumn("_e", F.explode(ends)).select("*", "_e.extract_id", "_e.place").drop("_e", "_at", "_last")


def limitation_id() -> Column:
    return tx.content_hash(*[F.col(c) for c in KEYS])


def entities(records: DataFrame) -> dict[str, tuple[DataFrame, dict]]:
    """For each table of entities: the rows of some snapshots, and the arguments of their history."""
    order = ["extract_id", "pos"]
    prep, pack_rows, lims = src.preparations(records), src.packs(records), src.limitations(records)
    texts = ["description_de", "description_fr", "description_it"]
    attrs = ["limitation_type", "limitation_niveau", *texts, "valid_from_date", "valid_thru_date", "dossier", "given_codes"]
    subs, partners = src.substances(records), src.partners(pack_rows)
    rules = lambda keys, place, **how: {"keys": keys, "seen": "extract_id", "order": place, **how}
    return {
        "preparation": (prep, rules(["swissmedic_no5"], order, last=list(src.PREPARATION_TEXTS))),
        "pack": (pack_rows, rules(["gtin"], [*order, "n"], first=["swissmedic_no5"], last=[*src.PACK_TEXTS, *src.PACK_PRICES])),
        "sku": (pack_rows, rules(["gtin"], [*order, "n"], first=["swissmedic_no5", *src.PACK_TEXTS], last_non_null=src.PACK_PRICES)),
        "substance": (subs, rules(["swissmedic_no5", "description_la"], [*order, "n"], first=["quantity", "quantity_unit", "n"])),
        "partner": (partners, rules(["gtin", "partner_type", "description"], [*order, "n", "m"], first=["street", "zip_code", "place", "phone"])),
        "limitation": (lims, rules(KEYS, [*order, "limitation_level"], first=attrs)),
        "limitation_text": (lims.filter("limitation_level <> 'ITCODE'"), rules(["content_hash"], [*order, "limitation_level"], first=["limitation_code", "limitation_type", "limitation_niveau", *texts])),
        "code": (coded_rows(lims, [*order, "limitation_level"]), rules([*KEYS, "code_value"], ["extract_id", "missing", "place"], first=["code_source", "dossier_part", "indication_part", "bag_dossier_no"])),
    }


def partial_tables(records: DataFrame) -> dict[str, tuple[DataFrame, dict]]:
    out = {}
    for name, (rows, how) in entities(records).items():
        rows = rows.withColumn("missing", F.col("place").isNull()) if name == "code" else rows
        out[name] = (partial_history(rows, **how), {k: v for k, v in how.items() if k not in ("seen", "order")})
    return out


def ingest(spark: SparkSession, path: str, out: str) -> dict[str, DataFrame]:
    """Snapshot files to tables of entities with their history, keyed by natural keys.

    Each table is written under out and read back, so the XML is parsed here only.
    """
    extracts, records = src.read_snapshots(spark, path)
    tables = {"extract": extracts, **{name: told_history(partial, **how) for name, (partial, how) in partial_tables(records).items()}}
    return {name: stored(df, f"{out}/{name}") for name, df in tables.items()}


def ingest_new(spark: SparkSession, path: str, out: str) -> dict[str, DataFrame]:
    """The tables of ingest(), brought up to date: only snapshot files that have not been read yet are.

    Partial histories are stored under <out>/upto-<number of snapshots>, with the list of the files in them written last; so
    a run that fails leaves the state before in use. New files' histories are merged with the stored ones. A new file
    that comes before one already read would change the numbers of snapshots: that is an error, and asks for a rebuild with another out.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    done = hadoop(f"{out}/upto-*/extract/_SUCCESS")
    states = sorted(f.getPath().getParent().getParent().toString() for f in done.getFileSystem(conf).globStatus(done) or [])
    ledger = spark.read.parquet(f"{states[-1]}/extract") if states else None
    known = [] if ledger is None else sorted((r["extract_id"], r["file_year"], r["file_name"]) for r in ledger.select("extract_id", "file_year", "file_name").collect())  # one row a file
    files = src.snapshot_files(spark, path)
    if [(y, n) for _, y, n in known] != [(y, n) for y, n, _ in files[: len(known)]]:
        raise ValueError("the files already read are not the first ones under this path: rebuild")
    extracts, records = src.read_snapshots(spark, path, known=len(known))
    made, state = partial_tables(records), f"{out}/upto-{len(files):08d}"
    if len(known) < len(files):
        for name, (partial, how) in made.items():
            old = spark.read.parquet(f"{states[-1]}/{name}") if states else None
            (partial if old is None else merged_history(old, partial.select(*old.columns), how["keys"])).write.mode("overwrite").parquet(f"{state}/{name}")
        (extracts if ledger is None else ledger.unionByName(extracts)).write.mode("overwrite").parquet(f"{state}/extract")
    tables = {name: told_history(spark.read.parquet(f"{state}/{name}"), **how) for name, (_, how) in made.items()}
    return {"extract": spark.read.parquet(f"{state}/extract"), **tables}


def indications(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Codes, segments and matches of the limitations of ingest(); each stage is written under out, as several later ones read it."""
    lims = stored(cd.named_limitations(tables["limitation"]).withColumn("limitation_id", limitation_id()), f"{out}/named_limitation")
    codes = tables["code"].withColumn("limitation_id", limitation_id()).select("limitation_id", "swissmedic_no5", "code_value", "code_source", "bag_dossier_no", "first_seen", "last_seen")
    codes = stored(codes, f"{out}/first_code")
    names = stored(matching.name_code_map(lims, codes), f"{out}/name_map")
    codes = stored(matching.retro_map(codes, lims, names), f"{out}/mapped_code")
    segments = cd.segment_table(cd.mappable(lims), "limitation_id", {x: f"description_{x}" for x in ("de", "fr", "it")})
    segments, codes = matching.segment_map(stored(segments, f"{out}/first_segment"), codes, names)
    codes = stored(codes, f"{out}/code")
    segments = stored(matching.existing_map(segments, codes, names), f"{out}/segment")
    left = segments.filter("matched_code_value is null").join(lims.select("limitation_id", F.col("dossier")), "limitation_id")
    left = left.select(F.concat_ws("#", "limitation_id", "segment_order").alias("segment"), F.col("limitation_id").alias("group"), F.col("segment_order").alias("position"), F.col("indication_name_de").alias("name"), "dossier")
    known = names.select(F.col("indication_name_de").alias("name"), "code_value", F.col("bag_dossier_no").alias("dossier"))
    # groups are as large as they are, whatever has a code already
    matches = stored(matching.cascade(left, known, codes.select(F.col("limitation_id").alias("group"), "code_value"), whole=segments.select(F.col("limitation_id").alias("group"))), f"{out}/match")
    log = stored(matching.match_log(left, matches), f"{out}/match_log")
    found = matches.select(F.col("segment").alias("segment_id"), F.col("code_value").alias("_code"), F.col("match_type").alias("_type"))
    matched = segments.withColumn("segment_id", F.concat_ws("#", "limitation_id", "segment_order")).join(found, "segment_id", "left")
    matched = matched.withColumns({"matched_code_value": F.coalesce("matched_code_value", "_code"), "matched_code_source": F.coalesce("matched_code_source", "_type")}).drop("_code", "_type")
    return {"limitation": lims, "code": codes, "name_map": names, "segment": stored(matched, f"{out}/matched_segment"), "match": matches, "match_log": log}


def item_links(tables: dict[str, DataFrame]) -> DataFrame:
    """Product-level links carried to items for the time both are valid; ITCODE limitations take no part."""
    codes = tables["code"].filter("limitation_level <> 'ITCODE'")
    fallback = F.col("code_source") == "FALLBACK_XX"
    links = codes.select("swissmedic_no5", "limitation_level", F.when(fallback, F.concat("bag_dossier_no", F.lit(".XX"))).otherwise(F.col("code_value")).alias("indication_code"), "content_hash", "first_seen", "last_seen")
    items = tables["pack"].select("swissmedic_no5", F.col("gtin").alias("item"), "bag_dossier_no", "first_seen", "last_seen")
    return fan_out(links, items, "swissmedic_no5", keep=["content_hash"])


def item_codes(tables: dict[str, DataFrame], made: dict[str, DataFrame]) -> DataFrame:
    """The export of items x indications from the tables of ingest() and indications()."""
    key = {"swissmedic_no5": "preparation_id"}
    lims = made["limitation"].select("limitation_id", "limitation_code", "limitation_type", "limitation_level", *[f"indication_name_{x}" for x in ("de", "fr", "it")], F.col("description_de").alias("limitation_text"), F.col("valid_from_date").alias("limitation_valid_from"), F.col("valid_thru_date").alias("limitation_valid_thru"), "first_seen", "last_seen")
    preps = tables["preparation"].withColumnsRenamed(key).select("preparation_id", F.col("name_de").alias("product_name"), "atc_code")
    packs_ = tables["pack"].withColumnsRenamed(key).select("preparation_id", "gtin", "swissmedic_no8", "bag_dossier_no", F.col("description_de").alias("pack_desc"), "first_seen", "last_seen")
    return exports.item_indications(made["code"].withColumnsRenamed(key), lims, preps, packs_, tables["extract"])


def limitation_texts(tables: dict[str, DataFrame]) -> DataFrame:
    """The distinct limitation texts with what is mined from the French one."""
    return refunds.text_flags(tables["limitation_text"], "description_fr")


def refund_rules(texts: DataFrame, id_col: str, text_col: str, unescape: bool = False, preparations: DataFrame | None = None, companies: DataFrame | None = None) -> DataFrame:
    """Rules of each distinct text once, then carried to all ids that hold it. preparations and companies as in refunds.mine()."""
    text = tx.decode_entities(F.col(text_col)) if unescape else F.col(text_col)
    keyed = texts.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("hash", tx.content_hash(F.col("text")))
    unique = keyed.groupBy("hash").agg(F.first("text").alias("text"))
    return keyed.select("id", "hash").join(refunds.mine(unique, "hash", "text", preparations=preparations, companies=companies).withColumnRenamed("id", "hash"), "hash").drop("hash")


def refund_exports(tables: dict[str, DataFrame], made: dict[str, DataFrame], out: str, earlier: DataFrame | None = None) -> dict[str, DataFrame]:
    """From rules to exports: refunds of segments and of the limitations without any, and the tables for analysis.

    Companies are those of earlier refunds (cashback_company), if given, and the partners of packs; drugs are the preparations and
    substances there are. Each table is written under out.
    """
    key = {"swissmedic_no5": "preparation_id"}
    preps = tables["preparation"].withColumnsRenamed(key).select("preparation_id", "name_de")
    none = tables["partner"].select(F.lit(None).cast("string").alias("cashback_company")).limit(0)
    companies = stored(refunds.company_set(none if earlier is None else earlier, tables["partner"], partner="description"), f"{out}/company")
    drugs = stored(refunds.drug_set(tables["preparation"], tables["substance"]), f"{out}/drug")
    lims = made["limitation"].withColumnsRenamed(key).select("limitation_id", "preparation_id", "limitation_code", "limitation_type", "limitation_level", "description_fr", "first_seen", "last_seen")
    segments = made["segment"].join(lims.select("limitation_id", "preparation_id", "limitation_code", "first_seen", "last_seen"), "limitation_id").join(preps.withColumnRenamed("name_de", "product_name"), "preparation_id")
    pack_rows = tables["pack"].withColumnsRenamed(key).select("preparation_id", "gtin", "bag_dossier_no", "first_seen", "last_seen")
    told = {"preparations": drugs, "companies": companies}
    own = stored(refund_rules(segments.filter("segment_text_fr is not null"), "segment_id", "segment_text_fr", **told).withColumnRenamed("id", "segment_id"), f"{out}/segment_refund")
    bare = lims.join(segments.select("limitation_id").distinct(), "limitation_id", "left_anti").filter("description_fr is not null")
    rest = stored(refund_rules(bare, "limitation_id", "description_fr", **told).withColumnRenamed("id", "limitation_id"), f"{out}/limitation_refund")
    exported = {
        "unmatched_names": reports.unmatched_names(segments, pack_rows),
        "segment_rules": exports.segment_rules(own, segments),
        "limitation_rules": exports.limitation_rules(rest, lims, preps),
        "refund_analysis": exports.refund_analysis(segments, pack_rows, own, tables["extract"]),
        "unsegmented_analysis": exports.unsegmented_analysis(lims, segments, pack_rows, rest, tables["extract"]),
    }
    return {"segment_refund": own, "limitation_refund": rest, **{name: stored(df, f"{out}/{name}") for name, df in exported.items()}}


def normalised_packs(tables: dict[str, DataFrame]) -> DataFrame:
    subs = tables["substance"].select(F.col("swissmedic_no5").alias("preparation_id"), F.struct("first_seen", "n").alias("substance_id"), "description_la", "quantity", "quantity_unit")
    return packs.normalise_packs(tables["pack"].withColumnRenamed("swissmedic_no5", "preparation_id"), subs)
