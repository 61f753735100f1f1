"""Nested XML snapshots of a product list, read by Spark's own XML source."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexhull.functions import text as tx
from lexhull.operators.codes import structured_codes


def record(names: str, **nested: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()] + [T.StructField(n, t) for n, t in nested.items()])


def listed(outer: str, inner: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(outer, T.ArrayType(inner))])


# The elements of a snapshot.
CODE = record("_Code _VALUE")
LIMITATIONS = listed("Limitation", record("LimitationCode LimitationType LimitationNiveau DescriptionDe DescriptionFr DescriptionIt ValidFromDate ValidThruDate", IndicationsCodes=listed("IndicationsCode", CODE), PmIndications=listed("PmIndication", CODE)))
PRICE = record("Price ValidFromDate")
PACK = record(
    "GTIN SwissmedicNo8 BagDossierNo DescriptionDe DescriptionFr DescriptionIt SwissmedicCategory FlagNarcosis FlagModal FlagGGSL SizePack PrevGTINcode SwissmedicNo8ParallelImp WholesaleMarginGrp UniformWholesaleMargin",
    Prices=T.StructType([T.StructField("PublicPrice", PRICE), T.StructField("ExFactoryPrice", PRICE)]),
    Status=record("IntegrationDate ValidFromDate ValidThruDate StatusTypeCodeSl StatusTypeDescriptionSl FlagApd"),
    Partners=listed("Partner", record("PartnerType Description Street ZipCode Place Phone")), Limitations=LIMITATIONS,
)
PREPARATION = record(
    "NameDe NameFr NameIt DescriptionDe DescriptionFr DescriptionIt SwissmedicNo5 AtcCode OrgGenCode FlagItLimitation FlagSB FlagGGSL CommentDe CommentFr CommentIt VatInEXF",
    Substances=listed("Substance", record("DescriptionLa Quantity QuantityUnit")), Packs=listed("Pack", PACK), Limitations=LIMITATIONS,
    ItCodes=listed("ItCode", T.StructType([T.StructField("Limitations", LIMITATIONS)])),
)


def snapshot_files(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(year, name, place) of all snapshot files <path>/<year>/Preparations-*.xml, in order; they are listed, not read."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/[0-9][0-9][0-9][0-9]/Preparations-*.xml")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    places = [f.getPath() for f in found]
    return sorted((int(p.getParent().getName()), p.getName(), p.toString()) for p in places)


def read_snapshots(spark: SparkSession, path: str, known: int = 0) -> tuple[DataFrame, DataFrame]:
    """(extracts, preparations) of the snapshot files under a path, without the `known` first ones, which aren't read.

    extracts: extract_id int, file_name, file_year int, release_date; ids number the files in order of
    year folder and name. preparations: one row per record with a number, its extract_id and pos, its
    place in the file.
    """
    files = snapshot_files(spark, path)
    numbered = [(i + 1, name, year) for i, (year, name, _) in enumerate(files)][known:]
    ids = spark.createDataFrame(numbered, "extract_id int, file_name string, file_year int")
    places = [place for _, _, place in files[known:]]
    if not places:
        return ids.withColumn("release_date", F.lit(None).cast("string")), spark.createDataFrame([], T.StructType([*T.StructType.fromDDL("file_name string, file_year int").fields, *PREPARATION.fields, *T.StructType.fromDDL("pos long, extract_id int").fields]))
    where = [F.col("_metadata.file_name").alias("file_name"), F.regexp_extract("_metadata.file_path", r"/(\d{4})/[^/]*$", 1).cast("int").alias("file_year")]
    heads = spark.read.format("xml").option("rowTag", "Preparations").schema(record("_ReleaseDate")).load(places).select(*where, F.col("_ReleaseDate").alias("release_date")).distinct()
    extracts = heads.join(F.broadcast(ids), ["file_name", "file_year"]).select("extract_id", "file_name", "file_year", "release_date")
    rows = spark.read.format("xml").option("rowTag", "Preparation").schema(PREPARATION).load(places).select("*", *where, F.monotonically_increasing_id().alias("pos"))
    rows = rows.filter(tx.filled(F.col("SwissmedicNo5")).isNotNull())
    return extracts, rows.join(F.broadcast(ids), ["file_name", "file_year"])


#: Columns of packs and preparations by the element they come from.
PACK_TEXTS = {
    "swissmedic_no8": "SwissmedicNo8", "bag_dossier_no": "BagDossierNo", "description_de": "DescriptionDe", "description_fr": "DescriptionFr", "description_it": "DescriptionIt",
    "swissmedic_category": "SwissmedicCategory", "flag_narcosis": "FlagNarcosis", "flag_modal": "FlagModal", "flag_ggsl": "FlagGGSL", "size_pack": "SizePack",
    "prev_gtin_code": "PrevGTINcode", "swissmedic_no8_parallel_imp": "SwissmedicNo8ParallelImp", "wholesale_margin_grp": "WholesaleMarginGrp", "uniform_wholesale_margin": "UniformWholesaleMargin",
    "integration_date": "Status.IntegrationDate", "valid_from_date": "Status.ValidFromDate", "valid_thru_date": "Status.ValidThruDate", "status_type_code": "Status.StatusTypeCodeSl",
    "status_type_desc": "Status.StatusTypeDescriptionSl", "flag_apd": "Status.FlagApd",
}
PACK_PRICES = ["public_price", "public_price_valid_from", "exfactory_price", "exfactory_price_valid_from"]
PREPARATION_TEXTS = {
    "name_de": "NameDe", "name_fr": "NameFr", "name_it": "NameIt", "description_de": "DescriptionDe", "description_fr": "DescriptionFr", "description_it": "DescriptionIt",
    "atc_code": "AtcCode", "org_gen_code": "OrgGenCode", "flag_it_limitation": "FlagItLimitation", "flag_sb": "FlagSB", "flag_ggsl": "FlagGGSL",
    "comment_de": "CommentDe", "comment_fr": "CommentFr", "comment_it": "CommentIt", "vat_in_exf": "VatInEXF",
}
PARTNER_TEXTS = {"partner_type": "PartnerType", "description": "Description", "street": "Street", "zip_code": "ZipCode", "place": "Place", "phone": "Phone"}


def preparations(records: DataFrame) -> DataFrame:
    """One row per product and snapshot."""
    return records.select("extract_id", "pos", tx.filled(F.col("SwissmedicNo5")).alias("swissmedic_no5"), *[tx.filled(F.col(e)).alias(c) for c, e in PREPARATION_TEXTS.items()])


def price(column: str) -> tuple[Column, Column]:
    """(price, date): a price that can't be read is null, its date stays."""
    return tx.to_number(tx.strip(F.col(f"{column}.Price"))), tx.filled(F.col(f"{column}.ValidFromDate"))


def packs(preparations: DataFrame, with_gtin: bool = True) -> DataFrame:
    """One row per pack and snapshot."""
    p = preparations.select("extract_id", "pos", tx.filled(F.col("SwissmedicNo5")).alias("swissmedic_no5"), F.posexplode("Packs.Pack").alias("n", "p"))
    public, public_date = price("p.Prices.PublicPrice")
    factory, factory_date = price("p.Prices.ExFactoryPrice")
    out = p.select(
        "extract_id", "pos", "n", "swissmedic_no5", tx.filled(F.col("p.GTIN")).alias("gtin"), *[tx.filled(F.col(f"p.{e}")).alias(c) for c, e in PACK_TEXTS.items()],
        *[e.alias(c) for c, e in zip(PACK_PRICES, (public, public_date, factory, factory_date))], F.col("p.Partners.Partner").alias("partners"),
    )
    return out.filter(F.col("gtin").isNotNull()) if with_gtin else out


def partners(pack_rows: DataFrame) -> DataFrame:
    p = pack_rows.select("extract_id", "pos", "n", "gtin", F.posexplode("partners").alias("m", "p"))
    return p.select("extract_id", "pos", "n", "m", "gtin", *[tx.filled(F.col(f"p.{e}")).alias(c) for c, e in PARTNER_TEXTS.items()])


def substances(preparations: DataFrame, first_only: bool = False) -> DataFrame:
    p = preparations.select("extract_id", "pos", tx.filled(F.col("SwissmedicNo5")).alias("swissmedic_no5"), F.posexplode("Substances.Substance").alias("n", "s"))
    p = p.filter("n = 0") if first_only else p
    return p.select("extract_id", "pos", "n", "swissmedic_no5", tx.filled(F.col("s.DescriptionLa")).alias("description_la"), tx.filled(F.col("s.Quantity")).alias("quantity"), tx.filled(F.col("s.QuantityUnit")).alias("quantity_unit"))


def limitations(preparations: DataFrame) -> DataFrame:
    """One row per limitation, level (PACK, PREPARATION, ITCODE) and snapshot, with the dossier to fall back on.

    A pack's limitations fall back on its own dossier, the others on the first dossier of any pack of
    the record, in order.
    """
    no = tx.filled(F.col("SwissmedicNo5")).alias("swissmedic_no5")
    dossiers = F.filter(F.transform("Packs.Pack", lambda p: tx.filled(p["BagDossierNo"])), lambda d: d.isNotNull())
    base = preparations.select("extract_id", "pos", no, F.get(dossiers, F.lit(0)).alias("dossier"), "Packs", "Limitations", "ItCodes")
    keep = ["extract_id", "pos", "swissmedic_no5"]
    pack = base.select(*keep, F.posexplode("Packs.Pack").alias("n", "p")).select(*keep, tx.filled(F.col("p.BagDossierNo")).alias("dossier"), F.explode("p.Limitations.Limitation").alias("l")).withColumn("limitation_level", F.lit("PACK"))
    prep = base.select(*keep, "dossier", F.explode("Limitations.Limitation").alias("l")).withColumn("limitation_level", F.lit("PREPARATION"))
    it = base.select(*keep, "dossier", F.explode("ItCodes.ItCode").alias("i")).select(*keep, "dossier", F.explode("i.Limitations.Limitation").alias("l")).withColumn("limitation_level", F.lit("ITCODE"))
    rows = pack.unionByName(prep).unionByName(it)
    codes = structured_codes(F.transform("l.IndicationsCodes.IndicationsCode", lambda c: c["_Code"]), F.transform("l.PmIndications.PmIndication", lambda c: c["_Code"]))
    texts = [tx.filled(F.col(f"l.Description{x}")).alias(f"description_{x.lower()}") for x in ("De", "Fr", "It")]
    out = rows.select(
        *keep, "limitation_level", "dossier", tx.filled(F.col("l.LimitationCode")).alias("limitation_code"), tx.filled(F.col("l.LimitationType")).alias("limitation_type"),
        tx.filled(F.col("l.LimitationNiveau")).alias("limitation_niveau"), *texts, tx.filled(F.col("l.ValidFromDate")).alias("valid_from_date"), tx.filled(F.col("l.ValidThruDate")).alias("valid_thru_date"), codes.alias("given_codes"),
    )
    return out.withColumn("content_hash", tx.content_hash(F.col("description_de"), F.col("description_fr"), F.col("description_it")))
