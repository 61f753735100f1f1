"""One query per operator on the star-schema and text tables, with its DuckDB twin.

Where the tables lack texts of the domain, both sides build them from the same keys: the query runs
the operator over the text, the twin mostly works out the answer from the keys themselves.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexhull.functions import text as tx
from lexhull.operators import codes as cd
from lexhull.operators import exports, history, intervals, matching, packs, refunds, replies, reports
from lexhull.rules import names as name_rules
from lexhull.rules import refunds as rules
from lexhull.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> str:
    """Days since 1970, in Spark."""
    return f"cast(datediff(to_date({column}), date'1970-01-01') as bigint)"


DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)) AS BIGINT)"


@query(f"""
WITH e AS (SELECT *, {DAY.format('ts')} AS seen, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS l FROM events)
SELECT user_id, event_type, min(seen) AS first_seen, max(seen) AS last_seen, max(CASE WHEN r = 1 THEN event_id END) AS event_id,
       max(CASE WHEN l = 1 THEN value END) AS value, max(CASE WHEN l = 1 THEN props END) AS props
FROM e GROUP BY user_id, event_type""")
def history_hull(spark, d):
    e = table(spark, d, "events").withColumn("seen", F.expr(day("ts")))
    return history.snapshot_history(e, ["user_id", "event_type"], "seen", ["ts", "event_id"], first=["event_id"], last=["value", "props"])


@query(f"""
WITH e AS (SELECT user_id, event_type, ts, event_id, {DAY.format('ts')} AS seen, CASE WHEN event_id % 3 <> 0 THEN value END AS price FROM events),
p AS (SELECT user_id, event_type, price FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS l FROM e WHERE price IS NOT NULL) WHERE l = 1),
f AS (SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM e) WHERE r = 1)
SELECT h.user_id, h.event_type, first_seen, last_seen, f.event_id, p.price
FROM (SELECT user_id, event_type, min(seen) AS first_seen, max(seen) AS last_seen FROM e GROUP BY ALL) h
JOIN f USING (user_id, event_type) LEFT JOIN p USING (user_id, event_type)""")
def history_first_write_last_nonnull(spark, d):
    e = table(spark, d, "events").withColumn("seen", F.expr(day("ts"))).withColumn("price", F.expr("case when event_id % 3 <> 0 then value end"))
    return history.snapshot_history(e, ["user_id", "event_type"], "seen", ["ts", "event_id"], first=["event_id"], last_non_null=["price"])


@query(f"""
WITH e AS (SELECT *, {DAY.format('ts')} AS seen, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS l,
           row_number() OVER (PARTITION BY user_id, event_id % 3 <> 0 ORDER BY ts DESC, event_id DESC) AS k FROM events)
SELECT user_id, min(seen) AS first_seen, max(seen) AS last_seen, max(CASE WHEN r = 1 THEN event_type END) AS event_type, max(CASE WHEN l = 1 THEN props END) AS props,
       max(CASE WHEN k = 1 AND event_id % 3 <> 0 THEN value END) AS price
FROM e GROUP BY user_id""")
def history_merged_parts(spark, d):
    e = table(spark, d, "events").withColumn("seen", F.expr(day("ts"))).withColumn("price", F.expr("case when event_id % 3 <> 0 then value end"))
    how = {"first": ["event_type"], "last": ["props"], "last_non_null": ["price"]}
    # three parts, as if the events of each had been read at another time
    old, new, late = (history.partial_history(e.filter(f"event_id % 3 = {k}"), ["user_id"], "seen", ["ts", "event_id"], **how) for k in range(3))
    return history.told_history(history.merged_history(history.merged_history(old, new, ["user_id"]), late, ["user_id"]), ["user_id"], **how)


@query("""
SELECT md5(coalesce(text, '') || '|' || coalesce(lang, '') || '|') AS content_hash, min(doc_id) AS first_seen, max(doc_id) AS last_seen, count(*) AS n
FROM documents GROUP BY 1""")
def content_hash_dedup(spark, d):
    docs = table(spark, d, "documents").withColumn("content_hash", tx.content_hash(F.col("text"), F.col("lang"), F.lit(None)))
    return docs.groupBy("content_hash").agg(F.min("doc_id").alias("first_seen"), F.max("doc_id").alias("last_seen"), F.count("*").alias("n"))


def customer_hulls(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Time spans of each customer's orders, and of each order's lines."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.expr(day("o_orderdate")).alias("seen"))
    own = history.snapshot_history(orders, ["o_custkey", "o_orderpriority"], "seen", ["seen", "o_orderkey"])
    lines = table(spark, d, "lineitem").select("l_orderkey", F.expr(day("l_shipdate")).alias("seen")).groupBy("l_orderkey").agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))
    return own, lines.join(history.grows(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")), "l_orderkey")


HULLS = f"""
o AS (SELECT o_custkey, o_orderpriority, min({DAY.format('o_orderdate')}) AS first_seen, max({DAY.format('o_orderdate')}) AS last_seen FROM orders GROUP BY 1, 2),
l AS (SELECT l_orderkey, any_value(o_custkey) AS o_custkey, min({DAY.format('l_shipdate')}) AS first_seen, max({DAY.format('l_shipdate')}) AS last_seen
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)"""


@query(f"""
WITH {HULLS}
SELECT o.o_custkey, o.o_orderpriority, l.l_orderkey, o.first_seen, o.last_seen,
       CASE WHEN l.first_seen IS NOT NULL THEN greatest(o.first_seen, l.first_seen) END AS valid_from,
       CASE WHEN l.last_seen IS NOT NULL THEN least(o.last_seen, l.last_seen) END AS valid_thru
FROM o LEFT JOIN l ON o.o_custkey = l.o_custkey AND o.first_seen <= l.last_seen AND o.last_seen >= l.first_seen""")
def overlap_left_join(spark, d):
    own, lines = customer_hulls(spark, d)
    return intervals.overlap_join(own, lines, ["o_custkey"]).select("o_custkey", "o_orderpriority", "l_orderkey", "first_seen", "last_seen", "valid_from", "valid_thru")


@query(f"""
WITH {HULLS}
SELECT o.o_custkey, o.o_orderpriority, l.l_orderkey, o.first_seen, o.last_seen, CASE WHEN l.first_seen IS NOT NULL THEN greatest(o.first_seen, l.first_seen) END AS valid_from, CASE WHEN l.last_seen IS NOT NULL THEN least(o.last_seen, l.last_seen) END AS valid_thru
FROM o LEFT JOIN l ON o.o_custkey = l.o_custkey AND o.first_seen <= l.last_seen AND o.last_seen >= l.first_seen""")
def overlap_by_buckets(spark, d):
    own, lines = customer_hulls(spark, d)
    out = intervals.bucket_join(own, lines, ["o_custkey"], 120, "left", row=["o_custkey", "o_orderpriority"])
    return out.select("o_custkey", "o_orderpriority", "l_orderkey", "first_seen", "last_seen", "valid_from", "valid_thru")


@query(f"""
WITH {HULLS},
links AS (SELECT o_custkey, CASE WHEN o_orderpriority < '3' THEN 'PACK' ELSE 'PREPARATION' END AS limitation_level,
          CAST(o_custkey % 7 AS VARCHAR) || '.' || substr(o_orderpriority, 1, 1) AS indication_code, first_seen, last_seen FROM o),
met AS (SELECT l.l_orderkey AS item, indication_code, limitation_level, greatest(k.first_seen, l.first_seen) AS valid_from, least(k.last_seen, l.last_seen) AS valid_thru
        FROM links k JOIN l ON k.o_custkey = l.o_custkey AND k.first_seen <= l.last_seen AND k.last_seen >= l.first_seen
        WHERE limitation_level <> 'PACK' OR CAST(l.l_orderkey % 7 AS VARCHAR) = split_part(indication_code, '.', 1))
SELECT item, indication_code, limitation_level, valid_from, valid_thru
FROM (SELECT *, row_number() OVER (PARTITION BY item, indication_code ORDER BY limitation_level, valid_from, valid_thru) AS r FROM met) WHERE r = 1""")
def fan_out_links(spark, d):
    own, lines = customer_hulls(spark, d)
    links = own.select("o_custkey", F.expr("case when o_orderpriority < '3' then 'PACK' else 'PREPARATION' end").alias("limitation_level"), F.expr("concat(o_custkey % 7, '.', substr(o_orderpriority, 1, 1))").alias("indication_code"), "first_seen", "last_seen")
    items = lines.select("o_custkey", F.col("l_orderkey").alias("item"), F.expr("cast(l_orderkey % 7 as string)").alias("bag_dossier_no"), "first_seen", "last_seen")
    return intervals.fan_out(links, items, "o_custkey")


@query("""
SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN
(SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) l ON l_orderkey = o_orderkey AND r = 1""")
def first_child_per_parent(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    first = history.first_per_key(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return table(spark, d, "orders").select("o_orderkey").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_partkey", "l_quantity")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority <= '3')")
def unmapped_anti(spark, d):
    links = table(spark, d, "customer").select("c_custkey")
    return reports.codes_without_names(links, table(spark, d, "orders").filter("o_orderpriority <= '3'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) >= 5)")
def having_semi(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return orders.join(reports.keys_having(orders, "o_custkey", distinct="o_orderpriority", least=5), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


CODED = "concat(cast(l_partkey % 500 as string), '.', case when l_linenumber = 1 then 'xx' when l_linenumber = 2 then 'XX' else cast(l_linenumber + 10 as string) end)"
SQL_CODED = "CAST(l_partkey % 500 AS VARCHAR) || '.' || CASE WHEN l_linenumber = 1 THEN 'xx' WHEN l_linenumber = 2 THEN 'XX' ELSE CAST(l_linenumber + 10 AS VARCHAR) END"


@query(f"""
SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'FALLBACK' WHEN code ILIKE '%.xx' THEN 'CROSS_INDICATION' ELSE 'REAL_CODE' END AS code_type,
       count(*) AS n_rows, count(DISTINCT code) AS n_codes, count(DISTINCT l_orderkey) AS n_entities
FROM (SELECT *, {SQL_CODED} AS code FROM lineitem) GROUP BY 1""")
def code_type_summary(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", F.expr(CODED).alias("indication_code"), F.expr("l_suppkey % 5 = 0").alias("is_fallback"))
    return reports.code_summary(lines, entity="l_orderkey")


@query("""
WITH o AS (SELECT o_orderkey, lpad(CAST(o_custkey % 90000 AS VARCHAR), 5, '0') AS dossier, lpad(CAST(o_orderkey % 90 AS VARCHAR), 2, '0') AS part, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, dossier || '.' || CASE WHEN k = 2 THEN 'xx' ELSE part END AS code_value,
       CASE k WHEN 0 THEN 'STRUCTURED_XML' WHEN 1 THEN 'TEXT_PARSED' ELSE 'FALLBACK_XX' END AS code_source, dossier AS dossier_part, CASE WHEN k = 2 THEN 'xx' ELSE part END AS indication_part
FROM o WHERE k < 3""")
def codes_three_layer(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "lpad(cast(o_custkey % 90000 as string), 5, '0') as dossier", "lpad(cast(o_orderkey % 90 as string), 2, '0') as part", "o_orderkey % 4 as k")
    o = o.selectExpr(
        "o_orderkey", "dossier", "case when k < 3 then 'DIA' else 'OTHER' end as kind", "case when k = 0 then array(concat(dossier, '.', part)) end as given",
        # a text names its code in one of seven ways, three German, two French, two Italian
        "case when k < 2 and o_orderkey div 4 % 7 < 3 then concat(element_at(array('Der Indikationscode ist: ', 'Dieser Code ist dem Krankenversicherer zu melden: ', 'Code zu &uuml;bermitteln ist: '), cast(o_orderkey div 4 % 7 + 1 as int)), dossier, '.', part, '. Ende') else 'Kein Code' end as de",
        "case when k < 2 and o_orderkey div 4 % 7 in (3, 4) then concat(case o_orderkey div 4 % 7 when 3 then 'le code d''indication suivant: ' else 'le code correspondant est&nbsp;: ' end, dossier, '.', part) end as fr",
        "case when k < 2 and o_orderkey div 4 % 7 > 4 then concat(case o_orderkey div 4 % 7 when 5 then 'il codice seguente: ' else 'All''assicuratore malattie: ' end, dossier, '.', part) end as it",
    )
    return cd.assign_codes(o, "given", ["de", "fr", "it"], "kind", "dossier").select("o_orderkey", "code_value", "code_source", "dossier_part", "indication_part")


HEADED = "concat('<b>', {}, '</b>', ' text of ', {}, ' with <b>inline</b> stress<br>', '<br>\n', '<b>UND</b> more<br/>', '<b>', {}, '</b>: body ', cast(p_size as string))"


def headed(p: str, q: str, r: str) -> str:
    return HEADED.format(p, q, r)


@query("""
SELECT p_partkey, CAST(s AS INTEGER) AS segment_order, CASE WHEN s = 0 THEN p_name ELSE p_brand END AS indication_name_de,
       CASE WHEN s = 0 THEN 'text of ' || p_type || ' with <b>inline</b> stress' ELSE ': body ' || CAST(p_size AS VARCHAR) END AS segment_text_de
FROM part, (SELECT unnest([0, 1]) AS s)""")
def segment_split(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr(headed("p_name", "p_type", "p_brand")).alias("de"))
    return cd.segment_table(p, "p_partkey", {"de": "de"}).select("p_partkey", "segment_order", "indication_name_de", "segment_text_de")


@query("""
SELECT p_partkey, CAST(s AS INTEGER) AS segment_order, CASE WHEN s = 0 THEN p_name ELSE p_brand END AS indication_name_fr, CASE s WHEN 0 THEN p_type END AS indication_name_de
FROM part, (SELECT unnest([0, 2]) AS s)""")
def segment_split_by_french_names(spark, d):
    """Headings are judged by the French name, and orders keep the place in the text."""
    texts = table(spark, d, "part").select("p_partkey", F.expr(headed("p_name", "p_type", "p_brand")).alias("fr"), F.expr("concat('<b>', p_type, '</b> x')").alias("de"))
    out = cd.segment_table(texts, "p_partkey", {"de": "de", "fr": "fr"}, renumber=False, name_by=["fr", "de"])
    return out.select("p_partkey", "segment_order", "indication_name_fr", "indication_name_de")


@query("""
SELECT p_partkey, CAST(s AS INTEGER) AS segment_order,
       CASE s WHEN 0 THEN p_name WHEN 1 THEN 'UND' ELSE p_brand END AS name_de, CASE WHEN s = 0 THEN p_type END AS name_fr, CASE s WHEN 0 THEN p_brand WHEN 1 THEN p_type END AS name_it
FROM part, (SELECT unnest([0, 1, 2]) AS s)""")
def align_three(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr(headed("p_name", "p_type", "p_brand")).alias("de"), F.expr("concat('<b>', p_type, '</b> un texte')").alias("fr"), F.expr("concat('<b>', p_brand, '</b> un testo<br><br>\n<b>', p_type, '</b> un altro')").alias("it"))
    out = p.select("p_partkey", F.posexplode(tx.aligned(*[tx.segments(F.col(x)).alias(x) for x in ("de", "fr", "it")])).alias("segment_order", "s"))
    return out.select("p_partkey", "segment_order", *[F.col(f"s.{x}.name").alias(f"name_{x}") for x in ("de", "fr", "it")])


@query("SELECT p_partkey, p_name || ' | inline | UND | ' || p_brand AS names, CASE WHEN p_size % 2 = 0 THEN p_type END AS other FROM part")
def bold_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", tx.bold_names(F.expr(headed("p_name", "p_type", "p_brand"))).alias("names"), tx.bold_names(F.expr("case when p_size % 2 = 0 then concat('x <b>', p_type, '</b> y') else 'plain' end")).alias("other"))


@query(r"""
SELECT page_id,
  trim(regexp_replace(regexp_replace(regexp_replace(html, '<br/?>|&nbsp;', ' ', 'g'), '</?[bu]>', '', 'g'), '\s+', ' ', 'g')) AS cleaned,
  trim(regexp_replace(translate(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<br\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g'),
    '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), chr(10) || chr(13), '  '), ' {2,}', ' ', 'g')) AS exported
FROM pages""")
def html_clean(spark, d):
    return table(spark, d, "pages").select("page_id", tx.clean_markup(F.col("html")).alias("cleaned"), tx.clean_export(F.col("html")).alias("exported"))


@query(r"""
WITH c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '<br/?>|&nbsp;', ' ', 'g'), '</?[bu]>', '', 'g'), '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN strpos(t, '.') > 1 AND strpos(t, '.') <= 120 THEN trim(substr(t, 1, strpos(t, '.'))) ELSE trim(substr(t, 1, 120)) || CASE WHEN length(t) > 120 THEN '...' ELSE '' END END AS head FROM c""")
def first_sentence_120(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.first_sentence(tx.clean_markup(F.col("text"))).alias("head"))


@query("""
SELECT p_partkey, p_name || ' x' AS plain, 'LENALIDOMID ' || p_brand AS canonical, 'REVLIMID in Kombination mit ' || p_type AS rewritten FROM part""")
def name_normalise_brand(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", tx.normalised(F.expr("concat('  ', p_name, '  \t x :: ')")).alias("plain"), tx.canonical_brands(F.expr("concat('REVLIMID ', p_brand)")).alias("canonical"),
        tx.combination_rewritten(F.expr("concat('Kombination REVLIMID, ', p_type)")).alias("rewritten"),
    )


#: The shapes by part number; a is 1 to 9, b the part's size.
PACK = "case p_partkey % 8 when 0 then concat('Blist ', a, ' x ', b, ' Stk') when 1 then concat(a, ' x ', b, ' Fertspr') when 2 then concat(a, ' Amp ', b, '.5 ml') when 3 then concat('Durchstf ', b, ' Stk.') when 4 then concat('Tb ', b, ' g (alt)') when 5 then concat(b, ' Stk (', a, 'x 10 Stk) (Muster)') when 6 then concat('Dosierspr ', b, ' Dosen') else concat('no pack ', b) end"


def described(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").selectExpr("p_partkey", "p_name", "p_size", "cast(p_partkey % 9 + 1 as string) as a", "cast(p_size as string) as b")
    return p.select("p_partkey", "p_name", F.expr(PACK).alias("description_de"))


PACK_SQL = """
p AS (SELECT p_partkey, p_partkey % 8 AS k, CAST(p_partkey % 9 + 1 AS INTEGER) AS a, p_size AS b FROM part),
parsed AS (
SELECT p_partkey, k,
  CASE k WHEN 0 THEN 'BLISTER' WHEN 1 THEN 'SYRINGE' WHEN 2 THEN 'AMPOULE' WHEN 3 THEN 'VIAL' WHEN 4 THEN 'TUBE' WHEN 6 THEN 'METERED_SYRINGE' END AS form_type,
  CAST(CASE k WHEN 1 THEN b WHEN 2 THEN a WHEN 3 THEN b WHEN 4 THEN 1 WHEN 6 THEN 1 END AS INTEGER) AS container_count,
  CAST(CASE k WHEN 0 THEN b WHEN 3 THEN b WHEN 5 THEN b END AS INTEGER) AS unit_count,
  CAST(CASE k WHEN 2 THEN b + 0.5 WHEN 4 THEN b END AS DOUBLE) AS volume_per_unit, CASE k WHEN 2 THEN 'ml' WHEN 4 THEN 'g' END AS volume_unit,
  CAST(CASE k WHEN 2 THEN a * (b + 0.5) WHEN 4 THEN b END AS DOUBLE) AS total_volume, CAST(CASE k WHEN 6 THEN b END AS INTEGER) AS dose_count,
  CAST(CASE WHEN k IN (0, 1) THEN a END AS INTEGER) AS multiplier,
  CAST(CASE k WHEN 0 THEN a * b WHEN 1 THEN a * b WHEN 2 THEN a WHEN 3 THEN b WHEN 4 THEN 1 WHEN 5 THEN b WHEN 6 THEN 1 END AS INTEGER) AS total_units,
  CASE WHEN k = 4 THEN 1 ELSE 0 END AS is_alt, CASE WHEN k = 5 THEN 'Muster' END AS annotation,
  CASE k WHEN 1 THEN 'MEDIUM' WHEN 7 THEN 'LOW' ELSE 'HIGH' END AS parse_confidence,
  CASE k WHEN 0 THEN 'P1B_FORM_MULT' WHEN 1 THEN 'P8B_MULT_FORM_BARE' WHEN 2 THEN 'P4_N_FORM_VOL' WHEN 3 THEN 'P5_FORM_STK' WHEN 4 THEN 'P6_FORM_VOL'
         WHEN 5 THEN 'P9_SIMPLE' WHEN 6 THEN 'P7_FORM_DOS' ELSE 'UNMATCHED' END AS parse_pattern FROM p)"""


@query(f"WITH {PACK_SQL} SELECT * EXCLUDE (k) FROM parsed")
def pack_parse(spark, d):
    p = described(spark, d).select("p_partkey", packs.parse_packs(F.col("description_de")).alias("p"))
    return p.select("p_partkey", *[f"p.{c}" for c in "form_type container_count unit_count volume_per_unit volume_unit total_volume dose_count multiplier total_units is_alt annotation parse_confidence parse_pattern".split()])


#: A description of each shape, A a number from 1 to 9 and B the part's size, and what it says: pattern, form, containers, units, volume, its unit, doses, all units, all volume.
SHAPES = [
    ("Blist A x B x 2 Stk", "P1_TRIPLE", "BLISTER", None, "2", None, None, None, "a * b * 2", None), ("Ds A x B x 2.5 ml", "P1_TRIPLE", "DISPENSER", None, None, "2.5", "ml", None, "a * b", "a * b * 2.5"),
    ("Disp A x B Dosen", "P1B_FORM_MULT", "DISPENSER", None, None, None, None, "a * b", "a", None), ("Stick A x B Stk", "P1B_FORM_MULT", "SACHET", None, "b", None, None, None, "a * b", None),
    ("A x B Fertspr", "P8B_MULT_FORM_BARE", "SYRINGE", "b", None, None, None, None, "a * b", None), ("A x Fl B ml", "P2_MULT_FORM_UNIT", "BOTTLE", "a", None, "b", "ml", None, "a", "a * b"),
    ("A x Btl B Stk", "P2_MULT_FORM_UNIT", "SACHET", None, "b", None, None, None, "a * b", None), ("A x B g", "P3_MULT_UNIT", None, None, None, "b", "g", None, "a", "a * b"),
    ("A x B Stk", "P3_MULT_UNIT", None, None, "b", None, None, None, "a * b", None), ("A Amp B ml", "P4_N_FORM_VOL", "AMPOULE", "a", None, "b", "ml", None, "a", "a * b"),
    ("A Polybag B Stk", "P4_N_FORM_VOL", "BAG", "a", "b", None, None, None, "a * b", None), ("Durchstf B Stk", "P5_FORM_STK", "VIAL", "b", "b", None, None, None, "b", None),
    ("Dosierspr B Dos", "P7_FORM_DOS", "METERED_SYRINGE", "1", None, None, None, "b", "1", None), ("Tb B g", "P6_FORM_VOL", "TUBE", "1", None, "b", "g", None, "1", "b"),
    ("B Monodos", "P8_N_FORM", "MONODOSE", "b", None, None, None, None, "b", None), ("B ml zur Injektion", "P11_VOL_ZUR", None, None, None, "b", "ml", None, "1", "b"),
    ("A B ml", "P10_N_N_UNIT", None, "a", None, "b", "ml", None, "a", "a * b"), ("B MBq", "P9_SIMPLE", None, None, None, "b", "MBq", None, "1", "b"),
    ("B Monodos A Btl à 10 Stk", "P14_MONODOS_BTL", "MONODOSE", "b", "10", None, None, None, "b", None), ("Durchstf A Stk B ml", "P12_FORM_STK_VOL", "VIAL", "a", None, "b", "ml", None, "a", "a * b"),
    ("A ml B Stk", "P13_VOL_STK", None, "b", None, "a", "ml", None, "b", "a * b"), ("Topf", "BARE_FORM", "JAR", "1", None, None, None, None, "1", None),
]


def sql_shapes() -> str:
    pick = lambda i, wrap, kind: "CAST(CASE k " + " ".join(f"WHEN {n} THEN {wrap(row[i])}" for n, row in enumerate(SHAPES) if row[i] is not None) + f" END AS {kind})"
    said, plain = (lambda v: f"'{v}'"), (lambda v: v)
    columns = [("parse_pattern", 1, said, "VARCHAR"), ("form_type", 2, said, "VARCHAR"), ("container_count", 3, plain, "INTEGER"), ("unit_count", 4, plain, "INTEGER"), ("volume_per_unit", 5, plain, "DOUBLE"), ("volume_unit", 6, said, "VARCHAR"), ("dose_count", 7, plain, "INTEGER"), ("total_units", 8, plain, "INTEGER"), ("total_volume", 9, plain, "DOUBLE")]
    return f"WITH p AS (SELECT p_partkey, p_partkey % {len(SHAPES)} AS k, p_partkey % 9 + 1 AS a, p_size AS b FROM part) SELECT p_partkey, " + ", ".join(f"{pick(i, wrap, kind)} AS {name}" for name, i, wrap, kind in columns) + " FROM p"


@query(sql_shapes())
def pack_shapes(spark, d):
    said = [F.lit(row[0]) for row in SHAPES]
    text = F.replace(F.replace(F.element_at(F.array(*said), F.expr(f"cast(p_partkey % {len(SHAPES)} + 1 as int)")), F.lit("A "), F.expr("concat(p_partkey % 9 + 1, ' ')")), F.lit("B "), F.expr("concat(p_size, ' ')"))
    p = table(spark, d, "part").select("p_partkey", packs.parse_packs(text).alias("p"))
    return p.select("p_partkey", *[f"p.{c}" for c in "parse_pattern form_type container_count unit_count volume_per_unit volume_unit dose_count total_units total_volume".split()])


@query(f"""
WITH {PACK_SQL}
SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN NULL ELSE CAST(p_partkey % 100 AS DOUBLE) + 0.25 END AS substance_qty,
  CASE WHEN p_partkey % 5 < 3 THEN (CAST(p_partkey % 100 AS DOUBLE) + 0.25) * total_units END AS total_substance FROM parsed""")
def pack_substance(spark, d):
    p = described(spark, d).selectExpr("p_partkey as preparation_id", "description_de")
    qty = "case p_partkey % 5 when 0 then '' when 1 then '<' when 2 then 'ca. ' when 3 then 'min. ' else 'q.s. ' end"
    subs = table(spark, d, "part").selectExpr("p_partkey as preparation_id", "explode(array(2, 1)) as substance_id", "p_partkey", "p_name as description_la")
    subs = subs.selectExpr("preparation_id", "substance_id", "description_la", f"case when substance_id = 1 then concat({qty}, cast(p_partkey % 100 as string), '.25') else '7' end as quantity", "case when p_partkey % 5 = 3 then 'Stk' else 'mg' end as quantity_unit")
    out = packs.normalise_packs(p, subs)
    return out.selectExpr("preparation_id as p_partkey", "substance_qty", "total_substance")


@query(f"WITH {PACK_SQL} SELECT parse_confidence, parse_pattern, count(*) AS n FROM parsed GROUP BY ALL")
def pack_distribution(spark, d):
    return reports.distribution(described(spark, d).select(packs.parse_packs(F.col("description_de")).alias("p")).select("p.*"), "parse_confidence", "parse_pattern")


#: A number from the id, in words for some.
NUMBER = "case doc_id % 7 when 0 then 'douze' when 1 then 'vingt-deux' else cast(doc_id % 89 + 2 as {}) end"
DIGITS = "cast(doc_id % 89 + 2 as {})"


def phrases(said: list[str], number: str = DIGITS, text: str = "string") -> str:
    """SQL for one of the phrases by the id, V in it the number; text is the engine's name for strings."""
    v = number.format(text)
    one = lambda p: "concat(" + ", ".join(x for i, q in enumerate(p.replace("'", "''").split("V")) for x in ([v] if i else []) + [f"'{q}'"]) + ")"
    return f"case doc_id % {len(said)} " + " ".join(f"when {i} then {one(p)}" for i, p in enumerate(said)) + " end"


#: Refund sentences, one for each detector.
SAID = [
    "La société Example Pharma SA rembourse V % du prix pour chaque emballage.", "Ce montant est remboursé par Muster Schweiz GmbH. Soit V francs par mois.",
    "L'assureur facture à la firme Roche Example AG le montant de CHF V par cycle.", "Le titulaire de l'autorisation rembourse V Fr. par flacon à partir du 3e emballage.",
    "Ils remboursent à l'assurance-maladie les coûts de l'emballage complet après V mois.", "On rembourse le montant de Fr. V par patient.",
    "Le reste est payé ; on rembourse complètement au-delà de V semaines.", "Elle rembourse une partie fixe du prix.", "Rien à dire.",
]
#: One or two for each calculation, unit, threshold and sentence, in the order of the rules.
CALCULATED = [
    "V %", "V CHF", "V,5 francs", "CHF V", "francs V.25", "Fr. V", "V Fr.", "V centimes par mg", "coûts de la totalité de l'emballage", "coût de l'emballage complet", "prix départ usine", "à partir du Ve paquet",
    "rembourse V, soit", "taux de V", "coûts correspondants", "part non divulguée", "convenu avec tous", "selon accord", "partie fixe du prix", "rembourse le montant", "CHF 3'V.40", "rien",
]
COUNTED = [
    "pour chaque emballage", "chaque boîte achetée", "par boîte ou", "par emballage resp. boîte", "pour chaque flacon", "par seringue", "chaque stylo", "par auto-injecteur", "pour chaque solution", "par injection", "par mg", "V /mg", "par milligramme",
    "par cycle combiné", "chaque cycle", "par mois", "mensuellement", "par patient", "par année civile", "pour chaque traitement", "par semaine", "chaque paquet", "rien",
]
BOUNDED = [
    "à partir du Ve emballage", "à partir du Ve cycle", "à partir du Ve mois", "à partir du V semaines", "après V mois", "après V semaines", "après V jours", "après V cycles", "pendant V mois", "durant V semaines",
    "durée de thérapie de V mois", "durée du traitement V semaines", "durée de traitement de V semaines", "au-delà de V cycles", "supérieur à V jours", "plus de V mois", "au moins V cycles", "au moins V mois", "dès le Ve flacon",
    "période de V jours", "V jours suivant", "dans les V jours", "ne se poursuit pas au-delà de V semaines", "cure de V cycles", "par année civile", "V flacons par an", "maximum de V emballages", "plafond de V", "> V cycles",
    "jusqu'à V boîtes", "les premiers V mois", "au cours des V premiers mois", "V semaines suivant le début", "montant forfaitaire unique", "forfait unique", "V cycles de chimiothérapie", "après V administrations",
    "V boîtes au total", "les V premiers mois gratuits", "dose supérieure à V", "si le patient a besoin de plus de V", "à partir de V mg par jour", "après échec de V lignes de traitement", "en cas de progression", "en cas de récidive",
    "V flacons par patient et par an", "après V jours de traitement", "la demande de remboursement dans les V jours", "après 3ème mois", "au moins 2e cycles", "durant 1ère semaine, puis après 12e jours de traitement",
    "après          V          mois", "plus de 00000000000000V jours", "> V mois ; après V mois ; pendant V mois", "rien",
]
STATED = [
    "Au-delà d'une durée de V mois, elle rembourse tout.", "À partir du Ve mois la firme restitue la part.", "Pour chaque boîte la firme rembourse V francs.", "Sur première demande de l'assureur-maladie, elle rembourse V francs.",
    "Example Pharma (Schweiz) AG remboursera V francs.", "Eli Lilly rembourse V francs.", "Le titulaire de l'autorisation restitue V francs.", "Dès la première demande écrite le titulaire rembourse V francs.",
    "Dans cette indication on sait que Muster SA rembourse V francs.", "En cas d'arrêt on restitue V francs.",
]
CONDITIONAL = [
    "arrêt du traitement", "la thérapie est arrêtée", "interruption de la thérapie", "cessation de traitement", "fin du traitement", "effets secondaires", "toxicité", "intolérance", "réactions adverses", "événements indésirables", "échec de la thérapie",
    "non-réponse", "progression de la maladie", "récidive", "rechute", "toujours",
]
GIVEN = [
    "en association avec Examplinib", "combiné avec l'Examplum", "traitement concomitant par Exampline", "avec le Examplumab", "schéma incluant Examplan", "pour l'association Examplor et autre", "Examplex en association avec rien",
    "(en association avec Examplu)", "YERVOY puis opdivo", "Keytruda® seul", "avec pour", "rien",
]


def refund_texts(spark: SparkSession, d: str, said: list[str], number: str = DIGITS, between: str = " ") -> DataFrame:
    """Whole documents, each with a phrase after it."""
    return tables.dealt(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.concat_ws(between, F.col("text"), F.expr(phrases(said, number))).alias("text"))


def sql_texts(said: list[str], number: str = DIGITS, between: str = " ") -> str:
    return f"WITH d AS (SELECT doc_id, coalesce(text || '{between}', '') || {phrases(said, number, 'VARCHAR')} AS t FROM documents)"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# The company of a refund as the detectors of the first rank see it.
CLASS = r"[A-Za-zÀ-ÿ\-\(\)&]"
LEGAL = "(?:SA|AG|Sàrl|GmbH|Ltd|Suisse|Switzerland|Schweiz)"
NAME = rf"[A-Z][A-Za-zÀ-ÿ\-]+(?:\s+{CLASS}+)*\s+{LEGAL}"
PRE = r"(?:la\s+)?(?:société|entreprise|firme)?\s*"


#: Detection of the texts in d.
DETECTED = rf""",
f AS (SELECT doc_id, t, regexp_extract(t, '(?i){PRE}({NAME}(?:\s+[A-Za-zÀ-ÿ\-\(\)]+)?)\s+rembourse(?:ra)?', 1) AS a,
  regexp_extract(t, '(?i)remboursé(?:s|e|es)?\s+par\s+{PRE}({NAME}(?:\s+[A-Za-zÀ-ÿ\-\(\)]+)?)', 1) AS b,
  regexp_extract(t, '(?i)assureur\s+facture\s+à\s+{PRE}({NAME})(?:\s+le\s|\s+un|\s+la\s|\s+les\s|\s*$|\s*\.)', 1) AS c FROM d),
p AS (SELECT doc_id, a, b, c, CASE WHEN a <> '' THEN 'company_rembourse' WHEN b <> '' THEN 'rembourse_par' WHEN c <> '' THEN 'assureur_facture'
  WHEN regexp_matches(t, '(?i)(?:le\s+)?titulaire\s+(?:de\s+l[''’\s]autorisation[\s,]+)?(?:de\s+[A-Z][A-Za-z0-9\-]+\s+)?(?:[^,\n]{{1,50}},\s+)?(?:rembourse(?:ra)?|restitue)') THEN 'titulaire_rembourse'
  WHEN regexp_matches(t, '(?i)rembourse(?:nt|ra|ront)?\s+(?:à\s+)?l[''’]assur(?:ance|eur)[\s\-]?maladie') THEN 'rembourse_assurance'
  WHEN regexp_matches(t, '(?i)rembourse.*\d+[.,]?\d*\s*%\s*(?:du|de|des)') THEN 'percentage'
  WHEN regexp_matches(t, '(?i)rembourse(?:ra)?\s+(?:à\s+l''assureur)?.*?(?:CHF|Fr\.)\s*[\d'']+') THEN 'amount'
  WHEN regexp_matches(t, '(?i)rembourse.*partie\s*fixe.*prix') THEN 'fixed_part' WHEN regexp_matches(t, '(?i)rembourse(?:ra)?\s+(?:intégralement|complètement)') THEN 'full_refund' END AS pattern FROM f)"""
COMPANY = "nullif(CASE WHEN a <> '' THEN a WHEN b <> '' THEN b ELSE c END, '')"


@query(sql_texts(SAID) + DETECTED + f" SELECT doc_id, pattern IS NOT NULL AS is_cashback, {COMPANY} AS company, pattern FROM p")
def cashback_detect(spark, d):
    return refund_texts(spark, d, SAID).select("doc_id", refunds.detect(F.col("text")).alias("f")).select("doc_id", "f.is_cashback", "f.company", "f.pattern")


@query(f"SELECT doc_id, {phrases(STATED, text='VARCHAR')} AS sentence FROM documents")
def cashback_sentence(spark, d):
    # a full stop before the phrase, so that the twin knows where its sentence begins
    return refund_texts(spark, d, STATED, between=" --. ").select("doc_id", refunds.sentence(F.col("text")).alias("sentence"))


def sql_calculation() -> tuple[str, str, str]:
    """The text with Swiss amounts as plain numbers, and kind and value read from that, which is u."""
    case, value = "", ""
    for kind, pattern, has_value in rules.CALCULATIONS:
        p = quoted("(?i)" + pattern.replace("N", r"(\d+(?:[.,]\d+)?)"))
        case += f" WHEN regexp_matches(u, {p}) THEN '{kind}'"
        value += f" WHEN regexp_matches(u, {p}) THEN " + (f"TRY_CAST(replace(regexp_extract(u, {p}, 1), ',', '.') AS DOUBLE)" if has_value else "NULL")
    plain = "regexp_replace(regexp_replace(t, '(\\d)[''’](\\d)', '\\1\\2', 'g'), '(\\d)[''’](\\d)', '\\1\\2', 'g')"
    return plain, f"CASE{case} ELSE 'unknown' END", f"CASE{value} END"


PLAIN, CALC_TYPE, CALC_VALUE = sql_calculation()
UNIT = "CASE" + "".join(f" WHEN regexp_matches(lower(t), {quoted(p)}) THEN '{u}'" for u, p in rules.UNITS) + " ELSE 'unknown' END"


@query(sql_texts(CALCULATED) + f", e AS (SELECT doc_id, {PLAIN} AS u FROM d) SELECT doc_id, {CALC_TYPE} AS type, {CALC_VALUE} AS value FROM e")
def cashback_calc(spark, d):
    return refund_texts(spark, d, CALCULATED).select("doc_id", refunds.calculation(F.col("text")).alias("c")).select("doc_id", "c.type", "c.value")


@query(sql_texts(COUNTED) + f" SELECT doc_id, {UNIT} AS unit FROM d")
def cashback_unit(spark, d):
    return refund_texts(spark, d, COUNTED).select("doc_id", refunds.refund_unit(F.col("text")).alias("unit"))


def sql_thresholds() -> str:
    """All patterns, on whole texts; entries near a deadline go, the first with a value is the primary one, else the first."""
    n = r"(\d+|" + "|".join(sorted(rules.NUMBER_WORDS, key=len, reverse=True)) + ")"
    made = []
    for kind, pattern, has_value in rules.THRESHOLDS:
        p = quoted(pattern.replace("NTH", "\0").replace("N", n).replace("\0", n + "(?:e|[èé]me|ème|eme)?"))
        made.append(f"{{'type': '{kind}', 'hit': regexp_extract(low, {p}, 0), 'raw': " + (f"regexp_extract(low, {p}, 1)" if has_value else "''") + "}")
    words = "MAP {" + ", ".join(f"'{w}': {v}" for w, v in rules.NUMBER_WORDS.items()) + "}"
    unit = "CASE" + "".join(f" WHEN regexp_matches(x.hit, '{'|'.join(marks)}') THEN '{u}'" for u, marks in rules.THRESHOLD_UNITS) + " END"
    around = "substring(low, greatest(strpos(low, x.hit) - 150, 1), length(x.hit) + 150 + least(strpos(low, x.hit) - 1, 150))"
    return f"""e AS (SELECT doc_id, lower(t) AS low FROM d), m AS (SELECT {words} AS w),
h AS (SELECT doc_id, low, list_filter([{', '.join(made)}], lambda x: x.hit <> '') AS hits FROM e),
k AS (SELECT doc_id, list_transform(list_filter(hits, lambda x: NOT regexp_matches({around}, {quoted('|'.join(rules.DEADLINES))})),
  lambda x: {{'type': x.type, 'value': coalesce(w[x.raw], TRY_CAST(CASE WHEN regexp_full_match(x.raw, '[0-9]+') THEN x.raw END AS INTEGER)), 'unit': {unit}, 'match': x.hit}}) AS t FROM h, m),
main AS (SELECT doc_id, t, coalesce(list_filter(t, lambda x: x.value IS NOT NULL)[1], t[1]) AS p FROM k)"""


@query(sql_texts(BOUNDED, NUMBER) + f""", {sql_thresholds()}
SELECT doc_id, p.type AS type, CAST(p.value AS INTEGER) AS value, p.unit AS unit, array_to_string(list_transform(t, lambda x: x.type), ',') AS all_types FROM main""")
def cashback_threshold(spark, d):
    found = refund_texts(spark, d, BOUNDED, NUMBER).select("doc_id", refunds.thresholds(F.col("text")).alias("all")).withColumn("t", refunds.primary_threshold(F.col("all")))
    return found.select("doc_id", "t.type", "t.value", "t.unit", F.array_join(F.transform("all", lambda x: x["type"]), ",").alias("all_types"))


CONDITIONS = ", ".join(f"regexp_matches(lower(t), {quoted('|'.join(ps))}) AS {name}" for name, ps in rules.CONDITIONS.items())


@query(sql_texts(CONDITIONAL) + f" SELECT doc_id, {CONDITIONS} FROM d")
def cashback_conditions(spark, d):
    return refund_texts(spark, d, CONDITIONAL).select("doc_id", *[c.alias(n) for n, c in refunds.conditions(F.col("text")).items()])


#: Drugs given along of the texts in d, by patterns and by name.
DRUGS_FOUND = ("SELECT doc_id, t, list_filter(list_transform(flatten([" + ", ".join(f"regexp_extract_all(t, {quoted('(?i)' + p)}, 1)" for p in rules.GIVEN_ALONG) + f"""]), lambda x: upper(trim(x))), lambda x: length(x) >= 4 AND x NOT IN ({', '.join(map(quoted, rules.NO_DRUGS))})) AS named,
  regexp_extract_all(upper(t), '\\b({'|'.join(rules.DRUGS)})®?\\b', 1) AS known FROM d""")


@query(sql_texts(GIVEN) + f", g AS ({DRUGS_FOUND}) SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(named, known))), ',') AS drugs FROM g")
def cashback_cotreatments(spark, d):
    return refund_texts(spark, d, GIVEN).select("doc_id", F.array_join(F.array_sort(refunds.cotreatments(F.col("text"))), ",").alias("drugs"))


@query("""
SELECT o_orderkey AS limitation_id, CAST(l_linenumber AS INTEGER) AS segment_order, 'segment ' || CAST(l_partkey AS VARCHAR) AS text
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 3 = 0)""")
def cashback_segments_union(spark, d):
    segs = table(spark, d, "lineitem").filter("l_orderkey % 3 = 0").selectExpr("l_orderkey as limitation_id", "l_linenumber as segment_order", "concat('segment ', l_partkey) as segment_text_fr")
    return refunds.segments_and_rest(segs, table(spark, d, "orders").selectExpr("o_orderkey as limitation_id", "o_orderpriority as description_fr"))


@query(sql_texts(["Un texte. La firme Nova-V verse V francs par mois.", "Nova-2 dit-on, sans plus.", "Le titulaire rembourse V francs par emballage, en association avec Examplinib.", "Rien."]) + """,
k AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'nova-' || CAST(doc_id % 89 + 2 AS VARCHAR) END AS named FROM d)
SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'fuzzy_company' ELSE 'titulaire_rembourse' END AS detection_patterns, CASE WHEN doc_id % 4 = 0 THEN (SELECT min(c) FROM (SELECT unnest(['Nova-1', 'Nova-2', 'Nova-3']) AS c) WHERE starts_with(named, lower(c))) END AS cashback_company,
  'chf_fixed' AS rule_calc_type
FROM k WHERE doc_id % 4 = 2 OR (doc_id % 4 = 0 AND substr(named, 6, 1) IN ('1', '2', '3'))""")
def cashback_known_companies(spark, d):
    """A known company near a verb tells a refund that no detector sees."""
    said = ["Un texte. La firme Nova-V verse V francs par mois.", "Nova-2 dit-on, sans plus.", "Le titulaire rembourse V francs par emballage, en association avec Examplinib.", "Rien."]
    texts = table(spark, d, "documents").select("doc_id", F.expr(phrases(said)).alias("text"))
    companies = table(spark, d, "region").selectExpr("concat('Nova-', r_regionkey) as company").filter("company between 'Nova-1' and 'Nova-3'")
    return refunds.mine(texts, "doc_id", "text", companies=companies).select("id", "detection_patterns", "cashback_company", "rule_calc_type")


@query(sql_texts(["<b>x</b> Example SA rembourse V francs par mois.", "L'assureur facture &agrave; la firme Roche Example AG le montant.", "rien"], between=" --. ") + """
SELECT doc_id, doc_id % 3 < 2 AS is_cashback, CASE doc_id % 3 WHEN 0 THEN 'company_rembourse' WHEN 1 THEN 'assureur_facture' END AS cashback_patterns, CAST(doc_id % 3 < 2 AS INTEGER) AS has_cashback FROM d""")
def cashback_text_flags(spark, d):
    said = ["<b>x</b> Example SA rembourse V francs par mois.", "L'assureur facture &agrave; la firme Roche Example AG le montant.", "rien"]
    return refunds.text_flags(refund_texts(spark, d, said, between=" --. "), "text").select("doc_id", "is_cashback", "cashback_patterns", "has_cashback")


def sql_rules() -> str:
    """Detection, then all rules over the sentence of the first phrase and of the one with the holder, and over the whole text of the others, which have no sentence."""
    clean = r"trim(regexp_replace(regexp_replace(regexp_replace(t, '<br/?>|&nbsp;', ' ', 'g'), '</?[bu]>', '', 'g'), '\s+', ' ', 'g'))"
    said = rf"nullif(CASE doc_id % {len(SAID)} WHEN 0 THEN regexp_extract(t, '(?s)^(?:.*\. )?(.*)$', 1) WHEN 3 THEN regexp_extract(t, '(?s)^(?:.*\. )?(.*?rembourse \d+ Fr\.) par flacon', 1) ELSE '' END, '')"
    legal = quoted(rf"([A-ZÀÂÄÉÈÊËÏÎÔÖÙÛÜŸÇ][a-zA-ZÀ-ÿ\-]*(?:[\s\-][{rules.NAME_CLASS}\s]*)?(?:\s*\([^)]+\))?\s*(?:SA|AG|GmbH|Sàrl))")
    entry = """'{"type":"' || x.type || '"' || coalesce(',"value":' || CAST(x.value AS VARCHAR), '') || coalesce(',"unit":"' || x.unit || '"', '') || ',"match":"' || x.match || '"}'"""
    conditions = ", ".join(f"cond_{n}" for n in rules.CONDITIONS)
    return sql_texts(SAID).replace("WITH d AS", "WITH raw AS") + f""", texts AS (SELECT doc_id, {clean} AS t FROM raw){DETECTED.replace("FROM d)", "FROM texts)")},
s AS (SELECT doc_id, t AS whole, {said} AS said, pattern, {COMPANY} AS company FROM p JOIN texts USING (doc_id) WHERE pattern IS NOT NULL),
d AS (SELECT doc_id, coalesce(said, whole) AS t FROM s), {sql_thresholds()}, g AS ({DRUGS_FOUND}),
c AS (SELECT doc_id, {CALC_TYPE} AS rule_calc_type, {CALC_VALUE} AS rule_calc_value FROM (SELECT doc_id, {PLAIN} AS u FROM d)),
r AS (SELECT doc_id, {UNIT} AS rule_unit, {CONDITIONS.replace(" AS ", " AS cond_")} FROM d)
SELECT doc_id AS id, said AS cashback_extract, coalesce(nullif(trim(regexp_extract(said, {legal}, 1)), ''), company) AS cashback_company, pattern AS detection_patterns, rule_calc_type, rule_calc_value, rule_unit,
  main.p.type AS rule_threshold_type, CAST(main.p.value AS INTEGER) AS rule_threshold_value, main.p.unit AS rule_threshold_unit, '[' || array_to_string(list_transform(main.t, lambda x: {entry}), ',') || ']' AS thresholds, {conditions},
  '[' || array_to_string(list_transform(list_sort(list_distinct(list_concat(named, known))), lambda x: '"' || x || '"'), ',') || ']' AS cotreatments, regexp_matches(whole, {quoted('(?i)' + '|'.join(rules.NO_REFUND))}) AS no_refund_phrase
FROM s JOIN main USING (doc_id) JOIN g USING (doc_id) JOIN c USING (doc_id) JOIN r USING (doc_id)"""


@query(sql_rules())
def cashback_rules(spark, d):
    out = refunds.mine(refund_texts(spark, d, SAID), "doc_id", "text")
    return out.withColumn("thresholds", F.to_json("thresholds")).withColumn("cotreatments", F.to_json("cotreatments"))


def limitation_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Limitations named after parts, every third one with a code, the others with a fallback."""
    lines = table(spark, d, "lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("limitation_id")).agg(F.min("l_partkey").alias("l_partkey")).join(history.grows(table(spark, d, "part").select("p_partkey", "p_name")), F.expr("l_partkey = p_partkey"))
    lims = lines.selectExpr("limitation_id", "p_name as indication_name_de")
    codes = lines.selectExpr("limitation_id", "case when limitation_id % 3 = 0 then concat('D', l_partkey % 50, '.', l_partkey % 90) else concat('D', l_partkey % 50, '.xx') end as code_value", "case when limitation_id % 3 = 0 then 'STRUCTURED_XML' else 'FALLBACK_XX' end as code_source", "concat('D', l_partkey % 50) as bag_dossier_no")
    return lims, codes


SQL_LIMS = """
WITH x AS (SELECT limitation_id, l_partkey, p_name FROM (SELECT l_orderkey * 10 + l_linenumber AS limitation_id, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1) JOIN part ON l_partkey = p_partkey),
c AS (SELECT limitation_id, p_name, 'D' || CAST(l_partkey % 50 AS VARCHAR) AS dossier, CASE WHEN limitation_id % 3 = 0 THEN 'D' || CAST(l_partkey % 50 AS VARCHAR) || '.' || CAST(l_partkey % 90 AS VARCHAR) END AS code FROM x),
m AS (SELECT p_name, code, min(limitation_id) AS limitation_id, min(dossier) AS dossier FROM c WHERE code IS NOT NULL GROUP BY p_name, code)"""


@query(SQL_LIMS + " SELECT p_name AS indication_name_de, code AS code_value, limitation_id, dossier AS bag_dossier_no FROM m")
def name_code_map(spark, d):
    return matching.name_code_map(*limitation_tables(spark, d))


@query(SQL_LIMS + """
SELECT c.limitation_id, coalesce(c.code, n.code, c.dossier || '.xx') AS code_value, CASE WHEN c.code IS NOT NULL THEN 'STRUCTURED_XML' WHEN n.code IS NOT NULL THEN 'NAME_MAPPED' ELSE 'FALLBACK_XX' END AS code_source
FROM c LEFT JOIN (SELECT p_name, dossier, max(code) AS code FROM m GROUP BY 1, 2) n ON c.p_name = n.p_name AND c.dossier = n.dossier""")
def retro_map(spark, d):
    lims, codes = limitation_tables(spark, d)
    return matching.retro_map(codes, lims, matching.name_code_map(lims, codes)).select("limitation_id", "code_value", "code_source")


@query(SQL_LIMS + """
SELECT c.limitation_id, n.code AS matched_code_value, CASE WHEN n.code IS NOT NULL THEN 'SEGMENT_MAPPED' END AS matched_code_source
FROM c LEFT JOIN (SELECT p_name, dossier, min(code) AS code FROM m GROUP BY 1, 2) n ON c.p_name = n.p_name AND c.dossier = n.dossier AND c.code IS NULL""")
def segment_map(spark, d):
    lims, codes = limitation_tables(spark, d)
    segs = lims.selectExpr("limitation_id", "0 as segment_order", "indication_name_de")
    return matching.segment_map(segs, codes, matching.name_code_map(lims, codes))[0].select("limitation_id", "matched_code_value", "matched_code_source")


#: Names that lead each layer of the cascade, by part: what a segment is called, what the map knows, how the groups are made up.
SEGMENT_NAME = (
    "case p_partkey % 12 when 0 then concat(p_name, ' 12345.67.') when 1 then concat(upper(p_name), ' :') when 2 then concat(' ', p_name, '  x') when 3 then concat('Kombination REVLIMID, ', p_name) "
    "when 4 then concat('IMNOVID ', p_name) when 8 then concat('cross ', p_name) when 9 then concat('piped ', p_name) when 10 then concat('Kombination VIDAZA und ', p_name) else concat('other ', p_partkey) end"
)
KNOWN_NAME = (
    "case p_partkey % 12 when 1 then p_name when 2 then concat(p_name, ' x|', p_type) when 3 then concat('LENALIDOMID in Kombination mit ', p_name) when 4 then concat('POMALIDOMID SANDOZ ', p_name) "
    "when 8 then concat('Cross ', p_name) when 9 then concat('Piped ', p_name, ' | more') when 10 then concat('AZACITIDIN in Kombination mit und ', p_name, '|rest') end"
)


def part_names(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    # parts of the second half of a dozen know their name under another dossier
    p = table(spark, d, "part").selectExpr("*", "concat('D', p_partkey % 40) as dossier", "concat('D', (p_partkey + case when p_partkey % 12 >= 7 then 1 else 0 end) % 40) as other", "cast(p_partkey % 90 + 10 as string) as part")
    segs = p.selectExpr("p_partkey as segment", "p_partkey div 2 as `group`", "p_partkey % 2 as position", f"{SEGMENT_NAME} as name", "dossier").filter("segment % 24 <> 5")
    known = p.selectExpr(f"{KNOWN_NAME} as name", "concat(other, '.', part) as code_value", "other as dossier").filter("name is not null")
    codes = p.selectExpr("p_partkey div 2 as `group`", "concat(dossier, '.', part) as code_value").filter("`group` % 7 < 5")
    return segs, known, codes


def sql_cascade() -> str:
    """The cascade without its fuzzy layer as unions of joins: names by key, same dossier first, else a part that is the only one."""
    brands = "{}"
    for brand, canonical in sorted(name_rules.BRANDS.items(), key=lambda x: -len(x[0])):
        brands = f"replace({brands}, '{brand}', '{canonical}')"
    plain = "regexp_replace(trim(regexp_replace(trim(name), ':+$', '')), '\\s+', ' ', 'g')"
    combined = f"regexp_replace({plain}, '^Kombination\\s+(\\S*[^\\s,]),*(?:\\s+|$)(.*)', '\\1 in Kombination mit \\2')"
    forms = f"lower({plain}) AS norm, lower({brands.replace('{}', plain)}) AS brand, lower({brands.replace('{}', combined)}) AS comb"
    layers = [("norm", "n", 10, "NORMALIZED_MATCH", 1.0, "NORMALIZED_CROSS", 0.95, ""), ("norm", "p", 20, "PIPE_PART_MATCH", 0.95, "PIPE_PART_CROSS", 0.9, ""), ("comb", "p", 30, "PIPE_PART_MATCH", 0.95, "PIPE_PART_CROSS", 0.9, ""),
              ("comb", "b", 40, "KOMBI_NORMALIZED", 0.9, "KOMBI_CROSS", 0.85, " AND s.comb <> s.norm"), ("brand", "b", 50, "BRAND_NORMALIZED", 0.9, "BRAND_CROSS", 0.85, "")]
    found = "SELECT segment, regexp_extract(name, '(\\d{5}\\.\\d{2})\\.?\\b', 1) AS code_value, 'EMBEDDED_IN_NAME' AS match_type, 1.0 AS score, 0 AS rank FROM s WHERE regexp_matches(name, '(\\d{5}\\.\\d{2})\\.?\\b')"
    for key, index, rank, same, s1, cross, s2, more in layers:
        found += f" UNION ALL SELECT segment, min(code), '{same}', {s1}, {rank} FROM s JOIN ix ON kind = '{index}' AND k = {key} AND d = dossier WHERE k <> ''{more} GROUP BY segment"
        found += f" UNION ALL SELECT segment, min(dossier || '.' || part), '{cross}', {s2}, {rank + 1} FROM s JOIN (SELECT kind, k, min(split_part(code, '.', 2)) AS part FROM ix GROUP BY 1, 2 HAVING count(DISTINCT split_part(code, '.', 2)) = 1) ON kind = '{index}' AND k = {key} WHERE k <> ''{more} GROUP BY segment"
    segment, known = (x.replace("p_partkey as string", "p_partkey AS VARCHAR") for x in (SEGMENT_NAME, KNOWN_NAME))
    return f"""
WITH s0 AS (SELECT p_partkey AS segment, p_partkey // 2 AS grp, p_partkey % 2 AS position, {segment} AS name, 'D' || CAST(p_partkey % 40 AS VARCHAR) AS dossier FROM part WHERE p_partkey % 24 <> 5),
s AS (SELECT *, {forms} FROM s0),
m0 AS (SELECT {known} AS name, 'D' || CAST((p_partkey + CASE WHEN p_partkey % 12 >= 7 THEN 1 ELSE 0 END) % 40 AS VARCHAR) AS d, CAST(p_partkey % 90 + 10 AS VARCHAR) AS part FROM part),
m AS (SELECT *, d || '.' || part AS code, {forms} FROM m0 WHERE name IS NOT NULL AND NOT contains(name, '|')),
q AS (SELECT *, d || '.' || part AS code, {forms} FROM (SELECT unnest(string_split(name, '|')) AS name, d, part FROM m0 WHERE contains(name, '|'))),
ix AS (SELECT 'n' AS kind, norm AS k, code, d FROM m UNION SELECT 'b', brand, code, d FROM m UNION SELECT 'b', comb, code, d FROM m WHERE comb <> brand UNION SELECT 'p', norm, code, d FROM q UNION SELECT 'p', brand, code, d FROM q WHERE brand <> norm),
c AS (SELECT DISTINCT p_partkey // 2 AS grp, 'D' || CAST(p_partkey % 40 AS VARCHAR) || '.' || CAST(p_partkey % 90 + 10 AS VARCHAR) AS code FROM part WHERE p_partkey // 2 % 7 < 5),
found AS ({found}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY rank, code_value) AS r FROM found) WHERE r = 1),
rest AS (SELECT s.*, count(*) OVER (PARTITION BY grp) AS n FROM s WHERE segment NOT IN (SELECT segment FROM best)),
sized AS (SELECT grp, count(*) AS n FROM s GROUP BY 1),
coded AS (SELECT grp, code, count(*) OVER (PARTITION BY grp) AS m, row_number() OVER (PARTITION BY grp ORDER BY code) AS i FROM c)
SELECT segment, code_value, match_type, CAST(score AS DOUBLE) AS score FROM best
UNION ALL SELECT segment, code, 'SINGLE_SEGMENT_CODE', 1.0 FROM rest JOIN sized USING (grp) JOIN coded USING (grp) WHERE sized.n = 1 AND m = 1
UNION ALL SELECT segment, code, 'ORDINAL_POSITION', 0.8 FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY position) AS i FROM rest) r JOIN sized USING (grp) JOIN coded ON coded.grp = r.grp AND coded.i = r.i WHERE sized.n = r.n AND r.n >= 2 AND m = r.n"""


@query(sql_cascade())
def match_layers(spark, d):
    """All layers that SQL can express."""
    return matching.cascade(*part_names(spark, d), fuzzy=False).select("segment", "code_value", "match_type", "score")


@query()
def match_cascade(spark, d):
    segs, known, codes = part_names(spark, d)
    return matching.match_log(segs, matching.cascade(segs, known, codes))


@query()
def fuzzy_best_gap(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", "p_brand as dossier", "lower(p_name) as a")
    left, right = p.withColumnRenamed("p_partkey", "segment"), p.selectExpr("dossier", "a as b").distinct()
    return matching.fuzzy_best(left, right, ["dossier"], "segment", "a", "b", others=True).select("segment", "dossier", "b", "score", "second")


@query("""
WITH n AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
c AS (SELECT l_orderkey, code, row_number() OVER (PARTITION BY l_orderkey ORDER BY split_part(code, '.', 2), code) AS i, count(*) OVER (PARTITION BY l_orderkey) AS m
      FROM (SELECT DISTINCT l_orderkey, CAST(l_suppkey % 3 AS VARCHAR) || '.' || CAST(l_partkey % 7 AS VARCHAR) AS code FROM lineitem))
SELECT n.l_orderkey, l_linenumber, code FROM n JOIN c ON n.l_orderkey = c.l_orderkey AND n.i = c.i WHERE n = m AND n >= 2""")
def ordinal_pairing(spark, d):
    lines = table(spark, d, "lineitem")
    names, codes = lines.select("l_orderkey", "l_linenumber").distinct(), lines.selectExpr("l_orderkey", "concat(l_suppkey % 3, '.', l_partkey % 7) as code")
    return matching.ordinal_pairs(names, codes, "l_orderkey", "l_linenumber", "code").select("l_orderkey", "l_linenumber", "code")


def sku_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """Links, segments, texts, reference names and replies in which every layer of the code map has its cases."""
    # links and segments start from the same lines, which are joined once
    lines = tables.cut(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_name"), F.expr("l_partkey = p_partkey")))
    links = lines.selectExpr(
        "l_orderkey as text_id", "case when l_orderkey % 9 = 8 then concat('D', l_orderkey % 30, '.XX') else concat('D', l_orderkey % 30, '.', l_partkey % 900 + 10) end as indication_code",
        "case when l_orderkey % 9 = 8 then 'FALLBACK_XX' when l_orderkey % 4 = 1 or (l_orderkey % 4 = 2 and l_linenumber = 1) then 'STRUCTURED_XML' else 'TEXT_PARSED' end as code_source",
    ).filter("text_id % 5 <> 1 or code_source = 'FALLBACK_XX' or indication_code like '%7'")
    segs = lines.filter("l_orderkey % 3 <> 0 and (l_orderkey % 2 = 0 or l_linenumber = 1)").selectExpr("l_orderkey as text_id", "l_linenumber as segment_order", "case when l_partkey % 11 = 0 then concat(p_name, ' :') else p_name end as indication_name_de")
    segs = segs.groupBy("text_id", "segment_order").agg(F.min("indication_name_de").alias("indication_name_de"))
    texts = table(spark, d, "orders").selectExpr("o_orderkey as text_id", "case o_orderkey % 4 when 0 then concat('<b>', o_orderpriority, '</b> x') when 1 then '<b>UND</b> Nur so. Mehr' else concat('Nur ', o_orderpriority, '. Mehr') end as text")
    reference = table(spark, d, "nation").selectExpr("concat('D', n_nationkey % 30, '.', n_regionkey + 10) as indication_code", "n_name as indication_name_de", "concat('D', n_nationkey % 30) as bag_dossier_no")
    replied = table(spark, d, "orders").filter("o_orderkey % 2 = 0").selectExpr("o_orderkey as text_id", "concat('reply ', o_orderpriority) as indication_name_fr")
    return links, segs, texts, reference, replied


@query("""
WITH l AS (SELECT l_orderkey AS t, l_linenumber AS n, l_partkey AS p, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
k0 AS (SELECT t, n, CASE WHEN t % 9 = 8 THEN 'D' || CAST(t % 30 AS VARCHAR) || '.XX' ELSE 'D' || CAST(t % 30 AS VARCHAR) || '.' || CAST(p % 900 + 10 AS VARCHAR) END AS code,
  CASE WHEN t % 9 = 8 THEN 'F' WHEN t % 4 = 1 OR (t % 4 = 2 AND n = 1) THEN 'S' ELSE 'T' END AS src FROM l),
k AS (SELECT DISTINCT t, code, src FROM k0 WHERE t % 5 <> 1 OR src = 'F' OR code LIKE '%7'),
r AS (SELECT * FROM k WHERE src <> 'F'),
s AS (SELECT t, n, min(CASE WHEN p % 11 = 0 THEN p_name || ' :' ELSE p_name END) AS name FROM l WHERE t % 3 <> 0 AND (t % 2 = 0 OR n = 1) GROUP BY t, n),
one AS (SELECT t, min(name) AS name FROM s GROUP BY t HAVING count(*) = 1),
g0 AS (SELECT 'D' || CAST(n_nationkey % 30 AS VARCHAR) || '.' || CAST(n_regionkey + 10 AS VARCHAR) AS code, n_name AS name, 0 AS rank FROM nation),
g1 AS (SELECT code, arg_min(name, t) AS name, 1 AS rank FROM r JOIN one USING (t) WHERE src = 'S' AND t IN (SELECT t FROM k WHERE src = 'S' GROUP BY t HAVING count(DISTINCT code) = 1) GROUP BY code),
g2 AS (SELECT code, arg_min(name, t) AS name, 2 AS rank FROM r JOIN one USING (t) WHERE src = 'T' AND t IN (SELECT t FROM r GROUP BY t HAVING count(DISTINCT code) = 1) GROUP BY code),
g3 AS (SELECT code, arg_min(name, t) AS name, 3 AS rank FROM r JOIN one USING (t) GROUP BY code),
c4 AS (SELECT t, code, row_number() OVER (PARTITION BY t ORDER BY split_part(code, '.', 2), code) AS i, count(*) OVER (PARTITION BY t) AS m FROM (SELECT DISTINCT t, code FROM r)),
s4 AS (SELECT t, name, row_number() OVER (PARTITION BY t ORDER BY n) AS i, count(*) OVER (PARTITION BY t) AS m FROM s),
g4 AS (SELECT code, name, 4 AS rank FROM c4 JOIN s4 USING (t, i, m) WHERE m >= 2),
a AS (SELECT code, name, min(rank) AS rank FROM (FROM g0 UNION ALL FROM g1 UNION ALL FROM g2 UNION ALL FROM g3 UNION ALL FROM g4) GROUP BY ALL),
f AS (SELECT lower(trim(regexp_replace(name, ' *:+$', ''))) AS form, split_part(code, '.', 1) AS d, code FROM a),
w AS (SELECT s.name, lower(trim(regexp_replace(s.name, ' *:+$', ''))) AS form, split_part(c.code, '.', 1) AS d FROM s JOIN (SELECT t, min(code) AS code FROM k GROUP BY t) c USING (t) WHERE s.name NOT IN (SELECT name FROM a)),
o AS (SELECT w.name, w.d, y.code AS own, x.code AS other FROM w JOIN (SELECT form, min(code) AS code FROM f GROUP BY 1) x USING (form) LEFT JOIN (SELECT form, d, min(code) AS code FROM f GROUP BY 1, 2) y USING (form, d)),
g5 AS (SELECT own AS code, name, 5 AS rank FROM o WHERE own IS NOT NULL UNION SELECT d || '.' || split_part(other, '.', 2), name, 6 FROM o WHERE own IS NULL),
b AS (SELECT code, name, min(rank) AS rank FROM (FROM a UNION ALL FROM g5) GROUP BY ALL),
g7 AS (SELECT k.code, arg_min('reply ' || o_orderpriority, t) AS fr FROM k JOIN orders ON o_orderkey = t WHERE src = 'F' AND t % 2 = 0 GROUP BY k.code),
z AS (SELECT DISTINCT r.code, CASE t % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN 'UND Nur so.' ELSE 'Nur ' || o_orderpriority || '.' END AS name, CASE WHEN t % 4 = 0 THEN 8 ELSE 9 END AS rank
  FROM r JOIN orders ON o_orderkey = t WHERE r.code NOT IN (SELECT code FROM b UNION SELECT code FROM g7))
SELECT code AS indication_code, name AS indication_name_de, CAST(NULL AS VARCHAR) AS indication_name_fr, split_part(code, '.', 1) AS bag_dossier_no,
  ['REF_MAP', 'DIRECT_STRUCT', 'DIRECT_TEXT', 'SHARED_TEXT', 'ORDINAL_POSITION', 'NORM_SAME', 'NORM_CROSS', '', 'BOLD_EXTRACT', 'DESC_TRUNCATED'][rank + 1] AS match_source,
  CAST([1, 1, 0.95, 0.9, 0.8, 0.95, 0.9, 0, 0.7, 0.5][rank + 1] AS DOUBLE) AS match_confidence FROM (FROM b UNION ALL SELECT code, name, min(rank) FROM z GROUP BY ALL)
UNION ALL SELECT code, NULL, fr, split_part(code, '.', 1), 'LLM_SEGMENT', 0.85 FROM g7""")
def sku_map_layers(spark, d):
    return matching.code_names(*sku_tables(spark, d)).select("indication_code", "indication_name_de", "indication_name_fr", "bag_dossier_no", "match_source", "match_confidence")


@query("""
WITH x AS (SELECT o_orderpriority AS source, o_custkey AS code FROM orders WHERE o_orderstatus = 'F'), a AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT source AS match_source, count(*) AS n_mappings, count(DISTINCT code) AS n_codes, count(DISTINCT code) / (SELECT n FROM a) AS share FROM x GROUP BY GROUPING SETS ((source), ())""")
def map_quality(spark, d):
    orders = table(spark, d, "orders").withColumnsRenamed({"o_custkey": "indication_code", "o_orderpriority": "match_source"})
    return reports.map_quality(orders.filter("o_orderstatus = 'F'"), orders)


REPLIED = """case conv_id % 9
 when 0 then concat('```json\n{"is_multi_indication": false, "segments": [{"order": 1, "indication_name_fr": "n', turn, '", "is_cashback": true, "cashback_calc_type": "percentage", "cashback_unit": "per_foot"}]}\n```')
 when 1 then concat('{"segments": [{"indication_name_fr": "m', turn, '", "is_cashback": false}, {"indication_name_fr": "k", "is_cashback": true, "cashback_calc_type": "guess"}]}')
 when 2 then '{"segments": []}' when 3 then 'not json' when 4 then '{"segments": [{"is_cashback": true}]}'
 when 5 then '{"segments": [{"indication_name_fr": null, "is_cashback": null, "cashback_unit": null}]}' when 6 then '[1]' when 7 then '{"segments": {"a": 1}}' else '{"segments": [{"indication_name_fr": "q"}]}' end"""


@query("""
WITH last AS (SELECT conv_id, max(turn) AS turn FROM conversations GROUP BY 1)
SELECT conv_id AS text_id, 0 AS segment_order, CASE conv_id % 9 WHEN 0 THEN 'n' ELSE 'm' END || CAST(turn AS VARCHAR) AS indication_name_fr, conv_id % 9 = 0 AS is_cashback,
  CASE conv_id % 9 WHEN 0 THEN 'percentage' END AS cashback_calc_type, CASE conv_id % 9 WHEN 0 THEN 'unknown' END AS cashback_unit FROM last WHERE conv_id % 9 < 2
UNION ALL SELECT conv_id, 1, 'k', true, 'unknown', NULL FROM last WHERE conv_id % 9 = 1
UNION ALL SELECT conv_id, 0, NULL, NULL, NULL, NULL FROM last WHERE conv_id % 9 = 5""")
def llm_parse_validate(spark, d):
    raw = table(spark, d, "conversations").selectExpr("conv_id as text_id", f"{REPLIED} as raw", "lpad(cast(turn as string), 6, '0') as processed_at")
    return replies.reply_segments(raw).select("text_id", "segment_order", "indication_name_fr", "is_cashback", "cashback_calc_type", "cashback_unit")


@query("""
WITH last AS (SELECT conv_id, max(turn) AS turn FROM conversations GROUP BY 1)
SELECT error, count(*) AS n FROM (SELECT CASE conv_id % 9 WHEN 2 THEN 'empty segments' WHEN 3 THEN 'no JSON' WHEN 4 THEN 'segment without a name' WHEN 6 THEN 'no object' WHEN 7 THEN 'segments are no list' WHEN 8 THEN 'segment without a verdict' END AS error
FROM conversations) GROUP BY error""")
def llm_reply_errors(spark, d):
    raw = table(spark, d, "conversations").selectExpr(f"{REPLIED} as raw")
    return replies.parse_replies(raw).groupBy("error").agg(F.count("*").alias("n"))


@query("""
SELECT count(*) AS n_texts, CAST(coalesce(sum(CASE WHEN a = b THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_agree, coalesce(CAST(sum(CASE WHEN a = b THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 0) AS rate
FROM (SELECT doc_id, max(quality) = 1 AS a FROM labels GROUP BY 1) JOIN (SELECT doc_id, max(n_chars) > 1500 AS b FROM documents GROUP BY 1) USING (doc_id)""")
def concordance(spark, d):
    return replies.concordance(table(spark, d, "labels").selectExpr("doc_id", "quality = 1 as is_cashback"), table(spark, d, "documents").selectExpr("doc_id", "n_chars > 1500 as is_cashback"), "doc_id")


@query("SELECT route, count(*) AS n FROM (SELECT CASE WHEN length(text) >= 2000 THEN 'large' ELSE 'small' END AS route FROM documents WHERE doc_id % 10 <> 0 AND lang = 'fr') GROUP BY 1")
def llm_targets(spark, d):
    texts = table(spark, d, "documents").selectExpr("doc_id as text_id", "text", "2020 as file_year", "lang = 'fr' as is_cashback")
    done = texts.filter("text_id % 20 = 10").select("text_id")
    return reports.distribution(replies.targets(texts, texts.filter("text_id % 20 = 0"), done), "route")


@query("SELECT o_custkey, string_agg(p, ',' ORDER BY p) AS priorities FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY 1")
def group_concat_report(spark, d):
    return reports.joined_list(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "priorities")


@query("""
SELECT count(*) AS n, count(*) FILTER (WHERE lang = 'en') AS n_english, CAST(count(*) FILTER (WHERE lang = 'en') AS DOUBLE) / count(*) AS share_english,
  count(*) FILTER (WHERE n_chars > 2000) AS n_long, CAST(count(*) FILTER (WHERE n_chars > 2000) AS DOUBLE) / count(*) AS share_long FROM documents""")
def coverage_counts(spark, d):
    return reports.coverage(table(spark, d, "documents"), english=F.col("lang") == "en", long=F.col("n_chars") > 2000)


@query("""
WITH s AS (SELECT l_suppkey AS preparation_id, CASE WHEN p_size = 7 THEN NULL ELSE p_type END AS name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 2 = 0),
pk AS (SELECT o_custkey AS preparation_id, 'D' || CAST(o_orderkey % 4 AS VARCHAR) AS bag_dossier_no FROM orders)
SELECT s.name AS indication_name_de, pk.bag_dossier_no, count(*) AS n_segments FROM s LEFT JOIN pk ON pk.preparation_id = s.preparation_id WHERE s.name IS NOT NULL GROUP BY s.name, pk.bag_dossier_no""")
def unmatched_names(spark, d):
    segs = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_type", "p_size"), F.expr("l_partkey = p_partkey"))
    segs = segs.selectExpr("l_suppkey as preparation_id", "case when p_size <> 7 then p_type end as indication_name_de", "case when l_linenumber % 2 <> 0 then 'x' end as matched_code_value")
    return reports.unmatched_names(segs, table(spark, d, "orders").selectExpr("o_custkey as preparation_id", "concat('D', o_orderkey % 4) as bag_dossier_no"))


@query("SELECT o_orderpriority, n FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, o_orderpriority LIMIT 3")
def top_categories(spark, d):
    return reports.top(reports.distribution(table(spark, d, "orders"), "o_orderpriority"), 3, "n")


@query("""
SELECT o_orderkey, coalesce(h.name, c_name) AS name, CASE WHEN h.o_custkey IS NOT NULL THEN 0 ELSE 1 END AS src FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN (SELECT DISTINCT o_custkey, 'first ' || CAST(o_custkey AS VARCHAR) AS name FROM orders WHERE o_orderstatus = 'F') h ON h.o_custkey = orders.o_custkey""")
def union_first_wins(spark, d):
    orders = table(spark, d, "orders")
    a = orders.filter("o_orderstatus = 'F'").selectExpr("o_custkey", "concat('first ', o_custkey) as name", "0 as src").distinct()
    b = table(spark, d, "customer").selectExpr("c_custkey as o_custkey", "c_name as name", "1 as src")
    return orders.select("o_orderkey", "o_custkey").join(history.union_first_wins([a, b], ["o_custkey"]), "o_custkey").select("o_orderkey", "name", "src")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def upsert_latest(spark, d):
    return history.latest_wins(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
SELECT l_orderkey, l_linenumber, n_name, {SQL_CODED} AS indication_code, CASE WHEN l_suppkey % 5 = 0 THEN 'FALLBACK' WHEN l_linenumber <= 2 THEN 'CROSS_INDICATION' ELSE 'REAL_CODE' END AS code_type,
  CASE WHEN o_orderpriority <= '2' THEN 1 ELSE 0 END AS has_rule
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def export_flat(spark, d):
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("gtin"), "l_linenumber", F.expr(CODED).alias("indication_code"), F.expr("l_suppkey % 5 = 0").alias("is_fallback"), F.col("l_orderkey").alias("content_hash"))
    owners = table(spark, d, "customer").join(table(spark, d, "nation"), F.expr("n_nationkey = c_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    items = table(spark, d, "orders").select(F.col("o_orderkey").alias("gtin"), "o_custkey").join(owners, "o_custkey").drop("o_custkey")
    rules = table(spark, d, "orders").filter("o_orderpriority <= '2'").select(F.col("o_orderkey").alias("content_hash"), F.lit(1).alias("rule"))
    out = exports.flat_links(links, items, rules)
    return out.select(F.col("gtin").alias("l_orderkey"), "l_linenumber", "n_name", "indication_code", "code_type", F.coalesce("rule", F.lit(0)).alias("has_rule"))


@query("SELECT doc_id, translate(text, 'eao', 'é<&') AS plain FROM documents")
def decode_entities(spark, d):
    # placeholders keep the letters of one reference from being coded by the next
    coded = F.translate("text", "eao", "\x01\x02\x03")
    for mark, entity in (("\x01", "&eacute;"), ("\x02", "&#60;"), ("\x03", "&amp;")):
        coded = F.replace(coded, F.lit(mark), F.lit(entity))
    return table(spark, d, "documents").select("doc_id", tx.decode_entities(coded).alias("plain"))


#: Months since 1970 as snapshot numbers.
MONTH = "cast((year({0}) - 1970) * 12 + month({0}) as int)"


def listed_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Products, limitations, codes, segments, packs, rules and snapshots made of customers, orders and lines."""
    orders, lines, customers = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "customer")
    month = MONTH.format("o_orderdate")
    lims = orders.selectExpr("o_orderkey as limitation_id", "o_custkey as preparation_id", "o_orderpriority as limitation_code", "concat('<b>', o_orderstatus, '</b> a&nbsp;b') as description_fr", f"{month} as first_seen", f"{month} + cast(o_orderkey % 24 as int) as last_seen")
    own = lines.join(history.grows(orders.select("o_orderkey", "o_custkey")), F.expr("l_orderkey = o_orderkey"))
    shipped = MONTH.format("l_shipdate")
    codes = own.selectExpr("l_orderkey as limitation_id", "o_custkey as preparation_id", "concat('D', l_suppkey % 3) as bag_dossier_no", "concat('D', l_suppkey % 3, '.', l_linenumber) as code_value", f"{shipped} as first_seen", f"{shipped} + 3 as last_seen").distinct()
    segments = own.filter("l_orderkey % 3 <> 0").groupBy("l_orderkey", "l_linenumber", "o_custkey").agg(F.min("l_partkey").alias("p")).selectExpr("l_orderkey * 10 + l_linenumber as segment_id", "l_orderkey as limitation_id", "o_custkey as preparation_id", "l_linenumber as segment_order", "concat('n', p % 50) as indication_name_fr", "concat('a<br>', p) as segment_text_fr")
    packs_ = orders.filter("o_custkey % 5 <> 0").selectExpr("o_custkey as preparation_id", "o_orderkey as gtin", "concat('D', o_orderkey % 3) as bag_dossier_no", f"{month} as first_seen", f"{month} + 6 as last_seen")
    return {"preparations": customers.selectExpr("c_custkey as preparation_id", "c_name as name_de"), "limitations": lims, "codes": codes, "segments": segments, "packs": packs_, "extracts": spark.range(240, 480).selectExpr("cast(id as int) as extract_id", "concat('on ', id) as release_date")}


SQL_MONTH = "CAST((year({0}) - 1970) * 12 + month({0}) AS INTEGER)"
SQL_LISTED = f"""
WITH lim AS (SELECT o_orderkey AS limitation_id, o_custkey AS preparation_id, o_orderpriority AS limitation_code, o_orderstatus || ' a b' AS description_fr, {SQL_MONTH.format('o_orderdate')} AS first_seen, {SQL_MONTH.format('o_orderdate')} + CAST(o_orderkey % 24 AS INTEGER) AS last_seen FROM orders),
code AS (SELECT DISTINCT l_orderkey AS limitation_id, o_custkey AS preparation_id, 'D' || CAST(l_suppkey % 3 AS VARCHAR) AS bag_dossier_no, 'D' || CAST(l_suppkey % 3 AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS code_value, {SQL_MONTH.format('l_shipdate')} AS first_seen, {SQL_MONTH.format('l_shipdate')} + 3 AS last_seen FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
seg AS (SELECT l_orderkey * 10 + l_linenumber AS segment_id, l_orderkey AS limitation_id, o_custkey AS preparation_id, l_linenumber AS segment_order, 'n' || CAST(min(l_partkey) % 50 AS VARCHAR) AS indication_name_fr, 'a ' || CAST(min(l_partkey) AS VARCHAR) AS segment_text_fr FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 3 <> 0 GROUP BY l_orderkey, l_linenumber, o_custkey),
pk AS (SELECT o_custkey AS preparation_id, o_orderkey AS gtin, 'D' || CAST(o_orderkey % 3 AS VARCHAR) AS bag_dossier_no, {SQL_MONTH.format('o_orderdate')} AS first_seen, {SQL_MONTH.format('o_orderdate')} + 6 AS last_seen FROM orders WHERE o_custkey % 5 <> 0),
ex AS (SELECT range AS extract_id, 'on ' || CAST(range AS VARCHAR) AS release_date FROM range(240, 480))"""


@query(SQL_LISTED + """
SELECT c.limitation_id, c.code_value, split_part(c.code_value, '.', 2) AS indication_part, l.limitation_code, c_name AS product_name, pk.gtin, ec.release_date AS code_first_seen, el.release_date AS limitation_last_seen, ep.release_date AS pack_first_seen, ef.release_date AS effective_from, et.release_date AS effective_to
FROM code c JOIN lim l USING (limitation_id) JOIN customer ON c_custkey = c.preparation_id
LEFT JOIN pk ON pk.preparation_id = c.preparation_id AND pk.bag_dossier_no = c.bag_dossier_no AND pk.first_seen <= c.last_seen AND pk.last_seen >= c.first_seen
LEFT JOIN ex ec ON ec.extract_id = c.first_seen LEFT JOIN ex el ON el.extract_id = l.last_seen LEFT JOIN ex ep ON ep.extract_id = pk.first_seen
LEFT JOIN ex ef ON ef.extract_id = CASE WHEN pk.gtin IS NOT NULL THEN greatest(pk.first_seen, c.first_seen) END LEFT JOIN ex et ON et.extract_id = CASE WHEN pk.gtin IS NOT NULL THEN least(pk.last_seen, c.last_seen) END""")
def item_indications(spark, d):
    t = listed_tables(spark, d)
    out = exports.item_indications(t["codes"], t["limitations"].drop("description_fr"), t["preparations"].withColumnRenamed("name_de", "product_name"), t["packs"], t["extracts"])
    return out.select("limitation_id", "code_value", "indication_part", "limitation_code", "product_name", "gtin", "code_first_seen", "limitation_last_seen", "pack_first_seen", "effective_from", "effective_to")


@query(SQL_LISTED + "SELECT seg.segment_id, seg.segment_order, c_name AS product_name, limitation_code, indication_name_fr FROM seg JOIN lim USING (limitation_id) JOIN customer ON c_custkey = seg.preparation_id")
def segment_listing(spark, d):
    t = listed_tables(spark, d)
    return exports.segment_listing(t["segments"], t["limitations"], t["preparations"]).select("segment_id", "segment_order", "product_name", "limitation_code", "indication_name_fr")


@query(SQL_LISTED + """
SELECT 'segment' AS level, seg.segment_id AS id, c_name AS product_name, CAST(seg.segment_id % 7 AS INTEGER) AS rule FROM seg JOIN customer ON c_custkey = preparation_id WHERE seg.segment_id % 2 = 0
UNION ALL SELECT 'limitation', limitation_id, c_name, CAST(limitation_id % 7 AS INTEGER) FROM lim JOIN customer ON c_custkey = preparation_id WHERE limitation_id % 3 = 0""")
def rules_by_level(spark, d):
    t = listed_tables(spark, d)
    listed = exports.segment_listing(t["segments"], t["limitations"], t["preparations"])
    a = exports.segment_rules(listed.filter("segment_id % 2 = 0").selectExpr("segment_id", "cast(segment_id % 7 as int) as rule"), listed)
    b = exports.limitation_rules(t["limitations"].filter("limitation_id % 3 = 0").selectExpr("limitation_id", "cast(limitation_id % 7 as int) as rule"), t["limitations"], t["preparations"])
    return a.select(F.lit("segment").alias("level"), F.col("segment_id").alias("id"), "product_name", "rule").union(b.select(F.lit("limitation"), "limitation_id", "product_name", "rule"))


@query(SQL_LISTED + """
SELECT seg.segment_id, gtin, CAST(seg.segment_id % 4 = 0 AS INTEGER) AS has_cashback, segment_text_fr AS text, ep.release_date AS pack_from
FROM seg LEFT JOIN pk USING (preparation_id) LEFT JOIN ex ep ON ep.extract_id = pk.first_seen""")
def refund_analysis(spark, d):
    t = listed_tables(spark, d)
    segs = t["segments"].join(t["limitations"].select("limitation_id", "first_seen", "last_seen"), "limitation_id")
    out = exports.refund_analysis(segs, t["packs"], segs.filter("segment_id % 4 = 0").selectExpr("segment_id", "'percentage' as rule_calc_type"), t["extracts"])
    return out.select("segment_id", "gtin", "has_cashback", F.col("segment_text_fr").alias("text"), "pack_from")


@query(SQL_LISTED + """
SELECT limitation_id, gtin, 1 AS has_cashback, description_fr AS text, el.release_date AS limitation_from
FROM lim LEFT JOIN pk USING (preparation_id) LEFT JOIN ex el ON el.extract_id = lim.first_seen WHERE limitation_id % 2 = 0 AND limitation_id NOT IN (SELECT limitation_id FROM seg)""")
def unsegmented_analysis(spark, d):
    t = listed_tables(spark, d)
    out = exports.unsegmented_analysis(t["limitations"], t["segments"], t["packs"], t["limitations"].filter("limitation_id % 2 = 0").selectExpr("limitation_id", "'percentage' as rule_calc_type"), t["extracts"])
    return out.select("limitation_id", "gtin", "has_cashback", F.col("description_fr").alias("text"), "limitation_from")


@query("""
WITH r AS (SELECT doc_id, lang AS calc, CASE WHEN n_chars > 3000 THEN source END AS threshold, doc_id % 2 = 0 AS stop, doc_id % 3 = 0 AS adverse, CASE WHEN n_chars > 3000 THEN doc_id % 3 ELSE 0 END AS size, doc_id % 5 AS drugs FROM documents),
e AS (SELECT 'detected' AS kind, 'refund' AS name FROM r UNION ALL SELECT 'calc', calc FROM r UNION ALL SELECT 'with_threshold', 'any' FROM r WHERE threshold IS NOT NULL UNION ALL SELECT 'threshold', threshold FROM r WHERE threshold IS NOT NULL
  UNION ALL SELECT 'with_threshold', 'several' FROM r WHERE size > 1 UNION ALL SELECT 'condition', 'treatment_stop' FROM r WHERE stop UNION ALL SELECT 'condition', 'adverse_effects' FROM r WHERE adverse UNION ALL SELECT 'with_cotreatments', 'any' FROM r WHERE drugs > 0)
SELECT kind, name, count(*) AS n FROM e GROUP BY ALL""")
def refund_report(spark, d):
    rules_ = table(spark, d, "documents").selectExpr("lang as rule_calc_type", "case when n_chars > 3000 then source end as rule_threshold_type", "doc_id % 2 = 0 as cond_treatment_stop", "doc_id % 3 = 0 as cond_adverse_effects", "false as cond_treatment_failure",
                                                     "case when n_chars > 3000 then array_repeat('x', cast(doc_id % 3 as int)) else array() end as thresholds", "array_repeat('x', cast(doc_id % 5 as int)) as cotreatments")
    return reports.refund_report(rules_)


@query("""
SELECT doc_id AS text_id, CAST(a AS INTEGER) AS by_label, CAST(b AS INTEGER) AS by_rule FROM (SELECT doc_id, max(quality) AS a FROM labels GROUP BY 1) JOIN (SELECT doc_id, CAST(max(n_chars) > 1500 AS INTEGER) AS b FROM documents GROUP BY 1) USING (doc_id) WHERE a <> b""")
def disagreements(spark, d):
    return replies.disagreements(table(spark, d, "labels").selectExpr("doc_id as text_id", "quality = 1 as is_cashback"), table(spark, d, "documents").selectExpr("doc_id as text_id", "n_chars > 1500 as is_cashback"))


@query("""
SELECT conv_id AS text_id, count(*) AS n_segments, string_agg(role, ' | ' ORDER BY turn, role) AS names FROM conversations WHERE conv_id % 3 <> 0 GROUP BY 1 ORDER BY n_segments DESC, text_id LIMIT 10""")
def multi_indication_sample(spark, d):
    return replies.multi_indication_sample(table(spark, d, "conversations").selectExpr("conv_id as text_id", "turn as segment_order", "role as indication_name_fr", "conv_id % 3 <> 0 as is_multi_indication"))


@query("SELECT role AS cashback_calc_type, count(*) AS n FROM conversations WHERE turn % 2 = 0 GROUP BY 1")
def label_calculations(spark, d):
    return replies.label_calculations(table(spark, d, "conversations").selectExpr("role as cashback_calc_type", "turn % 2 = 0 as is_cashback"))


#: Texts with the name of a nation as it is, in other words, cut short, or none.
NATION_SAID = "case p_partkey % 4 when 0 then initcap(n_name) when 1 then concat('In ', lower(n_name), ' now') when 2 then substring(n_name, 1, 4) else concat('qx', p_partkey) end"


@query(f"""
WITH t AS (SELECT p_partkey, upper({NATION_SAID.replace('initcap(n_name)', 'lower(n_name)')}) AS a FROM part JOIN nation ON n_nationkey = p_partkey % 25),
c AS (SELECT p_partkey, n_name, CASE WHEN a = n_name THEN 1 WHEN length(a) >= 4 AND (contains(a, n_name) OR contains(n_name, a)) THEN 2 END AS level FROM t, nation)
SELECT p_partkey, arg_min(n_name, level || n_name) AS candidate, CAST(1 AS DOUBLE) AS score FROM c WHERE level IS NOT NULL GROUP BY 1""")
def best_candidate(spark, d):
    named = tables.dealt(table(spark, d, "part").select("p_partkey")).join(table(spark, d, "nation"), F.expr("n_nationkey = p_partkey % 25")).selectExpr("p_partkey", f"{NATION_SAID} as name")
    return matching.best_candidate(named, "p_partkey", "name", table(spark, d, "nation"), "n_name")


@query("SELECT doc_id AS id, n_name AS name FROM (SELECT doc_id, upper(coalesce(text || ' ', '') || 'x' || n_name || CASE WHEN doc_id % 3 = 0 THEN 's' ELSE '' END) AS t FROM documents JOIN nation ON n_nationkey = doc_id % 25) d, nation n WHERE contains(t, n_name)")
def contained_names(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "nation"), F.expr("n_nationkey = doc_id % 25")).select("doc_id", F.concat_ws(" ", "text", F.expr("concat('x', lower(n_name), case when doc_id % 3 = 0 then 's' else '' end)")).alias("text"))
    return refunds.contained_names(docs, "doc_id", "text", table(spark, d, "nation"), "n_name", "n_name").select("id", "name")


@query("""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Muster Pharma (Schweiz) AG' END AS company, doc_id % 4 = 1 AS no_refund, CASE doc_id % 4 WHEN 2 THEN ' rest ' || CAST(doc_id AS VARCHAR) END AS section,
  CASE doc_id % 4 WHEN 3 THEN '12345.67' END AS embedded, CASE WHEN doc_id % 4 = 3 THEN lang ELSE source END AS first_name, [CAST(doc_id AS VARCHAR)] AS structured FROM documents""")
def text_helpers(spark, d):
    docs = table(spark, d, "documents")
    said = F.expr("case doc_id % 4 when 0 then ' .. Muster Pharma (Schweiz) AG paie.' when 1 then ' garantie de remboursement' when 2 then concat('<u>Coûts thérapeutiques</u> rest ', doc_id) else '' end")
    whole = F.concat(F.coalesce("text", F.lit("")), said)
    codes = cd.structured_codes(F.expr("case when doc_id % 2 = 0 then array(' ', cast(doc_id as string)) end"), F.expr("array(concat(' ', doc_id, ' '))"))
    return docs.select(
        "doc_id", F.when(F.expr("doc_id % 4 = 0"), refunds.sentence_company(F.substring_index(whole, " .. ", -1))).alias("company"), refunds.no_refund_phrase(whole).alias("no_refund"), F.when(F.expr("doc_id % 4 = 2"), refunds.cost_section(whole)).alias("section"),
        tx.embedded_code(F.expr("case when doc_id % 4 = 3 then 'name 12345.67.' else 'name' end")).alias("embedded"), tx.first_filled(F.expr("case when doc_id % 4 = 3 then lang else '' end"), F.col("source")).alias("first_name"), codes.alias("structured"),
    )
