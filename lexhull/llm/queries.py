"""The opN_ queries over whole tables, and their DuckDB twins where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom_lm, byte_bpe, conversation_repair, hard_negatives, hilbert, html_text, language_id, line_dedup, near_duplicates, scaled_sketch, token_counts, vector_search, winnowing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha(text: Column) -> Column:
    return F.sha2(text, 256)


def id_remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(5) == 1
    out = bloom_lm.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", hex_sha(F.col("text")).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
flagged AS (
  SELECT k.doc_id, k.pos, k.line, f.first_doc IS NOT NULL AND k.doc_id > f.first_doc AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Every pair that shares a shingle is counted; components by repeated reach.
OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 75 * (na.n + nb.n - p.c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, t.b FROM reach r JOIN both_ways t ON r.other = t.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, r.component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""


def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        hex_sha(byte_bpe.token_text(F.col("token_ids"))).alias("ids_sha256"), hex_sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(3) == 1
    out = language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        hex_sha(F.array_join("items", ",")).alias("items_sha256"), winnowing.contaminated().alias("contaminated"),
    )


#: Windows as equal word lists; every document word carries the windows that start at it.
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = hilbert.hilbert_shards(docs, ["lang", "source", "size"], ["text_crc32", "doc_id"], n_shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 50 == 0, k=5)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.audit(conversation_repair.damaged(rows))
    every = rows.select("conv_id").distinct()
    met = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", hex_sha(F.lit(""))).alias("repaired_sha256"))


#: The checksum bit by bit; then, row by row, for each state the cheapest way as a string of its cost and edits, so that the least string is the best way.
OP11_SQL = r"""
WITH RECURSIVE ids AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
  FROM ids),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n
  FROM hurt),
faults AS MATERIALIZED (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY n) || ini AS two
  FROM placed),
steps AS MATERIALIZED (
  SELECT *, blank OR again AS must, NOT (blank OR again) AND right(bare, 1) NOT IN ('.', '!', '?') AS short FROM faults),
-- ways to each state: a string of five digits (the cost) and the edits, or null
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '00000' AS w0, CAST(NULL AS VARCHAR) AS w1, CAST(NULL AS VARCHAR) AS w2, CAST(NULL AS VARCHAR) AS w3 FROM (SELECT DISTINCT conv_id FROM steps)
  UNION ALL
  SELECT conv_id, n,
    list_min(list_transform(list_filter(opts, lambda o: o.t = 0), lambda o: o.w)), list_min(list_transform(list_filter(opts, lambda o: o.t = 1), lambda o: o.w)),
    list_min(list_transform(list_filter(opts, lambda o: o.t = 2), lambda o: o.w)), list_min(list_transform(list_filter(opts, lambda o: o.t = 3), lambda o: o.w))
  FROM (
    SELECT conv_id, n, list_transform(
      list_filter([
        {'f': w0, 't': 0, 'c': 3, 'e': 'D', 'ok': true}, {'f': w1, 't': 1, 'c': 3, 'e': 'D', 'ok': true}, {'f': w2, 't': 2, 'c': 3, 'e': 'D', 'ok': true}, {'f': w3, 't': 3, 'c': 3, 'e': 'D', 'ok': true},
        {'f': w0, 't': 1, 'c': 0 + x, 'e': 'K', 'ok': stays AND ini = 's'}, {'f': w0, 't': 2, 'c': 0 + x, 'e': 'K', 'ok': stays AND ini = 'u'}, {'f': w0, 't': 2, 'c': 2 + x, 'e': 'R', 'ok': stays},
        {'f': w0, 't': 3, 'c': 2 + x, 'e': 'IK', 'ok': stays AND ini = 'a'}, {'f': w0, 't': 3, 'c': 4 + x, 'e': 'IR', 'ok': stays}, {'f': w0, 't': 2, 'c': 4 + x, 'e': 'IIK', 'ok': stays AND ini = 'u'},
        {'f': w1, 't': 2, 'c': 0 + x, 'e': 'K', 'ok': stays AND ini = 'u'}, {'f': w1, 't': 2, 'c': 2 + x, 'e': 'R', 'ok': stays}, {'f': w1, 't': 3, 'c': 2 + x, 'e': 'IK', 'ok': stays AND ini = 'a'}, {'f': w1, 't': 3, 'c': 4 + x, 'e': 'IR', 'ok': stays},
        {'f': w2, 't': 3, 'c': 0 + x, 'e': 'K', 'ok': stays AND ini = 'a'}, {'f': w2, 't': 3, 'c': 2 + x, 'e': 'R', 'ok': stays}, {'f': w2, 't': 2, 'c': 2 + x, 'e': 'IK', 'ok': stays AND ini = 'u'}, {'f': w2, 't': 2, 'c': 4 + x, 'e': 'IR', 'ok': stays},
        {'f': w3, 't': 2, 'c': 0 + x, 'e': 'K', 'ok': stays AND ini = 'u'}, {'f': w3, 't': 2, 'c': 2 + x, 'e': 'R', 'ok': stays}, {'f': w3, 't': 3, 'c': 2 + x, 'e': 'IK', 'ok': stays AND ini = 'a'}, {'f': w3, 't': 3, 'c': 4 + x, 'e': 'IR', 'ok': stays}],
        lambda o: o.ok AND o.f IS NOT NULL),
      lambda o: {'t': o.t, 'w': lpad(CAST(CAST(left(o.f, 5) AS INTEGER) + o.c AS VARCHAR), 5, '0') || substr(o.f, 6) || o.e}) AS opts
    FROM (SELECT w.conv_id, s.n, w0, w1, w2, w3, NOT s.must AS stays, s.ini, CAST(s.short AS INTEGER) AS x FROM ways w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n + 1))),
ends AS (
  SELECT conv_id, list_min(list_filter([w0, w3,
           lpad(CAST(CAST(left(w2, 5) AS INTEGER) + 2 AS VARCHAR), 5, '0') || substr(w2, 6) || 'I', lpad(CAST(CAST(left(w1, 5) AS INTEGER) + 4 AS VARCHAR), 5, '0') || substr(w1, 6) || 'II'], lambda w: w IS NOT NULL)) AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) AS back FROM ways) WHERE back = 1),
edits AS (
  SELECT conv_id, e, i, sum(CAST(e <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY i) AS n
  FROM (SELECT conv_id, unnest(string_split(substr(w, 6), '')) AS e, generate_subscripts(string_split(substr(w, 6), ''), 1) AS i FROM ends)),
stay AS (
  SELECT d.conv_id, d.e, d.i, s.role, s.text, row_number() OVER (PARTITION BY d.conv_id ORDER BY d.i) AS j, max(CAST(d.e = 'K' AND s.ini = 's' AS INTEGER)) OVER (PARTITION BY d.conv_id) AS sys
  FROM edits d LEFT JOIN steps s ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.n = s.n AND d.e <> 'I' WHERE d.e IN ('K', 'R', 'I')),
text_of AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (j - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS sha
  FROM stay GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate,
         count(*) FILTER (WHERE short) AS truncated, count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM steps GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(CAST(left(w, 5) AS INTEGER), 0) AS BIGINT) AS cost, coalesce(substr(w, 6), '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN text_of t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")), lambda i: i % 100 == 0)


#: Every anchor meets every row.
OP12_SQL = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scaled_sketch.edited_and_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return made.select(
        "doc_id", "n_chars", hex_sha(F.col("edited")).alias("edited_sha256"), scaled_sketch.written(own).alias("fingerprint"), scaled_sketch.written(edited).alias("edited_fingerprint"),
        scaled_sketch.containment(own, edited).alias("near_edited"), scaled_sketch.containment(own, after).alias("near_next"),
        scaled_sketch.resemblance(own, edited).alias("resemblance_edited"), scaled_sketch.resemblance(own, after).alias("resemblance_next"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_line_dedup": op3_line_dedup,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_byte_level_bpe": op5_byte_level_bpe,
        "op6_language_id": op6_language_id,
        "op7_token_counts": op7_token_counts,
        "op8_benchmark_decontamination": op8_benchmark_decontamination,
        "op9_hilbert_sharding": op9_hilbert_sharding,
        "op10_nearest_neighbours": op10_nearest_neighbours,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_document_fingerprints": op13_document_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op4_near_duplicates": OP4_SQL, "op8_benchmark_decontamination": OP8_SQL, "op11_conversation_repair": OP11_SQL, "op12_hard_negatives": OP12_SQL}
