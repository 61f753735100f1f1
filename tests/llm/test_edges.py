"""Empty tables, repeated rows, null ids and clashing columns, for every operator on documents."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexhull.llm import bloom_lm, byte_bpe, hilbert, html_text, language_id, line_dedup, near_duplicates, token_counts, vector_search, winnowing

RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (None, "some other words")]


def run(name, df):
    items = df.sparkSession.createDataFrame(ITEMS, "item_id long, text string")
    return {
        "lm": lambda: bloom_lm.score_documents(df, F.lit(True)),
        "lines": lambda: line_dedup.dedup_lines(df),
        "near": lambda: near_duplicates.near_duplicates(df),
        "bpe": lambda: byte_bpe.round_trip(df, RANKS, public_tokenizers.PATTERN),
        "language": lambda: language_id.identify(df, F.lit(True)),
        "counts": lambda: token_counts.count_tokens(df, PIECES),
        "winnow": lambda: winnowing.contamination(df, items),
        "clean": lambda: winnowing.decontaminate(df, items),
        "hilbert": lambda: hilbert.hilbert_shards(df, ["lang", "n_chars"], ["doc_id"]),
        "html": lambda: html_text.extract_text(df.withColumn("html", F.col("text")).drop("text")),
    }[name]()


NAMES = ["lm", "lines", "near", "bpe", "language", "counts", "winnow", "clean", "hilbert", "html"]
CLASH = "doc_id long, text string, lang string, n_chars long, n_lines long, n_dropped string, kept string, component_id string, token_ids string, decoded string, lang_pred int, score string, n_tokens string, shard string, slot string, curve string, id string, key string, blocks string, _gone string"


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert run(name, spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_nulls_repeats_and_clashing_columns(spark, name):
    long = "wort " * 30000
    base = [(1, "same text here for all to see\nand more", "en", 3), (1, "same text here for all to see\nand more", "en", 3), (2, "same text here for all to see\nand more", None, None), (None, "same text here for all to see", "fr", 1), (None, None, None, None), (4, None, "en", 0), (5, "", "en", 0), (6, long, "de", len(long))]
    df = spark.createDataFrame([(*r, 7, *["9"] * 5, 7, *["9"] * 9) for r in base], CLASH)
    out = run(name, df)
    got = out.collect()
    assert len(got) == len(base) and len(out.columns) == len({c.lower() for c in out.columns})
    if name == "near":
        by = {(r["doc_id"]): r for r in got}
        assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[1]["kept"] and not by[2]["kept"]
        assert by[None]["component_id"] is None and by[None]["kept"] and by[4]["component_id"] == 4
    if name == "lines":
        assert sorted((r["doc_id"], r["n_dropped"]) for r in got if r["doc_id"] in (1, 2)) == [(1, 0), (1, 0), (2, 1)]
        assert all(r["text"] == "" and r["n_lines"] == 1 for r in got if r["doc_id"] in (4, 5))
    if name == "lm":
        assert all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (4, 5)) and len({r["base_score"] for r in got if r["doc_id"] in (1, 2)}) == 1


def test_one_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (3, a), (3, b), (5, b), (8, "other words of no kin at all")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df).collect()} == {1: 1, 3: 1, 5: 1, 8: 8}


def test_no_benchmark(spark):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    got = winnowing.contamination(df, spark.createDataFrame([], "item_id long, text string")).collect()
    assert [(r["n_hit"], r["items"]) for r in got] == [(0, []), (0, [])]


def test_vectors_in_a_table_with_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, query_id string, rank string, score string, id string, vec string, cell string, block string, share string, label int"
    empty = spark.createDataFrame([], schema)
    assert vector_search.nearest(empty, lambda i: i % 2 == 0).collect() == []
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*v, *["9"] * 8, 7) for v in vectors], schema)
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in vector_search.nearest(df, lambda i: i % 2 == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 0.894427), (0, 2, 2, 0.0), (2, 1, 1, 0.447214), (2, 2, 0, 0.0)]
