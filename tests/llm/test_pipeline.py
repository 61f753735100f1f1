"""Each stage of the corpus pipeline on its own input, beside a plain version, and the whole of it."""
import hashlib
from collections import defaultdict

import corpus_pipeline as cp
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_text_operators import ALNUM, LOWER, RANKS, components_of, sets

from lexhull.llm import language_id

EXTRA = "score string, lang_pred int, n_lines string, n_dropped int, token_ids string, decoded int, kept string, row_hash string, id string, key string"


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    some = [r["text"] for r in docs.collect() if r["text"] and len(r["text"]) > 300][:4]
    spark.createDataFrame([(i, t[40:300]) for i, t in enumerate(some)] + [(8, None), (9, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def language_plain(rows, told):
    """Of rows (id, text, lang, ...), those with a letter and a sure language; told: id to (language, score)."""
    return [(i, t, lang or told[i][0], *rest) for i, t, lang, *rest in rows if t and any(c.isalpha() for c in t) and told[i][1] >= cp.LEAST_SCORE]


def lines_plain(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first = defaultdict(lambda: 1 << 60)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            first[key(x)] = min(first[key(x)], i)
    out = []
    for i, t, lang, source, _ in rows:
        text = "\n".join(x for x in (t or "").split("\n") if len(key(x)) < 10 or first[key(x)] == i)
        out.append((i, text, lang, source, len(text)))
    return out


def copies_plain(spark, rows):
    label = components_of(sets(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")))
    return [r for r in rows if label[r[0]] == r[0]]


def overlap_plain(rows, items):
    wins = set()
    for t in items:
        w = ALNUM((t or "").translate(LOWER))
        wins |= {tuple(w[s : s + min(13, len(w))]) for s in range(max(1, len(w) - 12))} if w else set()
    out = []
    for r in rows:
        w, hit = ALNUM((r[1] or "").translate(LOWER)), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    hit |= set(range(s, s + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def tokens_plain(rows):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [(i, lang, source, len(ids), ids, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, lang, source, _ in rows for ids in [enc.encode_ordinary(t or "")]]


def test_whole_pipeline_matches_a_plain_one(spark, docs, sf_dir):
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(False))).collect()}
    rows = [tuple(r) for r in docs.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    sizes = [len(rows)]
    stages = [lambda x: language_plain(x, told), lines_plain, lambda x: copies_plain(spark, x), lambda x: overlap_plain(x, items), tokens_plain]
    for stage in stages:
        rows = stage(rows)
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] == sizes[5]  # every filter takes something
    assert held(cp.run(spark, sf_dir)) == sorted(rows, key=str)


@pytest.mark.parametrize("at", range(len(cp.STAGES)))
def test_stage_on_odd_rows(spark, sf_dir, at):
    """Nulls in any column, repeated rows, a very long text, columns named as an operator's own, and no rows."""
    long = "wort wörter satz " * 20000
    rows = [(1, "Ein Satz mit Worten für alle\nund noch mehr", "de", "a", 3), (1, "Ein Satz mit Worten für alle\nund noch mehr", "de", "a", 3), (2, None, "de", None, None), (3, "", None, "a", 0), (None, "Ein anderer Satz steht hier", "de", "b", 1), (4, long, None, "b", len(long)), (5, " \n\t", "de", "c", 3), (None, None, None, None, None)]
    df = spark.createDataFrame([(*r, "s", 1, "x", 2, "y", 3, "z", "h", "i", "k") for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")
    out = cp.STAGES[at][1](spark, df, sf_dir)
    got = out.collect()
    empty = cp.STAGES[at][1](spark, df.limit(0), sf_dir)
    assert empty.count() == 0 and empty.columns == out.columns
    ids = sorted(str(r["doc_id"]) for r in got)
    if cp.STAGES[at][0] == "language_id":
        assert ids == ["1", "1", "4", "None"] and {r["lang"] for r in got} == {"de"}
    else:
        assert ids == sorted(str(r[0]) for r in rows)
    if at < len(cp.STAGES) - 1:
        assert out.columns == df.columns and all(r["score"] == "s" and r["n_lines"] == "x" and r["token_ids"] == "y" for r in got)
    if cp.STAGES[at][0] == "line_dedup":
        assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_nothing_learnt_leaves_nothing(spark, sf_dir):
    df = spark.createDataFrame([(1, "Ein Satz", None, "a", 8)], "doc_id long, text string, lang string, source string, n_chars long")
    assert cp.language(spark, df, sf_dir).count() == 0
