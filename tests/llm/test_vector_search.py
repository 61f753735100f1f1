import numpy as np
import pytest

from lexhull.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=10):
    good = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in good:
        if q % every == 0:
            s = sorted((-float((good[q] * v).sum() / (np.linalg.norm(good[q]) * np.linalg.norm(v))), i) for i, v in good.items() if i != q)[:k]
            out[q] = s
    return out


def test_finds_the_nearest_and_breaks_ties_by_id(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), None) for i in range(600)]
    rows += [(600 + i, rows[7][1], 1) for i in range(40)]  # one vector many times
    rows += [(700, None, 0), (710, [], 0), (720, [0.0] * 16, 0), (730, [float("nan")] * 16, 0), (740, [None] + [1.0] * 15, 0), (750, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in vector_search.nearest(df, lambda i: i % 10 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute([r for r in rows if r[0] != 750])
    assert set(got) == set(want)
    hit = 0
    for q, best in want.items():
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hit += len({i for i, _ in got[q].values()} & {i for _, i in best})
        for rank, (i, score) in got[q].items():
            assert score == pytest.approx(-best[rank - 1][0], abs=0.2)
    assert hit >= 0.9 * 5 * len(want)
    assert [got[600][k][0] for k in (1, 2, 3, 4, 5)] == [7, 601, 602, 603, 604]


def test_few_candidates_repeats_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (0, [1.0, 0.0], 1)], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in vector_search.nearest(df, lambda i: i % 10 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert vector_search.nearest(spark.createDataFrame([], SCHEMA), lambda i: i % 10 == 0).collect() == []
    assert vector_search.nearest(spark.createDataFrame([(0, None, 1)], SCHEMA), lambda i: i % 10 == 0).collect() == []


def test_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 64)
    monkeypatch.setattr(vector_search, "QUERIES", 8)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=24)).astype(np.float32).tolist(), 0) for i in range(1500)]
    got = {}
    for r in vector_search.nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 10 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows)
    assert sum(len(got[q] & {i for _, i in b}) for q, b in want.items()) >= 0.95 * 5 * len(want)
