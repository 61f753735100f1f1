"""Conversation repair, hard negatives and fingerprints beside plain versions, and on odd tables."""
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexhull.llm import conversation_repair as cr
from lexhull.llm import hard_negatives as hn
from lexhull.llm import scaled_sketch as sk

# ---- conversations

CONV = "conv_id long, turn long, role string, text string"


def plain_faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(cr.SPACE)
        out.append(cr.BLANK if not bare else cr.AGAIN if (role, text) in seen else cr.FINE if bare[-1] in ".!?" else cr.CUT)
        seen.add((role, text))
    return out


def plain_repair(rows, longest):
    """(cost, audit, messages) by trying every string of edits with at most `longest` inserts in a row."""
    faults, best = plain_faults(rows), None
    gaps = ["I" * n for n in range(longest + 1)]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for each in itertools.product("DKR", repeat=len(rows)):
            if any(e != "D" and f in (cr.BLANK, cr.AGAIN) for e, f in zip(each, faults)):
                continue
            # the role of what is made is all that can follow; both are tried
            cost = sum(len(i) * 2 for i in inserts) + sum({"D": 3, "K": 0, "R": 2}[e] + (e != "D" and f == cr.CUT) for e, f in zip(each, faults))
            edits = "".join(i + e for i, e in zip(inserts, each)) + inserts[-1]
            if best is not None and (cost, edits) >= best[:2]:
                continue
            waiting, made = iter(rows), []
            for e in edits:
                row = None if e == "I" else next(waiting)
                if e == "K":
                    made.append(row[1:])
                elif e != "D":
                    made.append(("assistant" if made and made[-1][0][:1] == "u" else "user", row[2] if row else ""))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or " " for r, _ in made)):
                best = (cost, edits, made)
    return best


def sorted_rows(rows):
    spaced = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    return sorted(spaced, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    out = {}
    for conv in [None, *range(40)]:
        n = rng.randrange(1, 6)
        out[conv] = [(conv, rng.choice([None, *range(6)]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", None]), rng.choice(["Yes.", "No", "Why?", " ", "", None, "Because!\n", "été…"])) for _ in range(n)]
    return out


def test_repair_equals_a_search_of_all_edits(spark, talks):
    df = spark.createDataFrame([r for rows in talks.values() for r in rows], CONV).repartition(5)
    got = {r["conv"]: r for r in cr.audit(df).collect()}
    said = {}
    for r in cr.repair(df).orderBy("conv", "place").collect():
        said.setdefault(r["conv"], []).append(r)
    for conv, rows in talks.items():
        own = sorted_rows(rows)
        cost, edits, made = plain_repair(own, 2 if len(own) < 4 else 1)
        r, faults = got[conv], plain_faults(own)
        assert (r["cost"], r["audit"]) == (cost, edits), own
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in made).encode()).hexdigest()
        assert [faults.count(k) for k in (cr.BLANK, cr.AGAIN, cr.CUT)] == [r["blank"], r["duplicate"], r["truncated"]]
        turns = {t for t, _, _ in own if t is not None}
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert r["illegal"] == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        assert "".join(x["edit"] for x in said.get(conv, [])) == edits
        assert [(x["role"], x["text"]) for x in said.get(conv, []) if x["edit"] != "D"] == made


def test_survivors_coalesce_in_a_long_conversation():
    rng = random.Random(3)
    search, given = cr.Search(), []
    for _ in range(20000):
        given += search.step(rng.choice("uas"), rng.choice((cr.FINE, cr.FINE, cr.CUT, cr.BLANK)))
    decided = sum(len(e.replace("I", "")) for e in given)
    assert search.most < 500 and decided > 19000
    given += search.finish()
    assert len("".join(given).replace("I", "")) == 20000
    # nothing leans on what has been given out
    assert search.root.parent is None


def test_order_of_ways_is_that_of_whole_strings():
    """Ranks give the same ties as whole strings do."""
    rng = random.Random(8)
    for _ in range(300):
        rows = [(rng.choice("uasx"), rng.choice((cr.FINE, cr.CUT, cr.AGAIN))) for _ in range(rng.randrange(1, 14))]
        search = cr.Search()
        given = [e for row in rows for e in search.step(*row)]
        given += search.finish()
        ways = {cr.START: (0, "")}
        for row in rows:
            new = {}
            for s, (cost, edits) in ways.items():
                for to, more, c in cr.moves(*row)[s]:
                    new[to] = min(new.get(to, (10**9, "")), (cost + c, edits + more))
            ways = new
        assert (search.cost, "".join(given)) == min((c + 2 * len(cr.LAST[s]), e + cr.LAST[s]) for s, (c, e) in ways.items())


def test_repair_of_odd_tables(spark):
    assert cr.audit(spark.createDataFrame([], CONV)).collect() == cr.repair(spark.createDataFrame([], CONV)).collect() == []
    long = "word " * 50000 + "."
    rows = [(1, 0, "user", long, 1, "x"), (1, 1, "assistant", "Yes.", 1, "x"), (1, 1, "assistant", "Yes.", 1, "x"), (2, None, None, None, 1, "x")]
    df = spark.createDataFrame(rows, CONV + ", place int, edit string")
    got = {r["conv"]: r for r in cr.audit(df).collect()}
    assert (got[1]["audit"], got[1]["duplicate"], got[2]["audit"], got[2]["blank"], got[2]["gaps"]) == ("KKD", 1, "D", 1, 0)
    assert got[1]["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:Yes.".encode()).hexdigest()
    assert cr.damaged(spark.createDataFrame([], CONV)).collect() == []


# ---- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows, every, k=5):
    once = {}
    for i, v, y in rows:
        if i is None or y is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        own = (y, len(v), [int(np.floor(256 * float(np.float32(x)))) for x in v])
        packed = lambda r: (r[0], r[1], np.array(r[2], np.int64).tobytes())
        once[i] = min(once.get(i, own), own, key=packed)
    sizes = [n for _, n, _ in once.values()]
    dim = max(set(sizes), key=lambda n: (sizes.count(n), -n)) if sizes else 0
    once = {i: (y, v) for i, (y, n, v) in once.items() if n == dim}
    out = []
    for a, (y, v) in once.items():
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v, w)) for i, (_, w) in once.items() if i != a}
        for p in sorted((i for i in score if once[i][0] == y), key=lambda i: (-score[i], i))[:k]:
            near = sorted((i for i in score if once[i][0] != y and 80 * score[p] <= 100 * score[i] <= 100 * score[p]), key=lambda i: (-score[i], i))[:k]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(near)]
    return sorted(out)


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("block, dim", [(4096, 8), (64, 24)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, dim):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "ANCHORS", 16)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(500)]
    rows += [(500 + i, rows[20][1], i % 3) for i in range(40)]  # one vector many times, so ties
    rows += [(600, [0.0] * dim, 1), (610, None, 1), (620, [], 1), (630, [None] * dim, 1), (640, [float("nan")] * dim, 1), (650, [1.0], 1), (660, [1.0] * dim, None), (None, [1.0] * dim, 1), (670, [1e30] * dim, 1)]
    rows += [rows[0], rows[0], (20, [2.0] * dim, 9)]  # repeated rows, and an id with two vectors
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], VECTORS + ", rank int, score string").repartition(4)
    got = sorted(tuple(r[c] for c in NEGATIVES) for r in hn.mine(df, lambda i: i % 10 == 0).collect())
    want = plain_negatives([r for r in rows if r[0] != 670], 10)
    assert got == want and len(want) > 200


def test_intervals_hold_the_product_and_leave_rows_out():
    rng = np.random.default_rng(6)
    to = hn.isometry(64)
    assert np.allclose(to @ to.T, np.eye(64))
    centres = rng.normal(size=(20, 64)) * 300
    x = np.concatenate([np.rint(centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 64)) * 40), np.zeros((2, 64)), np.full((2, 64), 10**7)]).astype(np.int64)
    codes, rows = hn.Codes(x, to), np.arange(len(x))
    for q in [*x[:40], x[1500], x[1502]]:
        low, high = codes.interval(q, to, rows)
        exact = np.array([sum(int(a) * int(b) for a, b in zip(q, v)) for v in x], float)
        assert (low <= exact).all() and (exact <= high).all()
    table = hn.pa.table({"id": np.arange(1500), "label": np.zeros(1500, np.int64), "vec": [v.tobytes() for v in x[:1500]]})
    held = hn.Held(table, 64)
    for i in range(50):
        held.positives(i, 0, x[i], 5)
    assert held.scored < 0.25 * 50 * 1500


def test_large_components_are_scored_exactly():
    rng = np.random.default_rng(7)
    x = rng.integers(-(2**29), 2**29, (300, 4))
    held = hn.Held(hn.pa.table({"id": np.arange(300), "label": np.zeros(300, np.int64), "vec": [v.tobytes() for v in x]}), 4)
    ids, scores = held.positives(0, 0, x[0], 5)
    exact = sorted(((sum(int(a) * int(b) for a, b in zip(x[0], x[i])), -i) for i in range(1, 300)), reverse=True)[:5]
    assert list(zip(scores.tolist(), (-ids).tolist())) == exact


def test_negatives_of_odd_tables(spark):
    assert hn.mine(spark.createDataFrame([], VECTORS), lambda i: i % 10 == 0).collect() == []
    assert hn.mine(spark.createDataFrame([(0, [1.0], 1)], VECTORS), lambda i: i % 10 == 0).collect() == []
    assert hn.mine(spark.createDataFrame([(None, None, None)], VECTORS), lambda i: i % 10 == 0).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 5.0], 2), (3, [0.5, 5.0], 2)], VECTORS)
    assert [tuple(r[c] for c in NEGATIVES) for r in hn.mine(few, lambda i: i % 10 == 0).collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]


# ---- fingerprints

def plain_sets(text, n=5):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text.lower()) if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.fixture(scope="module")
def fingerprinted(spark, docs):
    return {r["doc_id"]: r for r in sk.edited_and_next(docs).withColumns({
        "c": sk.containment(F.col("sketch"), F.col("edited_sketch")), "d": sk.resemblance(F.col("sketch"), F.col("edited_sketch")), "print": sk.written(F.col("sketch")), "after": sk.containment(F.col("sketch"), F.col("next_sketch"))}).collect()}


def test_edited_and_next_documents(docs, fingerprinted):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    errors = []
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        third, r = len(text) // 3, fingerprinted[i]
        assert (r["n_chars"], r["edited"]) == (len(text), text[: len(text) - third] + after[:third])
        own, edited, next_ = plain_sets(text), plain_sets(r["edited"]), plain_sets(after)
        if own:
            errors.append(abs(r["c"] - len(own & edited) / len(own)))
            assert r["after"] == 1.0 if own <= next_ else r["after"] <= 1
        if len(own) > 1000:
            assert abs(r["c"] - len(own & edited) / len(own)) < 0.1 and abs(r["d"] - len(own & edited) / len(own | edited)) < 0.1
            assert abs(len(r["sketch"]) / len(own) - 2.0**-sk.SCALE) < 0.05
        assert (len(r["sketch"]) > 0) == bool(own) and r["sketch"] == sorted(set(r["sketch"]))
    assert np.mean(errors) < 0.25
    prints = {}
    for i, text in rows:
        assert prints.setdefault(text, fingerprinted[i]["print"]) == fingerprinted[i]["print"]


def test_sketches_merge(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(900)}" for _ in range(4000)]
    # the parts overlap by four words, so that no shingle of the whole is lost
    whole, parts = " ".join(words), [" ".join(words[:2004]), " ".join(words[2000:])]
    df = spark.createDataFrame([(whole, *parts)], "w string, a string, b string")
    r = df.select(sk.sketch(F.col("w")).alias("w"), sk.merged(sk.sketch(F.col("a")), sk.sketch(F.col("b"))).alias("m"), sk.containment(sk.sketch(F.col("a")), sk.sketch(F.col("w"))).alias("c"), sk.sketch(F.lit("one two")).alias("s")).withColumn("t", sk.merged(F.col("s"), F.col("w"))).first()
    assert r["w"] == r["m"] and r["c"] == 1.0 and len(r["s"]) == 1
    assert set(r["t"]) - set(r["s"]) == set(r["w"]) - set(r["s"])


def test_fingerprints_of_odd_tables(spark):
    schema = "doc_id long, text string, sketch string, i int, k int"
    assert sk.edited_and_next(spark.createDataFrame([], schema)).collect() == []
    alone = sk.edited_and_next(spark.createDataFrame([(4, "abcdef", "x", 1, 1)], schema)).first()
    assert (alone["n_chars"], alone["edited"]) == (6, "abcdab")
    rows = [(None, None), (None, "null id"), (0, "zero id"), (3, "abc"), (3, "abc"), (3, "xyz xyz"), (5, ""), (-9, " \n"), (7, "é" * 9)]
    got = sk.edited_and_next(spark.createDataFrame([(*r, "x", 1, 1) for r in rows], schema).repartition(3)).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)
    by = {(r["doc_id"], r["n_chars"]): r["edited"] for r in got}
    assert by[7, 9] == "é" * 6 and by[5, 0] == "" and by[0, 7] == "zero  \n"
    both = [r for r in got if r["doc_id"] == 3 and r["n_chars"] == 3]
    assert len(both) == 2 and both[0] == both[1]
    out = sk.fingerprints(spark.createDataFrame([(1, None, "x", 1, 1), (1, None, "x", 1, 1)], schema)).collect()
    assert [r["sketch"] for r in out] == [[], []]
