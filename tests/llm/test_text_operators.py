"""The text operators against plain versions of what they compute."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexhull.llm import bloom_lm, byte_bpe, hilbert, html_text, language_id, line_dedup, near_duplicates, textbytes, token_counts, winnowing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x20\x09-\x0d]+").findall
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_line_dedup_matches_brute_force(docs):
    own = {r["doc_id"]: (r["text"] or "").split("\n") for r in docs.collect()}
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, lines in own.items():
        for x in lines:
            holders[key(x)].add(i)
    got = rows(line_dedup.dedup_lines(docs))
    assert len(got) == len(own)
    for i, lines in own.items():
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == i]
        assert (got[i]["text"], got[i]["n_lines"], got[i]["n_dropped"]) == ("\n".join(kept), len(lines), len(lines) - len(kept))
    assert sum(r["n_dropped"] for r in got.values()) > 50


def sets(docs):
    out = {}
    for r in docs.collect():
        w = WORDS((r["text"] or "").translate(LOWER))
        out[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def components_of(own):
    """Smallest id reachable over links of 75 of 100, by comparing all pairs."""
    links, label = defaultdict(set), {}
    for i, x in own.items():
        for j, y in own.items():
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                links[i].add(j)
    for i in sorted(own):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in label:
                label[k] = i
                todo += links[k]
    return label


def test_near_duplicates_match_brute_force(docs):
    own = sets(docs)
    label = components_of(own)
    got = rows(near_duplicates.near_duplicates(docs))
    assert {i: (len(own[i]), label[i], label[i] == i) for i in own} == {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()}
    assert len(set(label.values())) < len(own) - 10  # the fixture holds links at all


def test_large_buckets_are_split_and_starred(spark):
    """More copies of one text, each with a word of its own, than a bucket pairs out, and the text itself."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base)] + [" ".join([*base[: k % 60], f"new{k}", *base[k % 60 + 1 :]]) for k in range(300)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["component_id"] for r in got.collect()} == {0}


def test_large_group_without_its_template_matches_brute_force(spark):
    """Copies of a text that isn't there itself, each with three words of its own."""
    rng, texts = random.Random(1), []
    for k in range(500):
        copy = [f"w{i}" for i in range(120)]
        for j, at in enumerate(rng.sample(range(0, 120, 6), 3)):
            copy[at] = f"n{k}x{j}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own, want = sets(df), {}
    for i in sorted(own):
        found = {want[j] for j in want if 100 * len(own[i] & own[j]) >= 75 * len(own[i] | own[j])}
        want[i] = min(found, default=i)
        want = {j: want[i] if c in found else c for j, c in want.items()}
    got = near_duplicates.near_duplicates(df)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want and len(set(want.values())) < 100


def test_clusters_whose_common_text_is_linked_to_none(spark):
    """Several clusters around one common text that is itself too far from all of them, and pairs that just miss or just make it."""
    rng, texts = random.Random(2), ["c" + " c".join(str(i) for i in range(100))]
    for k in range(12):
        head = [f"c{i}" for i in range(62)] + [f"k{k}w{i}" for i in range(38)]
        for m in range(14):
            own = list(head)
            for j, at in enumerate(rng.sample(range(0, 100, 5), rng.randrange(0, 4))):
                own[at] = f"n{k}m{m}x{j}"
            texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = components_of(sets(df))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df).collect()}
    assert got == want and 12 <= len(set(want.values())) < 100 and want[0] == 0 and list(want.values()).count(0) == 1


def test_contamination_matches_brute_force(spark, docs):
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    some = [t for t in own.values() if t and len(t) > 200][:6]
    items = [(k, " ".join(ALNUM(t.translate(LOWER))[3 : 3 + n])) for k, (t, n) in enumerate(zip(some, (40, 25, 13, 12, 3, 20)))] + [(90, None), (91, ""), (92, "nothing of the kind at all"), (93, "aa aa"), (10, "Aa")]
    wins = defaultdict(set)
    for k, t in items:
        w = ALNUM((t or "").translate(LOWER))
        for s in range(max(0, len(w) - 12) if len(w) >= 13 else 1 if w else 0):
            wins[tuple(w[s : s + min(13, len(w))])].add(str(k))
    got = rows(winnowing.contamination(docs, spark.createDataFrame(items, "item_id long, text string")))
    hits = 0
    for i, t in own.items():
        w = ALNUM((t or "").translate(LOWER))
        at, which = set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    at |= set(range(s, s + n))
                    which |= wins[tuple(w[s : s + n])]
        hits += bool(at)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(w), len(at), sorted(which))
    assert hits > 5


def test_decontaminate_drops_only_contaminated(spark, docs):
    passage = next(r["text"] for r in docs.collect() if r["text"] and len(r["text"]) > 300)
    left = winnowing.decontaminate(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    flags = rows(winnowing.contamination(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).withColumn("bad", winnowing.contaminated()))
    assert {r["doc_id"] for r in left.collect()} == {i for i, r in flags.items() if not r["bad"]} and left.columns == docs.columns


def test_bpe_equals_tiktoken_and_decodes(docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    made = byte_bpe.round_trip(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    for r in made.collect():
        assert r["token_ids"] == enc.encode_ordinary(own[r["doc_id"]]) and bytes(r["decoded"]) == own[r["doc_id"]].encode()
    again = byte_bpe.decode_ids(made.select("doc_id", "token_ids"), RANKS)
    assert all(bytes(r["decoded"]) == own[r["doc_id"]].encode() for r in again.collect())


def test_merges_of_lower_rank_in_between():
    """A merge that makes a pair of lower rank than itself, while another place of the word waits."""
    vocab = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab"]
    merges = byte_bpe.Merges(vocab)
    words = [b"ab", b"abcab", b"abab", b"bcabc", b"aabbc", b"", b"ababcab"]
    tokens, count = byte_bpe.replay(words, merges)
    at = 0
    for w, n in zip(words, count.tolist()):
        assert tokens[at : at + n].tolist() == merges.one(w)
        at += n


def test_token_counts_equal_the_unigram_tokenizer(docs):
    from tokenizers import Tokenizer, models, normalizers

    pieces = token_counts.read_pieces(PIECES)
    tok = Tokenizer(models.Unigram([(p or f"control{i}", s) for i, (p, s) in enumerate(pieces)], 0, True))
    tok.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    got = rows(token_counts.count_tokens(docs.select("doc_id", "text"), PIECES))
    for r in docs.collect():
        assert got[r["doc_id"]]["n_tokens"] == len(tok.encode(r["text"] or "", add_special_tokens=False).ids)


def test_token_count_ties():
    """Equal sums: the piece that starts further left stays; without byte pieces, unknown stretches count one."""
    counter = token_counts.Counter([("", 0.0), ("▁a", -1.0), ("b", -1.0), ("▁", -1.0), ("ab", -1.0), ("a", -1.0)])
    assert counter.count("ab") == 2 and counter.count("") == 0 and counter.count("a??b") == 3


def test_lm_baseline_is_exact_and_model_predicts(docs):
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    own = {r["doc_id"]: WORDS((r["text"] or "").translate(LOWER)) + [None] for r in docs.collect()}
    count = Counter(w for i, ws in own.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    got = rows(bloom_lm.score_documents(docs, train))
    assert len(got) == len(own)
    for i, ws in own.items():
        base = sum(math.log10((count.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    seen = [i for i in own if zlib.crc32(str(i).encode()) % 5 != 1]
    assert sum(got[i]["score"] for i in seen) > sum(got[i]["base_score"] for i in seen)


def test_lm_score_is_the_formula_over_quantised_counts(docs, monkeypatch):
    """With a filter so large that keys don't collide, broadcast and in slices, beside a plain version."""
    monkeypatch.setattr(bloom_lm, "KEY_BITS", 400)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    own = {r["doc_id"]: WORDS((r["text"] or "").translate(LOWER)) + [None] for r in docs.collect()}
    taught = [ws for i, ws in own.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    one, two = Counter(w for ws in taught for w in ws), Counter(x for ws in taught for x in zip(ws, ws[1:]))
    whole = one.total() + 0.5 * (len(one) + 1)
    quant = lambda c: 0.0 if c == 0 else 1.0 if c == 1 else 1.5 * 2 ** (c.bit_length() - 1) - 0.5
    want = {}
    for i, ws in own.items():
        total = 0.0
        for h, w in zip([None, *ws], ws):
            p = min((quant(one[w]) + 0.5) / whole, 1.0)
            if h is not None:
                ch = quant(one[h])
                spread = max(ch, 1.0) ** bloom_lm.FOLLOWERS
                p = min((min(quant(two[h, w]), ch, quant(one[w])) + spread * p) / (ch + spread), 1.0)
            total += math.log10(p)
        want[i] = total
    for bits in (bloom_lm.BROADCAST_BITS, 0):
        monkeypatch.setattr(bloom_lm, "BROADCAST_BITS", bits)
        got = rows(bloom_lm.score_documents(docs, train))
        assert {i: r["score"] for i, r in got.items()} == pytest.approx(want, rel=1e-9)
        assert all(r["n_known"] == sum(w in one for w in own[i]) for i, r in got.items())


def test_lm_levels_come_back_from_the_filter():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    counts = rng.integers(1, 500, len(hashes))
    table = pa.table({"bucket": pa.array([0]), "kind": pa.array([1], pa.int32()), "hashes": [hashes.tobytes()], "counts": [bloom_lm.narrow(counts)]})
    made = bloom_lm.merge_bucket(table).to_pylist()[0]
    assert bloom_lm.wide(made["counts"], made["v"]).tolist() == counts.tolist() and made["n"] == counts.sum()
    model = bloom_lm.Levels(np.array([made["top"]]), np.array([len(made["bits"])]), np.frombuffer(made["bits"], np.uint8))
    back, real = model.levels(hashes), bloom_lm.levels(counts)
    assert (back >= real).all() and (back == real).mean() > 0.98
    others = model.levels(textbytes.mix(hashes + np.uint64(12345)))
    assert (others > 0).mean() < 0.03 and others.max() <= made["top"]
    # a filter whose bits are all set still ends
    full = bloom_lm.Levels(np.array([made["top"]]), np.array([64]), np.full(64, 255, np.uint8))
    assert set(full.levels(hashes).tolist()) == {made["top"]}


def test_lm_buckets_answer_a_batch_at_once(monkeypatch):
    """Groups and buckets are many, so a pair of these exchanges one row, no row is answered on its own, and answers lie beside what was asked."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rng, groups, buckets = random.Random(8), 200, 7
    texts = [" ".join(str(rng.randrange(300)) for _ in range(60)) for _ in range(groups)]
    rows = pa.RecordBatch.from_pydict({"group": list(range(groups)), "id": list(range(groups)), "text": texts})
    asked = pa.Table.from_batches(bloom_lm.ask(buckets, True)(iter([rows])))
    assert asked.num_rows <= groups * buckets
    counts = pa.Table.from_batches(bloom_lm.packed_counts(buckets)(iter([pa.RecordBatch.from_pydict({"text": texts[: groups // 2]})])))
    merged = pa.concat_tables([bloom_lm.merge_bucket(counts.filter(pc.equal(counts.column("bucket"), b))) for b in range(buckets)])
    none = lambda n, kind: pa.nulls(n, kind)
    columns = asked.schema.names + ["counts", "top", "bits"]
    n = asked.num_rows
    own = pa.table([merged.column("bucket"), none(buckets, pa.int64()), merged.column("hashes"), none(buckets, pa.binary()), *(merged.column(c) for c in columns[-3:])], names=columns)
    meeting = pa.concat_tables([own, pa.table([*asked.columns, none(n, pa.binary()), none(n, pa.int32()), none(n, pa.binary())], names=columns)])
    meeting = meeting.take(np.lexsort((meeting.column("group").is_valid().to_numpy(), meeting.column("bucket").to_numpy())))
    calls, levels = [], bloom_lm.Levels.levels
    monkeypatch.setattr(bloom_lm.Levels, "levels", lambda self, hashes: calls.append(len(hashes)) or levels(self, hashes))
    batches = meeting.combine_chunks().to_batches(500)
    answers = pa.Table.from_batches(bloom_lm.answer(True)(iter(batches)))
    assert answers.num_rows == n and len(calls) <= 2 * (buckets + len(batches))
    size = np.array([len(b) for b in merged.column("bits").to_pylist()])
    model = bloom_lm.Levels(merged.column("top").to_numpy(), size, np.frombuffer(b"".join(merged.column("bits").to_pylist()), np.uint8))
    known = Counter(w for t in texts[: groups // 2] for w in [*t.split(), None])
    for group in (0, groups - 1):
        hashes, _, _, pairs = bloom_lm.piece_tokens(pa.array([texts[group]]))
        told = answers.filter(pc.equal(answers.column("group"), group)).sort_by("bucket")
        for column, grams in (("words", hashes), ("pairs", pairs)):
            assert list(b"".join(told.column(column).to_pylist())) == levels(model, np.unique(grams)).tolist()
        exact = np.concatenate([bloom_lm.wide(c, k) for c, k in zip(told.column("counts").to_pylist(), told.column("asked").to_pylist())])
        assert sorted(exact.tolist()) == sorted(known[w] for w in {*texts[group].split(), None})


def test_counts_beyond_32_bits():
    import numpy as np

    for most in (1, 255, 256, 1 << 20, (1 << 32) + 5):
        assert bloom_lm.wide(bloom_lm.narrow(np.array([1, most])), 2).tolist() == [1, most]


def test_hash_tells_regular_words_apart():
    """A word of the Thue-Morse sequence and its complement, which a polynomial modulo 2**64 alone takes for one."""
    import pyarrow as pa

    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    data, offsets = textbytes.column_bytes(pa.array([f"{word} {word.translate(str.maketrans('ab', 'ba'))} {word.upper()}"]))
    one, other, upper = textbytes.span_hashes(data, *textbytes.words(data, offsets)[:2]).tolist()
    assert one == upper != other


def test_language_id_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    out = language_id.identify(docs, rest != 1).filter(rest == 1)
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert r["right"] > 0.97 and 0 <= r["low"] <= r["high"] <= 1


def test_language_id_without_letters(docs):
    got = rows(language_id.identify(docs, F.lit(True)))
    for r in docs.collect():
        blank = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (got[r["doc_id"]]["lang_pred"] == "und") == blank
    assert {r["lang_pred"] for r in language_id.identify(docs, F.lit(False)).collect()} == {"und"}


def test_hilbert_curve_visits_every_cell_by_single_steps(spark):
    for n, bits in ((2, 3), (3, 2)):
        cells = spark.range(1 << (n * bits)).select(*[(F.shiftright("id", bits * i) % (1 << bits)).alias(f"x{i}") for i in range(n)])
        path = sorted(tuple(r) for r in cells.select(hilbert.curve_index([F.col(f"x{i}") for i in range(n)], bits), "*").collect())
        assert [p[0] for p in path] == list(range(1 << (n * bits)))
        assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(path, path[1:]))


def plain_curve(cell, bits):
    """Position on the Hilbert curve by the textbook's loops over bits and axes."""
    x, n, q = list(cell), len(cell), 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        t, q = t ^ (q - 1) if x[-1] & q else t, q >> 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def plain_shards(rows_, dims, tie, shards, bits=8):
    """(shard, slot) by row number: quantile steps, curve, order, runs."""
    steps = []
    for d in dims:
        values = sorted((r[d] for r in rows_ if r[d] is not None), key=lambda v: v.encode() if isinstance(v, str) else v)
        cuts = sorted({values[max(0, math.ceil(i / 2**bits * len(values)) - 1)] for i in range(1, 2**bits)}) if values else []
        top = max(1, len(cuts) - (not cuts or values[-1] <= cuts[-1]))
        steps.append([0 if r[d] is None else sum(c < r[d] for c in cuts) * (2**bits - 1) // top for r in rows_])
    order = sorted(range(len(rows_)), key=lambda i: (plain_curve([s[i] for s in steps], bits), *[(r is not None, r) for r in (rows_[i][t] for t in tie)]))
    out, n = {}, len(rows_)
    for rank, i in enumerate(order):
        shard = rank * shards // n
        out[i] = (shard, rank - -(-shard * n // shards))
    return out


def test_hilbert_shards_equal_a_plain_version(spark, docs):
    rng = random.Random(3)
    made = [(i, rng.choice(["https://a.example/x", "https://a.example/y", "https://b.example", "", None]), rng.choice([None, 1.5, 2.5, 1e9]), rng.randrange(400)) for i in range(700)]
    df = spark.createDataFrame(made, "doc_id long, source string, weight double, n_chars long").repartition(5)
    for frame, dims in ((df, ["source", "weight", "n_chars"]), (docs, ["lang", "source", "n_chars"])):
        out = hilbert.hilbert_shards(frame, dims, ["doc_id"], n_shards=16).collect()
        want = plain_shards(out, dims, ["doc_id"], 16)
        assert {i: (r["shard"], r["slot"]) for i, r in enumerate(out)} == want and len({r["curve"] for r in out}) > 20
        sizes = [sum(r["shard"] == s for r in out) for s in range(16)]
        assert max(sizes) - min(sizes) <= 1


def test_hilbert_shards_are_narrow_in_every_dimension(spark):
    rng = random.Random(9)
    made = [(i, f"https://one.example/with/a/long/shared/start/{rng.randrange(50):02d}", float(rng.randrange(1000)), rng.choice("abcdefgh")) for i in range(4000)]
    df = spark.createDataFrame(made, "doc_id long, source string, size double, lang string")
    by = defaultdict(list)
    for r in hilbert.hilbert_shards(df, ["source", "size", "lang"], ["doc_id"], n_shards=64).collect():
        by[r["shard"]].append(r)
    for name in ("source", "size", "lang"):
        values = sorted({m for m in ({"source": x[1], "size": x[2], "lang": x[3]}[name] for x in made)})
        # a reader that wants one value opens the shards whose range holds it
        opened = sum(min(r[name] for r in rs) <= v <= max(r[name] for r in rs) for v in values for rs in by.values()) / (64 * len(values))
        assert opened < 0.55


def test_op9_query_derives_size_and_checksum(spark):
    from lexhull.llm import queries as q

    out = rows(q.op9_hilbert_sharding(spark, "/root/testdata/sf0.001"))
    src = rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert set(out) == set(src) and {r["law"] for r in out.values()} == {"rows"}
    for i, r in src.items():
        text = (r["text"] or "").encode()
        assert (out[i]["size"], out[i]["text_crc32"], out[i]["grown_shard"]) == (len(text) + 1, zlib.crc32(text), None)
    told = [dict(r.asDict(), lang=src[i]["lang"], source=src[i]["source"]) for i, r in out.items()]
    want = plain_shards(told, ["lang", "source", "size"], ["text_crc32", "doc_id"], 16)
    assert [(r["shard"], r["slot"]) for r in told] == [want[k] for k in range(len(told))]


def test_html_keeps_the_article_only():
    main = lambda page: "\n".join(main_text(page))
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p>";</script></head><body><nav><a href=/>Start</a></nav><!-- x > y -->
      <div class="ad">Buy this</div><article><h1>A &amp; B</h1><p><b>First   words<br><p>Second&nbsp;words &lt;i&gt;.</p><form><label>Mail</label></form></article><footer>&copy; all</footer>"""
    assert main(page) == "A & B\nFirst words\nSecond words <i>."
    assert main(None) == main("") == main("<nav><a href=1>Home</a></nav>") == ""
    assert main("<p unclosed") in ("", "<p unclosed")


@pytest.mark.parametrize("name", ["video-player", "svg-icon", "math-note", "title-bar", "select-menu", "object-viewer"])
def test_html_custom_elements_are_not_raw(name):
    texts, _ = html_text.blocks(f"<article><p>First.</p><{name} a=b></{name}><p>Second.</p><svg><text>gone</text></svg><p>Third.</p></article>")
    assert texts == ["First.", "Second.", "Third."]


LONG = "The harbour was opened again on Monday after two days of storm had kept all of the boats in the bay."
MENU = "<ul><li><a href=1>Home</a><li><a href=2>About us</a><li><a href=3>World news</a></ul>"


def main_text(page, tree=html_text.trained()):
    texts, x = html_text.blocks(page)
    return [t for t, keep in zip(texts, tree.predict(x)) if keep]


def test_html_tree_uses_links_and_neighbours_and_holds_on_other_pages():
    tree, right, n = html_text.trained(), 0, 0
    used = {html_text.FEATURES[f] for f in tree.feature if f >= 0}
    assert {"words", "links"} <= used and any("before" in f or "after" in f for f in used)
    for page, labels in html_text.labelled_table(150, seed=99):
        texts, x = html_text.blocks(page)
        assert len(texts) == len(labels)
        right, n = right + sum((c == "1") == k for c, k in zip(labels, tree.predict(x).tolist())), n + len(labels)
    assert right / n > 0.98


@pytest.mark.parametrize("name", "related-content sidebar-content footer-text newsletter-text cookie-text main-nav main-sidebar post-share story-ad".split())
def test_html_compound_names_of_boilerplate(name):
    assert main_text(f"{MENU}<article><h1>Title</h1><p>{LONG}</p></article><div class={name}><p>{LONG}</p></div>") == ["Title", LONG]
    assert main_text(f"{MENU}<div><h1>Title</h1><p>{LONG}</p><p>Short one.</p></div><div class={name}><p>{LONG}</p></div>") == ["Title", LONG, "Short one."]


def test_html_without_container():
    assert main_text(f"{MENU}<h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p><a href=1>Read more</a></p>") == ["Title", LONG, LONG]
    assert main_text(f"<p>Short first.</p><p>{LONG}</p>") == ["Short first.", LONG]
    assert main_text("<p>One short paragraph.</p>") == ["One short paragraph."]
    assert main_text(f"<div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div>{LONG}</div><div>{LONG}</div><div><a href=1>The next story of this week and of the one before</a></div>") == [LONG, LONG]
    assert main_text(MENU) == []


def test_html_layout_words_comments_and_forms():
    assert main_text(f"<body class='has-sidebar no-menu'><h1>Title</h1><p>{LONG}</p></body>") == ["Title", LONG]
    assert main_text(f"<article><p>{LONG}</p></article><div id=comments><article><p>{LONG}</p></article></div>") == [LONG]
    assert main_text(f"<form><article><h1>Title</h1><p>{LONG}</p></article></form><form><p>{LONG}</p></form>") == ["Title", LONG]
    assert main_text(f"<article><header><h1>Title</h1></header><p>{LONG}</p><aside><p>{LONG}</p></aside></article><footer><p>{LONG}</p></footer>") == ["Title", LONG]


def test_html_pages_of_the_test_data(spark):
    import html as h

    out = html_text.extract_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("raw", F.col("html"))).collect()
    assert len(out) == 50
    for r in out:
        inner = re.search("<article>(.*)</article>", r["raw"], re.S)[1]
        parts = [" ".join(h.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?h1>|</?p>|<br>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p)


def test_sha_of_ids(spark):
    r = spark.createDataFrame([([1, 22, 333],), ([],)], "ids array<int>").select(F.sha2(byte_bpe.token_text(F.col("ids")), 256)).collect()
    assert [x[0] for x in r] == [hashlib.sha256(b"1 22 333").hexdigest(), hashlib.sha256(b"").hexdigest()]


BRIDGE = "<p>" + "The council met on Tuesday to speak about the new bridge and its cost, which has grown. " * 2 + "</p><p>" + "A second paragraph tells what the mayor said to the press after the meeting had ended. " * 2 + "</p>"


@pytest.mark.parametrize("page, also", [
    (f'<body><div class="text-ad-free"><h1>Bridge</h1>{BRIDGE}</div></body>', []),
    (f"<article><h1>Bridge</h1>{BRIDGE}<figure><img src=x><figcaption>The old bridge in spring</figcaption></figure><p>One more paragraph, with words to read.</p></article>", ["The old bridge in spring", "One more paragraph, with words to read."]),
    (f'<body><div>We use cookies to make this site better. <a href=x>Accept</a></div><div class="content"><h1>Bridge</h1>{BRIDGE}</div></body>', []),
    (f'<body><article><h1>Bridge</h1>{BRIDGE}</article><div class="seitenleiste"><p>Wetter heute schön.</p><p>Lesen Sie auch dies.</p></div></body>', []),
    (f'<body><article><h1>Bridge</h1>{BRIDGE}</article><div class="usr-cmts"><p>I like the bridge a lot, thanks for it!</p><p>Too dear if you ask me.</p></div></body>', []),
    (f'<body><article><h1>Bridge</h1>{BRIDGE}</article><div class="side-content"><p>Most read this week was that.</p></div></body>', []),
    (f'<body><nav><ul><li><a href=a>News.</a></li><li><a href=b>Sports</a></li></ul></nav><h1>Bridge</h1>{BRIDGE}<footer>All rights reserved.</footer></body>', []),
])
def test_pages_whose_names_say_nothing_or_mislead(spark, page, also):
    text = html_text.extract_text(spark.createDataFrame([(page,)], "html string")).first()["text"].split("\n")
    assert [t[:11] for t in text[:3]] == ["Bridge", "The council", "A second pa"] and text[3:] == also


def test_blocks_of_pages_drawn_anew_are_told_apart():
    tree, right, total = html_text.trained(), 0, 0
    for seed in (99, 1234):
        for page, labels in html_text.labelled_table(pages=240, seed=seed):
            found = tree.predict(html_text.blocks(page)[1])
            right, total = right + sum(bool(f) == (c == "1") for f, c in zip(found, labels)), total + len(labels)
    assert right / total > 0.98
