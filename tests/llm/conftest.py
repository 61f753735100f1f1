import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, start=0):
    return " ".join(f"{rng.choice('bcdfgl')}{rng.choice('aeiou')}{rng.choice('mnrst')}{rng.randrange(40)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Small texts with copies, near copies, shared lines and passages, and odd ones."""
    rng = random.Random(5)
    base = [words(rng, rng.randrange(8, 90)) for _ in range(60)]
    shared = words(rng, 30)
    line = "A line that many documents share"
    out = []
    for t in base:
        out.append(t + "\n" + line + "\n" + words(rng, 5))
    out += base[:10] + base[:4]  # copies
    for t in base[10:30]:  # near copies
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [t + " " + shared for t in base[30:45]]
    out += [None, "", " \n\t ", "...", "Aa", "aa aa", "aa aa aa aa", "  line that\n\n\nA LINE THAT MANY documents share  \r\n", "été œuvre 日本語 🙂", "x" * 5000, words(rng, 6000)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i * 7 % 1009, t, [None, "en", "fr"][i % 3], f"s{i % 4}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
