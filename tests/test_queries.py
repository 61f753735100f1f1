"""Every registered query runs on the smallest tables and equals its DuckDB twin where it has one."""
import difflib
import duckdb
import os

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexhull import queries
from lexhull.operators import matching
from oracle_check import rows

SF = "/root/testdata/sf0.001"
#: Trained or iterative queries are run by their own tests on the larger tables.
NAMES = [n for n in entry.queries() if n != "pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for f in os.listdir(SF):
            con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
        want = con.execute(entry.oracle_sql()[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_fuzzy_best_gap_asks_for_every_part(spark, tmp_path):
    names = [(1, "B1", "almond apple"), (2, "B1", "almond appla"), (3, "B1", "zinc"), (4, "B2", "almond apple"), (5, "B2", "navy linen"), (6, "B2", "navy linem")]
    spark.createDataFrame(names, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    want = set()
    for i, block, a in names:
        scored = sorted({(-difflib.SequenceMatcher(None, a, b).ratio(), b) for _, other, b in names if other == block and b != a})
        if -scored[0][0] >= 0.9:
            want.add((i, scored[0][1], round(-scored[0][0], 6)))
    got = {(r["segment"], r["b"], round(r["score"], 6)) for r in entry.queries()["fuzzy_best_gap"](spark, str(tmp_path)).collect()}
    assert got == want and {i for i, _, _ in got} == {1, 2, 5, 6}


def test_match_cascade_runs_the_fuzzy_layer(spark, tmp_path):
    # parts 1 and 13 are of one dossier here: a name and one that differs in its last letter
    spark.createDataFrame([(1, "zebra crossing", "t"), (121, "zebra crossinh", "t")], "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    segs, known, codes = queries.part_names(spark, str(tmp_path))
    got = {r["segment"]: (r["matched_code"], r["match_type"]) for r in matching.match_log(segs, matching.cascade(segs, known.filter("name like '%g'"), codes)).collect()}
    assert got[121] == ("D1.11", "FUZZY_MATCHED") and got[1] == ("D1.11", "NORMALIZED_MATCH")


def test_every_rule_has_a_phrase_that_it_finds(spark):
    """The twins of the refund queries cover all calculations, units, thresholds and sentences."""
    from lexhull.operators import refunds
    from lexhull.rules import refunds as rules

    def found(said, value):
        df = spark.createDataFrame([(p.replace("V", "12"),) for p in said], "t string")
        return [r[0] for r in df.select(value(F.col("t"))).collect()]

    kinds = {k for k, *_ in rules.CALCULATIONS} - {"per_mg"}  # per_mg comes after an amount, which every text with it has
    assert set(found(queries.CALCULATED, lambda t: refunds.calculation(t)["type"])) == kinds - {"threshold_box"} | {"unknown"} | ({"threshold_box"} & kinds)
    assert set(found(queries.COUNTED, refunds.refund_unit)) == {u for u, _ in rules.UNITS} | {"unknown"}
    seen = {x for xs in found(queries.BOUNDED, lambda t: F.transform(refunds.thresholds(t), lambda x: x["type"])) for x in xs}
    assert seen == {k for k, *_ in rules.THRESHOLDS}
    assert all(found(queries.STATED, refunds.sentence)) and len(queries.STATED) == len(rules.SENTENCES)
