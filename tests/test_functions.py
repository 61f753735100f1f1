"""Text functions: worked examples and the quirks that decide results."""
import hashlib

import pytest
from pyspark.sql import functions as F

from lexhull.functions import text as tx


def one(spark, expr, **cols):
    names = list(cols)
    schema = ", ".join(f"{n} string" for n in names) or "x string"
    row = tuple(cols.values()) or (None,)
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_content_hash_takes_null_as_empty(spark):
    assert one(spark, tx.content_hash(F.col("a"), F.col("b"), F.col("c")), a="x", b=None, c="z") == hashlib.md5(b"x||z").hexdigest()


def test_split_code(spark):
    head, tail = tx.split_code(F.col("a"))
    assert one(spark, F.struct(head, tail), a="12345.67.8") == ("12345", "67.8")
    assert one(spark, F.struct(head, tail), a="12345") == ("12345", None)


def test_code_type_is_blind_to_case(spark):
    t = tx.code_type(F.lit(False), F.col("a"))
    assert [one(spark, t, a=x) for x in ("1.xx", "1.XX", "1.01")] == ["CROSS_INDICATION", "CROSS_INDICATION", "REAL_CODE"]
    assert one(spark, tx.code_type(F.lit(True), F.col("a")), a="1.01") == "FALLBACK"


@pytest.mark.parametrize("text,want", [("12.5", 12.5), ("1_0", None), ("12.5d", None), ("nan", None), ("", None), (None, None), ("-3", -3.0)])
def test_numbers_are_plain(spark, text, want):
    assert one(spark, tx.to_number(F.col("a")), a=text) == want


@pytest.mark.parametrize("name,want", [(None, True), ("", True), (" UND: ", True), ("Und", False), ("Maximal 3", True), ("1.200,5", True), ("abc", True), ("aBc", False), ("abcd", False), ("80", True), ("Melanom", False), ("Erwachsene ab 18", True)])
def test_structural_names(spark, name, want):
    assert one(spark, tx.is_structural(F.col("a")), a=name) is want


def test_text_codes(spark):
    codes = tx.text_codes([F.col("a"), F.col("b")])
    assert one(spark, codes, a="Der INDIKATIONSCODE lautet: 12345.67 und Code an Krankenversicherer: 11111.01", b="le code suivant : 12345.67, codice: 22222.02") == ["12345.67", "11111.01", "22222.02"]
    assert one(spark, codes, a=None, b="12345.67") == []


def test_bold_names(spark):
    assert one(spark, tx.bold_names(F.col("a")), a="x <b>A</b> y <b>B</b>") == "A | B"
    assert one(spark, tx.bold_names(F.col("a")), a="plain") is None


def test_segments_cut_at_paragraph_headers_only(spark):
    text = "intro <b>inline</b><br>\n<br/><b>First</b> body <b>stress</b>\n<b>Second</b>: tail "
    got = one(spark, tx.segments(F.col("a")), a=text)
    assert [tuple(s) for s in got] == [("First", "body <b>stress</b>"), ("Second", ": tail")]
    assert one(spark, tx.segments(F.col("a")), a=None) == [] == one(spark, tx.segments(F.col("a")), a="no header")
    assert [s["name"] for s in one(spark, tx.segments(F.col("a")), a="<b>A</b>")] == ["A"]


def test_headers_and_bodies_make_up_the_text(spark):
    text = "<b>A</b>one<br><b>B</b>two<br/>\n<b>C</b>three"
    got = one(spark, tx.segments(F.col("a")), a=text)
    assert text.replace("<br><b>B", "<b>B").replace("<br/>\n<b>C", "<b>C") == "".join(f"<b>{s['name']}</b>{s['body']}" for s in got)


def test_cleaning(spark):
    text = " a<br>b<br/>c <b>d</b>&nbsp;<u>e</u>\n\n f <i>g</i> &amp;&lt; "
    assert one(spark, tx.clean_markup(F.col("a")), a=text) == "a b c d e f <i>g</i> &amp;&lt;"
    assert one(spark, tx.clean_export(F.col("a")), a=text) == "a b c d e f g &<"


def test_entities(spark):
    assert one(spark, tx.decode_entities(F.col("a")), a="&eacute;&#65;&amp;lt;") == "éA&lt;"
    assert one(spark, tx.decode_entities(F.col("a")), a=None) is None


def test_first_sentence(spark):
    assert one(spark, tx.first_sentence(F.col("a")), a="One. Two.") == "One."
    assert one(spark, tx.first_sentence(F.col("a")), a="x" * 130) == "x" * 120 + "..."
    assert one(spark, tx.first_sentence(F.col("a")), a=". no") == ". no"


def test_names(spark):
    assert one(spark, tx.normalised(F.col("a")), a="  A \t b :: ") == "A b"
    assert one(spark, tx.normalised(F.col("a"), True), a=None) == ""
    assert one(spark, tx.canonical_brands(F.col("a")), a="Trastuzumab und LENALIDOMID SANDOZ") == "TRASTUZUMAB und LENALIDOMID"
    assert one(spark, tx.combination_rewritten(F.col("a")), a="Kombination REVLIMID, Elotuzumab und X") == "REVLIMID in Kombination mit Elotuzumab und X"
    assert one(spark, tx.combination_rewritten(F.col("a")), a="Kombination VIDAZA und Venetoclax") == "VIDAZA in Kombination mit und Venetoclax"
    assert one(spark, tx.embedded_code(F.col("a")), a="Name 12345.67.") == "12345.67"


def test_only_references_go_to_python(spark):
    import html

    texts = ["a &amp; b &eacute;&#60;&#x41;", "&notit; && &;", "&#0;&amp;amp;", "&" + "a" * 40 + ";", "&lt 𝒳&\n", "none", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.decode_entities(F.col("t")).alias("got"))
    assert all(r["got"] == (r["t"] and html.unescape(r["t"])) for r in df.collect())
    asked = spark.createDataFrame([("x &amp; " * 5,)], "t string").select(tx.decode_entities(F.col("t")).alias("got"))
    assert "unescaped(CASE WHEN" in asked._jdf.queryExecution().toString() and "array_distinct" in asked._jdf.queryExecution().toString()
