import pytest
from pyspark.sql import functions as F

from marea.functions.hashing import md5_number
from marea.functions.numeric import to_number
from marea.functions.text import clean_label, clean_name, compact_text, literal_pattern
from marea.operators.html import html_to_text

NAMES = {
    "cat__Contract_Two year": "Contract_Two_year", "num__tenure": "tenure", "cat__SeniorCitizen_1": "SeniorCitizen",
    "cat__Partner_Yes": "Partner", "cat__Pay_Bank transfer (automatic)": "Pay_Bank_transfer_automatic",
    " x-y__z ": "x_y_z", "x_10": "x0", "año": "ao", "a % b": "a_b",
}


def test_clean_name_and_label_agree(spark):
    assert {n: clean_name(n) for n in NAMES} == NAMES
    df = spark.createDataFrame([(n,) for n in NAMES], "label string")
    assert dict(tuple(r) for r in df.select("label", clean_label(F.col("label"))).collect()) == NAMES


def test_to_number(spark):
    cases = {"12.5": 12.5, " 7 ": 7.0, "-1e3": -1000.0, ".5": 0.5, "5.": 5.0, "": None, " ": None, "n/a": None,
             "12d": None, "NaN": None, "1,000": None, "0x10": None}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert dict(tuple(r) for r in df.select("t", to_number(F.col("t"))).collect()) == cases


def test_md5_number_matches_python(spark):
    import hashlib
    row = spark.createDataFrame([("42|7",)], "t string").select(md5_number(F.col("t"))).first()
    assert row[0] == int(hashlib.md5(b"42|7").hexdigest()[:15], 16)


def test_literal_pattern(spark):
    row = spark.createDataFrame([("a.|\\Eb.|\\Ec",)], "t string").select(F.split("t", literal_pattern(".|\\E"))).first()
    assert row[0] == ["a", "b", "c"]


def test_compact_text_keeps_texts_apart(spark):
    texts = ["a" * 63, "a" * 64, "b" * 64, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    stand_ins = [r[0] for r in df.select(compact_text(F.col("t"))).collect()]
    assert len(set(stand_ins)) == 5 and stand_ins[4] is None and all(len(s) <= 64 for s in stand_ins[:4])


@pytest.mark.parametrize("html, text", [
    ("<p>uno</p><p>dos<br>tres</p>", "uno\n\ndos\ntres"),
    ('<script>var t="</p>";</script><style>p{}</style><!-- <p>x</p> --><p>ok</p>', "ok"),
    ("<nav><a>menu</a></nav><DIV>1 &lt; 2 &amp;amp; 3</DIV>", "1 < 2 &amp; 3"),
    ("<p>abierto<p>otro &nbsp; más", "abierto\n\notro   más"),
    ("<p>&iquest;Qu&eacute; a&ntilde;o?&hellip; &amp;lt;</p>", "¿Qué año?… &lt;"),
    ("", ""),
    ("caf&#233; &#xE9; &euro; &middot; &NotEqualTilde; &nosuch; &amp &#0; AT&T", "caf\u00e9 \u00e9 \u20ac \u00b7 \u2242\u0338 &nosuch; & &#0; AT&T"),
    ("&#128512; &amp;#233;", "\U0001f600 &#233;"),
    ("<table><tr><td>uno</td><td>dos</td></tr><tr><th>a</th></tr></table>", "uno\n\ndos\n\na"),
    ("<dl><dt>t</dt><dd>d</dd></dl><blockquote>q</blockquote>x", "t\n\nd\n\nq\n\nx"),
    ('<p>one</p><script>var a="<!--";</script><p>two</p><p>three</p>', "one\n\ntwo\n\nthree"),
    ("<p>a</p><nav>a<nav>b</nav>secret menu</nav><p>b</p>", "a\n\nb"),
    ('<p><a title="x > y">link</a></p>', "link"),
    ("<nav-item>kept</nav-item><p>and this</p>", "kept\n\nand this"),
    ("<!-- <script> --><p>a</p><!-- </script> --><p>b</p>", "a\n\nb"),
    ("<STYLE media='a>b'>p{}</style ><p>a</p>", "a"), ("<p data-x='<!--'>a</p>b<p>c</p>", "a\n\nb\n\nc"),
    ("<template>x<noscript>y</template>z</noscript><p>a</p></nav>b", "z\n\na\n\nb"),
    ("<nav>a<template>b</nav>c", "c"), ("<nav>never closed<p>gone", ""), ('<p title="open>a</p>b', "a\n\nb"),
    ("<NAV/ class=x>m</NAV>1 < 2 and 3 > 2", "1  2"), ("<p-card>x</p-card>y", "xy"),
    ("<p>a</p><script>leak()", "a"), ("<p>a</p><!-- open", "a"), ("x<br/>y<br class='c'>z", "x\ny\nz"),
])
def test_html(spark, html, text):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert html_to_text(df).first()["text"] == text
