from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from skein.functions import ids, records, text, urls, vectors


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "expected"), [("  a  b ", "a b"), ("a" + chr(0xA0) + "b", "a b"), (chr(0xFB01) + "n", "fin"), ("", None), ("   ", None), (None, None)])
def test_clean_text(spark, raw, expected):
    assert one(spark, raw, text.clean_text) == expected


@pytest.mark.parametrize(("raw", "expected"), [("Jos" + chr(0xE9) + " O'Neil-Ruiz", "jose o neil ruiz"), ("STRA" + chr(0xDF) + "E", "strasse"), ("", ""), (None, None)])
def test_name_key(spark, raw, expected):
    assert one(spark, raw, text.name_key) == expected


def test_terms_keep_their_order(spark):
    assert one(spark, "b aa bb aa c", text.terms) == ["aa", "bb"]
    assert one(spark, None, text.terms) == []


@pytest.mark.parametrize(("a", "b", "same"), [("ann b cole", "ann cole", True), ("ann cole", "ann b cole", True), ("ann bea cole", "ann cole", False), ("ann cole", "ann cole", False), ("ann b cole", "ann dole", False)])
def test_omitted_initial(spark, a, b, same):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(text.same_but_for_initial(F.col("a"), F.col("b")).alias("x")).first()["x"] is same


@pytest.mark.parametrize(("a", "b", "score"), [("ann cole", "ann cole", 0.30), ("anna cole", "ann cole", round(0.3 * 16 / 17, 6)), ("ann b cole", "ann c cole", 0.0), ("bob cole", "ann cole", 0.0), ("", "", 0.0)])
def test_name_score(spark, a, b, score):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(text.name_score(F.col("a"), F.col("b")).alias("x")).first()["x"]
    assert got == pytest.approx(score, abs=2e-6)


def test_sentences_tokens_and_lines(spark):
    assert one(spark, " One. Two!  Three? four ", text.sentences) == ["One.", "Two!", "Three?", "four"]
    assert one(spark, "a " + chr(0xA0) + " b\n", text.token_count) == 2
    assert one(spark, None, text.token_count) == 0
    assert one(spark, "a\nREAD MORE\nb\n\nread more\n\nc", lambda v: text.drop_lines(v, ["Read more"])) == "a b\n\nc"


def test_snippet(spark):
    body = "x " * 300 + "needle & <thread> " + "y " * 300
    got = spark.createDataFrame([(body, ["needle", "thread"])], "t string, q array<string>").select(text.snippet(F.col("t"), F.col("q"), 80).alias("x")).first()["x"]
    assert "needle &amp; &lt;thread&gt;" in got and got.startswith("...") and got.endswith("...")


@pytest.mark.parametrize(("raw", "expected"), [
    ("HTTP://Ex.org:80//a//b/?b=2&utm_source=q&a=1&a=0#f", "http://ex.org:80/a/b?a=0&a=1&b=2"), ("https://ex.org", "https://ex.org/"), ("https://ex.org/", "https://ex.org/"),
    ("https://ex.org/A/", "https://ex.org/A"), ("https://u:p@ex.org/", None), ("ftp://ex.org/", None), ("nothing", None), ("https://ex.org/a b", "https://ex.org/a b"), ("https://[bad", None), (None, None),
])
def test_canonical_url(spark, raw, expected):
    assert one(spark, raw, urls.canonical_url) == expected == (urls.canonical(raw) if raw is not None else None)


def test_root_addresses_match_with_and_without_slash(spark):
    assert one(spark, "https://Ex.org", urls.match_key) == one(spark, "https://ex.org/", urls.match_key) == "https://ex.org"


@pytest.mark.parametrize(("raw", "expected"), [("https://doi.org/10.1/AB. ", "10.1/ab"), ("doi: 10.1/x", "10.1/x"), ("http://dx.doi.org/10.2/y", "10.2/y"), ("", None), (None, None)])
def test_doi(spark, raw, expected):
    assert one(spark, raw, urls.doi) == expected


def test_uuid5_is_the_same_as_in_python(spark):
    for name in ("a|b|c", "", "J" + chr(0xFC) + "rgen|x"):
        assert one(spark, name, ids.uuid5) == str(uuid.uuid5(ids.NAMESPACE, name))
    assert one(spark, None, ids.uuid5) is None


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0]), (None, [1.0, 2.0])], "a array<float>, b array<float>")
    rows = df.select(vectors.dot(F.col("a"), F.col("b")).alias("d"), vectors.usable(F.col("a"), 2).alias("u")).collect()
    assert [tuple(r) for r in rows] == [(3.0, True), (None, False), (None, False)]
    assert one(spark, [3.0, 4.0], vectors.unit, "array<float>") == pytest.approx([0.6, 0.8])
    with pytest.raises(Exception, match="length above zero"):
        spark.createDataFrame([([0.0, 0.0],)], "a array<float>").select(vectors.unit(F.col("a"))).collect()


def test_records(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"}, '{"k": 5}', '["x","y"]', None, 2007)], "l map<string,string>, r map<string,string>, j string, s string, d string, y int")
    row = df.select(records.merged(F.col("l"), F.col("r")).alias("m"), records.json_text(F.col("j"), "k").alias("k"), records.json_strings(F.col("s")).alias("s"), records.json_strings(F.col("j")).alias("bad"), records.date_or_year(F.col("d"), F.col("y")).alias("d")).first()
    assert row.m == {"a": "1", "b": "3"} and row.k == "5" and row.s == ["x", "y"] and row.bad == [] and row.d == "2007-00-00"
