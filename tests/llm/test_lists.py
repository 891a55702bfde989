"""Top N, splitting, mixture, leaks."""

from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.llm import leak, mixture, split, topn

PAPERS = "author_id string, external_id string, publication_date string, year int, fetched_at timestamp, rank string, _k string, date_key string"


def papers(spark, rows):
    return spark.createDataFrame([(a, e, d, y, datetime(2024, 1, t) if t else None, "clash", "clash", "clash") for a, e, d, y, t in rows], PAPERS)


@pytest.mark.parametrize(("raw", "key"), [
    ("2009-06-21", 20090621), ("2010/1/2", 20100102), ("2016-12", 20161200), ("2006", 20060000), (" 1998-07-12 ", 19980712), ("2006-03-25T00:00:00Z", 20060325), ("Dec 2020", 20201200),
    ("10 Nov 2023", 20231110), ("Jun 15, 2024", 20240615), ("September 3, 2001", 20010903), ("0000-00-00", 0), ("2010-13-40", 20100000), ("2010-02-00", 20100200), ("n.d.", 0), ("forthcoming", 0), ("", 0), (None, 0),
])
def test_date_key(spark, raw, key):
    assert spark.createDataFrame([(raw,)], "d string").select(topn.date_key(F.col("d")).alias("k")).first().k == key


def test_latest_papers(spark):
    rows = [
        ("a", "p1", "2020-05", 1999, 1), ("a", "p2", "2020-05-01", 2020, 1), ("a", "p3", None, 2020, 1), ("a", "p4", "n.d.", 0, 1), ("a", "p5", None, None, 1),
        ("a", "p2", "2001", 2001, 2), ("a", "p6", "2020-05", 2020, None), ("a", None, "2024", 2024, 1), (None, "p1", "2020", 2020, 1), ("a", "p1", "2020-05", 1999, 1),
    ]
    got = [(r.author_id, r.external_id) for r in topn.latest_papers(papers(spark, rows), 10).orderBy("author_id", "rank").collect()]
    assert got == [(None, "p1"), ("a", "p6"), ("a", "p1"), ("a", "p3"), ("a", "p2"), ("a", "p5"), ("a", "p4")]
    assert topn.latest_papers(papers(spark, []), 10).count() == 0


def test_top_n_of_a_hot_group_against_brute_force(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.5 else f"g{rnd.randrange(9)}", f"i{n}", rnd.randrange(40)) for n in range(3000)]
    df = spark.createDataFrame(rows, "g string, i string, s int")
    got = {(r.g, r["rank"]): r.i for r in topn.top_n(df, ["g"], [F.col("s").desc(), F.col("i").desc()], 5, ["i"], subgroups=8).collect()}
    expected = {}
    for g in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]), reverse=True)[:5], 1):
            expected[g, n] = r[1]
    assert got == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c,", "d!\n", "e\n\n", "f" + chr(0xA0), "g" * 30, "  "]), max_size=120), st.integers(1, 12), st.integers(0, 5))
def test_cut_points(parts, limit, overlap):
    text = " ".join(parts)
    overlap = min(overlap, limit - 1)
    pieces, words = split.cut_points(text, limit, overlap)
    assert len(words) == len(text.split())
    if not words:
        assert pieces == []
        return
    assert pieces[0][0] == 0 and pieces[-1][1] == len(words)
    assert all(0 < b - a <= limit for a, b in pieces)
    for (a, b), (c, d) in zip(pieces, pieces[1:], strict=False):
        assert a < c <= b < d and b - c <= overlap


def test_natural_boundaries_are_preferred():
    text = " ".join(["w"] * 300) + ".\n\n" + " ".join(["v"] * 300) + ". " + " ".join(["u"] * 100)
    pieces, _ = split.cut_points(text)
    assert pieces[0] == (0, 300) and pieces[1][0] in (250, 300)


def test_split_items(spark):
    rows = [(1, "w " * 401, "x", 5), (1, "w " * 401, "x", 5), (2, "w " * 400, None, 5), (3, None, None, 5), (4, "", None, 5), (5, chr(0xA0).join("w" * 401), None, 5), (6, ("long " * 90000), None, 5)]
    df = spark.createDataFrame(rows, "item_id long, text string, _text string, piece_no int")
    got = split.split_items(df, "text", ["item_id"]).collect()
    assert {r.item_id for r in got} == {1, 5, 6}
    assert [(r.chunk_key, r.n_words) for r in got if r.item_id == 5] == [("section-001", 400), ("section-002", 51)]
    assert max(r.n_words for r in got) <= 400
    assert split.split_items(df.limit(0), "text", ["item_id"]).count() == 0


DOCS = "doc_id long, text string, source string, _key string, copies int"


def test_mixture(spark):
    rnd = random.Random(4)
    rows = [(n, " ".join(rnd.choice(["river", "delta", "stone", "moss"]) for _ in range(rnd.randrange(5, 60))), rnd.choice(["big", "big", "big", " Mid ", "MID"]), "clash", 7) for n in range(3000)]
    rows += [(n, "tiny text of a few words " * 3, "small", "clash", 7) for n in range(5000, 5010)] + [(9001, None, "big", None, 0), (9002, "", "big", None, 0), (9003, "x y", None, None, 0)]
    targets = spark.createDataFrame([("big", 0.5, 2), ("mid", 0.3, 1), ("small", 0.1, 4), ("absent", 0.1, 4), ("big", 0.2, 1), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mix(spark.createDataFrame(rows, DOCS), targets)
    out = {r.source: r for r in report.collect()}
    assert set(out) == {"big", "mid", "small", "absent"} and out["absent"].chosen_tokens == 0
    assert out["small"].epochs == 4 and out["small"].chosen_tokens == 4 * out["small"].available_tokens
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.1)):
        assert out[s].actual_share == pytest.approx(share / 0.9, abs=0.01)
    copies = [r.copies for r in chosen.collect()]
    assert min(copies) >= 1 and chosen.filter("source = 'small'").count() == 10
    assert chosen.groupBy("doc_id").count().filter("count > 1").count() == 0


def test_mixture_with_a_given_total_and_extremes(spark):
    rows = [(n, "one two three four", "a" if n % 10 else "b", None, None) for n in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3), ("c", 0.0, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mix(docs, targets, total_tokens=1000)
    out = {r.source: r for r in report.collect()}
    assert out["b"].chosen_tokens == pytest.approx(480, abs=4) and out["a"].chosen_tokens == pytest.approx(520, abs=4)
    assert chosen.agg(F.max("copies")).first()[0] == 3
    everything = mixture.mix(docs, targets, total_tokens=10**9)[0]
    assert everything.filter("source = 'a'").count() == 360 and everything.filter("source = 'b' and copies = 3").count() == 40
    empty = mixture.mix(docs.limit(0), targets)
    assert empty[0].count() == 0 and {r.actual_share for r in empty[1].collect()} == {0.0}
    assert mixture.mix(docs, targets.limit(0))[1].count() == 0


def test_mixture_prefers_weightier_records_and_repeats_itself(spark):
    rows = [(n, ("clean words of prose " * 20) if n % 2 else ("#9 %1 &2 @3 " * 27), "s", None, None) for n in range(2000)]
    targets = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    docs = spark.createDataFrame(rows, DOCS)
    first = {r.doc_id for r in mixture.mix(docs, targets, total_tokens=30000)[0].collect()}
    assert sum(n % 2 for n in first) > 0.6 * len(first)
    assert first == {r.doc_id for r in mixture.mix(docs.repartition(5), targets, total_tokens=30000)[0].collect()}


@pytest.mark.parametrize("n", [3, 200])
def test_mixture_edges_of_light_records(spark, monkeypatch, n):
    """Light records have large keys; budgets end at the right key all the same, and no ordered range is large."""
    monkeypatch.setattr(mixture, "EDGE_ROWS", 16)
    monkeypatch.setattr(mixture, "PARTS", 8)
    rows = [(k, "# 1 2", "light", None, None) for k in range(20 * n)] + [(10**6 + k, "Plain words of a sentence that goes on for some time. " * 4, "plain", None, None) for k in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("light", 0.5, 1), ("plain", 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mix(docs, targets, total_tokens=40 * n)
    out = {r.source: r for r in report.collect()}
    assert abs(out["light"].chosen_tokens - 20 * n) <= 5 and out["light"].budget_tokens == 20 * n
    # equal weights: every record has the same chance, so the chosen are spread over all ids
    got = sorted(r.doc_id for r in chosen.filter("source = 'light'").collect())
    half = sum(k < 10 * n for k in got)
    assert n == 3 or abs(half - len(got) / 2) < 4 * (len(got) / 4) ** 0.5
    sized = docs.select("doc_id", "source", F.lit(5).cast("long").alias("n_tokens"), (-F.log(mixture._uniform(F.col("doc_id"), seed=1)) * 2.0**40 / 0.05).cast("long").alias("_key"))
    plan = spark.createDataFrame([("light", 0, 1, 30 * n), ("plain", 0, 1, 10**6)], "source string, epochs int, max_repeats int, rest_tokens long")
    for e in mixture._edges(sized, plan).collect():
        mine = sized.filter(F.col("source") == e.source)
        inside, below = mine.filter((F.col("_key") >= e._low) & (F.col("_key") < e._high)), mine.filter(F.col("_key") < e._low)
        assert inside.count() <= 16 and below.count() * 5 == e._below
        total = mine.count() * 5
        assert e._below <= e.rest_tokens and (e._below + 5 * inside.count() > e.rest_tokens or e.rest_tokens >= total)


def test_inclusion_follows_the_weights(spark):
    """Records of twice the weight are chosen about twice as often where few are chosen."""
    sized = spark.range(60000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 0.05).otherwise(0.1).alias("w"))
    keyed = sized.withColumn("_key", (-F.log(mixture._uniform(F.col("doc_id"), seed=3)) / F.col("w") * 2.0**40).cast("long"))
    first = keyed.orderBy("_key", "doc_id").limit(3000).groupBy((F.col("doc_id") % 2).alias("odd")).count().collect()
    n = {r.odd: r["count"] for r in first}
    assert n[1] / n[0] == pytest.approx(2.0, rel=0.12)


def test_quality_prefers_prose(spark):
    texts = ["The river shapes the delta, and the delta feeds the coast with slow brown water. " * 5 + "Every season brings another channel.", "spam " * 200, "a1 b2 c3 d4 e5 " * 30, "Menu | Home | About | #9 %1 &2", "", None]
    got = [r.q for r in spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", mixture.quality(F.col("t")).alias("q")).orderBy("n").collect()]
    assert got[0] == max(got) and got[0] > 0.6 and all(0.05 <= q <= 1 for q in got) and got[4] == got[5] == 0.05 and got[1] < got[0] / 1.3 and got[3] < got[0] / 1.3


def test_leaks_against_brute_force(spark):
    rnd = random.Random(2)
    vocabulary = [f"w{n}" for n in range(60)]
    items = [(n, " ".join(rnd.choice(vocabulary) for _ in range(size))) for n, size in enumerate([1, 2, 3, 4, 5, 7, 9, 11, 12, 13, 20, 40, 40, 60])]
    docs = []
    for n in range(300):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 80))]
        if rnd.random() < 0.6:
            item = items[rnd.randrange(len(items))][1].split()
            k = rnd.randrange(1, len(item) + 1)
            a = rnd.randrange(0, len(item) - k + 1)
            at = rnd.randrange(0, len(words) + 1)
            words[at:at] = item[a : a + k]
        docs.append((n, " ".join(words)))
    expected = set()
    for i, t in items:
        w = t.split()
        size = min(12, len(w))
        runs = [" " + " ".join(w[j : j + size]) + " " for j in range(len(w) - size + 1)]
        expected |= {(n, i) for n, d in docs if any(r in f" {d} " for r in runs)}
    d, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in leak.find_leaks(d, e).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert {tuple(r) for r in leak.find_leaks(d, e, most_bits=8).collect()} == expected


def test_leaks_ignore_case_accents_and_invisible_signs(spark):
    soft, zero, fi, nbsp = chr(0xAD), chr(0x200B), chr(0xFB01), chr(0xA0)
    item = "The café in Zurich served nineteen cold filter brews to tired analysts daily"
    text = f"X. THE CAFE, in{nbsp}Zu{soft}rich ser{zero}ved nineteen; cold {fi}lter brews: to tired analysts daily!"
    docs = spark.createDataFrame([(1, text, "c"), (1, text, "c"), (2, None, "c"), (3, "", "c"), (4, "the cafe in zurich served nineteen cold", "c")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item), (7, None), (8, ""), (9, "...")], "item_id long, text string")
    assert [tuple(r) for r in leak.find_leaks(docs, items).collect()] == [(1, 7)]
    assert leak.find_leaks(docs.limit(0), items).count() == leak.find_leaks(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("w", [1, 3, 5, 6, 9, 12])
def test_equal_windows_have_equal_signatures(w):
    rnd = np.random.default_rng(w)
    words = rnd.integers(0, 2**63, 400, dtype=np.uint64)
    words[200:200 + w] = words[50:50 + w]
    found = leak.signatures(words, w)
    assert len(found) == 401 - w and found[50] == found[200] and leak.signatures(words[50:50 + w], w).tolist() == [found[50]]
    assert len(leak.signatures(words[: w - 1], w)) == 0


def test_leaks_of_a_filter_that_lets_everything_through(spark, monkeypatch):
    monkeypatch.setattr(leak, "LEAST_BITS", 1 << 16)
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "four five six one two three")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "three four five"), (8, "six one"), (9, "zz")], "item_id long, text string")
    assert {tuple(r) for r in leak.find_leaks(docs, items).collect()} == {(1, 7), (2, 8)}
