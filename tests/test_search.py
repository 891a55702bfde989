from __future__ import annotations

import math
import os
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from skein.operators import retrieval

FOLDER = os.path.join(os.path.dirname(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")), "sf0.01")


def shuffled(spark, run):
    """(result, rows that went through shuffles)."""

    def total():
        sc = spark.sparkContext
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        nothing = sc._jvm.java.util.ArrayList()
        stages = sc._jsc.sc().statusStore().stageList(nothing, False, False, sc._gateway.new_array(sc._jvm.double, 0), nothing)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    return run(), total() - before


def brute_force(queries, rows, k):
    """BM25 of rows (doc_id, title, text) as the inverted table defines it."""
    factor = retrieval.TITLE_WEIGHT / retrieval.TEXT_WEIGHT
    tf = Counter()
    for doc, *fields in rows:
        words = [re.findall(r"\w+", (f or "").lower()) for f in fields]
        length = len(words[0]) * factor + len(words[1])
        for field, weight in zip(words, (factor, 1.0), strict=True):
            for w in field:
                tf[w, doc, length] += weight
    df = Counter(w for w, _, _ in tf)
    sizes = {(doc, length) for _, doc, length in tf}
    mean, n = sum(x for _, x in sizes) / len(sizes), len({r[0] for r in rows})
    out = []
    for q, text in queries:
        scores = Counter()
        for (w, doc, length), f in tf.items():
            if w in set(text.lower().split()):
                scores[doc] += math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length / mean))
        best = sorted(((-round(s, 6), doc) for doc, s in scores.items()))[:k]
        out += [(q, doc, -s, place) for place, (s, doc) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("twice", [False, True])
def test_lexical_equals_brute_force_and_hands_on_no_pairs(spark, twice):
    word = lambda i, m: f"w{i * i % m}"
    rows = [(i, None if i % 7 == 0 else f"the {word(i, 13)}", "" if i % 11 == 0 else f"The {word(i, 5)} {word(i, 17)}, {word(i + 1, 17)}" + " the" * (i % 3)) for i in range(3_000)]
    if twice:  # ids that occur again, with the same words and with others
        rows += [(i, *rows[i][1:]) for i in range(0, 3_000, 50)] + [(i, "w1", "the w2 the w4 x") for i in range(0, 3_000, 40)]
    queries = [(100 + q, f"the w{q} w{q * q % 11} The") for q in range(40)] + [(1, "the"), (2, "absent"), (3, "w1 absent"), (4, "W1"), (5, "x")]
    corpus = spark.createDataFrame(rows, "doc_id long, title string, text string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    for block_rows in (16_384, 15):
        got, moved = shuffled(spark, lambda: [tuple(r) for r in retrieval.bm25_top_k(asked, corpus, 6, block_rows=block_rows).orderBy("query_id", "rank").collect()])  # noqa: B023
        assert got == sorted(brute_force(queries, rows, 6), key=lambda r: (r[0], r[3]))
        assert moved < 60_000  # the corpus is dealt and counted; 120 000 pairs have a score
    assert retrieval.bm25_top_k(asked.limit(0), corpus, 6).count() == 0
    assert retrieval.bm25_top_k(asked, corpus.limit(0), 6).count() == 0


@pytest.mark.parametrize("name", ["lexical", "fused", "evidence", "channel_comparison", "retrieval_measures", "owners", "traced", "mean_measures", "bootstrap"])
def test_search_moves_no_postings(spark, name):
    """sf0.01 has 74 000 postings, and 9 000 pairs of its 10 queries and documents that share a word."""
    _, moved = shuffled(spark, lambda: entry.queries()[name](spark, FOLDER).collect())
    assert moved < 20_000
