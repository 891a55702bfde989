from __future__ import annotations

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skein.operators import chunk, dedupe, evaluate, matching, report, retrieval, state
from skein.operators.components import components, resolve_redirects


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    pairs = [(f"i{rnd.randrange(60):02d}", f"k{rnd.randrange(55)}") for _ in range(80)] + [(f"c{n:02d}", f"x{m}") for n in range(30) for m in (n, n + 1)]
    parent = {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_key = {}
    for i, k in pairs:
        by_key.setdefault(k, []).append(i)
    for members in by_key.values():
        for other in members[1:]:
            a, b = sorted((root(members[0]), root(other)))
            parent[b] = a
    got = {r.item: r.component for r in components(spark.createDataFrame(pairs + [(None, "k1"), ("i00", None)], "item string, key string")).collect()}
    assert got == {i: root(i) for i in parent}


def test_redirects(spark):
    edges = [(n, n + 1) for n in range(1, 40)] + [(100, 7), (None, 3)]
    got = {r.from_id: r.to_id for r in resolve_redirects(spark.createDataFrame(edges, "from_id long, to_id long")).collect()}
    assert got == {**dict.fromkeys(range(1, 40), 40), 100: 40}
    for cycle in ([(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1)], [(1, 1)]):
        with pytest.raises(ValueError, match="cycle"):
            resolve_redirects(spark.createDataFrame(cycle, "from_id long, to_id long"))


PAPERS = "author_id string, source_name string, external_id string, title string, abstract string, year int, publication_date string, doi string"


def test_works_and_selection(spark):
    rows = [
        ("a", "p", "1", "A long enough title", None, 2024, "2024-05-01", "10.1/X"), ("a", "q", "9", "A Long Enough Title!", "text", 2024, None, None),
        ("a", "q", "2", "Another one entirely", "text", 2023, "2023-01-01", "https://doi.org/10.1/x"), ("a", "p", "3", "Tiny", None, 2025, None, None),
        ("a", "p", "4", "Out of the window", "text", 2001, None, None), ("b", "p", "1", "A long enough title", "text", None, None, None), ("a", "p", None, "no id", None, 2024, None, None),
    ]
    papers = spark.createDataFrame(rows, PAPERS)
    works = {(r.author_id, r.external_id): r for r in dedupe.representatives(papers).collect()}
    assert set(works) == {("a", "2"), ("a", "3"), ("a", "4"), ("b", "1")}
    assert works["a", "2"].provider_ids == {"p": ["1"], "q": ["2", "9"]} and works["a", "2"].n_records == 3
    chosen = [(r.external_id, r.tier, r.place) for r in dedupe.select_recent(papers, 2025).filter("author_id = 'a'").orderBy("place").collect()]
    assert chosen == [("9", 1, 1), ("2", 1, 2), ("1", 2, 3)]
    counts = dedupe.selection_counts(papers, 2025, most=1).filter("author_id = 'a'").first()
    assert (counts.without_year, counts.outside, counts.inside, counts.beyond) == (0, 1, 5, 4)


def test_merge_listings(spark):
    df = spark.createDataFrame([("k", 2, "B", ["y", "x"]), ("k", 1, " ", ["x"]), ("k", 3, "C", None)], "key string, n int, name string, areas array<string>")
    r = dedupe.merge_listings(df, ["key"], ["n"], ["name"], ["areas"]).first()
    assert (r["name"], r.areas, r.n_rows) == ("B", ["x", "y"], 3)


@pytest.mark.parametrize("seed", range(5))
def test_chunks(seed):
    rnd = random.Random(seed)
    body = "\n\n".join(" ".join("w" * rnd.randrange(1, 9) + ("." if rnd.random() < 0.1 else "") for _ in range(rnd.randrange(1, 90))) for _ in range(12))
    letters = lambda texts: [len(t) for t in texts]
    for sizes, limit, target, overlap in ((chunk.words, 40, 30, 6), (letters, 90, 60, 12)):
        found = chunk.chunks("a title", body, sizes, limit, target, overlap)
        assert [k for k, _ in found] == [f"section-{n:03d}" for n in range(1, len(found) + 1)]
        head = sum(sizes("Title: a title Text:".split()))
        assert all(sum(sizes(t.split())) <= limit - head for _, t in found)
        words, at = body.split(), 0  # every chunk goes on where the last one ended, or up to the overlap before
        for _, t in found:
            mine = t.split()
            lap = next(k for k in range(min(overlap, at), -1, -1) if words[at - k : at - k + len(mine)] == mine)
            assert sum(sizes(words[at - lap : at])) <= overlap
            at += len(mine) - lap
        assert at == len(words)


def test_chunk_limits():
    assert chunk.chunks("t", "", limit=10) == [("whole", "")] and chunk.chunks("t", "", limit=1) == []
    with pytest.raises(ValueError, match="word"):
        chunk.Layout("aaaa", lambda texts: [len(t) for t in texts]).pieces(2)
    assert chunk.fit("A b. C d. E f.", 4) == ("A b. C d.", True)
    assert chunk.fit("a b c d e", 3) == ("a b c", True)
    assert chunk.fit("a b", 3) == ("a b", False)
    with pytest.raises(ValueError, match="not even"):
        chunk.fit("aaaa", 2, lambda texts: [len(t) for t in texts])


def test_chunk_sizes_of_a_vocabulary():
    path = "/opt/tokenizers/byte_bpe_50k.json"
    from tokenizers import Tokenizer

    text = "A long-winded sentence about antidisestablishmentarianism. Another one, shorter."
    sizes = chunk.vocabulary(path)
    assert sum(sizes(text.split())) == len(Tokenizer.from_file(path).encode(" " + text).ids)
    shortened, cut_off = chunk.fit(text, 16, sizes)
    assert cut_off and sum(sizes(shortened.split())) <= 16


def test_apply_batch(spark):
    columns = "k string, v string, is_active boolean, missed int, last_seen timestamp"
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    old = spark.createDataFrame([("a", "1", True, 0, t1), ("b", "1", True, 1, t1), ("c", "1", False, 2, t1), ("d", "1", True, 0, t1)], columns)
    batch = spark.createDataFrame([("d", "2"), ("e", "2")], "k string, v string")
    full = {r.k: tuple(r)[1:] for r in state.apply_batch(old, batch, ["k"], ["v"], True, F.lit(t2)).collect()}
    assert full == {"a": ("1", True, 1, t1), "b": ("1", False, 2, t1), "c": ("1", False, 2, t1), "d": ("2", True, 0, t2), "e": ("2", True, 0, t2)}
    part = {r.k: tuple(r)[1:] for r in state.apply_batch(old, batch, ["k"], ["v"], False, F.lit(t2)).collect()}
    assert part == {"a": ("1", True, 0, t1), "b": ("1", True, 1, t1), "c": ("1", False, 2, t1), "d": ("2", True, 0, t1), "e": ("2", True, 0, t2)}


def test_upsert_cascade_merge_and_sets(spark):
    stored = spark.createDataFrame([("1", "h", "t", False), ("2", "h", "t", True)], "document_id string, content_hash string, text string, is_active boolean")
    fresh = spark.createDataFrame([("1", "h", "t"), ("2", "g", "u"), ("3", "f", "v")], "document_id string, content_hash string, text string")
    got = {r.document_id: (r.text, r.is_active, r.changed) for r in state.upsert_documents(stored, fresh).collect()}
    assert got == {"1": ("t", True, False), "2": ("u", True, True), "3": ("v", True, True)}
    docs = spark.createDataFrame([(1, 10, True), (2, 11, True), (3, None, True)], "doc int, o int, is_active boolean")
    assert {r.doc: r.is_active for r in state.cascade(docs, spark.createDataFrame([(10,), (10,), (None,)], "o int"), "o").collect()} == {1: False, 2: True, 3: True}
    owned = spark.createDataFrame([(1, "A", "t", "x", "w", True), (2, "B", "t", "x", "w", True), (3, "A", "t", "y", "w", True), (4, "A", "t", "x", "w", False)], "document_id int, owner_id string, document_type string, external_id string, chunk_key string, is_active boolean")
    merged = {r.document_id: (r.owner_id, r.is_active, r.folded_into) for r in state.merge_entities(owned, spark.createDataFrame([("A", "B")], "from_id string, to_id string")).collect()}
    assert merged == {1: ("B", False, 2), 2: ("B", True, None), 3: ("B", True, None), 4: ("B", False, None)}
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int")
    assert {tuple(r) for r in state.symmetric_difference(a, b).collect()} == {(1, "left"), (3, "right")}
    assert [tuple(r) for r in state.violations(a, ["x"]).collect()] == [(2, 2)]


def test_match_by_alias_and_affiliations(spark):
    incoming = spark.createDataFrame([("o", "n", ["a", "b"]), ("o", "m", ["z"])], "owner string, id string, aliases array<string>")
    stored = spark.createDataFrame([("o", "s1", ["b"], False, 1), ("o", "s2", ["a"], True, 5), ("o", "s3", ["b"], True, 3), ("p", "s4", ["a"], True, 0)], "owner string, id string, aliases array<string>, is_active boolean, created_at int")
    assert [tuple(r) for r in state.match_by_alias(incoming, stored).collect()] == [("o", "n", "s3")]
    rows = spark.createDataFrame([(1, [("B", "x"), ("A", "Y"), ("A", "y"), (" ", "q")])], "e int, affiliations array<struct<school:string,department:string>>")
    found = [(r.school, r.is_primary) for r in state.affiliations_of(rows, "e", [F.col("e")]).orderBy("school").collect()]
    assert found == [("A", True), ("B", False)]


def test_snapshot_is_applied_as_a_whole(spark):
    day = datetime(2024, 2, 1)
    records = spark.createDataFrame(
        [("s", "a", "A", "old a", True, 0, day), ("s", "b", "B", "old b", True, 1, day), ("s", "c", "B", "old c", True, 0, day), ("t", "d", "D", "old d", True, 1, day)],
        "source string, key string, owner string, name string, is_active boolean, missed int, last_seen timestamp",
    )
    documents = spark.createDataFrame([("s", "a", "bio", "h", True), ("s", "a", "lab", "h", True), ("s", "b", "bio", "h", True), ("s", "c", "bio", "h", True), ("t", "d", "bio", "h", True)], "source string, key string, document_type string, content_hash string, is_active boolean")
    entities = spark.createDataFrame([("A", "old a", True), ("B", "old b", True), ("D", "old d", True), ("Z", "alone", True)], "owner string, name string, is_active boolean")
    batch = spark.createDataFrame([("s", "a", "A", "new a", False), ("s", "c", "B", "new c", True), ("s", "e", "E", "new e", False)], "source string, key string, owner string, name string, has_error boolean")
    sections = spark.createDataFrame([("s", "a", "bio", "h"), ("s", "e", "bio", "g")], "source string, key string, document_type string, content_hash string")
    runs = spark.createDataFrame([("s", True, datetime(2024, 3, 1))], "source string, complete boolean, now timestamp")
    got = state.apply_snapshot({"records": records, "documents": documents, "entities": entities}, batch, runs, sections, ["source", "key"], ["owner", "name"], "owner", ["name"], [F.col("key")])
    assert {r.key: (r.name, r.is_active, r.missed) for r in got["records"].collect()} == {"a": ("new a", True, 0), "b": ("old b", False, 2), "c": ("new c", True, 0), "d": ("old d", True, 1), "e": ("new e", True, 0)}
    # the laboratory section of a vanished; c came with an error, so its section stays; b was retired with its own
    assert {(r.key, r.document_type): (r.is_active, r.changed) for r in got["documents"].collect()} == {("a", "bio"): (True, False), ("a", "lab"): (False, False), ("b", "bio"): (False, False), ("c", "bio"): (True, False), ("d", "bio"): (True, False), ("e", "bio"): (True, True)}
    assert {r.owner: (r.name, r.is_active) for r in got["entities"].collect()} == {"A": ("new a", True), "B": ("new c", True), "D": ("old d", True), "E": ("new e", True), "Z": ("alone", True)}
    assert {r.source: tuple(r)[1:] for r in got["counts"].collect()} == {"s": (1, 2, 0, 1, 1, 2), "t": (0, 0, 1, 0, 0, 0)}


def test_publications_are_applied_with_grace(spark):
    shape = "owner string, id string, title string, aliases array<string>, providers array<string>"
    stored = spark.createDataFrame([("o", "1", "old", ["x"], ["p:1"], True, 0, 1), ("o", "2", "kept", ["y"], ["p:2"], True, 0, 1), ("o", "3", "gone", ["z"], ["p:3"], True, 1, 1), ("q", "4", "other", ["x"], ["p:4"], True, 1, 1)], shape + ", is_active boolean, missed int, created_at int")
    batch = spark.createDataFrame([("o", "9", "new", ["x", "w"], ["q:9"]), ("o", "8", "fresh", ["v"], ["q:8"])], shape)
    got = {r.id: (r.title, r.aliases, r.providers, r.is_active, r.missed, r.matched) for r in state.apply_publications(stored, batch, spark.createDataFrame([("o", True)], "owner string, complete boolean"), ["title"]).collect()}
    assert got == {"1": ("new", ["w", "x"], ["p:1", "q:9"], True, 0, True), "2": ("kept", ["y"], ["p:2"], True, 1, False), "3": ("gone", ["z"], ["p:3"], False, 2, False), "4": ("other", ["x"], ["p:4"], True, 1, False), "8": ("fresh", ["v"], ["q:8"], True, 0, False)}


def test_merges_of_all_tables(spark):
    merges = spark.createDataFrame([("A", "B")], "from_id string, to_id string")
    tables = {
        "documents": spark.createDataFrame([(1, "A", "t", "x", "w", True), (2, "B", "t", "x", "w", True)], "document_id int, owner_id string, document_type string, external_id string, chunk_key string, is_active boolean"),
        "records": spark.createDataFrame([("r", "A")], "key string, owner_id string"),
        "affiliations": spark.createDataFrame([("A", "S", True), ("B", "S", True)], "owner_id string, school string, is_active boolean"),
        "links": spark.createDataFrame([("A", "p", "1"), ("A", "q", "2"), ("B", "p", "1")], "owner_id string, provider string, provider_id string"),
        "entities": spark.createDataFrame([("A", True), ("B", True)], "owner_id string, is_active boolean"),
    }
    got = state.merge_all(tables, merges)
    assert {r.document_id: (r.is_active, r.folded_into, r.absorbed) for r in got["documents"].collect()} == {1: (False, 2, []), 2: (True, None, [1])}
    assert [tuple(r) for r in got["records"].collect()] == [("r", "B")] and sorted(tuple(r) for r in got["links"].collect()) == [("B", "p", "1"), ("B", "q", "2")]
    assert sorted(tuple(r) for r in got["affiliations"].collect()) == [("B", "S", False), ("B", "S", True)]
    assert {tuple(r) for r in got["entities"].collect()} == {("A", False), ("B", True)} and [tuple(r) for r in got["redirects"].collect()] == [("A", "B")]
    with pytest.raises(ValueError, match="itself"):
        state.merge_all(tables, spark.createDataFrame([("A", "A")], "from_id string, to_id string"))
    with pytest.raises(ValueError, match="provider"):
        state.merge_all(tables | {"links": spark.createDataFrame([("A", "p", "1"), ("B", "p", "7")], "owner_id string, provider string, provider_id string")}, merges)


def test_corpus_snapshots_and_touch(spark):
    runs = spark.createDataFrame([("a", "complete", True), ("b", "partial", True), ("c", "complete", False), ("d", "running", True)], "run_id string, status string, membership_complete boolean")
    claim = lambda *ids: state.corpus_snapshot(runs, spark.createDataFrame([(i,) for i in ids], "run_id string"))
    assert sorted(r.run_id for r in claim("a", "b", "a").collect()) == ["a", "b"] and claim("a", "b").first().snapshot_id == claim("b", "a").first().snapshot_id
    for bad in (["a", "c"], ["d"], ["zz"], []):
        with pytest.raises(ValueError, match="run"):
            claim(*bad)
    before = spark.createDataFrame([(1, "x", 5), (2, None, 5)], "k int, v string, updated_at int")
    after = spark.createDataFrame([(1, "y", 5), (2, None, 5), (3, "z", None)], "k int, v string, updated_at int")
    assert {r.k: r.updated_at for r in state.touch(before, after, ["k"], F.lit(9)).collect()} == {1: 9, 2: 5, 3: 9}


def test_encoding_and_activation(spark, tmp_path):
    from skein.operators import embed
    from skein.sources.versions import Store

    class Lengths:
        version, dimension, most_tokens = "lengths", 2, 3

        def encode(self, texts):
            assert len(texts) <= 2
            return [[float(len(t)), 1.0] for t in texts]

    inputs = spark.createDataFrame([(n, " ".join("abcd"[: n + 1]), f"h{n}") for n in range(4)] + [(9, None, "h9")], "doc_id long, text string, content_hash string")
    found = embed.encode(inputs, Lengths(), batch=2)
    got = {r.document_id: r for r in found.collect()}
    assert got[3].is_shortened and not got[2].is_shortened and got[9].embedding == [0.0, 1.0] and got[0].document_hash == "h0"
    stamped = found.withColumn("created_at", F.lit(1))
    other = stamped.filter("document_id = 1").withColumn("embedding", F.array(F.lit(3.0), F.lit(4.0)).cast("array<float>")).withColumn("created_at", F.lit(0))
    merged = {r.document_id: [round(x, 2) for x in r.embedding] for r in embed.upsert_vectors(stamped, other).collect()}
    assert merged[1] == [0.6, 0.8] and len(merged) == 5
    store = Store(spark, f"file://{tmp_path}/store")
    documents = inputs.filter("text is not null").withColumn("is_active", F.lit(True))
    store.publish({"documents": documents, "vectors": stamped, "snapshots": spark.createDataFrame([("s1", "r")], "snapshot_id string, run_id string")})
    assert embed.activate(store, "lengths", "s1", 2)["active"] == 1 and tuple(store.read("active").first()) == ("lengths", "s1")
    with pytest.raises(ValueError, match="snapshot"):
        embed.activate(store, "lengths", "s2", 2)
    store.publish({"documents": documents.withColumn("content_hash", F.lit("changed"))})
    with pytest.raises(ValueError, match="violations"):
        embed.activate(store, "lengths", "s1", 2)


def test_ids_keep_the_place_of_nulls(spark):
    from skein.functions import ids

    row = spark.range(1).select(*[ids.document_id(*[F.lit(v).cast("string") for v in t]).alias(n) for n, t in (("a", ("5", None, "a", "b")), ("b", ("5", "a", None, "b")))], ids.content_hash(F.lit("t"), F.lit("b  c")).alias("c"), ids.content_hash(F.lit(" t"), F.lit("b c ")).alias("d")).first()
    assert row.a != row.b and row.c == row.d


def test_meet_deals_hot_keys_in_pieces(spark):
    from skein.runtime import meet

    left = spark.createDataFrame([("h", n) for n in range(25)] + [("k", 99)], "key string, a int")
    right = spark.createDataFrame([("h", n) for n in range(17)] + [("k", 5), ("z", 1)], "key string, b int")
    assert sorted(tuple(r) for r in meet(left, right, ["key"], piece=4).collect()) == sorted([("h", a, b) for a in range(25) for b in range(17)] + [("k", 99, 5)])


def test_reconcile(spark):
    listing = spark.createDataFrame([(1, "https://x.org/a/", "Q"), (2, None, "Ann Cole"), (3, None, "Bob D Ray"), (4, None, "Twin"), (5, "https://x.org/zz", "Nobody")], "listing_id int, url string, name string")
    feed = spark.createDataFrame([(11, "https://x.org/a?utm_source=f", "A"), (12, "https://x.org/b", "ann cole"), (13, "https://x.org/c", "Bob Ray"), (14, "https://x.org/d", "Twin"), (15, "https://x.org/e", "TWIN")], "feed_id int, url string, name string")
    got = {tuple(r) for r in matching.reconcile(listing, feed).collect()}
    assert got == {(1, 11, "url"), (2, 12, "name"), (3, 13, "initial"), (4, None, "unmatched"), (5, None, "unmatched"), (None, 14, "left_over"), (None, 15, "left_over")}


def test_candidate_scores(spark):
    shape = "person_id int, candidate_id string, name string, candidate_name string, affiliations array<string>, candidate_affiliations array<string>, titles array<string>, candidate_titles array<string>, research_text string, topics array<string>, direct boolean"
    rows = [
        (1, "x", "Ann Cole", "Ann Cole", ["Home U"], ["Home U"], ["On Rivers"], ["on rivers."], "rivers and deltas", ["deltas"], False),
        (1, "y", "Ann Cole", "A Cole", ["Home U"], ["Far U"], ["On Rivers"], ["Other"], "rivers", ["cats"], False),
        (2, "z", "Ann B Cole", "Ann C Cole", [], ["Home U"], [], [], "x", [], None),
    ]
    scored = matching.score_candidates(spark.createDataFrame(rows, shape), ["home u"])
    got = {r.candidate_id: (r.score, r.contradicted) for r in scored.collect()}
    assert got["x"][0] == pytest.approx(0.30 + 0.25 + 0.25 + 0.09, abs=0.07) and got["y"] == (0.0, True) and got["z"][0] == 0.0
    best = {r.person_id: r for r in matching.decide(matching.best_with_margin(scored, "person_id", "candidate_id")).collect()}
    assert best[1].candidate_id == "x" and best[1].decision == "match" and best[2].decision == "none"


def test_dense_ties_and_unusable_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0]), (8, [float("nan"), 1.0])]
    corpus = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    queries = corpus.filter("doc_id in (1, 3)").withColumnRenamed("doc_id", "query_id")
    got = [(r.query_id, r.doc_id, r.score, r["rank"]) for r in retrieval.dense_top_k(queries, corpus, 2, block_rows=1).orderBy("query_id", "rank").collect()]
    assert got == [(1, 2, 1.0, 1), (1, 4, 1.0, 2), (3, 1, 0.0, 1), (3, 2, 0.0, 2)]
    assert retrieval.dense_top_k(queries.limit(0), corpus, 2).count() == 0


def test_bm25_and_matching_all(spark):
    corpus = spark.createDataFrame([(1, None, "red fox red"), (2, "", "fox"), (3, "Red", "dog"), (4, None, None), (5, "", "")], "doc_id long, title string, text string")
    queries = spark.createDataFrame([(9, "red fox"), (8, "zebra"), (7, "red dog")], "query_id long, text string")
    got = {r.query_id: [] for r in queries.collect()}
    for r in retrieval.bm25_top_k(queries, corpus, 5).orderBy("rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    factor = retrieval.TITLE_WEIGHT / retrieval.TEXT_WEIGHT
    mean, idf = (3 + 1 + 1 + factor) / 3, lambda df: math.log(1 + (5 - df + 0.5) / (df + 0.5))
    weight = lambda tf, n: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))
    assert dict(got[9]) == pytest.approx({1: idf(2) * weight(2, 3) + idf(2) * weight(1, 3), 2: idf(2) * weight(1, 1), 3: idf(2) * weight(factor, 1 + factor)}, abs=1e-5)
    assert got[8] == [] and got[7][0][0] == 3
    assert {tuple(r) for r in retrieval.matching_all(queries, corpus).collect()} == {(9, 1), (7, 3)}  # title and text together


def test_fusion_and_owners(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, doc_id int, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id int, doc_id int, rank int")
    traced = {r.doc_id: (r.rank_a, r.rank_b) for r in retrieval.fuse({"a": a, "b": b}, trace=True).collect()}
    assert traced == {10: (1, None), 11: (2, 1), 12: (None, 2)} and retrieval.single(a).first().score == round(1 / 61, 9)
    fused = retrieval.fuse({"a": a, "b": b})
    assert [(r.doc_id, round(r.score, 6)) for r in fused.orderBy("rank").collect()] == [(11, round(1 / 61 + 1 / 62, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]
    docs = spark.createDataFrame([(10, "o", "t", "x"), (11, "o", "t", "x"), (12, "p", "t", "y")], "doc_id int, owner_id string, document_type string, external_id string")
    owners = [(r.owner_id, r.n_evidence, round(r.score, 6)) for r in retrieval.rank_owners(fused, docs).orderBy("rank").collect()]
    assert owners == [("o", 1, round(0.6 * (1 / 61 + 1 / 62), 6)), ("p", 1, round(0.6 / 62, 6))]


def test_compose_query():
    assert retrieval.compose_query(" a ", methods="b") == "a\nMethods: b"
    with pytest.raises(ValueError, match="empty"):
        retrieval.compose_query(" ")
    with pytest.raises(ValueError, match="more than"):
        retrieval.compose_query("a" * 9000)


def test_measures(spark):
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 20, 1)], "query_id int, doc_id int, rank int")
    truth = spark.createDataFrame([(1, 11, 3), (1, 13, 2), (1, 12, 0), (2, 20, 1), (3, 30, 2)], "query_id int, doc_id int, grade int")
    got = {r.query_id: r for r in evaluate.measures(ranked, truth).collect()}
    ideal = 7 + 3 / math.log2(3)
    assert got[1].recall_5 == 0.5 and got[1].reciprocal_rank == 0.5 and got[1].ndcg_5 == pytest.approx(7 / math.log2(3) / ideal, abs=1e-6) and got[1].judged_5 == pytest.approx(2 / 3, abs=1e-6)
    assert got[2].recall_5 is None and got[3].recall_5 == 0.0 and got[3].reciprocal_rank == 0.0
    mean = {r.measure: (r["mean"], r.n_queries) for r in evaluate.macro(evaluate.measures(ranked, truth), ["recall_5"]).collect()}
    assert mean == {"recall_5": (0.25, 2)}
    b = evaluate.bootstrap(evaluate.measures(ranked, truth), "recall_5").first()
    assert b.low <= b["mean"] <= b.high


def test_reports_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, is_active boolean, faculty_id long, chunk_key string, created_at timestamp, source string, n_chars long, document_type string, content_hash string")
    vectors = spark.createDataFrame([], "document_id long, embedding_version string, created_at timestamp, embedding array<float>, document_hash string")
    assert report.corpus_health(docs).first().n_documents == 0
    assert report.missing_vectors(docs, vectors, 3).count() == report.activation(docs, vectors, 3).count() == 0


def test_lexical_queries_and_recency(spark):
    q = retrieval.lexical_query('The rivers and "flowing waters of rivers" studied', most=3)
    assert q == {"terms": ["river", "flow", "water"], "phrases": [["flow", "water", "river"]]}
    results = spark.createDataFrame([(1, 10, 0.4, 1), (1, 11, 0.3, 2)], "query_id int, doc_id int, score double, rank int")
    docs = spark.createDataFrame([(10, 2015), (11, None)], "doc_id int, publication_year int")
    assert [(r.doc_id, r.score) for r in retrieval.recency(results, docs, 2025, 10).orderBy("rank").collect()] == [(11, 0.3), (10, 0.2)]
    assert retrieval.recency(results, docs, 2025) is results


def test_settings():
    from skein.settings import Settings, from_environment

    assert from_environment({"SKEIN_YEARS": "5", "SKEIN_LISTING_SPACING": "2.5"}) == Settings(years=5, listing_spacing=2.5)
    for bad in ({"chunk_overlap": 400}, {"chunk_limit": 600}, {"years": 0}, {"publications": 60}):
        with pytest.raises(ValueError, match="must"):
            Settings(**bad)


def test_json_rows(spark):
    from skein.sources.tables import as_json

    assert as_json(spark.createDataFrame([(1, None)], "b int, a string")).first().value == '{"a":null,"b":1}'
