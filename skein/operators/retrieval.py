"""Retrieval over a corpus for many queries at once: dense, lexical, fused, by owner."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import name_key, terms
from skein.runtime import cut, join_small

K1, B = 1.2, 0.75


def first_k(ranked: DataFrame, query: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    place = Window.partitionBy(query).orderBy(*order)
    return ranked.withColumn(rank, F.row_number().over(place)).filter(F.col(rank) <= k)


def dense_top_k(queries: DataFrame, corpus: DataFrame, k: int = 50, block_rows: int = 4096, decimals: int = 6) -> DataFrame:
    """(query_id, doc_id, score, rank): exact cosine top k. queries and corpus: (query_id | doc_id, vector), ids long.

    The queries are a stated set and meet the corpus in blocks of about block_rows, each sent to the executors; a corpus
    row never moves, and every batch passes on only k rows per query. Scores are rounded before ranking, so that ties go
    to the smaller id. A document isn't its own neighbour. Vectors that are null, zero, not finite or of another length
    than the queries' longest are left out.
    """
    spark = queries.sparkSession
    q = queries.select(F.col("query_id").cast("long"), "vector").filter("query_id is not null and vector is not null")
    docs = corpus.select(F.col("doc_id").cast("long"), "vector").filter("doc_id is not null and vector is not null")
    shape = q.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dimension")).first()
    if not shape["n"]:
        return spark.createDataFrame([], "query_id long, doc_id long, score double, rank int")
    blocks, dimension = math.ceil(shape["n"] / block_rows), shape["dimension"]
    parts = []
    for n in range(blocks):
        block = q.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n) if blocks > 1 else q
        asked = spark.sparkContext.broadcast(_units(block.toArrow(), "query_id", dimension))  # one block of the query set

        def search(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            names, wanted = asked.value
            for batch in batches:
                found, vectors = _units(pa.Table.from_batches([batch]), "doc_id", dimension)
                scores = np.round(wanted @ vectors.T, decimals)
                scores[names[:, None] == found[None, :]] = -np.inf
                if scores.shape[1] > k:  # ties with the k-th stay in
                    low = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                    row, col = np.nonzero((scores >= low[:, None]) & np.isfinite(scores))
                else:
                    row, col = np.nonzero(np.isfinite(scores))
                yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(found[col]), pa.array(scores[row, col])], names=["query_id", "doc_id", "score"])

        parts.append(docs.mapInArrow(search, "query_id long, doc_id long, score double"))
    return first_k(reduce(DataFrame.unionByName, parts), "query_id", [F.col("score").desc(), F.col("doc_id").asc()], k)


def _units(table: pa.Table, key: str, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors of length one) of the usable rows."""
    column = table.column("vector").combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    right = np.flatnonzero(np.array(pc.fill_null(pc.list_value_length(column), -1)) == dimension)
    values = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), dimension)
    norms = np.linalg.norm(values, axis=1)
    usable = np.isfinite(norms) & (norms > 0)
    return np.asarray(table.column(key))[right[usable]].astype(np.int64), values[usable] / norms[usable, None]


#: Weights of a term in the title and in the text.
TITLE_WEIGHT, TEXT_WEIGHT = 1.0, 0.4


def postings(corpus: DataFrame, title_weight: float = TITLE_WEIGHT, text_weight: float = TEXT_WEIGHT) -> DataFrame:
    """(term, doc_id, tf, length): the inverted table of documents (doc_id, title, text), written once.

    tf is the weighted number of times a term occurs in title and text, in units of the text's weight; length is the
    weighted number of all terms. A document that has a term only in its title is in the table too.
    """
    words = lambda c: F.filter(F.split(F.coalesce(name_key(F.col(c)), F.lit("")), " "), lambda w: w != "")
    factor = title_weight / text_weight
    split = corpus.select("doc_id", words("title").alias("a"), words("text").alias("b")).withColumn("length", F.size("a") * F.lit(factor) + F.size("b"))
    both = F.concat(F.transform("a", lambda w: F.struct(w.alias("term"), F.lit(factor).alias("n"))), F.transform("b", lambda w: F.struct(w.alias("term"), F.lit(1.0).alias("n"))))
    return cut(split.select("doc_id", "length", F.explode(both).alias("x")).groupBy(F.col("x.term").alias("term"), "doc_id", "length").agg(F.sum("x.n").alias("tf")))


def _hits(asked: DataFrame, table: DataFrame) -> DataFrame:
    """Query terms with their postings. The terms asked for are a small side; where they aren't, they are spread by salt,
    since a frequent term has a posting in nearly every document."""
    return join_small(table, asked, ["term"])


#: Documents that a task scores at once. It bounds memory, not the result.
CHUNK_DOCUMENTS = 16_384


def bm25_top_k(queries: DataFrame, corpus: DataFrame, k: int = 50, decimals: int = 6, block_rows: int = 16_384) -> DataFrame:
    """(query_id, doc_id, score, rank): BM25 top k over weighted fields. queries: (query_id, text); corpus: (doc_id,
    title, text), ids long. Statistics cover the whole corpus.

    The queries are a stated set and meet the corpus in blocks of about block_rows, each sent to the executors. Documents
    stream past them, once for the numbers of documents with a term and once for scores; neither postings nor scores of
    pairs are written. A task hands on the k best documents of its own for every query, which hold its share of the best
    of all: scores are rounded before ranking, and ties go to the smaller id.
    """
    spark = queries.sparkSession
    asked = cut(queries.select("query_id", F.explode(terms(F.col("text"), 1)).alias("term")).groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms")))
    shape = f"query_id {asked.schema['query_id'].dataType.simpleString()}, doc_id long, score double"
    n_queries, n_rows, n_docs = asked.count(), corpus.count(), corpus.select("doc_id").distinct().count()
    if not n_queries:
        return spark.createDataFrame([], f"{shape}, rank int")
    keys = corpus.select(F.col("doc_id").cast("long"), *[F.coalesce(name_key(F.col(c)), F.lit("")).alias(c) for c in ("title", "text")])
    if n_rows == n_docs:
        docs = keys.select("doc_id", F.array("title").alias("titles"), F.array("text").alias("texts"))
    else:
        docs = keys.groupBy("doc_id").agg(F.collect_list(F.struct("title", "text")).alias("rows")).select("doc_id", F.col("rows.title").alias("titles"), F.col("rows.text").alias("texts"))
    blocks, parts = math.ceil(n_queries / block_rows), []
    for n in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n) if blocks > 1 else asked
        known = block.toArrow()  # one block of the query set
        if known.num_rows:
            parts.append(docs.mapInArrow(_scorer(docs, known, n_docs, k, decimals), shape))
    return first_k(reduce(DataFrame.unionByName, parts), "query_id", [F.col("score").desc(), F.col("doc_id").asc()], k)


def _scorer(docs: DataFrame, known: pa.Table, n_docs: int, k: int, decimals: int):  # noqa: ANN202
    """What takes batches of documents to the k best of each query in `known` (query_id, terms)."""
    context = docs.sparkSession.sparkContext
    lists = known.column("terms").combine_chunks()
    wanted = pc.unique(lists.flatten())
    numbers, ends = pc.index_in(lists.flatten(), value_set=wanted).to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())
    sets: dict[tuple[int, ...], int] = {}  # queries of the same terms are scored once
    of = np.array([sets.setdefault(tuple(sorted(x.tolist())), len(sets)) for x in np.split(numbers, ends[:-1])])
    words = context.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, entries, total = np.zeros(len(words.value), np.int64), 0, 0.0
        for batch in batches:
            _, length, _, term, _ = _entries(batch, words.value)
            df += np.bincount(term, minlength=len(df))
            entries, total = entries + int((length > 0).sum()), total + float(length.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *seen], pa.int64()), pa.array([entries, *df[seen]], pa.int64()), pa.array([total, *np.zeros(len(seen))], pa.float64())], names=["term", "n", "length"])

    counted = docs.mapInArrow(count, "term long, n long, length double").groupBy("term").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).toArrow().to_pydict()
    df, mean = np.zeros(len(wanted)), 0.0
    for term, m, length in zip(counted["term"], counted["n"], counted["length"], strict=True):
        if term < 0:
            mean = length / max(m, 1)
        else:
            df[term] = m
    shared = context.broadcast((known.column("query_id").combine_chunks(), of, [np.array(x) for x in sets], np.log(1 + (n_docs - df + 0.5) / (df + 0.5)), mean))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, of, sets, idf, mean = shared.value
        best, ids, held, size = np.full((len(sets), k), -np.inf), np.zeros((len(sets), k), np.int64), [], 0
        for batch in batches:
            document, length, entry, term, tf = _entries(batch, words.value)
            part = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[entry] / mean)) if len(tf) else tf
            held.append((pc.fill_null(batch.column(0), _NO_ID).to_numpy(), document[entry] + size, term, part))
            size += batch.num_rows
            if size >= CHUNK_DOCUMENTS:
                _score(held, sets, len(idf), best, ids, decimals)
                held, size = [], 0
        if held:
            _score(held, sets, len(idf), best, ids, decimals)
        for first in range(0, len(of), 1024):
            mine = of[first : first + 1024]
            row, col = np.nonzero(np.isfinite(best[mine]))
            found = ids[mine[row], col]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(first + row)), pa.array(found, mask=found == _NO_ID), pa.array(best[mine[row], col])], names=["query_id", "doc_id", "score"])

    return search


#: Stands for a document id that is null.
_NO_ID = np.iinfo(np.int64).max


def _entries(batch: pa.RecordBatch, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents (doc_id, titles, texts) as they would stand in the inverted table: document and length of every entry;
    entry, term and tf of every wanted term. Rows of a document that have the same length are one entry."""
    document = np.asarray(pc.list_parent_indices(batch.column(1))).astype(np.int64)
    length, keys, weights = np.zeros(len(document)), [], []
    for column, weight in ((1, TITLE_WEIGHT / TEXT_WEIGHT), (2, 1.0)):
        split = pc.split_pattern(batch.column(column).flatten(), " ")
        words, row = split.flatten(), np.asarray(pc.list_parent_indices(split)).astype(np.int64)
        length += weight * np.bincount(row[pc.not_equal(words, "").to_numpy(zero_copy_only=False)], minlength=len(document))
        term = pc.fill_null(pc.index_in(words, value_set=wanted), -1).to_numpy()
        keys.append(row[term >= 0] * len(wanted) + term[term >= 0])
        weights.append(np.full(len(keys[-1]), weight))
    key = np.concatenate(keys)
    if len(document) > batch.num_rows:
        entries, entry = np.unique(np.stack([document, length]), axis=1, return_inverse=True)
        document, length = entries[0].astype(np.int64), entries[1]
        key = entry.ravel()[key // len(wanted)] * len(wanted) + key % len(wanted)
    key, place = np.unique(key, return_inverse=True)
    return document, length, key // len(wanted), key % len(wanted), np.bincount(place, np.concatenate(weights), len(key))


def _score(held: list[tuple], sets: list[np.ndarray], n_terms: int, best: np.ndarray, ids: np.ndarray, decimals: int) -> None:
    """Takes the documents of a chunk into the k best of every set of terms, kept in order of rank."""
    names, document, term, part = (np.concatenate([h[i] for h in held]) for i in range(4))
    key, place = np.unique(term * len(names) + document, return_inverse=True)
    document, part = key % len(names), np.bincount(place, part, len(key))
    starts = np.searchsorted(key, np.arange(n_terms + 1) * len(names))
    rows: dict[int, np.ndarray] = {}  # terms of many documents, a number for each document
    for t in np.flatnonzero(np.diff(starts) > len(names) // 8):
        rows[t] = np.zeros(len(names))
        rows[t][document[starts[t] : starts[t + 1]]] = part[starts[t] : starts[t + 1]]
    scores, k = np.empty(len(names)), best.shape[1]
    for n, wanted in enumerate(sets):
        scores.fill(0)
        for t in wanted:
            if t in rows:
                scores += rows[t]
            else:
                scores[document[starts[t] : starts[t + 1]]] += part[starts[t] : starts[t + 1]]
        low = best[n, -1]  # what is below it can't be among the k best, nor what is below k documents of this chunk
        if low == -np.inf and len(scores) > k:
            low = np.partition(scores, len(scores) - k)[len(scores) - k]
        low -= 10.0**-decimals
        if low > 0:
            near = np.flatnonzero(scores >= low)
        else:
            near = np.unique(np.concatenate([document[starts[t] : starts[t + 1]] for t in wanted]))
        if not len(near):
            continue
        new = np.round(scores[near], decimals)
        if len(near) > k:  # ties with the k-th stay in
            keep = new >= np.partition(new, len(new) - k)[len(new) - k]
            near, new = near[keep], new[keep]
        new, found = np.concatenate([best[n], new]), np.concatenate([ids[n], names[near]])
        order = np.lexsort((found, -new))[:k]
        best[n], ids[n] = new[order], found[order]


def matching_all(queries: DataFrame, corpus: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id) of the documents that hold every term of the query in title or text."""
    asked = cut(queries.select("query_id", F.explode(terms(F.col("text"), 1)).alias("term")).filter("term <> ''"))
    need = asked.groupBy("query_id").agg(F.count("*").alias("_need"))
    table = postings(corpus) if table is None else table
    hits = _hits(asked, table.select("term", "doc_id")).groupBy("query_id", "doc_id").agg(F.count("*").alias("_have"))
    return hits.join(need, "query_id").filter("_have = _need").select("query_id", "doc_id")


def single(channel: DataFrame, k: int = 60, decimals: int = 9) -> DataFrame:
    """A channel alone with the score 1 / (k + rank), so that single and fused scores can be compared."""
    return channel.withColumn("score", F.round(1 / (k + F.col("rank")), decimals))


def fuse(channels: dict[str, DataFrame], k: int = 60, keep: int = 100, decimals: int = 9, trace: bool = False) -> DataFrame:
    """(query_id, doc_id, score, best_rank, rank): reciprocal rank fusion of ranked channels (query_id, doc_id, rank).

    A channel in which a document is absent adds nothing. Union and one aggregate instead of an outer join per channel.
    With `trace`, rank_<channel> tells the rank that each channel gave, null where the document is absent.
    """
    ranked = reduce(DataFrame.unionByName, [c.select("query_id", "doc_id", "rank", F.lit(name).alias("_c")) for name, c in channels.items()])
    ranks = [F.min(F.when(F.col("_c") == name, F.col("rank"))).alias(f"rank_{name}") for name in channels] if trace else []
    fused = ranked.groupBy("query_id", "doc_id").agg(F.round(F.sum(1 / (k + F.col("rank"))), decimals).alias("score"), F.min("rank").alias("best_rank"), *ranks)
    return first_k(fused, "query_id", [F.col("score").desc(), F.col("best_rank").asc(), F.col("doc_id").asc()], keep)


def rank_owners(results: DataFrame, documents: DataFrame, weights: tuple[float, ...] = (0.60, 0.30, 0.10), keep: int = 10, decimals: int = 9) -> DataFrame:
    """(query_id, owner_id, score, best_rank, n_evidence, rank): owners by their best documents.

    results: (query_id, doc_id, score, rank); documents: (doc_id, owner_id, document_type, external_id). Documents of
    one owner with the same type and external id (chunks) count once, the best one. Missing places count 0; owners
    without a document don't appear. Ties go to the better document, then to the first normalised name where documents
    have owner_name, then to the smaller id.
    """
    owned = results.join(documents, "doc_id").filter("owner_id is not null")
    once = Window.partitionBy("query_id", "owner_id", "document_type", "external_id").orderBy("rank")
    best = owned.withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    place = Window.partitionBy("query_id", "owner_id").orderBy("rank")
    top = best.withColumn("_p", F.row_number().over(place)).filter(F.col("_p") <= len(weights))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_p"))
    named = "owner_name" in documents.columns
    owners = top.groupBy("query_id", "owner_id").agg(F.round(F.sum(F.col("score") * weight), decimals).alias("score"), F.min("rank").alias("best_rank"), F.count("*").alias("n_evidence"), *([F.min(name_key(F.col("owner_name"))).alias("_name")] if named else []))
    order = [F.col("score").desc(), F.col("best_rank").asc(), *([F.col("_name").asc_nulls_last()] if named else []), F.col("owner_id").asc()]
    return first_k(owners, "query_id", order, keep).drop("_name")


def compose_query(text: str, interests: str = "", methods: str = "", background: str = "", most_chars: int = 8000) -> str:
    """A query of free text and labelled lines; repeated lines once, an error if nothing is left or it is too long."""
    lines = [text.strip(), *[f"{label}: {value.strip()}" for label, value in (("Research interests", interests), ("Methods", methods), ("Background", background)) if value.strip()]]
    kept = list(dict.fromkeys(x for x in lines if x))
    if not kept:
        raise ValueError("the query is empty")
    query = "\n".join(kept)
    if len(query) > most_chars:
        raise ValueError(f"the query has more than {most_chars} characters")
    return query


#: Words of a query that carry no meaning.
STOP = frozenset("a an and are as at be by for from has have i in is it its of on or our that the their this to was we were which with you".split())


def stem(word: str) -> str:
    """A word without its most common English endings, the same for a query and a document."""
    for ending, least in (("ies", 3), ("sses", 2), ("ing", 4), ("ed", 4), ("s", 3)):
        if word.endswith(ending) and len(word) - len(ending) >= least and not word.endswith("ss"):
            return word[: -len(ending)] + {"ies": "y", "sses": "ss"}.get(ending, "")
    return word


def lexical_query(text: str, most: int = 32) -> dict[str, list]:
    """terms (stems in order of first occurrence, without stop words, at most `most`) and phrases (quoted parts as
    lists of stems) of a free query."""
    words = lambda t: [stem(w) for w in re.findall(r"[^\W_]+", t.casefold()) if w not in STOP]
    phrases = [p for q in re.findall(r'"([^"]+)"', text) if len(p := words(q)) > 1]
    return {"terms": list(dict.fromkeys(words(text)))[:most], "phrases": phrases}


def recency(results: DataFrame, documents: DataFrame, current_year: int, half_life: float | None = None, decimals: int = 9) -> DataFrame:
    """Results with the scores of publications halved for every half_life years of age, ranked anew; off by default."""
    if half_life is None:
        return results
    years = documents.filter("publication_year is not null").select("doc_id", "publication_year")
    age = F.greatest(F.lit(0.0), F.lit(float(current_year)) - F.col("publication_year"))
    aged = results.join(years, "doc_id", "left").withColumn("score", F.round(F.col("score") * F.coalesce(F.pow(F.lit(0.5), age / half_life), F.lit(1.0)), decimals))
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("rank").asc())
    return aged.drop("publication_year").withColumn("rank", F.row_number().over(place))
