"""Evaluation texts leaking into training text, by size-partitioned MinHash containment search.

A leaked passage is a run of `run` consecutive words of an item (or the whole of a shorter item). Items are partitioned
by the size w of their passages, which settles their number of shingles. For every partition a document is seen as its
windows of exactly w words; a window's signature are its minima under two hash functions, so a window that holds a
passage has the passage's signature without fail. Documents emit a window only where a filter of fixed size, built from
all signatures of the items, lets it through; windows and passages then meet in a join on size and signature and are
verified by exact containment: all words of the passage in sequence.

One pass over the documents, whatever the number of items; texts don't move, only the few windows that pass the filter.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.runtime import cut, frame, join_small, spread

RUN, SHINGLE = 12, 5
#: Bits of the filter per passage, and its least and greatest size; the greatest is 16 MB.
BITS_PER_PASSAGE, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27
#: Documents that are hashed together.
BLOCK = 512
_CHUNK = 1 << 16

_ASCII_WORD = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"[^\W_]+")
_UNSEEN = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_FACTORS = np.random.default_rng(7).integers(1, 2**63, size=2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, without regard to case, accents, compatibility forms and invisible characters."""
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())
    return _WORD.findall(_UNSEEN.sub("", plain))


class _Hashes(dict):
    """Word hashes; emptied by its owner when it grows."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def signatures(words: np.ndarray, w: int) -> np.ndarray:
    """The signature of every window of w words of a sequence of word hashes, in order."""
    n = len(words) - w + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    k = min(SHINGLE, w)
    with np.errstate(over="ignore"):
        shingles = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            shingles = (shingles * _GOLDEN) ^ words[j : j + len(shingles)]
            shingles ^= shingles >> np.uint64(29)
        out = np.full(n, np.uint64(w))
        for factor in _FACTORS:
            v = shingles * factor
            v ^= v >> np.uint64(32)
            least, span = v, 1  # minima over twice as many shingles in every step
            while span < w - k + 1:
                step = min(span, w - k + 1 - span)
                least = np.minimum(least[: len(least) - step], least[step:])
                span += step
            out = (out ^ least[:n]) * _MIX
            out ^= out >> np.uint64(31)
    return out


def passages(items: DataFrame, run: int = RUN) -> DataFrame:
    """(item_id, w, sig, passage) of items (item_id, text): every run of w words, w being `run` or the size of a shorter
    item."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = words_of(text)
                w = min(run, len(words))
                if w:
                    found = signatures(np.array([hashes[x] for x in words], np.uint64), w).view(np.int64)
                    rows += [(item, w, sig, " ".join(words[j : j + w])) for j, sig in enumerate(found.tolist())]
            hashes.clear()
            yield frame(rows, ["item_id", "w", "sig", "passage"])

    return items.mapInPandas(read, "item_id long, w int, sig long, passage string").distinct()


def _filter(found: DataFrame, bits: int) -> np.ndarray:
    """A bit for every signature modulo `bits`, packed; put together in pieces on the executors."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(_CHUNK, np.uint8)
        marks[group["at"].to_numpy()] = 1
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "packed": [np.packbits(marks).tobytes()]})

    places = found.select(F.pmod("sig", F.lit(bits)).alias("p")).distinct().select((F.col("p") / _CHUNK).cast("long").alias("chunk"), (F.col("p") % _CHUNK).cast("int").alias("at"))
    out = np.zeros(bits // 8, np.uint8)
    for r in places.groupBy("chunk").applyInPandas(pack, "chunk long, packed binary").toLocalIterator():  # at most bits / 8 bytes
        out[r["chunk"] * (_CHUNK // 8) : (r["chunk"] + 1) * (_CHUNK // 8)] = np.frombuffer(r["packed"], np.uint8)
    return out


def find_leaks(documents: DataFrame, items: DataFrame, run: int = RUN, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, item_id): the documents that hold at least `run` consecutive words of an item, or all of a shorter one.

    Null or wordless documents and items match nothing; an item_id with several texts stands for all of them; each pair
    is given once. More passages than the filter has room for only let more windows through to the join.
    """
    spark = documents.sparkSession
    known = cut(passages(items.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null"), run))
    sizes = sorted(r["w"] for r in known.select("w").distinct().collect())  # at most `run` of them
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long")
    bits = LEAST_BITS
    while bits < min(most_bits, BITS_PER_PASSAGE * known.count()):
        bits *= 2
    wanted = spark.sparkContext.broadcast(_filter(known, bits))  # at most MOST_BITS / 8 bytes
    docs = spread(documents.select(F.col("doc_id").cast("long"), "text").filter("text is not null"), "doc_id")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks, hashes = wanted.value, _Hashes()
        for batch in batches:
            rows: set[tuple] = set()
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for at in range(0, len(texts), BLOCK):
                split = [words_of(t) for t in texts[at : at + BLOCK]]
                words = [w for x in split for w in x]
                if not words:
                    continue
                h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                ends = np.cumsum([len(x) for x in split])
                owner = np.repeat(np.arange(len(split)), [len(x) for x in split])
                for w in sizes:
                    sig = signatures(h, w)
                    place = sig & np.uint64(bits - 1)
                    hit = np.flatnonzero((marks[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & 1)
                    hit = hit[hit + w <= ends[owner[hit]]]  # a window ends with its document
                    rows.update((ids[at + d], w, s, " ".join(words[j : j + w])) for j, d, s in zip(hit.tolist(), owner[hit].tolist(), sig[hit].view(np.int64).tolist(), strict=True))
                if len(hashes) > 500_000:
                    hashes.clear()
            yield frame(sorted(rows), ["doc_id", "w", "sig", "passage"])

    windows = docs.mapInPandas(search, "doc_id long, w int, sig long, passage string")
    return join_small(windows, known, ["w", "sig", "passage"]).select("doc_id", "item_id").distinct()
