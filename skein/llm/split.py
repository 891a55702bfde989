"""Splitting oversized items at natural boundaries.

Per text, one pass finds the tokens and the boundaries. Token offsets (prefix sums of sizes) and the sorted array of
boundaries are then searched by bisection: each piece ends at the last boundary of the best kind under the limit, the
next one steps back by the overlap, and a hard cut is the fallback.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.canonical import SPACE
from skein.runtime import frame, spread

LIMIT, OVERLAP = 400, 50

_WORD = re.compile(f"[^{SPACE}]+")
#: A boundary lies before the word that follows. Kinds, best first: blank line, line end, sentence end, clause end.
_LINE_END = re.compile(f"[\n\r{chr(0x2028)}{chr(0x2029)}]")
_PARAGRAPH = re.compile(f"\n[ \t\r]*\n|{chr(0x2029)}")
_SENTENCE_END = re.compile("[.!?%s%s][\"')\\]%s%s%s]*$" % tuple(map(chr, (0x2026, 0x3002, 0x201D, 0x2019, 0xBB))))
_CLAUSE_END = re.compile(r"[;:,]$")


def cut_points(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(pieces, words): pieces as half-open ranges of words, words as character spans.

    No piece has more than `limit` words; consecutive pieces share at most `overlap` words; every word is in a piece.
    A text of at most `limit` words is one piece; one without words has none.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    n = len(words)
    if n <= limit:
        return ([(0, n)] if n else []), words
    kinds: list[list[int]] = [[], [], [], []]
    for i in range(1, n):
        gap = text[words[i - 1][1] : words[i][0]]
        if _LINE_END.search(gap):
            kinds[0 if _PARAGRAPH.search(gap) else 1].append(i)
        else:
            last = text[words[i - 1][0] : words[i - 1][1]]
            if _SENTENCE_END.search(last):
                kinds[2].append(i)
            elif _CLAUSE_END.search(last):
                kinds[3].append(i)
    merged = sorted(kinds[0] + kinds[1] + kinds[2])
    pieces, start = [], 0
    while True:
        if n - start <= limit:
            pieces.append((start, n))
            return pieces, words
        most = start + limit
        end = 0
        for boundaries in (*kinds, None):
            # better kinds of boundary only count in the later half, so that pieces don't become splinters
            if boundaries is None:
                end = most
                break
            k = bisect_right(boundaries, most) - 1
            if k >= 0 and boundaries[k] > start + max(limit // 2, overlap):
                end = boundaries[k]
                break
        pieces.append((start, end))
        # the overlap begins at the first boundary within it, so that it holds whole sentences where possible
        least = max(end - overlap, start + 1)
        k = bisect_left(merged, least)
        start = merged[k] if k < len(merged) and merged[k] < end else least


def split_items(items: DataFrame, text: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(*keep, chunk_key, piece_no, first_word, n_words, piece) for every text of more than `limit` words.

    chunk_key numbers the pieces as section-001, section-002 and so on. Null, blank and short texts give no rows.
    Texts that can't exceed the limit by their length are dropped before they leave the JVM.
    """
    long = items.select(*keep, F.col(text).alias("_text")).filter(F.length("_text") > 2 * limit)
    fields = ", ".join(f"`{c}` {t}" for c, t in long.dtypes if c != "_text")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False, name=None):
                *kept, body = row
                cuts, words = cut_points(body, limit, overlap)
                if len(words) > limit:
                    rows += [(*kept, f"section-{k:03d}", k, a, b - a, body[words[a][0] : words[b - 1][1]]) for k, (a, b) in enumerate(cuts, 1)]
            yield frame(rows, [*keep, "chunk_key", "piece_no", "first_word", "n_words", "piece"])

    return long.mapInPandas(pieces, f"{fields}, chunk_key string, piece_no int, first_word int, n_words int, piece string")


def long_texts(faculty: DataFrame, documents: DataFrame) -> DataFrame:
    """Biographies and document texts side by side: (source_table, item_id, text)."""
    a = faculty.select(F.lit("raw_faculty").alias("source_table"), F.col("record_id").alias("item_id"), F.col("biography").alias("text"))
    b = documents.select(F.lit("documents").alias("source_table"), F.col("doc_id").alias("item_id"), "text")
    return spread(a).unionByName(spread(b))
