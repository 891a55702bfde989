"""Documents cut into chunks that fit an encoder.

A text is read once: word spans, the kind of break before every word, and the running sum of token sizes. Everything
after that is arithmetic on word numbers. The end of a piece, of a chunk and of its overlap is each found by one
bisection in the running sums, so a text is never counted again however many chunks it gives.

Sizes are those of a tokenizer that works word by word (a word is what stands between white space), as word-piece and
byte-pair vocabularies do; a text then has the sum of the sizes of its words.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sizes of words, all at once so that a tokenizer can take them as a batch.
Sizes = Callable[[list[str]], list[int]]

#: The encoder's limit for a chunk with its title, the size to aim at, the overlap, and the encoder's own limit.
LIMIT, TARGET, OVERLAP, ENCODER = 448, 400, 50, 512

_WORD = re.compile(r"\S+")
_BLANK_LINE = re.compile(r"\n\s*\n")


def words(texts: list[str]) -> list[int]:
    """Every word counts one."""
    return [1] * len(texts)


@functools.cache
def _tokenizer(path: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary(path: str) -> Sizes:
    """Sizes by a vocabulary file of the `tokenizers` library, which must be readable under `path` on every executor."""

    def sizes(texts: list[str]) -> list[int]:
        found: dict[str, int] = {}
        fresh = list(dict.fromkeys(texts))
        for word, encoded in zip(fresh, _tokenizer(path).encode_batch([f" {w}" for w in fresh], add_special_tokens=False), strict=True):
            found[word] = len(encoded.ids)
        return [found[w] for w in texts]

    return sizes


class Layout:
    """Words of a text with their running sizes; `paragraphs` and `sentences` are the word numbers where one ends."""

    def __init__(self, text: str, sizes: Sizes) -> None:
        spans = [m.span() for m in _WORD.finditer(text)]
        self.text, self.spans = text, spans
        self.words = [text[a:b] for a, b in spans]
        self.upto = [0, *accumulate(sizes(self.words))]
        self.paragraphs, self.sentences = [], []
        for n in range(1, len(spans)):
            if _BLANK_LINE.search(text, spans[n - 1][1], spans[n][0]):
                self.paragraphs.append(n)
                self.sentences.append(n)
            elif self.words[n - 1][-1] in ".!?":
                self.sentences.append(n)
        if spans:
            self.paragraphs.append(len(spans))
            self.sentences.append(len(spans))

    def size(self, a: int, b: int) -> int:
        return self.upto[b] - self.upto[a]

    def reach(self, a: int, most: int) -> int:
        """The last word number up to which the words from a on have at most `most` tokens."""
        return bisect_right(self.upto, self.upto[a] + most, lo=a) - 1

    def pieces(self, most: int) -> list[int]:
        """Ends of the pieces: a piece is as many whole sentences of one paragraph as fit, or as many words of a
        sentence that doesn't. A word beyond the limit is an error."""
        ends, at, p = [], 0, 0
        while at < len(self.words):
            while self.paragraphs[p] <= at:
                p += 1
            far = min(self.reach(at, most), self.paragraphs[p])
            k = bisect_right(self.sentences, far) - 1
            end = self.sentences[k] if k >= 0 and self.sentences[k] > at else far
            if end == at:
                raise ValueError(f"a word of more than {most} tokens")
            ends.append(end)
            at = end
        return ends


def chunks(title: str, body: str, sizes: Sizes = words, limit: int = LIMIT, target: int = TARGET, overlap: int = OVERLAP) -> list[tuple[str, str]]:
    """(key, text) of a document: one chunk `whole` if title and body fit, else section-001 and so on.

    A chunk holds the pieces that bring it up to `target` tokens, at least one, behind up to `overlap` words of the
    chunk before it (and no more tokens than that), unless the overlap would push its first piece beyond what the title
    leaves of `limit`. Pieces stand a blank line apart. An empty body is one empty chunk.
    """
    page = Layout(body, sizes)
    head = sum(sizes(f"Title: {title}\nText: ".split()))
    if head + page.upto[-1] <= limit:
        return [("whole", body)]
    room = max(1, limit - head)
    aim = min(target, room)
    ends = page.pieces(room)
    starts = {0, *ends}
    out, start, at = [], 0, 0  # the chunk begins with word `start`; `at` is its first word that no chunk had before
    while at < len(page.words):
        first = ends[bisect_right(ends, at)]
        if page.size(start, first) > room:
            start = at
        k = bisect_right(ends, page.reach(start, aim)) - 1
        end = max(first, ends[k] if k >= 0 else 0)
        out.append("".join(("" if n == start else "\n\n" if n >= at and n in starts else " ") + page.words[n] for n in range(start, end)))
        least = max(start, end - overlap)
        tail = bisect_right(page.upto, page.upto[end] - overlap - 1, lo=least, hi=end) if page.size(least, end) > overlap else least
        start, at = tail, end
    return [(f"section-{n:03d}", text) for n, text in enumerate(out, 1)]


def fit(text: str, most: int = ENCODER, sizes: Sizes = words) -> tuple[str, bool]:
    """(text, shortened): as many whole sentences as fit, else as many words of the first one; an error if none fits."""
    page = Layout(text, sizes)
    far = page.reach(0, most)
    if far == len(page.words):
        return text, False
    ends = [n for n in range(1, len(page.words)) if page.words[n - 1][-1] in ".!?"]
    k = bisect_right(ends, far) - 1
    if k >= 0:
        return re.sub(r"(?<=[.!?])\s+", " ", text[page.spans[0][0] : page.spans[ends[k] - 1][1]]), True
    if not far:
        raise ValueError("not even one word fits")
    return " ".join(page.words[:far]), True


_CHUNK = T.ArrayType(T.StructType([T.StructField("chunk_key", T.StringType()), T.StructField("chunk", T.StringType())]))


def chunk_column(title: Column, body: Column, sizes: Sizes = words, limit: int = LIMIT, target: int = TARGET, overlap: int = OVERLAP) -> Column:
    """`chunks` as an array column, to be exploded; null bodies count as empty."""

    @F.pandas_udf(_CHUNK)
    def run(titles: pd.Series, bodies: pd.Series) -> pd.Series:
        return pd.Series([[{"chunk_key": k, "chunk": c} for k, c in chunks(t or "", b or "", sizes, limit, target, overlap)] for t, b in zip(titles, bodies, strict=True)], dtype=object)

    return run(title, body)


_FIT = T.StructType([T.StructField("text", T.StringType()), T.StructField("shortened", T.BooleanType())])


def fit_column(text: Column, most: int = ENCODER, sizes: Sizes = words) -> Column:
    """`fit` as a struct column."""

    @F.pandas_udf(_FIT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fit(t or "", most, sizes) for t in texts], columns=["text", "shortened"])

    return run(text)
