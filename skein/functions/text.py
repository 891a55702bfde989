"""Text and name functions. ASCII values stay in the JVM; others pass through one Arrow UDF per column."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.canonical import SPACE

_BEYOND_ASCII = r"[^\x00-\x7F]"


def _unicode_only(value: Column, function, kind: T.DataType = T.StringType()) -> Column:  # noqa: ANN001, B008
    """function over the values with characters beyond ASCII; the others are null and never leave the JVM's batch."""

    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda s: None if s is None else function(s), na_action="ignore")

    return run(F.when(value.rlike(_BEYOND_ASCII), value))


def clean_text(value: Column) -> Column:
    """NFKC, white space runs to one space, edges trimmed, empty becomes null."""
    plain = F.coalesce(_unicode_only(value, lambda s: unicodedata.normalize("NFKC", s)), value)
    return F.nullif(F.trim(F.regexp_replace(plain, f"[{SPACE}]+", " ")), F.lit(""))


def _fold(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold())
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def name_key(value: Column) -> Column:
    """Comparison form of a name: no case, no accents, signs other than letters and digits become single spaces."""
    folded = F.coalesce(_unicode_only(value, _fold), F.lower(value))
    return F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}_]+", " "))


def terms(value: Column, least: int = 2) -> Column:
    """Distinct words of a name key with at least `least` characters, in order of first occurrence; null gives none."""
    return F.array_distinct(F.filter(F.split(F.coalesce(name_key(value), F.lit("")), " "), lambda w: F.length(w) >= least))


def alias(value: Column, aliases: dict[str, str]) -> Column:
    """The cleaned value, or what a case-insensitive alias maps it to."""
    cleaned = clean_text(value)
    out = cleaned
    for short, full in aliases.items():
        out = F.when(F.lower(cleaned) == short.lower(), F.lit(full)).otherwise(out)
    return out


def same_but_for_initial(left: Column, right: Column) -> Column:
    """First and last words of two name keys are equal, and one lacks the single-letter middle word of the other."""
    a, b = F.split(left, " "), F.split(right, " ")
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    ends = (F.element_at(longer, 1) == F.element_at(shorter, 1)) & (F.element_at(longer, -1) == F.element_at(shorter, -1))
    return (F.size(longer) == 3) & (F.size(shorter) == 2) & (F.length(F.try_element_at(longer, F.lit(2))) == 1) & ends


def sequence_ratio(left: Column, right: Column) -> Column:
    """Ratcliff-Obershelp similarity of two strings, rounded to 6 places; null if either is null.

    Gate it with cheap native conditions first: it is the only part that needs Python.
    """

    @F.pandas_udf(T.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(difflib.SequenceMatcher(None, x, y).ratio(), 6) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio(left, right)


def name_score(left: Column, right: Column, weight: float = 0.30, least: float = 0.72) -> Column:
    """weight for equal name keys; weight times the ratio where surname and first initial agree, the ratio reaches
    `least` and the second words of names with more than two words do not begin differently; else 0."""
    a, b = F.split(left, " "), F.split(right, " ")
    conflict = (F.size(a) > 2) & (F.size(b) > 2) & (F.substring(F.try_element_at(a, F.lit(2)), 1, 1) != F.substring(F.try_element_at(b, F.lit(2)), 1, 1))
    gate = (F.element_at(a, -1) == F.element_at(b, -1)) & (F.substring(left, 1, 1) == F.substring(right, 1, 1)) & ~conflict
    ratio = sequence_ratio(F.when(gate & (left != right), left), F.when(gate & (left != right), right))
    return F.when((left == right) & (left != ""), F.lit(weight)).when(gate & (ratio >= least), F.round(weight * ratio, 6)).otherwise(0.0)


def sentences(value: Column) -> Column:
    """Pieces of a text between white space that follows a full stop, exclamation or question mark."""
    return F.filter(F.split(F.trim(value), f"(?<=[.!?])[{SPACE}]+"), lambda s: s != "")


def token_count(value: Column) -> Column:
    """Words between white space; null counts 0."""
    return F.size(F.filter(F.split(F.coalesce(value, F.lit("")), f"[{SPACE}]+"), lambda w: w != ""))


def drop_lines(value: Column, phrases: list[str]) -> Column:
    """Removes lines that consist of one of the phrases, whatever their case; paragraphs stay a blank line apart."""
    pattern = "(?i)^(?:" + "|".join(re.escape(p) for p in phrases) + ")$"
    line = lambda x: F.trim(F.regexp_replace(x, f"[{SPACE}]+", " "))
    paragraph = lambda p: F.array_join(F.filter(F.transform(F.split(p, "\n"), line), lambda x: (x != "") & ~x.rlike(pattern)), " ")
    return F.array_join(F.filter(F.transform(F.split(value, "\n[ \t\r]*\n"), paragraph), lambda p: p != ""), "\n\n")


def labelled(title: Column, body: Column) -> Column:
    """Title and body as one encoder input."""
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit("\nText: "), F.coalesce(body, F.lit("")))


def snippet(text: Column, query_terms: Column, width: int = 280) -> Column:
    """The window of about `width` characters that holds most of the query's terms (the leading one on ties), with
    marks where text was left out; markup signs are escaped."""

    @F.pandas_udf(T.StringType())
    def best(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        def one(body: str | None, words) -> str | None:  # noqa: ANN001
            if body is None:
                return None
            spans = [m.span() for m in re.finditer(r"\S+", body)]
            keys = [re.sub(r"\W+", "", body[a:b]).casefold() for a, b in spans]
            want, start, top, lead = set(words if words is not None else []), 0, -1, (0, 0)
            for end in range(len(spans)):
                while spans[end][1] - spans[start][0] > width and start < end:
                    start += 1
                hits = len(want & set(keys[start : end + 1]))
                if hits > top:
                    top, lead = hits, (start, end)
            if not spans:
                return ""
            a, b = spans[lead[0]][0], spans[min(len(spans) - 1, lead[1])][1]
            grown = [s for s in spans if s[1] - a <= width and s[0] >= a]
            b = max(b, grown[-1][1]) if grown else b
            cut = body[a:b].replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            return ("... " if a > spans[0][0] else "") + cut + (" ..." if b < spans[-1][1] else "")

        return pd.Series([one(t, w) for t, w in zip(texts, wanted, strict=True)], dtype=object)

    return best(text, query_terms)
