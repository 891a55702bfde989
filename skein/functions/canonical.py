"""Canonical forms of text for comparisons: white space and Unicode composition."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of the Unicode property White_Space.
_WHITE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
#: The same as the inside of a character class, for Java and Python patterns alike.
SPACE = "".join("\\u%04x-\\u%04x" % (a, b) for a, b in _WHITE)

#: All white space characters, as a set for trimming.
SPACES = "".join(chr(c) for a, b in _WHITE for c in range(a, b + 1))


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFC", s), na_action="ignore")


def nfc(text: Column) -> Column:
    """NFC of a string column. Only values with characters beyond ASCII are sent to Python."""
    return F.coalesce(_nfc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def squeeze(text: Column) -> Column:
    """Runs of Unicode white space become one space, the edges are trimmed, null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(text, f"[{SPACE}]+", " ")), F.lit(""))
