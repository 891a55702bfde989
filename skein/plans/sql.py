"""Pieces of SQL that several queries share."""

from __future__ import annotations

#: Full-width signs and what they stand for.
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")


def narrow(column: str) -> str:
    """A text with full-width signs replaced by those they stand for."""
    return f"translate({column}, '{_WIDE}', '{_NARROW}')"
