"""Texts cut into units at spaces, and tables of what has been worked out for a unit."""

from __future__ import annotations

import re

_OPEN_SPACE = re.compile(r" (?:\s|$)")
_CUT = re.compile(r"(?= \S)")
_MARK = "\x1f"

#: Units that a table keeps before it starts anew; bounds the memory of a worker.
TABLE_LIMIT = 300_000


def byte_level_units(text: str) -> list[str]:
    """Cut before each space that a non-space follows.

    Byte-level pre-tokenizers never join characters over such a place: an optional single space
    starts a token, and a run of white space gives its last space to the word behind it.
    """
    if not text:
        return []
    if _MARK in text or _OPEN_SPACE.search(text):
        return [u for u in _CUT.split(text) if u]
    units = text.replace(" ", _MARK + " ").split(_MARK)
    return units if units[0] else units[1:]
