"""Byte-level word splitting shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_NOT_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SEGMENT = 1 << 20


def runs_of_words(data: bytes, segment: int = SEGMENT) -> Iterator[list[bytes]]:
    """Lists of words of a UTF-8 text, cut at ASCII white space; a list holds about ``segment`` bytes of text."""
    at, end = 0, len(data)
    while at < end:
        to = at + segment
        found = _SPACE.search(data, to) if to < end else None
        to = found.start() if found else end
        yield data[at:to].split()
        at = to


def spaced_words(data: bytes) -> bytes:
    """Lower-case A-Z, and a space for each ASCII character that is neither digit nor letter."""
    return data.translate(_NOT_ALNUM)
