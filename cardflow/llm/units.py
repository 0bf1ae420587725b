"""Texts as units that a byte-level tokenizer treats alone.

A unit is a run of letters or of other non-space characters, with the one space before it, or a piece
of white space: the tokenizers' pattern never lets a match reach from one unit into the next. So the ids of a text are
the ids of its units in order, and a unit is encoded once per worker instead of once per occurrence.
Texts with other white space than spaces and line feeds, or with the text of a special token, are
one unit each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: Letters up to a space, full stop or comma; what else has no white space; white space.
UNIT = re.compile(
    r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+(?![^ \n.,])| ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]"
)
OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0  -     　]")
SPECIAL = "<|endoftext|>"
CACHE = 400_000
LONGEST = 64


def split(text: str) -> list[str]:
    if SPECIAL in text or OTHER_SPACE.search(text):
        return [text]
    return UNIT.findall(text)


class Cache:
    """What `encode` gives for units. It keeps two generations of at most about `limit` units, of
    which the older goes when the newer is full; a unit in use moves to the newer."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], limit: int = CACHE):
        self.encode, self.limit = encode, limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[list[bytes]]:
        new, old = self.new, self.old
        cut = [split(t) for t in texts]
        used: set[str] = set()
        for units in cut:
            used.update(units)
        missing = []
        for u in used.difference(new):
            if (known := old.get(u)) is not None:
                new[u] = known
            else:
                missing.append(u)
        new.update(zip(missing, self.encode(missing)))
        out = [list(map(new.__getitem__, units)) for units in cut]
        for u in missing:
            if len(u) > LONGEST:
                del new[u]
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return out


def groups(texts: Iterable[str | None], chars: int = 1 << 20) -> Iterable[list[str]]:
    """Consecutive texts of about `chars` characters; null is empty."""
    out, size = [], 0
    for t in texts:
        out.append(t or "")
        size += len(out[-1])
        if size >= chars:
            yield out
            out, size = [], 0
    if out:
        yield out
