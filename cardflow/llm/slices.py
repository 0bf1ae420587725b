"""Texts of an Arrow column laid end to end, in slices of about equal size that cut no sentence."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from cardflow.llm.words import chunks

LIMIT = 1 << 20


class Slice(NamedTuple):
    """`data` holds whole sentences, each text with a line feed after it. Row `first + k` starts at
    `begins[k]`, where a text that began in an earlier slice starts at 0; `chars` code points of it
    came before."""

    data: np.ndarray
    begins: np.ndarray
    first: int
    chars: int

    def rows(self, at: np.ndarray) -> np.ndarray:
        return self.first + np.searchsorted(self.begins, at, side="right") - 1


def slices(column: pa.Array, ends: np.ndarray, limit: int = LIMIT) -> Iterator[Slice]:
    """Slices of about `limit` bytes; a cut is after a byte that `ends` a sentence, so a longer
    sentence makes a longer slice. A null text is an empty one. A line feed must be in `ends`."""
    for i, j, data, offsets in chunks(column, limit):
        flat = np.insert(data, offsets[1:], 10)
        begins = offsets[:-1] + np.arange(j - i)
        if len(flat) <= 2 * limit:
            yield Slice(flat, begins, i, 0)
            continue
        a = 0
        while a < len(flat):
            b = min(a + limit, len(flat))
            if b < len(flat):
                cut = np.flatnonzero(ends[flat[a:b]])
                if len(cut):
                    b = a + int(cut[-1]) + 1
                else:
                    while not ends[flat[b - 1]]:
                        more = np.flatnonzero(ends[flat[b : b + limit]])
                        b = b + int(more[0]) + 1 if len(more) else min(b + limit, len(flat))
            k = int(np.searchsorted(begins, a, side="right")) - 1
            last = int(np.searchsorted(begins, b, side="left"))
            before = flat[begins[k] : a]
            yield Slice(flat[a:b], np.maximum(begins[k:last] - a, 0), i + k, int(np.count_nonzero((before & 0xC0) != 0x80)))
            a = b
