"""Words of Arrow text columns as 64-bit hashes, a batch at a time.

A word is a maximal run of bytes other than the space and 0x09 to 0x0D. Those six bytes never occur
inside a longer UTF-8 character, so bytes can be split without decoding them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cardflow.llm import kept

SPACES = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
#: Longer words get another hash: polynomials modulo 2^64 of certain long words collide, whatever the base.
LONG_WORD = 32

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result looks random."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    mine = kept.of(kept.WORDS)
    if "powers" in mine and len(mine["powers"][0]) >= n:
        return mine["powers"]
    usual = n <= CHUNK_BYTES + 1
    n = max(n, CHUNK_BYTES + 1)
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    powers = np.cumprod(up), np.cumprod(down)
    if usual:  # a very long text's are not kept
        mine["powers"] = powers
    return powers


class Words:
    """The words of consecutive texts: `hashes`, byte ranges `starts` and `ends` in `data`, and
    `first`, the number of the first word of each text (one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        gap = np.empty(n + 2, dtype=bool)
        gap[0] = gap[-1] = True
        np.take(_SEPARATOR, self.data, out=gap[1:-1])
        # a text's end also ends its last word: starts and ends at borders without a space
        inner = offsets[(offsets > 0) & (offsets < n)]
        edge_start = np.flatnonzero(gap[:-2] & ~gap[1:-1])
        edge_end = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
        joined = np.unique(inner[~gap[inner] & ~gap[inner + 1]]) if len(inner) else inner
        if len(joined):
            edge_start = np.union1d(edge_start, joined)
            edge_end = np.union1d(edge_end, joined)
        self.starts, self.ends = edge_start, edge_end
        self.first = np.searchsorted(edge_start, offsets)
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[edge_end] - sums[edge_start]) * down[edge_start]
        self.hashes = mix(h + (edge_end - edge_start).astype(np.uint64))
        for i in np.flatnonzero(edge_end - edge_start > LONG_WORD).tolist():
            word = self.data[edge_start[i] : edge_end[i]].tobytes()
            self.hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text's number for each word."""
        return np.repeat(np.arange(len(self)), self.counts())


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `limit` bytes (or one longer text): first and last row, the bytes, the
    offsets in them. A null text is an empty one."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, raw, data = column.buffers()
    at = np.frombuffer(raw, dtype=np.int64, count=n + 1, offset=column.offset * 8)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, whole[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` words, wherever it starts in `hashes`."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + hashes[i : i + n]
    return mix(out)


def gram_rows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and first word's number of each run of `k` words inside one text."""
    counts = np.maximum(words.counts() - k + 1, 0)
    owner = np.repeat(np.arange(len(words)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, words.first[owner] + within
