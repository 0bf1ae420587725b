"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least 2q and `least` words long,
that no neighbouring word extends with that period. Texts of a batch lie end to end in one array of
word numbers, with a number of its own after each text, so nothing matches across texts.

* Periods up to 5 are stretches of `word[i] == word[i + q]`.
* For windows of t = 2, 4, 8, ... words, a position i is synchronising when the least hash of the
  windows at i to i + t is at i or at i + t. Windows inside a known run of a period up to t / 3 take no
  part: those highly periodic regions were found before, at smaller t. Whether i is chosen depends on
  the 2t words from i alone.
* A run of smallest period q, 3t <= q < 6t, has a chosen i within its first q - 2t words: without one
  that stretch would be highly periodic, and q not smallest. Then i + q is chosen too, with the same
  2t words. So pairs of chosen positions of one context, 3t to 6t apart, propose all periods. Chosen
  positions of one context are more than t / 3 apart, so there are at most 18 partners each.
* A proposed period is extended word by word to both sides. Equal stretches keep their least period,
  which is the smallest one, as two periods of at most half a stretch have a common divisor as period.

Hashes only propose, and one hash of two contexts costs work, no run; words are compared as numbers of
an exact dictionary. A text is handled whole in
one task, in time and memory about proportional to its length times the number of scales.

Defined results: a null or empty text has no runs and collapses to an empty text; repeated rows and
rows without an id are rows like others; very long texts are not cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.words import chunks, mix

LEAST = 12
DIRECT = 5
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"_row long, n_words long, n_runs long, longest {RUN}, runs array<{RUN}>, collapsed string"

#: The original word at each place, or None for the text as it is; from the row's id and word count.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def _stretches(ids: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches with period `q` and at least 2q words."""
    same = np.zeros(len(ids) - q + 2, dtype=np.int8)
    np.equal(ids[q:], ids[:-q], out=same[1:-1], casting="unsafe")
    step = np.diff(same)
    start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = stop - start >= q
    return start[long], stop[long] + q


def _window_least(v: np.ndarray, t: int) -> np.ndarray:
    """Least of v[i], ..., v[i + t] for each i that has them all."""
    n = len(v) - t
    blocks = -(-len(v) // t)
    padded = np.full(blocks * t, _NEVER)
    padded[: len(v)] = v
    square = padded.reshape(blocks, t)
    head = np.minimum.accumulate(square, axis=1).ravel()
    tail = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:n], head[t - 1 : t - 1 + n])
    return np.minimum(least, v[t : t + n])


def _pairs(at: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of pairs with one context, 3t to 6t apart."""
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    left, apart = [], []
    for k in range(1, len(at)):
        near = np.flatnonzero((context[k:] == context[:-k]) & (at[k:] - at[:-k] < 6 * t))
        if not len(near):
            break
        distance = at[near + k] - at[near]
        far = distance >= 3 * t
        left.append(at[near[far]])
        apart.append(distance[far])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(apart)


def _extend(ids: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """The longest stretch around i whose words equal those j - i further on."""
    n, a, b, step = len(ids), i, j, 64
    while True:
        size = min(step, n - b)
        differ = ids[a : a + size] != ids[b : b + size]
        first = int(differ.argmax()) if size else 0
        if not size or differ[first]:
            stop = b + first
            break
        a, b, step = a + size, b + size, step * 2
    a, b, step = i, j, 64
    while True:
        size = min(step, a)
        differ = (ids[a - size : a] != ids[b - size : b])[::-1]
        first = int(differ.argmax()) if size else 0
        if not size or differ[first]:
            return a - first, stop
        a, b, step = a - size, b - size, step * 2


def _proposed(ids: np.ndarray, at: np.ndarray, apart: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """The longest stretches around the pairs that are at least two periods long."""
    order = np.lexsort((at, apart))
    at, apart = at[order], apart[order]
    first = np.ones(len(at), dtype=bool)  # of pairs whose contexts overlap, so that they are of one stretch
    first[1:] = (apart[1:] != apart[:-1]) | (at[1:] - at[:-1] > 2 * t)
    out, equal = _stretched(ids, at[first], apart[first], t)
    if not equal:  # two contexts of one hash: neighbours are no proof then
        out, _ = _stretched(ids, at, apart, t)
    return [r for r in out if r[1] - r[0] >= 2 * r[2]]


def _stretched(ids: np.ndarray, at: np.ndarray, apart: np.ndarray, t: int) -> tuple[list[tuple[int, int, int]], bool]:
    out: list[tuple[int, int, int]] = []
    equal = True
    for i, d in zip(at.tolist(), apart.tolist()):
        if out and out[-1][2] == d and out[-1][0] <= i and i + d < out[-1][1]:
            continue
        start, stop = _extend(ids, i, i + d)
        equal &= i + d + 2 * t <= stop
        out.append((start, stop, d))
    return out, equal


def find(ids: np.ndarray, reach: Callable[[int], int], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs in `ids`, by start, then period. `ids` begins and ends with
    a number found nowhere else; `reach(n)` is the length of a beginning of `ids` that holds all texts
    of at least n words."""
    start, stop, period = [], [], []
    for q in range(1, DIRECT + 1):
        if len(ids) > q:
            s, e = _stretches(ids, q)
            start.append(s)
            stop.append(e)
            period.append(np.full(len(s), q))
    t, h = 1, mix(ids.astype(np.uint64) + _ODD)
    while True:
        h = mix(h[:-t] * _ODD + h[t:]) if len(h) > t else h[:0]  # windows of 2t words
        t *= 2
        n = reach(6 * t)
        if n < 6 * t:
            break
        h = h[: n - t + 1]
        v = h.copy()
        covered = np.zeros(n + 2, dtype=np.int64)
        for s, e, q in zip(start, stop, period):
            inside = (3 * q <= t) & (e - s >= t) & (e <= n)
            np.add.at(covered, s[inside], 1)
            np.add.at(covered, e[inside] - t + 1, -1)
        v[np.cumsum(covered)[: len(v)] > 0] = _NEVER
        lowest = _window_least(v, t)
        chosen = (lowest != _NEVER) & ((v[: len(lowest)] == lowest) | (v[t : t + len(lowest)] == lowest))
        at = np.flatnonzero(chosen)
        context = mix(h[at] * _ODD + h[at + t])
        found = _proposed(ids, *_pairs(at, context, t), t)
        if found:
            s, e, q = np.array(found, dtype=np.int64).T
            start.append(s)
            stop.append(e)
            period.append(q)
    if not start:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    s, e, q = np.concatenate(start), np.concatenate(stop), np.concatenate(period)
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    new &= e - s >= least
    s, e, q = s[new], e[new], q[new]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def _structs(start: np.ndarray, length: np.ndarray, period: np.ndarray, null: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int64)) for x in (start, length, period)],
        names=["start", "length", "period"],
        mask=None if null is None else pa.array(null),
    )


def _batch(rows: list[int], keys: list[int | None], texts: list[bytes], least: int, rewrite: Rewrite | None) -> pa.RecordBatch:
    """The runs of some texts."""
    numbers: dict[bytes, int] = {}
    words = [t.split() for t in texts]  # at the space and 0x09 to 0x0D
    size = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    places: list[np.ndarray | None] = [None] * len(words)
    parts, base, at = [np.array([-1], np.int64)], np.zeros(len(words), np.int64), 1
    for border, k in enumerate(order.tolist(), 2):
        w = words[k]
        own = np.fromiter((numbers.setdefault(x, len(numbers)) for x in w), np.int64, len(w))
        if rewrite is not None and len(w):
            places[k] = rewrite(keys[k], len(w))
            if places[k] is not None:
                own = own[places[k]]
        parts += [own, np.array([-border], np.int64)]
        base[k] = at
        at += len(w) + 1
    ids = np.concatenate(parts)
    longest_first = size[order]
    ends = 1 + np.cumsum(longest_first + 1)

    def reach(n: int) -> int:
        texts_of = int(np.searchsorted(-longest_first, -n, side="right"))
        return int(ends[texts_of - 1]) if texts_of else 0

    s, e, q = find(ids, reach, least)
    by_base = base[order]
    owner = order[np.searchsorted(by_base, s, side="right") - 1]
    local = s - base[owner]
    by_text = np.lexsort((q, local, owner))
    owner, local, length, q = owner[by_text], local[by_text], (e - s)[by_text], q[by_text]
    count = np.bincount(owner, minlength=len(words))
    first = np.concatenate([[0], np.cumsum(count)])
    repeats = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(repeats, base[owner] + local + q, 1)
    np.add.at(repeats, base[owner] + local + length, -1)
    kept = np.cumsum(repeats)[:-1] == 0
    top = np.zeros((len(words), 3), dtype=np.int64)
    collapsed = []
    for k, w in enumerate(words):
        if count[k]:
            a, b = first[k], first[k + 1]
            best = a + int(np.lexsort((q[a:b], local[a:b], -length[a:b]))[0])
            top[k] = local[best], length[best], q[best]
            left = np.flatnonzero(kept[base[k] : base[k] + len(w)])
            if places[k] is not None:
                left = places[k][left]
            w = [w[i] for i in left.tolist()]
        elif places[k] is not None:
            w = [w[i] for i in places[k].tolist()]
        collapsed.append(b" ".join(w).decode())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int64()),
            pa.array(size),
            pa.array(count.astype(np.int64)),
            _structs(*top.T, null=count == 0),
            pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _structs(local, length, q)),
            pa.array(collapsed, pa.string()),
        ],
        names=["_row", "n_words", "n_runs", "longest", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """id, n_words, n_runs, the longest run (of equal ones that of least start, then period; null if
    there is none), all runs by start and period, and the text without the words that repeat the
    period before them, joined by one space. `rewrite` puts other words of a text in its places first.
    No shuffle; other columns of `docs` are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, j, data, offsets in chunks(batch.column(1)):
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield _batch(keys[i:j], keys[i:j], texts, least, rewrite)

    return (
        docs.select(F.col(id).cast("long").alias("_row"), F.col(text).alias("text"))
        .mapInArrow(run, SCHEMA)
        .withColumnRenamed("_row", id)
    )
