"""Removal of passages that occur elsewhere, by suffix automata of reference shards.

Automata of the whole corpus, each sent to every document, would cost documents times shards. Here a
shard holds what can match at all, and the text meets only the shard it belongs to:

1. Each window of `WINDOW` words is led by the least hash of its `GRAM`-word runs, so equal windows
   have equal leaders. Leaders are counted; one that occurs once leads no repeated window. Which do
   repeat, and which are very frequent, is broadcast as two bitmaps of fixed size.
2. Runs of windows with one leader are cut out as segments. A window with a very frequent leader is
   led by the least of its other runs instead, so a common line does not draw all its surroundings
   into one shard.
3. Equal segments are counted before they are moved. The distinct segments of a leader are the
   reference shard; its suffix automaton knows how often each of their word sequences occurs, and the
   segments are streamed through it: where the matching statistics reach `WINDOW` words that occur
   twice or more, the window is repeated.
4. Ranges go back to the documents by segment, and the words they cover are removed.

`remove_reference` is the plain form for a reference table of bounded size, such as a benchmark: its
automata are broadcast, and each document is streamed through all of them.

Defined results: words are compared unchanged; a null or empty text has no words and stays as it is;
a repeated row is another document, so its windows are repeated; a document's own repetitions count.
A very long text is handled whole where it is read, its windows like those of many texts elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.llm import bitmaps
from cardflow.llm.tables import Scratch, partitions, saved
from cardflow.llm.words import Words, chunks, gram_rows, grams

WINDOW = 35
GRAM = 8
#: Occurrences from which a leader is replaced.
FREQUENT = 200
REFERENCE_BYTES = 64 << 20
SHARD_WORDS = 200_000

_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


class Automaton:
    """Suffix automaton of several word sequences; `count` tells how often a state's sequences occur."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words: list, times: int = 1) -> None:
        last = 0
        next_, link, length, count = self.next, self.link, self.length, self.count
        for w in words:
            there = next_[last].get(w)
            if there is not None:
                if length[there] == length[last] + 1:
                    last = there
                else:
                    last = self._copy(last, there, w)
            else:
                new = len(next_)
                next_.append({})
                length.append(length[last] + 1)
                link.append(0)
                count.append(0)
                p = last
                while p >= 0 and w not in next_[p]:
                    next_[p][w] = new
                    p = link[p]
                if p >= 0:
                    q = next_[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._copy(p, q, w)
                last = new
            count[last] += times

    def _copy(self, p: int, q: int, w) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def total(self) -> None:
        """Counts ends at every state, once all is added."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, words: list, window: int, times: int) -> list[tuple[int, int]]:
        """Ranges (first, last) of windows of `words` that occur `times` or more in the automaton."""
        next_, link, length, count = self.next, self.link, self.length, self.count
        state = matched = 0
        out: list[list[int]] = []
        for i, w in enumerate(words):
            while state and w not in next_[state]:
                state = link[state]
                matched = length[state]
            if w in next_[state]:
                state = next_[state][w]
                matched += 1
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
            if matched >= window and count[state] >= times:
                at = i - window + 1
                if out and out[-1][1] == at - 1:
                    out[-1][1] = at
                else:
                    out.append([at, at])
        return [(a, b) for a, b in out]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


def _runs(key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return np.flatnonzero(new)


def _leaders(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """key, n: the leaders of the documents' windows and how often each occurs (2: twice or more in
    one run)."""
    width = window - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words = Words(data, offsets)
                owner, at = gram_rows(words, window)
                if not len(at):
                    continue
                hashes = grams(words.hashes, gram)
                lead = _least(hashes, width)[at]
                first = _runs(lead, owner)
                length = np.diff(np.append(first, len(at)))
                key, start = lead[first], at[first]
                n = np.zeros(len(key), dtype=np.int64)
                for i in range(2 * width - 1):
                    inside = i < width + length - 1
                    n += inside & (hashes[np.minimum(start + i, len(hashes) - 1)] == key)
                n = np.where(length > width, 2, n)
                key, back = np.unique(key, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.bincount(back, weights=n).astype(np.int64))], names=["key", "n"]
                )

    found = docs.select("_text").mapInArrow(run, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


_SEGMENT = "key long, segment binary, doc binary, at int, words binary"


def _segments(docs: DataFrame, shared, frequent, window: int, gram: int) -> DataFrame:
    """key, segment (digest), doc (digest of the text), at (first window), words (joined by spaces)."""
    width = window - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words = Words(data, offsets)
                owner, at = gram_rows(words, window)
                if not len(at):
                    continue
                hashes = grams(words.hashes, gram)
                lead = _least(hashes, width)[at]
                rare = np.where(bitmaps.contains(frequent.value, hashes), _MOST, hashes)
                other = _least(rare, width)[at]
                key = np.where(other == _MOST, lead, other)
                keep = (key != lead) | bitmaps.contains(shared.value, key)
                first = _runs(key, owner)
                last = np.append(first[1:], len(at)) - 1
                ok = np.logical_or.reduceat(keep, first)
                first, last = first[ok], last[ok]
                digests: dict[int, bytes] = {}
                rows: list[list] = [[], [], [], []]
                raw = data.tobytes()
                for f, l in zip(first.tolist(), last.tolist()):
                    doc = int(owner[f])
                    if doc not in digests:
                        digests[doc] = hashlib.md5(raw[offsets[doc] : offsets[doc + 1]]).digest()
                    a, b = int(at[f]), int(at[l]) + window - 1
                    text = b" ".join(raw[words.starts[a] : words.ends[b]].split())
                    rows[0].append(hashlib.blake2b(text, digest_size=16).digest())
                    rows[1].append(digests[doc])
                    rows[2].append(a - int(words.first[doc]))
                    rows[3].append(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[first].view(np.int64)), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.binary()),
                        pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.binary()),
                    ],
                    names=["key", "segment", "doc", "at", "words"],
                )

    return docs.select("_text").mapInArrow(run, _SEGMENT)


def _matched(distinct: DataFrame, window: int, gram: int) -> DataFrame:
    """segment, first, last: ranges of repeated windows of each distinct segment."""

    def shard(rows: list[tuple]) -> Iterator[tuple]:
        texts = [r[3].split(b" ") for r in rows]
        single = [r[2] == 1 for r in rows]
        if len(rows) == 1 and single[0]:
            w = texts[0]
            if len({tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)}) == len(w) - gram + 1:
                return
        if any(single):
            automaton = Automaton()
            for r, w in zip(rows, texts):
                automaton.add(w, r[2])
            automaton.total()
        for r, w, alone in zip(rows, texts, single):
            if alone:
                for a, b in automaton.repeated(w, window, 2):
                    yield r[1], a, b
            else:
                yield r[1], 0, len(w) - window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[0]):
            out.extend(shard(list(group)))
            if len(out) > 5000:
                yield _ranges(out)
                out = []
        if out:
            yield _ranges(out)

    return (
        distinct.repartition(partitions(distinct.sparkSession), "key")
        .sortWithinPartitions("key")
        .select("key", "segment", "n", "words")
        .mapInArrow(run, "segment binary, first int, last int")
    )


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    s, a, b = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(s, pa.binary()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["segment", "first", "last"]
    )


def repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM, frequent: int = FREQUENT) -> DataFrame:
    """doc (MD5 of the text), spans: the ranges of words (start, end) that repeated windows cover."""
    texts = docs.select(F.col(text).alias("_text"))
    members = {"shared": F.lit(True), "frequent": F.col("n") >= frequent}
    maps = bitmaps.build(_leaders(texts, window, gram).where("n > 1"), "key", members)
    span = F.struct((F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + window).alias("end"))
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.saved(_segments(texts, maps["shared"], maps["frequent"], window, gram), "segments")
        bitmaps.drop(maps)
        distinct = found.groupBy("key", "segment").agg(F.count("*").alias("n"), F.first("words").alias("words"))
        ranges = scratch.saved(_matched(distinct, window, gram), "ranges")
        places = found.select("segment", "doc", "at").distinct()
        spans = places.join(ranges, "segment").groupBy("doc").agg(F.collect_list(span).alias("spans"))
        return saved(spans, "spans")


def _cut(text: bytes, spans: list[tuple[int, int]], layout: bool) -> tuple[int, int, bytes]:
    """Words, removed words, and the rest: its words joined by spaces, or with its own white space."""
    if not spans and layout:
        return len(text.split()), 0, text
    words = text.split()
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    if not layout:
        return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
    at = Words(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out, done = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(text[done : at.starts[a]])
        done = int(at.starts[b]) if b < len(words) else len(text)
    out.append(text[done:])
    return len(words), int(gone.sum()), b"".join(out)


def _removed(docs: DataFrame, spans: DataFrame, text: str, layout: bool) -> DataFrame:
    """`docs` with text cut, _n_words and _n_removed."""
    keyed = docs.withColumn("_doc", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    joined = keyed.join(spans.select(F.col("doc").alias("_doc"), F.col("spans").alias("_spans")), "_doc", "left").select(
        *docs.columns, "_spans"
    )
    at, names = docs.columns.index(text), [*docs.columns, "_n_words", "_n_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                columns = list(part.columns)
                texts = columns[at].cast(pa.binary())
                done = [
                    _cut(t.as_py() or b"", [(s["start"], s["end"]) for s in spans or ()], layout)
                    for t, spans in zip(texts, columns.pop().to_pylist())
                ]
                cut = pa.array([d[2] for d in done], pa.binary()).cast(pa.string())
                columns[at] = pa.compute.if_else(columns[at].is_null(), None, cut) if layout else cut
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64())],
                    names=names,
                )

    schema = T.StructType(
        [*docs.schema.fields, T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
    )
    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, layout: bool = True) -> DataFrame:
    """`docs` without the words that repeated windows cover, with _n_words and _n_removed. With
    `layout` the rest keeps its white space, else its words are joined by one space."""
    return _removed(docs, repeats(docs, text, window), text, layout)


def remove_reference(docs: DataFrame, reference: DataFrame, text: str = "text", reference_text: str = "text", window: int = WINDOW, limit: int = REFERENCE_BYTES) -> DataFrame:
    """`docs` without the words that windows of `reference` cover. The reference must be at most
    `limit` bytes: its automata, one for each `SHARD_WORDS` words, are broadcast."""
    rows = reference.select(F.col(reference_text).alias("t")).where(F.col("t").isNotNull())
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > limit:
        raise ValueError(f"the reference has {size} bytes; at most {limit} are broadcast")
    shards, held = [Automaton()], 0
    for row in rows.toLocalIterator():
        words = row["t"].encode().split()
        if held and held + len(words) > SHARD_WORDS:
            shards.append(Automaton())
            held = 0
        shards[-1].add(words)
        held += len(words)
    for a in shards:
        a.total()
    sent = docs.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, spans = [], []
            for t in batch.column(0).cast(pa.binary()):
                raw = t.as_py() or b""
                words = raw.split()
                found = sorted({(a, b + window) for s in sent.value for a, b in s.repeated(words, window, 1)})
                if found:
                    digests.append(hashlib.md5(raw).digest())
                    spans.append([{"start": a, "end": b} for a, b in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(spans, kind)], names=["doc", "spans"])

    found = docs.select(text).mapInArrow(run, "doc binary, spans array<struct<start:int,end:int>>")
    return _removed(docs, found.dropDuplicates(["doc"]), text, True)
