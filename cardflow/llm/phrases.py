"""Phrase collocations: frequent runs of two to four words that occur together more than apart.

Fingerprints of all n-grams come from prefix polynomials over the bytes of a slice of text, modulo a
prime in two bases, so any phrase costs the same whatever its length. Each task sums equal
fingerprints before anything is shuffled:

1. Counts of words, then of pairs of frequent words, then of three and four words whose pairs are
   frequent, give the frequent fingerprints of each length. Infrequent ones are left out, as a phrase
   is never more frequent than its parts. What is frequent travels as a bitmap sized by the number of
   keys, at most 2^`MOST_BITS` bits; a false member costs work and changes no result.
2. Occurrences of what is left are summed again, now with a pointer to an occurrence (the hash of the
   text it is in) and with the least and greatest of a check value in a third base.
3. Fingerprints with two check values belong to several phrases: their occurrences are counted by
   text. The others' text is read once, where the pointer says. Only frequent phrases become text.
4. Scores, cuts, containment and ranks are joins and windows over the phrases found.

No fingerprint set passes the driver; no group is held in one task: equal keys are sums, and the
first rows of a language are taken by (language, slot) before they are taken by language.

Defined results: a null text is an empty one and a null language is `und`; repeated rows count each
time; other columns are not read; very long texts are processed in slices that cut no piece.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm import bitmaps
from cardflow.llm.slices import Slice, slices
from cardflow.llm.tables import Scratch
from cardflow.llm.words import mix

LEAST, LONGEST, TOP = 30, 4, 2000
#: Share of a phrase's occurrences inside one longer phrase at which it is dropped, in percent.
INSIDE = 80
SCALE = 2_000_000
MOST_BITS, BITS_PER_KEY = 28, 64
#: Fingerprints a task holds before it sums equal ones.
HELD = 1 << 22
#: Tasks of the pass that makes pointers, for each that runs at a time.
TASKS_PER_CORE = 2
#: Parts of a language's candidates that are ranked apart, in rounds; the last round ranks at most
#: `TOP` rows of each part of the one before.
SLOTS = (1024, 32, 1)

_PIECE = np.zeros(256, dtype=bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _PIECE.copy()
_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P = np.uint64((1 << 31) - 1)
_SHIFT = np.uint64(31)
_BASES = (1_284_865_837, 2_010_881_663, 1_690_203_427)


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for x below 2^62."""
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    return np.where(x >= _P, x - _P, x)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _fold(out[:more] * np.uint64(pow(base, done, int(_P))))
        done += more
    return out


class Powers:
    """Powers of the bases and of their inverses, kept for one task."""

    def __init__(self) -> None:
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __call__(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self.kept or len(self.kept[base][0]) < n:
            self.kept[base] = _powers(base, n), _powers(pow(base, -1, int(_P)), n)
        up, down = self.kept[base]
        return up, down


class Grams:
    """Words of a slice, and fingerprints of the n-grams that start at each."""

    def __init__(self, s: Slice, salts: np.ndarray, powers: Powers, bits: int):
        data = _LOWER[s.data]
        gap = np.ones(len(data) + 1, dtype=bool)
        np.take(_GAP, data, out=gap[1:])
        start = np.flatnonzero(gap[:-1] & ~gap[1:])
        end = np.flatnonzero(~gap[:-1] & gap[1:])  # each text has a line feed after it
        self.row = s.rows(start)
        self.salt = salts[self.row]
        pieces = np.cumsum(_PIECE[data], dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
        last = np.append(pieces[1:] != pieces[:-1], True) if len(start) else np.zeros(0, bool)
        stops = np.flatnonzero(last)
        #: Words from here to the end of the piece.
        self.room = stops[np.searchsorted(stops, np.arange(len(start)))] - np.arange(len(start)) + 1
        keep = ~gap[1:]
        keep[end] = True
        data[end] = 32
        self.text = data[keep]
        self.at = np.concatenate([[0], np.cumsum(end - start + 1)])
        self.powers, self.bits = powers, bits
        self.sums: dict[int, np.ndarray] = {}

    def _polynomial(self, base: int, i: np.ndarray, size: int) -> np.ndarray:
        up, down = self.powers(base, len(self.text) + 1)
        if base not in self.sums:
            sums = np.zeros(len(self.text) + 1, dtype=np.uint64)
            np.cumsum(_fold((self.text + np.uint64(1)) * up[: len(self.text)]), out=sums[1:])
            self.sums[base] = sums
        sums, a = self.sums[base], self.at[i]
        return _fold(_fold(sums[self.at[i + size] - 1] - sums[a]) * down[a])

    def starts(self, size: int) -> np.ndarray:
        return np.flatnonzero(self.room >= size)

    def keys(self, i: np.ndarray, size: int) -> np.ndarray:
        """One number for language and words of the n-grams that start at `i`."""
        high, low = (self._polynomial(b, i, size) for b in _BASES[:2])
        key = mix(mix((high << _SHIFT) | low) + self.salt[i])
        return key & np.uint64((1 << self.bits) - 1) if self.bits < 64 else key

    def checks(self, i: np.ndarray, size: int) -> np.ndarray:
        return self._polynomial(_BASES[2], i, size).astype(np.int64)

    def phrase(self, i: int, size: int) -> str:
        return self.text[self.at[i] : self.at[i + size] - 1].tobytes().decode()


def _grams(batch: pa.RecordBatch, powers: Powers, bits: int) -> Iterator[Grams]:
    names = batch.column(0).to_pylist()
    salt = {n: int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in set(names)}
    salts = np.array([salt[n] for n in names], dtype=np.uint64)
    for s in slices(batch.column(1), _PIECE):
        yield Grams(s, salts, powers, bits)


def _summed(parts: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.nulls(len(keys), pa.string()), pa.array(counts)], names=["key", "lang", "count"]
    )


#: Keys, their counts, least and greatest check values and pointers.
Occurrences = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _combined(parts: list[Occurrences]) -> Occurrences:
    """One row per key."""
    keys, counts, least, greatest, pointers = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (
        keys[first],
        np.add.reduceat(counts[order], first),
        np.minimum.reduceat(least[order], first),
        np.maximum.reduceat(greatest[order], first),
        np.minimum.reduceat(pointers[order], first),
    )


def _open(b: bitmaps.Bitmap) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b.sent.value), dtype=np.uint8)


Pick = Callable[[Grams], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def _candidates(known: list[np.ndarray]) -> Pick:
    """Sizes, starts and keys of the n-grams to count next. `known` are the frequent words, pairs, and
    longer phrases found so far."""

    def pick(g: Grams) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        n = len(g.row)
        if not known:
            i = np.arange(n)
            yield 1, i, g.keys(i, 1)
        elif len(known) == 1:
            i = np.arange(n)
            word = bitmaps.contains(known[0], g.keys(i, 1))
            i = g.starts(2)
            i = i[word[i] & word[i + 1]]
            yield 2, i, g.keys(i, 2)
        else:
            pair = np.zeros(n, dtype=bool)
            i = g.starts(2)
            pair[i] = bitmaps.contains(known[1], g.keys(i, 2))
            for size in range(3, LONGEST + 1):
                i = g.starts(size)
                for k in range(size - 1):
                    i = i[pair[i + k]]
                yield size, i, g.keys(i, size)

    return pick


def _frequent(known: list[np.ndarray]) -> Pick:
    """Sizes, starts and keys of all n-grams that may be frequent."""
    longer = _candidates(known)

    def pick(g: Grams) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for size in (1, 2):
            i = g.starts(size)
            keys = g.keys(i, size)
            found = bitmaps.contains(known[size - 1], keys)
            yield size, i[found], keys[found]
        for size, i, keys in longer(g):
            found = bitmaps.contains(known[2], keys)
            yield size, i[found], keys[found]

    return pick


def _bitmap(keys: DataFrame, key: Column | None = None) -> bitmaps.Bitmap:
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(BITS_PER_KEY * keys.count() + 1))))
    keys = keys.select((F.col("key") if key is None else key).alias("key"))
    return bitmaps.build(keys, "key", {"all": F.lit(True)}, bits)["all"]


def _count(texts: DataFrame, known: list[bitmaps.Bitmap], bits: int) -> DataFrame:
    """Counts of keys; with nothing known yet, also words of each language, whose key is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, pick = Powers(), _candidates([_open(b) for b in known])
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            words = np.zeros(len(batch), dtype=np.int64)
            for g in _grams(batch, powers, bits):
                if not known:
                    words += np.bincount(g.row, minlength=len(batch))
                for _, _, keys in pick(g):
                    held.append(keys)
                    size += len(keys)
                if size >= HELD:
                    yield _summed(held)
                    held, size = [], 0
            if not known and len(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(batch), pa.int64()), batch.column(0).cast(pa.string()), pa.array(words)],
                    names=["key", "lang", "count"],
                )
        if size:
            yield _summed(held)

    return texts.select("lang", "text").mapInArrow(run, "key long, lang string, count long").groupBy("key", "lang").agg(F.sum("count").alias("count"))


def _gathered(texts: DataFrame) -> DataFrame:
    """The same rows in no more tasks than `TASKS_PER_CORE` for each that runs at a time. A frequent key is
    in most tasks, so with tasks as many as the input is long the rows of `_pointers` would grow with
    keys times tasks; here they grow with the keys."""
    return texts.coalesce(TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism)


def _pointers(texts: DataFrame, known: list[bitmaps.Bitmap], bits: int) -> DataFrame:
    """Count, pointer and least and greatest check value of each key that may be frequent. A task keeps
    one row per key until it ends, and lets go of them earlier only when they are more than a quarter of
    `HELD`: what it makes does not grow with how often it had to combine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, pick = Powers(), _frequent([_open(b) for b in known])
        held: list[Occurrences] = []
        size = 0

        def made(x: Occurrences) -> pa.RecordBatch:
            keys, counts, least, greatest, pointers = x
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(counts),
                    pa.array(least.astype(np.int64)),
                    pa.array(greatest.astype(np.int64)),
                    pa.array(pointers),
                ],
                names=["key", "count", "least", "greatest", "pointer"],
            )

        for batch in batches:
            pointer = batch.column(2).to_numpy()
            for g in _grams(batch, powers, bits):
                for n, i, keys in pick(g):
                    checks = g.checks(i, n).astype(np.int32)
                    held.append((keys, np.ones(len(keys), dtype=np.int64), checks, checks, pointer[g.row[i]]))
                    size += len(keys)
                if size >= HELD // 2:
                    held = [_combined(held)]
                    size = len(held[0][0])
                    if size > HELD // 4:
                        yield made(held[0])
                        held, size = [], 0
        if size:
            yield made(_combined(held))

    return (
        texts.mapInArrow(run, "key long, count long, least long, greatest long, pointer long")
        .groupBy("key")
        .agg(F.sum("count").alias("count"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.min("pointer").alias("pointer"))
    )


def _place(key: Column, pointer: Column) -> Column:
    return key.bitwiseXOR(pointer)


def _read(texts: DataFrame, known: list[bitmaps.Bitmap], places: bitmaps.Bitmap, clashes: bitmaps.Bitmap | None, bits: int) -> DataFrame:
    """The phrases at `places` and all occurrences of `clashes`, one row per key, pointer, language
    and text of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, pick = Powers(), _frequent([_open(b) for b in known])
        place, clash = _open(places), None if clashes is None else _open(clashes)
        for batch in batches:
            pointer, lang = batch.column(2).to_numpy(), batch.column(0).to_pylist()
            for g in _grams(batch, powers, bits):
                found: dict[tuple[int, int, str, str, int], int] = {}
                for n, i, keys in pick(g):
                    at = pointer[g.row[i]]
                    here = bitmaps.contains(place, keys ^ at.view(np.uint64))
                    wanted = here if clash is None else here | bitmaps.contains(clash, keys)
                    i, keys, at = i[wanted], keys[wanted].view(np.int64), at[wanted]
                    if clash is None:  # one occurrence in a text is enough
                        _, once = np.unique(keys ^ at, return_index=True)
                        i, keys, at = i[once], keys[once], at[once]
                    for k, key, p in zip(i.tolist(), keys.tolist(), at.tolist()):
                        row = (key, p, lang[g.row[k]], g.phrase(k, n), n)
                        found[row] = found.get(row, 0) + 1
                if found:
                    columns = [*zip(*found), list(found.values())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()))],
                        names=["key", "pointer", "lang", "phrase", "size", "here"],
                    )

    return texts.mapInArrow(run, "key long, pointer long, lang string, phrase string, size int, here long")


def frequent_phrases(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = LEAST, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, size (words) and f of all phrases of 1 to 4 words found at least `least` times;
    and lang and n, the words of each language. `bits` shortens the fingerprints (for tests)."""
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(lang), F.col(text)).alias("pointer"),
    )
    known: list[bitmaps.Bitmap] = []
    totals = None
    for name in ("words", "pairs", "longer"):
        counted = _count(texts, known, bits)
        kept = scratch.saved(counted.where(F.col("key").isNull() | (F.col("count") >= least)), f"frequent-{name}")
        if totals is None:
            totals = kept.where(F.col("key").isNull()).select("lang", F.col("count").alias("n"))
        known.append(_bitmap(kept.where(F.col("key").isNotNull())))
    found = scratch.saved(_pointers(_gathered(texts), known, bits).where(F.col("count") >= least), "frequent-pointers")
    clean, clashing = (found.where(c) for c in (F.col("least") == F.col("greatest"), F.col("least") != F.col("greatest")))
    places = _bitmap(clean, _place(F.col("key"), F.col("pointer")))
    clashes = None if clashing.isEmpty() else _bitmap(clashing)
    read = scratch.saved(_read(texts, known, places, clashes, bits), "phrase-texts")
    phrases = (
        read.join(clean.select("key", "pointer", "count"), ["key", "pointer"])
        .groupBy("key")
        .agg(*[F.first(c).alias(c) for c in ("lang", "phrase", "size")], F.first("count").alias("f"))
        .select("lang", "phrase", "size", "f")
    )
    if clashes is not None:
        by_text = read.join(clashing.select("key"), "key").groupBy("lang", "phrase", "size").agg(F.sum("here").alias("f"))
        phrases = phrases.unionByName(by_text.where(F.col("f") >= least))
    phrases = scratch.saved(phrases, "phrases")
    for b in [*known, places, *([] if clashes is None else [clashes])]:
        bitmaps.drop({"": b})
    return phrases, totals


def _exact(c: Column) -> Column:
    return c.cast("decimal(27,0)")


def _run(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` phrases of two to four
    words. a, l and r count the phrase and its parts at the cut that makes `score`, SCALE * a / (l + r),
    least (then: the earlier cut). A phrase is dropped if at least INSIDE percent of its occurrences may
    lie in one longer phrase that contains it. The result reads tables of `scratch`."""
    phrases, totals = frequent_phrases(docs, scratch, text, lang, least, bits)
    words = F.split("phrase", " ")
    candidates = phrases.where("size >= 2")
    parts = phrases.where(F.col("size") < LONGEST)
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = (
        cuts.withColumn("head", _run(words, F.lit(1), F.col("cut")))
        .withColumn("tail", _run(words, F.col("cut") + 1, F.col("size") - F.col("cut")))
        .join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
        .withColumn("both", _exact(F.col("l")) + _exact(F.col("r")))
        .withColumn("score", F.expr(f"(cast(a as decimal(20,0)) * cast({SCALE} as decimal(7,0))) div both"))
    )
    scored = (
        cuts.groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i ->"
        " array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    holders = (
        candidates.where("size >= 3")
        .select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("holder"))
    )
    kept = scored.join(holders, ["lang", "phrase"], "left").where(
        F.col("holder").isNull() | (100 * _exact(F.col("holder")) < INSIDE * _exact(F.col("a")))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = kept
    for slots in SLOTS:
        by = ["lang"]
        if slots > 1:
            first, by = first.withColumn("slot", F.pmod(F.xxhash64("phrase"), F.lit(slots))), ["lang", "slot"]
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        first = first.withColumn("rank", rank).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
