"""Size-aware heavy-light join of shingle sets by Jaccard similarity.

A text's set holds its distinct shingles of `k` words; with fewer words, the whole sequence is one.
Two sets of a and b shingles link when they share at least need(a, b) = p (a + b) / (100 + p) of them.

Equal sets are one class from the start. Then, by size:

- Small sets enumerate their subsets of fixed sizes. Sets that share a subset of i shingles share i, so
  in each group of one subset the smallest set links to every other whose need is at most i. That
  connects whatever the group connects, without its pairs.
- Large sets scan inverted lists. Two linked sets share one of the first n - need + 1 shingles of any
  order, so only those are listed. The order puts last what is frequent in whole sets. Set sizes and the
  parity signatures bound the difference of two sets from below (those of large sets by wider
  signatures, kept beside the lists), so that few pairs are left to verify with the whole sets.
- The boundary is the size at which the estimated work of both is least.

A long list does not emit its pairs. It is dealt into blocks of `BLOCK`; each set proposes its nearest
two, these are verified and joined to components, and in a second round only pairs of different
components are proposed: of a group of near copies those few that the first round left apart.

The result is one class per document, links are never expanded.

Defined results: a null or empty text has an empty set and is alone; repeated rows are equal sets; a
null id takes part, and a component's id is its least id that is not null. A very
long text is one set, cut into shingles whole in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm import bitmaps
from cardflow.llm.components import components
from cardflow.llm.tables import Scratch, partitions, saved
from cardflow.llm.words import Words, chunks, gram_rows, grams

BITS = 512
WIDE_BITS = 8192
FREQUENT = 100
SHORT_LIST = 64
BLOCK = 2000
PROPOSED = 2
#: Estimated work of one listed shingle, in subsets.
LIST_COST = 8
MOST_SUBSETS = 1000
MOST_SMALL = 40
#: Tokens a task counts at once, and the least count in a task that it reports.
MOST_COUNTED = 1_000_000
LEAST_COUNT = 2


def need(a, b, percent: int):
    """Least intersection with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def least_size(n, percent: int):
    """Size of the smallest set that a set of `n` may link to."""
    return -(-percent * n // 100)


def is_wide(n, percent: int):
    """Whether so many shingles may differ that the short signature no longer tells sets apart."""
    return 2 * n - 2 * need(n, n, percent) > BITS // 4


def subset_count(n: int, percent: int) -> int:
    return sum(comb(n, n - i) for i in range(least_size(n, percent), n + 1))


class Sets:
    """The shingle sets of consecutive texts: sorted `tokens`, and `at`, each set's first."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int):
        words = Words(data, offsets, lower=True)
        owner, first = gram_rows(words, k)
        token = grams(words.hashes, k)[first] if len(first) else np.zeros(0, np.uint64)
        counts = words.counts()
        for m in range(1, k):
            short = np.flatnonzero(counts == m)
            if len(short):
                owner = np.concatenate([owner, short])
                token = np.concatenate([token, grams(words.hashes, m)[words.first[short]] ^ np.uint64(m)])
        order = np.lexsort((token, owner))
        owner, token = owner[order], token[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = token[new], owner[new]
        self.at = np.searchsorted(self.owner, np.arange(len(counts) + 1))
        self.sizes = np.diff(self.at)

    def digest(self, i: int) -> bytes:
        return hashlib.blake2b(self.tokens[self.at[i] : self.at[i + 1]].tobytes(), digest_size=16).digest()

    def signatures(self, rows: list[int], step: int = 256) -> Iterator[bytes]:
        """Parity of the tokens in each of `BITS` classes, packed, for some sets in order, `step` texts at
        a time."""
        wanted = np.array(rows, dtype=np.int64)
        for a in range(0, len(self.sizes), step):
            b = min(a + step, len(self.sizes))
            here = wanted[np.searchsorted(wanted, a) : np.searchsorted(wanted, b)] - a
            if not len(here):
                continue
            part = slice(self.at[a], self.at[b])
            place = (self.owner[part] - a) * BITS + (self.tokens[part] >> np.uint64(64 - 9)).astype(np.int64)
            odd = np.bincount(place, minlength=(b - a) * BITS) & 1
            packed = np.packbits(odd.reshape(-1, BITS).astype(np.uint8), axis=1)
            yield from (packed[i].tobytes() for i in here.tolist())

    def wide(self, i: int) -> bytes:
        """The same for one set in `WIDE_BITS` classes."""
        place = (self.tokens[self.at[i] : self.at[i + 1]] >> np.uint64(64 - 13)).astype(np.int64)
        return np.packbits((np.bincount(place, minlength=WIDE_BITS) & 1).astype(np.uint8)).tobytes()


def _prefixes(sets: Sets, percent: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Set number and token of the prefix of every set: the first tokens, frequent ones last."""
    token, owner = sets.tokens, sets.owner
    if frequent is not None:
        late = bitmaps.contains(frequent, token)
        order = np.lexsort((token, late, owner))
        token, owner = token[order], owner[order]
    length = sets.sizes - least_size(sets.sizes, percent) + 1
    rank = np.arange(len(token)) - sets.at[owner]
    take = rank < length[owner]
    return owner[take], token[take]


class Counts:
    """Sets that hold each token, counted over whole sets. When there are more than `MOST_COUNTED`
    tokens, the rarest half go, so a count may be too low; it only serves for an order."""

    def __init__(self):
        self.token, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, tokens: np.ndarray) -> None:
        self.waiting.append(tokens)
        if sum(map(len, self.waiting)) > 2 * MOST_COUNTED:
            self._merge()

    def _merge(self) -> None:
        token, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.waiting]), return_counts=True)
        self.waiting = []
        both, at = np.unique(np.concatenate([self.token, token]), return_inverse=True)
        total = np.bincount(at, np.concatenate([self.count, count]), len(both)).astype(np.int64)
        if len(both) > MOST_COUNTED:
            most = np.sort(np.argpartition(total, -(MOST_COUNTED // 2))[-(MOST_COUNTED // 2) :])
            both, total = both[most], total[most]
        self.token, self.count = both, total

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        take = self.count >= LEAST_COUNT
        return self.token[take], self.count[take]


def _described(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, doc (MD5 of the text), n, digest (null for an empty set) and the whole set where it is
    small. Besides, rows without a doc: token and count of what recurs in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counts()
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in chunks(batch.column(1)):
                sets = Sets(data, offsets, k)
                seen.add(sets.tokens)
                raw = data.tobytes()
                little = sets.sizes[sets.owner] < MOST_SMALL
                small_ends = np.searchsorted(sets.owner[little], np.arange(len(sets.sizes) + 1))
                yield rows(
                    j - i,
                    doc_id=ids.slice(i, j - i),
                    doc=pa.array([hashlib.md5(raw[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
                    n=pa.array(sets.sizes.astype(np.int64)),
                    digest=pa.array([sets.digest(x) if n else None for x, n in enumerate(sets.sizes.tolist())], pa.binary()),
                    small=pa.ListArray.from_arrays(
                        pa.array(small_ends.astype(np.int32)), pa.array(sets.tokens[little].view(np.int64))
                    ),
                )
        token, count = seen.repeated()
        for at in range(0, len(token), 10_000):
            part = slice(at, at + 10_000)
            yield rows(len(token[part]), token=pa.array(token[part].view(np.int64)), c=pa.array(count[part]))

    types = {
        "doc_id": pa.int64(), "doc": pa.binary(), "n": pa.int64(), "digest": pa.binary(),
        "small": pa.list_(pa.int64()), "token": pa.int64(), "c": pa.int64(),
    }

    def rows(count: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns.get(name, pa.nulls(count, t)) for name, t in types.items()], names=list(types)
        )

    schema = "doc_id long, doc binary, n long, digest binary, small array<long>, token long, c long"
    return docs.mapInArrow(run, schema)


def _boundary(described: DataFrame, percent: int) -> int:
    """Sets below this size enumerate subsets."""
    rows = described.where(f"n < {MOST_SMALL}").select("n", "digest").distinct().groupBy("n").count().collect()
    sizes = {r["n"]: r["count"] for r in rows if r["n"]}

    def cost(x: int) -> float:
        subsets = sum(c * subset_count(n, percent) for n, c in sizes.items() if n < x)
        lists = sum(
            c * (n - least_size(n, percent) + 1) * LIST_COST for n, c in sizes.items() if n >= least_size(x, percent)
        )
        return subsets + lists

    options = [x for x in range(1, MOST_SMALL) if all(subset_count(n, percent) <= MOST_SUBSETS for n in range(1, x))]
    return min(options, key=lambda x: (cost(x), x))


def _light_links(described: DataFrame, percent: int, below: int) -> DataFrame:
    """a, b: links among sets smaller than `below`."""
    light = described.where((F.col("n") > 0) & (F.col("n") < below)).select("digest", "small").dropDuplicates(["digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                rows: list[tuple] = []
                for digest, small in zip(*(c.slice(at, 100).to_pylist() for c in batch.columns)):
                    tokens = [t.to_bytes(8, "little", signed=True) for t in small]
                    n = len(tokens)
                    for size in range(least_size(n, percent), n + 1):
                        for subset in combinations(tokens, size):
                            key = hashlib.blake2b(b"".join(subset), digest_size=16).digest()
                            rows.append((key, size, digest, n))
                key, size, digest, n = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.binary()), pa.array(size, pa.int32()), pa.array(digest, pa.binary()), pa.array(n, pa.int32())],
                    names=["key", "size", "digest", "n"],
                )

    subsets = light.mapInArrow(run, "key binary, size int, digest binary, n int")
    heads = subsets.groupBy("key").agg(F.min(F.struct("n", "digest")).alias("head"), F.count("*").alias("c"))
    required = F.ceil(F.lit(percent) * (F.col("n") + F.col("head.n")) / F.lit(100 + percent))
    return (
        subsets.join(heads.where("c > 1"), "key")
        .where((F.col("digest") != F.col("head.digest")) & (required <= F.col("size")))
        .select(F.col("head.digest").alias("a"), F.col("digest").alias("b"))
        .distinct()
    )


def _frequent(found: DataFrame) -> dict[str, bitmaps.Bitmap]:
    counted = found.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("c").alias("c"))
    return bitmaps.build(counted.where(F.col("c") >= FREQUENT), "token", {"frequent": F.lit(True)})


_LISTED = "digest binary, n int, sign binary, wide binary, tokens array<long>"
_ENTRY = "token long, digest binary, n int, sign binary, long boolean"


def _listed(docs: DataFrame, k: int, percent: int, frequent, least: int) -> DataFrame:
    """The sets of at least `least` shingles, with the whole prefix in the order that the lists use and,
    where they are large, the wide signature. A task lists equal sets once, so of many copies few rows
    are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed: set[bytes] = set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(1)):
                sets = Sets(data, offsets, k)
                owner, token = _prefixes(sets, percent, frequent.value)
                rows, digests = [], []
                for i in np.flatnonzero(sets.sizes >= max(least, 1)).tolist():
                    digest = sets.digest(i)
                    if digest not in listed:
                        rows.append(i)
                        digests.append(digest)
                        if len(listed) < 200_000:
                            listed.add(digest)
                chosen = np.zeros(len(sets.sizes), dtype=bool)
                chosen[rows] = True
                wide = is_wide(sets.sizes, percent)
                token, owner = token[chosen[owner]], owner[chosen[owner]]
                ends = np.append(np.searchsorted(owner, rows), len(owner)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()), pa.array(sets.sizes[chosen].astype(np.int32)),
                        pa.array(list(sets.signatures(rows)), pa.binary()),
                        pa.array([sets.wide(i) if wide[i] else None for i in rows], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64))),
                    ],
                    names=["digest", "n", "sign", "wide", "tokens"],
                )

    return docs.mapInArrow(run, _LISTED)


def _entries(listed: DataFrame, shared, long) -> DataFrame:
    """The inverted lists' rows. `shared` holds the tokens of more than one row of `listed`, counted in
    the same prefixes: what it leaves out has no partner. `long` holds those of long lists; what it
    leaves out is in none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), tokens.value_lengths().to_numpy())
            token = tokens.flatten().to_numpy()
            take = bitmaps.contains(shared.value, token.view(np.uint64))
            row, token = pa.array(row[take]), token[take]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token), *[batch.column(c).take(row) for c in range(3)],
                    pa.array(bitmaps.contains(long.value, token.view(np.uint64)), pa.bool_()),
                ],
                names=["token", "digest", "n", "sign", "long"],
            )

    return listed.select("digest", "n", "sign", "tokens").mapInArrow(run, _ENTRY)


def _passing(
    n: np.ndarray, sign: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows `i` against rows `j`: which may link, and a lower bound of how many shingles differ."""
    differ = np.bitwise_count(sign[i, None, :] ^ sign[None, j, :]).sum(axis=2, dtype=np.int32)
    both, least = n[i, None] + n[None, j], need(n[i, None], n[None, j], percent)
    return (differ <= both - 2 * least) & (least <= np.minimum(n[i, None], n[None, j])), differ


def _short_pairs(lists: pa.RecordBatch, lengths: np.ndarray, percent: int) -> pa.RecordBatch:
    """All pairs that pass, of consecutive short lists of these lengths: at each distance the rows so far
    apart in a list are compared at once, so what is held grows with the rows, not with the pairs."""
    coded = lists.column("digest").dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    code = rank[coded.indices.to_numpy()]
    n = lists.column("n").to_numpy().astype(np.int64)
    sign = np.frombuffer(b"".join(lists.column("sign").to_pylist()), dtype=np.uint64).reshape(len(n), -1)
    following = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(n))
    found = [np.zeros(0, np.int64)]
    for distance in range(1, int(lengths.max(initial=0))):
        i = np.flatnonzero(following > distance)
        j = i + distance
        both, least = n[i] + n[j], need(n[i], n[j], percent)
        may = np.flatnonzero((least <= np.minimum(n[i], n[j])) & (code[i] != code[j]))
        i, j, most = i[may], j[may], (both - 2 * least)[may]
        near = np.bitwise_count(sign[i] ^ sign[j]).sum(axis=1, dtype=np.int32) <= most
        x, y = code[i[near]], code[j[near]]
        found.append(np.minimum(x, y) * len(order) + np.maximum(x, y))
    pairs = np.unique(np.concatenate(found))
    digests = coded.dictionary.take(order)
    return pa.RecordBatch.from_arrays(
        [digests.take(pa.array(pairs // max(len(order), 1))), digests.take(pa.array(pairs % max(len(order), 1)))], names=["a", "b"]
    )


def _block_pairs(labelled: DataFrame) -> DataFrame:
    """Lists with `comp`, the set's component, dealt into pairs of blocks of about `BLOCK` rows: each block
    of the main component with each of the others, and each two of the others. So each pair of sets
    of which one is minor meets once, and no task holds more than two blocks."""
    main = (
        labelled.groupBy("token", "comp")
        .agg(F.count("*").alias("c"))
        .groupBy("token")
        .agg(
            F.max_by("comp", F.struct("c", "comp")).alias("main"),
            F.ceil(F.max("c") / BLOCK).alias("mains"),
            F.ceil((F.sum("c") - F.max("c")) / BLOCK).alias("minors"),
        )
        .where("minors > 0")
    )
    rows = labelled.join(main, "token").withColumn("minor", F.col("comp") != F.col("main"))
    mains, minors = F.col("mains"), F.col("minors")
    block = F.pmod(F.xxhash64("digest", "token"), F.when(F.col("minor"), minors).otherwise(mains))
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    place = lambda part, side: F.struct(part.alias("part"), side.cast("int").alias("side"))
    with_minors = F.transform(to(minors), lambda j: place(F.col("block") * minors + j, F.lit(0)))
    with_mains = F.transform(to(mains), lambda i: place(i * minors + F.col("block"), F.lit(1)))
    among = F.transform(
        to(minors),
        lambda j: place(
            (mains + F.least(j, F.col("block"))) * minors + F.greatest(j, F.col("block")),
            F.when(j < F.col("block"), 1).otherwise(0),
        ),
    )
    places = F.when(F.col("minor"), F.concat(with_mains, among)).otherwise(with_minors)
    return rows.withColumn("block", block).withColumn("place", F.explode(places)).select(
        "token", F.col("place.part").alias("part"), "digest", "n", "sign", "comp", F.col("place.side").alias("side")
    )


def _proposed(rows: DataFrame, percent: int, second: bool) -> DataFrame:
    """a, b: pairs to verify, from lists of (token, part, digest, n, sign, comp, side).

    First round: all that pass in a short list, the nearest `PROPOSED` earlier ones of each set in a
    longer one. Second round: all that pass between components, and where a part has rows of side 1,
    only of these with the others."""

    def pairs(digest: np.ndarray, n: np.ndarray, sign: np.ndarray, comp: np.ndarray, side: np.ndarray) -> set:
        order = np.unique(digest, return_index=True)[1]
        order = order[np.argsort(n[order], kind="stable")]
        digest, n, sign, comp, side = digest[order], n[order], sign[order], comp[order], side[order]
        # one block against itself, or the rows of one side against those of the other
        own = np.flatnonzero(side != 1)
        other = np.flatnonzero(side == 1) if len(own) < len(side) else own
        out = set()
        for start in range(0, len(own), 64):
            i = own[start : start + 64]
            ok, differ = _passing(n, sign, i, other, percent)
            if other is own:
                ok &= other[None, :] < i[:, None]
            if second:
                ok &= comp[i, None] != comp[None, other]
            elif len(own) > SHORT_LIST:
                near = np.where(ok, differ, 1 << 30)
                best = np.argpartition(near, PROPOSED - 1, axis=1)[:, :PROPOSED]
                chosen = np.zeros_like(ok)
                np.put_along_axis(chosen, best, True, axis=1)
                ok &= chosen
            for x, y in zip(*np.nonzero(ok)):
                a, b = digest[i[x]], digest[other[y]]
                out.add((a, b) if a < b else (b, a))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # lists end inside batches: the last one waits for the next batch
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if held:
                old = held[-1]
                same = old.column(0)[-1].as_py() == key[0, 0] and old.column(1)[-1].as_py() == key[1, 0]
                if not same:
                    yield from finish(held)
                    held = []
            if len(cuts):
                held.append(batch.slice(0, int(cuts[0])))
                yield from finish(held)
                yield from whole(batch.slice(int(cuts[0]), int(cuts[-1] - cuts[0])), cuts - cuts[0])
                held = [batch.slice(int(cuts[-1]))]
            else:
                held.append(batch)
        if held:
            yield from finish(held)

    def one(table: pa.RecordBatch) -> set:
        if table.num_rows < 2:
            return set()
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), dtype=np.uint64).reshape(table.num_rows, -1)
        as_bytes = lambda c: np.array(table.column(c).to_pylist(), dtype=object)
        return pairs(as_bytes("digest"), table.column("n").to_numpy().astype(np.int64), sign, as_bytes("comp"), table.column("side").to_numpy())

    def finish(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield from whole(table, np.array([0, table.num_rows]))

    def whole(table: pa.RecordBatch, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of the lists between these edges."""
        lengths = np.diff(edges)
        brief = (lengths <= SHORT_LIST) & (not second)
        if (lengths[brief] > 1).any():
            yield _short_pairs(table.filter(pa.array(np.repeat(brief, lengths))), lengths[brief], percent)
        found: set = set()
        for k in np.flatnonzero(~brief).tolist():
            found |= one(table.slice(int(edges[k]), int(lengths[k])))
        yield from _pair_batch(found)

    dealt = (
        rows.select("token", "part", "digest", "n", "sign", "comp", "side")
        .repartition(partitions(rows.sparkSession), "token", "part")
        .sortWithinPartitions("token", "part")
    )
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _pair_batch(found: set) -> Iterator[pa.RecordBatch]:
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _narrowed(chosen: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide signatures of large sets let pass."""
    wide = chosen.where(F.col("wide").isNotNull()).select("digest", F.col("wide").alias("w"), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, m, y, n in zip(*(batch.column(c).to_pylist() for c in range(2, 6))):
                if x is not None and y is not None:
                    differ = int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum())
                    keep.append(differ <= m + n - 2 * need(m, n, percent))
                else:
                    keep.append(True)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = wide.select(F.col("digest").alias("a"), F.col("w").alias("x"), F.col("n").alias("m"))
    right = wide.select(F.col("digest").alias("b"), F.col("w").alias("y"), "n")
    return pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", "x", "m", "y", "n").mapInArrow(run, "a binary, b binary")


def _verified(
    docs: DataFrame, described: DataFrame, pairs: DataFrame, k: int, percent: int, scratch: Scratch
) -> DataFrame:
    """The pairs that link, by their whole sets. Only one text of each set that is asked for is cut
    into shingles again, and only these sets are moved."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    sources = described.join(asked, "digest", "left_semi").groupBy("digest").agg(F.min("doc").alias("doc"))
    head = F.conv(F.hex(F.substring("doc", 1, 7)), 16, 10).cast("long")
    maps = bitmaps.build(sources.select(head.alias("key")), "key", {"wanted": F.lit(True)}, bits=24)
    wanted = maps["wanted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            texts = batch.column(1).fill_null("")
            heads = [int.from_bytes(hashlib.md5(t.as_py()).digest()[:7], "big") for t in texts.cast(pa.binary())]
            asked_for = bitmaps.contains(wanted.value, np.array(heads, dtype=np.uint64))
            for _, _, data, offsets in chunks(texts.filter(pa.array(asked_for))):
                sets = Sets(data, offsets, k)
                rows = []
                for i in np.flatnonzero(sets.sizes).tolist():
                    digest = sets.digest(i)
                    if digest not in sent:
                        rows.append((digest, sets.tokens[sets.at[i] : sets.at[i + 1]].tobytes()))
                        if len(sent) < 200_000:
                            sent.add(digest)
                if rows:
                    digest, tokens = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(tokens, pa.binary())], names=["digest", "tokens"])

    sets = docs.mapInArrow(run, "digest binary, tokens binary").groupBy("digest").agg(F.first("tokens").alias("tokens"))
    sets = scratch.saved(sets.join(asked, "digest", "left_semi"), "sets")
    bitmaps.drop(maps)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(t.as_py(), dtype=np.uint64) for t in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("digest").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("digest").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, doc (MD5 of the text), n, digest and label (the same for all of a component; null for
    an empty set) of every row."""
    with Scratch(docs.sparkSession) as scratch:
        return saved(_classes(docs, id, text, k, percent, scratch), "classes")


def _classes(docs: DataFrame, id: str, text: str, k: int, percent: int, scratch: Scratch) -> DataFrame:
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = scratch.saved(_described(texts, k, percent), "described")
    described = found.where(F.col("doc").isNotNull()).drop("token", "c")
    below = _boundary(described, percent)
    links = scratch.saved(_light_links(described, percent, below), "light-links")

    maps = _frequent(found)
    chosen = _listed(texts, k, percent, maps["frequent"], least_size(below, percent)).dropDuplicates(["digest"])
    chosen = scratch.saved(chosen, "listed")
    bitmaps.drop(maps)
    lengths = chosen.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("length"))
    lengths = scratch.saved(lengths.where("length > 1"), "lengths")
    is_long = F.col("length") > SHORT_LIST
    maps = bitmaps.build(lengths, "token", {"shared": F.lit(True), "long": is_long})
    entries = _entries(chosen, maps["shared"], maps["long"])
    # only rows of long lists meet the lengths; without one they were taken for long by a false member
    long_lists = scratch.saved(entries.where("long").drop("long").join(lengths.where(is_long), "token", "left"), "lists")
    parts = F.coalesce(F.ceil(F.col("length") / BLOCK), F.lit(1))
    part = F.pmod(F.xxhash64("digest", "token"), parts).cast("int").alias("part")
    row = ["digest", "n", "sign", F.col("digest").alias("comp"), F.lit(0).alias("side")]
    short = entries.where(~F.col("long")).select("token", F.lit(0).alias("part"), *row)
    first = _proposed(short.union(long_lists.select("token", part, *row)), percent, second=False)
    first = scratch.saved(_narrowed(chosen, first, percent), "proposed")
    bitmaps.drop(maps)
    links = scratch.saved(links.union(_verified(texts, described, first, k, percent, scratch)), "links")
    labels = components(links, scratch)

    labelled = long_lists.where(is_long).join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "comp", F.coalesce("label", "digest")
    )
    second = _proposed(_block_pairs(labelled), percent, second=True).join(first, ["a", "b"], "left_anti")
    second = scratch.saved(_narrowed(chosen, second, percent), "proposed")
    if not second.isEmpty():
        more = scratch.saved(_verified(texts, described, second, k, percent, scratch), "links")
        if not more.isEmpty():
            labels = components(links.union(more), scratch)
    return described.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "doc", "n", "digest", F.coalesce("label", "digest").alias("label")
    )


def component_ids(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    found = classes(docs, id, text, k, percent)
    least = found.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("least"))
    return found.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_per_class(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each component: that of the least id. Texts without words stay."""
    found = classes(docs, id, text, k, percent)
    chosen = (
        found.where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "doc")).alias("f"))
        .select(F.col("f.doc_id").alias("_i"), F.col("f.doc").alias("_m"))
    )
    keyed = docs.withColumns({"_id": F.col(id).cast("long"), "_md5": F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))})
    stays = keyed.join(chosen, (F.col("_md5") == F.col("_m")) & F.col("_id").eqNullSafe(F.col("_i")), "left_semi")
    rank = F.row_number().over(Window.partitionBy("_md5", "_id").orderBy("_id"))
    empty = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    return (
        stays.withColumn("_rank", rank).where("_rank = 1").select(*docs.columns).union(docs.where(empty))
    )
