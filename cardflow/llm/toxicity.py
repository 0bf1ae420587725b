"""Toxic spans by a linear-chain conditional random field.

A token is a run of letters, digits and longer characters; its state is toxic or not. Emissions are
weights of hashed features of the lower-cased token (the whole, beginnings, ends, inner four-byte
grams, length); transitions and a start weight join the tokens of a sentence. All marginals come from
forward and backward messages, computed as prefix products of 2 x 2 matrices over a whole slice of
texts at once: the matrix of a sentence's first token has equal rows, so messages stop there.

Labels are of documents. Tokens get theirs from a lexicon of token beginnings that are at least `LIFT`
times as common in toxic documents as in others, and so beyond what chance would show once in all
beginnings. Near copies count once, so that rare words of a copied document stay out. Tokens of the
lexicon in toxic documents are toxic, all others are not; toxic documents without any are left out.

A document's score is a logistic curve of the chance that any of its tokens is toxic, by the marginals,
fitted to documents that the field did not see. Offending spans are runs of tokens with a marginal of
at least one half.

The field is fitted in one task on at most `MAX_TOXIC` toxic and `MAX_OTHER` other labelled rows, those with the
least hash of their id; their labels are joined as a broadcast of that many rows. Every text is scored
whole, without a shuffle, in slices that cut no sentence.

Defined results: a null or empty text scores as one without tokens; labels other than 0 and 1 and
labels of null ids are not used; of several labels of an id the greatest counts, of several texts the
least; with labels of one class or none every score is that class's smoothed share; rows without an
id are scored and not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.slices import slices
from cardflow.llm.words import mix

MAX_TOXIC, MAX_OTHER = 1_500, 3_000
BITS = 18
LIFT = 8.0
STEPS, LEAST_EPOCHS, RATE, DECAY = 320, 8, 0.3, 1e-4
THRESHOLD = 0.7
FLAT = 30.0
FAINT = 0.1

#: Weights after the features': toxic bias, start, and the three transitions that touch `toxic`.
BIAS, START, ENTER, LEAVE, STAY = range(1 << BITS, (1 << BITS) + 5)
SIZE = (1 << BITS) + 5

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?\n")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))


class Tokens:
    """Tokens of a slice: bytes from `start` to `end`, `first` in a sentence, `kind` among the distinct
    tokens, whose bytes begin at `sample`."""

    def __init__(self, data: np.ndarray):
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 1, dtype=bool)
        np.take(_TOKEN, self.data, out=inside[1:])
        self.start = np.flatnonzero(~inside[:-1] & inside[1:])
        self.end = np.flatnonzero(inside[:-1] & ~inside[1:])
        sentence = np.cumsum(_ENDS[data], dtype=np.int32)[self.start] if len(data) else np.zeros(0, np.int32)
        self.first = np.append(True, sentence[1:] != sentence[:-1])[: len(self.start)]
        padded = np.append(self.data, np.zeros(16, np.uint8)).astype(np.uint64)
        self.eight = padded[: len(data) + 1].copy()
        for k in range(1, 8):
            self.eight |= padded[k : len(data) + 1 + k] << np.uint64(8 * k)
        length = self.end - self.start
        whole = mix(_cut(self.eight[self.start], np.minimum(length, 8)) + mix(length.astype(np.uint64)))
        for k in range(8, int(length.max(initial=0)), 8):  # longer tokens, eight bytes more a time
            long = np.flatnonzero(length > k)
            part = _cut(self.eight[self.start[long] + k], np.minimum(length[long] - k, 8))
            whole[long] = mix(whole[long] + part)
        _, sample, self.kind = np.unique(whole, return_index=True, return_inverse=True)
        self.names = whole[sample]
        self.sample, self.length = self.start[sample], length[sample]

    def beginnings(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct token and hash of its beginnings of three to eight bytes and of the whole."""
        kind, name = [np.arange(len(self.names))], [self.names]
        for k in range(3, 9):
            i = np.flatnonzero(self.length >= k)
            kind.append(i)
            name.append(mix(_cut(self.eight[self.sample[i]], k) * np.uint64(31) + np.uint64(k)))
        return np.concatenate(kind), np.concatenate(name)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct token and feature, in pairs."""
        kind, begin = self.beginnings()
        kinds, found = [kind], [begin]
        for k in (2, 3, 4):
            i = np.flatnonzero(self.length >= k)
            kinds.append(i)
            found.append(mix(_cut(self.eight[self.sample[i] + self.length[i] - k], k) * np.uint64(37) + np.uint64(k)))
        inner = np.maximum(self.length - 3, 0)
        owner = np.repeat(np.arange(len(inner)), inner)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(inner) - inner, inner)
        kinds.append(owner)
        found.append(mix(_cut(self.eight[self.sample[owner] + within], 4) * np.uint64(41)))
        kinds.append(np.arange(len(inner)))
        found.append(mix(np.minimum(self.length, 20).astype(np.uint64) * np.uint64(43)))
        return np.concatenate(kinds), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _cut(eight: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """The first `size` bytes, 1 to 8."""
    away = (8 * (8 - np.asarray(size))).astype(np.uint64)
    return (eight << away) >> away


Matrices = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _product(a: Matrices, b: Matrices) -> Matrices:
    out = (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3])
    top = np.maximum(np.maximum(out[0], out[1]), np.maximum(out[2], out[3]))
    return tuple(x / top for x in out)


def _prefixes(m: Matrices) -> Matrices:
    """Products of the first 1, 2, ..., n matrices, up to a factor: products of pairs, then theirs."""
    n = len(m[0])
    if n < 2:
        return m
    half = _prefixes(_product(tuple(x[: n - 1 : 2] for x in m), tuple(x[1::2] for x in m)))
    odd = _product(tuple(x[: (n - 1) // 2] for x in half), tuple(x[2::2] for x in m))
    out = tuple(np.empty(n) for _ in range(4))
    for o, h, d, x in zip(out, half, odd, m):
        o[0], o[1::2], o[2::2] = x[0], h, d
    return out


def _messages(emission: np.ndarray, first: np.ndarray, w: np.ndarray) -> tuple[Matrices, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Matrix of each token, forward and backward messages (other, toxic), up to a factor."""
    e = np.exp(np.clip(emission, -FLAT, FLAT))
    enter, leave, stay, start = (np.exp(np.clip(w[k], -10, 10)) for k in (ENTER, LEAVE, STAY, START))
    one = np.ones(len(e))
    m = (one, np.where(first, start, enter) * e, np.where(first, 1.0, leave), np.where(first, start, stay) * e)
    top = np.maximum(np.maximum(m[0], m[1]), np.maximum(m[2], m[3]))
    m = tuple(x / top for x in m)
    p = _prefixes(m)
    q = _prefixes((m[0][:0:-1], m[2][:0:-1], m[1][:0:-1], m[3][:0:-1]))
    b0, b1 = np.append((q[0] + q[2])[::-1], 1.0), np.append((q[1] + q[3])[::-1], 1.0)
    return m, (p[0], p[1]), (b0, b1)


def marginals(emission: np.ndarray, first: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Probability that each token is toxic."""
    if not len(emission):
        return np.zeros(0)
    _, (a0, a1), (b0, b1) = _messages(emission, first, w)
    return a1 * b1 / (a0 * b0 + a1 * b1)


def _gradient(emission: np.ndarray, first: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood: labelled minus expected toxic tokens, one by one; and labelled minus
    expected numbers of starts and transitions that touch `toxic`."""
    m, (a0, a1), (b0, b1) = _messages(emission, first, w)
    p = a1 * b1 / (a0 * b0 + a1 * b1)
    inner = np.flatnonzero(~first)
    left = inner - 1
    joint = [a[left] * x[inner] * b[inner] for a, x, b in ((a0, m[0], b0), (a0, m[1], b1), (a1, m[2], b0), (a1, m[3], b1))]
    total = joint[0] + joint[1] + joint[2] + joint[3]
    expected = [(j / total).sum() for j in joint[1:]]
    was, now = y[left], y[inner]
    labelled = [np.sum((1 - was) * now), np.sum(was * (1 - now)), np.sum(was * now)]
    starts = (y[first] - p[first]).sum()
    return y - p, np.array([starts, *(a - b for a, b in zip(labelled, expected))])


def _emission(tokens: Tokens, w: np.ndarray) -> np.ndarray:
    kind, feature = tokens.features()
    return (np.bincount(kind, weights=w[feature], minlength=len(tokens.names)) + w[BIAS])[tokens.kind]


def _sketch(tokens: Tokens) -> int:
    """Least hash of three tokens in a row, which most near copies share."""
    h = tokens.names[tokens.kind]
    if len(h) > 2:
        h = mix(mix(h[:-2] * np.uint64(31) + h[1:-1]) * np.uint64(31) + h[2:])
    return int(h.min()) if len(h) else 0


def lexicon(docs: list[np.ndarray], sketches: list[int], toxic: np.ndarray) -> np.ndarray:
    """Hashes of telling beginnings, from each document's distinct ones. Toxic documents of sketches
    with shares s count as 1 / sum(s^2)."""
    names, inverse = np.unique(np.concatenate(docs), return_inverse=True)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    _, sketch = np.unique(np.array(sketches, dtype=np.uint64), return_inverse=True)
    bad = toxic[doc]
    pairs, times = np.unique(inverse[bad] * len(docs) + sketch[doc[bad]], return_counts=True)
    of = pairs // len(docs)
    total = np.bincount(of, weights=times, minlength=len(names))
    n1 = total**2 / np.maximum(np.bincount(of, weights=times.astype(np.float64) ** 2, minlength=len(names)), 1)
    n0 = np.bincount(inverse[~bad], minlength=len(names))
    share = toxic.mean()
    lift = ((n1 + 0.5) / (toxic.sum() + 1)) / ((n0 + 0.5) / ((~toxic).sum() + 1))
    n = np.maximum(n1 + n0, 1e-9)
    q = n1 / n
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = n * (np.where(q > 0, q * np.log(q / share), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - share)), 0))
    return names[(lift >= LIFT) & (q > share) & (surprise >= np.log(len(names)))]


def _evidence(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row minus the logarithm of the chance that none of its tokens is toxic, where tokens of
    less than `FAINT` count as none, so that long texts do not add up to something."""
    sure = p >= FAINT
    return np.bincount(row[sure], weights=-np.log1p(-np.minimum(p[sure], 1 - 1e-4)), minlength=n)


def _argument(evidence: np.ndarray) -> np.ndarray:
    some = np.clip(-np.expm1(-evidence), 1e-4, 1 - 1e-4)
    return np.stack([np.log(some / (1 - some)), np.ones(len(some))], axis=1)


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve: Newton steps, halved until the penalized loss falls."""
    start = np.array([1.0, 0.0])
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5 * ((w - start) ** 2).sum())

    w = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        g = x.T @ (p - target) + (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), g)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def fit_field(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """All weights, from whole texts and the labels of the documents."""
    labels = labels.astype(np.int64)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1.0) / (len(labels) + 2.0)
        return np.concatenate([np.zeros(SIZE), [0.0, np.log(share / (1 - share))]])
    unseen = np.arange(len(labels)) % 5 == 0
    for y in (0, 1):
        if not (labels[unseen] == y).any() or (labels[~unseen] == y).sum() < 2:
            unseen = np.zeros(len(labels), dtype=bool)
    docs, sketches, batches = [], [], []
    seen = [k for k in range(len(labels)) if not unseen[k]]
    for k in seen:
        t = Tokens(np.frombuffer(texts[k] + b"\n", dtype=np.uint8))
        docs.append(np.unique(t.beginnings()[1]))
        sketches.append(_sketch(t))
    known = lexicon(docs, sketches, labels[seen] == 1)
    usable = [k for k, d in zip(seen, docs) if labels[k] == 0 or np.isin(d, known).any()]
    del docs
    for part in _groups(usable, texts):
        owner = np.repeat([labels[k] for k in part], [len(texts[k]) + 1 for k in part])
        t = Tokens(np.frombuffer(b"\n".join(texts[k] for k in part) + b"\n", dtype=np.uint8))
        kind, name = t.beginnings()
        listed = np.bincount(kind[np.isin(name, known)], minlength=len(t.names)) > 0
        y = (listed[t.kind] & (owner[t.start] == 1)).astype(np.float64)
        kind, feature = t.features()
        batches.append((kind.astype(np.int32), feature.astype(np.int32), len(t.names), t.kind.astype(np.int32), t.first, y))
    w = np.zeros(SIZE)
    w[[BIAS, START, ENTER]] = -2.0
    w[STAY] = -1.0
    seen_squares = np.full(SIZE, 1e-6)
    rng = np.random.default_rng(5)
    for _ in range(max(LEAST_EPOCHS, STEPS // max(1, len(batches)))):
        for b in rng.permutation(len(batches)).tolist():
            kind, feature, kinds, token, first, y = batches[b]
            if not len(y):
                continue
            emission = (np.bincount(kind, weights=w[feature], minlength=kinds) + w[BIAS])[token]
            per_token, moves = _gradient(emission, first, y, w)
            by_kind = np.bincount(token, weights=per_token, minlength=kinds)
            g = np.zeros(SIZE)
            g[: 1 << BITS] = np.bincount(feature, weights=by_kind[kind], minlength=1 << BITS)
            g[BIAS] = per_token.sum()
            g[[START, ENTER, LEAVE, STAY]] = moves
            g -= DECAY * len(y) * w / max(1, len(batches))
            seen_squares += g * g
            w += RATE * g / np.sqrt(seen_squares)
    check = np.flatnonzero(unseen) if unseen.any() else np.arange(len(labels))
    evidence = np.zeros(len(check))
    for at, k in enumerate(check.tolist()):
        t = Tokens(np.frombuffer(texts[k] + b"\n", dtype=np.uint8))
        evidence[at] = _evidence(marginals(_emission(t, w), t.first, w), np.zeros(len(t.start), np.int64), 1)[0]
    return np.concatenate([w, _curve(_argument(evidence), labels[check].astype(np.float64))])


def _groups(rows: list[int], texts: list[bytes], limit: int = 1 << 19) -> Iterator[list[int]]:
    held, size = [], 0
    for k in rows:
        held.append(k)
        size += len(texts[k])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", most: tuple[int, int] = (MAX_TOXIC, MAX_OTHER)) -> np.ndarray:
    """The weights, from labelled rows that are not held out."""
    usable = (
        labels.select(F.col(id).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    parts = [usable.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in ((1, most[0]), (0, most[1]))]
    sample = (
        docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .join(F.broadcast(parts[0].union(parts[1])), "_id")
        .groupBy("_id", "_y")
        .agg(F.min("_text").alias("_text"))
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist())
        rows.sort()
        w = fit_field([r[2] for r in rows], np.array([r[1] for r in rows], dtype=np.int64))
        yield pa.RecordBatch.from_pydict({"w": pa.array([w.tolist()], pa.list_(pa.float64()))})

    model = sample.repartition(1).mapInArrow(train, "w array<double>").first()
    return np.array(model["w"]) if model else fit_field([], np.zeros(0, dtype=np.int64))


SPAN = "struct<start:long,end:long,mass:double>"


def score(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score, predicted and the offending spans (code points, end exclusive, with the sum
    of their marginals) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, curve = sent.value[:SIZE], sent.value[SIZE:]
        for batch in batches:
            n = len(batch)
            evidence = np.zeros(n)
            spans: list[list[dict[str, float]]] = [[] for _ in range(n)]
            for s in slices(batch.column(1), _ENDS):
                t = Tokens(s.data)
                p = marginals(_emission(t, w), t.first, w)
                row = s.rows(t.start)
                evidence += _evidence(p, row, n)
                bad = np.flatnonzero(p >= 0.5)
                if not len(bad):
                    continue
                begin = np.append(True, (np.diff(bad) > 1) | t.first[bad[1:]])
                run_first = np.flatnonzero(begin)
                run_last = np.append(run_first[1:], len(bad)) - 1
                total = np.add.reduceat(p[bad], run_first)
                points = np.append(0, np.cumsum((s.data & 0xC0) != 0x80))
                for i, j, x in zip(bad[run_first].tolist(), bad[run_last].tolist(), total.tolist()):
                    k = int(row[i])
                    shift = points[s.begins[k - s.first]] - (s.chars if k == s.first else 0)
                    spans[k].append({"start": int(points[t.start[i]] - shift), "end": int(points[t.end[j]] - shift), "mass": x})
            p = 1 / (1 + np.exp(-np.clip(_argument(evidence) @ curve, -500, 500)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("mass", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(spans, kind)], names=["_id", "score", "spans"])

    return (
        docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
        .mapInArrow(run, f"_id long, score double, spans array<{SPAN}>")
        .select(
            F.col("_id").alias(id),
            held_out("_id").alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            "spans",
        )
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
