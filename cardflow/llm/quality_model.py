"""Quality classifier: support vectors over naive Bayes features.

A text is a set of n-gram indicators: byte trigrams, runs of one to three word shapes (case, digits,
marks, length), and how much of the text repeats itself. Each indicator counts by its log-count ratio
between the classes; a linear hinge-loss model over the scaled indicators is fitted by dual
coordinate descent; its margin becomes a probability by a logistic curve fitted to rows that the
model did not see.

The model is fitted on at most `MAX_ROWS` labelled rows, those with the least hash of their id, in
one task; labels are joined as a broadcast of that many rows. Every text is scored whole, in one scan
without a shuffle.

Defined results: a null or empty text has only the indicator of no words; labels other than 0 and 1
and labels of null ids are not used; of several labels of an id the least counts; with labels of one
class or none every score is that class's smoothed share; a very long text is scored whole, as one
row of indicators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.words import Words, chunks, grams

MAX_ROWS = 12_000
BYTE_BITS, SHAPE_BITS, REPEATS = 16, 13, 64
SIZE = (1 << BYTE_BITS) + (1 << SHAPE_BITS) + REPEATS
TEXTS = 256
SMOOTHING = 1.0
PENALTY = 0.05
EPOCHS = 8
THRESHOLD = 0.7

_CLASS = np.zeros((4, 256), dtype=np.int32)  # upper, digit, mark, letter or longer character
_CLASS[0, 65:91] = 1
_CLASS[1, 48:58] = 1
_CLASS[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_CLASS[3, [*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def _bucket(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64)


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and indicator, each pair once, in order."""
    n = len(offsets) - 1
    on = np.zeros((n, SIZE), dtype=bool)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) > 2:
        b = data.astype(np.uint32)
        inside = owner[:-2] == owner[2:]
        three = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        on[owner[:-2][inside], _bucket(three[inside], BYTE_BITS)] = True
    words = Words(data, offsets)
    at = words.owners()
    counts = words.counts()
    if len(at):
        length = words.ends - words.starts
        cuts = np.stack([words.starts, words.ends], axis=1).ravel()
        padded = np.append(data, 32)
        upper, digit, mark, letter = (np.add.reduceat(c[padded], cuts)[::2] for c in _CLASS)
        shape = (
            np.where(upper == 0, 0, np.where((upper == letter) & (letter > 1), 2, 1))
            + 3 * (digit > 0)
            + 6 * np.minimum(mark, 3)
            + 24 * np.minimum(length // 4, 5)
            + 144 * (letter > 0)
        ).astype(np.uint32)
        base = 1 << BYTE_BITS
        for k in (1, 2, 3):
            if len(shape) < k:
                break
            run = np.full(len(shape) - k + 1, k, dtype=np.uint32)
            for i in range(k):
                run = run * np.uint32(1009) + shape[i : len(shape) - k + 1 + i]
            inside = at[: len(run)] == at[k - 1 :]
            on[at[: len(run)][inside], base + _bucket(run[inside], SHAPE_BITS)] = True
    base = SIZE - REPEATS
    for j, k in enumerate((1, 3)):
        total, distinct = np.zeros(n), np.zeros(n)
        if len(words.hashes) >= k:
            g = grams(words.hashes, k)
            own = at[: len(g)]
            inside = own == at[k - 1 :]
            g, own = g[inside], own[inside]
            order = np.lexsort((g, own))
            g, own = g[order], own[order]
            new = np.ones(len(g), dtype=bool)
            new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
            total = np.bincount(own, minlength=n)
            distinct = np.bincount(own[new], minlength=n)
        share = np.where(total > 0, distinct / np.maximum(total, 1), 1.0)
        on[np.arange(n), base + 16 * j + np.minimum((share * 15).astype(np.int64), 15)] = True
    on[np.arange(n), base + 32 + np.minimum(np.log2(counts + 1).astype(np.int64), 15)] = True
    flat = np.flatnonzero(on.ravel())
    return flat // SIZE, flat % SIZE


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, data, offsets in chunks(column):
        for a in range(0, j - i, TEXTS):
            b = min(a + TEXTS, j - i)
            yield i + a, i + b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-count ratio of each indicator."""
    counts = [np.full(SIZE, SMOOTHING) for _ in range(2)]
    for x, y in zip(rows, labels.tolist()):
        counts[y][x] += 1
    p, q = counts[1] / counts[1].sum(), counts[0] / counts[0].sum()
    return np.log(p / q)


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) that minimize the hinge loss: one dual variable at a time is
    set to its best value between 0 and its class's penalty. Classes weigh the same in total."""
    share = np.bincount(labels, minlength=2)
    penalty = PENALTY * len(labels) / (2 * np.maximum(share, 1))
    w = np.zeros(SIZE + 1)
    y = np.where(labels == 1, 1.0, -1.0)
    alpha = np.zeros(len(rows))
    values = [scale[x] for x in rows]
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (w[x] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), penalty[labels[i]])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[x] += step * v
                w[-1] += step
    return w


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margin to probability, by Newton steps."""
    a, b = 1.0, 0.0
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        s = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margin).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(s * margin**2).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def _fit(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weight of each indicator, then the bias, of the curve's argument."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1.0) / (len(labels) + 2.0)
        return np.append(np.zeros(SIZE), np.log(share / (1 - share)))
    unseen = np.arange(len(rows)) % 5 == 0
    for y in (0, 1):  # each side needs both classes
        if not (labels[unseen] == y).any() or not (labels[~unseen] == y).any():
            unseen = np.zeros(len(rows), dtype=bool)
    seen = [r for r, u in zip(rows, unseen) if not u]
    scale = ratios(seen, labels[~unseen])
    w = descend(seen, labels[~unseen], scale)
    w[:-1] *= scale
    check = np.flatnonzero(unseen) if unseen.any() else np.arange(len(rows))
    a, b = logistic(np.array([w[rows[i]].sum() + w[-1] for i in check]), labels[check])
    w *= a
    w[-1] += b
    return w


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> np.ndarray:
    """The model's weights, from labelled rows that are not held out."""
    chosen = (
        labels.select(F.col(id).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.min("_y").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    sample = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _parts(batch.column(1)):
                owner, x = indicators(data, offsets)
                at = np.searchsorted(owner, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32)))],
                    names=["_id", "_y", "x"],
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for id_, y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                rows.append((id_, y, np.asarray(x.values)))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        w = _fit([r[2] for r in rows], np.array([r[1] for r in rows], dtype=np.int64))
        yield pa.RecordBatch.from_pydict({"w": pa.array([w.tolist()], pa.list_(pa.float64()))})

    features = sample.select("_id", "_text", "_y").mapInArrow(extract, "_id long, _y int, x array<int>")
    model = features.repartition(1).mapInArrow(train, "w array<double>").first()
    return np.array(model["w"]) if model else _fit([], np.zeros(0, dtype=np.int64))


def score(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            for i, j, data, offsets in _parts(batch.column(1)):
                owner, x = indicators(data, offsets)
                margin = np.bincount(owner, weights=w[x], minlength=j - i) + w[-1]
                p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(p)], names=["doc_id", "score"])

    return (
        docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .mapInArrow(run, "doc_id long, score double")
        .select(
            "doc_id",
            held_out("doc_id").alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
