"""Exact top-k inner products by a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it, and kept in that order as blocks:
annuli of one pivot. A query's distance to the pivot bounds its distance to everything in an annulus
from below, and with the largest norm there its inner product from above, since
2 <q, x> = |q|^2 + |x|^2 - |q - x|^2. A query first reads the annuli of highest bounds, which gives it
k scores; then it expands to the annuli whose bound still reaches its k-th score. What is left out
cannot be in the result, so the search is exact.

Queries are grouped as blocks too, so a join row is one block of queries against one annulus: a
matrix product, with no key that gathers rows. Equal vectors are one entry that keeps its k + 1 least
ids (no query can use more, being at most one of them itself); the window that picks them limits
before it shuffles. Pivots come from at most `SAMPLE` vectors. The list of annuli is broadcast: their
size grows so that there are never more than `MAX_BLOCKS` and one for each pivot and task.

Defined results: vectors that are null or hold a null or non-finite component, and rows without an
id, take no part; a shorter vector is padded with zeros; a repeated row counts once; ties go to the
smaller id; with fewer candidates a query has fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.tables import partitions, saved

SCALE = 256
SAMPLE = 4096
MAX_PIVOTS = 128
BLOCK = 512
QUERIES = 128
MAX_BLOCKS = 1 << 17
FIRST_BLOCKS = 2
#: Above this, sums of products may leave the integers that a double holds.
EXACT = float(1 << 52)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (ends == width).all():
        return values.reshape(len(column), width).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), ends)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(ends) - ends, ends)] = values
    return out


def _packed(x: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold them all."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return x.astype(kind).tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"i{len(data) // (rows * width)}").reshape(rows, width).astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    d = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(d, 0))


def quantized(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v: the integer vectors that take part, each row once."""
    ok = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
        .where(ok)
        .select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))
    )


def _pivots(entries: DataFrame, width: int, n: int) -> np.ndarray:
    rows = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()["v"]
    x = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        x[i, : len(v)] = v
    k = int(np.clip(np.sqrt(n) / 2, 1, min(MAX_PIVOTS, len(x))))
    centers = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(6):
        near = _distances(x, centers).argmin(1)
        for c in range(k):
            if (near == c).any():
                centers[c] = x[near == c].mean(0)
    return centers


def _assigned(entries: DataFrame, pivots, width: int) -> DataFrame:
    """pivot and distance of each entry of (v, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column(0), width), pivots.value)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                names=["v", "ids", "pivot", "distance"],
            )

    return entries.select("v", "ids").mapInArrow(run, "v array<long>, ids array<long>, pivot int, distance double")


_BLOCK = (
    "block long, pivot int, low double, high double, norm double, n int, ids binary, counts binary, "
    "vectors binary"
)


def _blocks(assigned: DataFrame, width: int, size: int, by_pivot: bool) -> DataFrame:
    """Entries in order of pivot and distance, in blocks of at most `size`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0

        def block(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            x = np.zeros((len(rows), width), dtype=np.int64)
            for i, r in enumerate(rows):
                x[i, : len(r[0])] = r[0]
            norm = (x.astype(np.float64) ** 2).sum(1)
            ids = [np.array(r[1], dtype=np.int64) for r in rows]
            d = [r[3] for r in rows]
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([task + made - 1]),
                    "pivot": pa.array([rows[0][2]], pa.int32()),
                    "low": pa.array([min(d)]),
                    "high": pa.array([max(d)]),
                    "norm": pa.array([norm.max()]),
                    "n": pa.array([sum(map(len, ids))], pa.int32()),
                    "ids": pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                    "counts": pa.array([np.array([len(i) for i in ids], dtype=np.int64).tobytes()], pa.binary()),
                    "vectors": pa.array([_packed(x)], pa.binary()),
                }
            )

        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, group in groupby(rows, key=lambda r: r[2] if by_pivot else 0):
            part: list[tuple] = []
            for row in group:
                part.append(row)
                if len(part) == size:
                    yield block(part)
                    part = []
            if part:
                yield block(part)

    order = ["pivot", "distance", F.element_at("ids", 1)]
    return (
        assigned.repartitionByRange(partitions(assigned.sparkSession), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, _BLOCK)
    )


def _bounds(x: np.ndarray, meta: dict[str, np.ndarray], pivots: np.ndarray) -> np.ndarray:
    """Upper bound of each query's products in each annulus, with room for rounding."""
    d = _distances(x, pivots)[:, meta["pivot"]]
    apart = np.maximum(np.maximum(d - meta["high"][None, :], meta["low"][None, :] - d), 0)
    own = (x.astype(np.float64) ** 2).sum(1)[:, None]
    return (own + meta["norm"][None, :] - apart**2) / 2 + 1e-6 * (own + meta["norm"][None, :]) + 1


def _first(bounds: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """The annuli that the first round reads: those of highest bounds, until they hold k + 1 ids."""
    chosen = set()
    for order in np.argsort(-bounds, axis=1, kind="stable"):
        held = np.cumsum(n[order])
        chosen.update(order[: max(FIRST_BLOCKS, int(np.searchsorted(held, k + 1)) + 1)].tolist())
    return np.array(sorted(chosen), dtype=np.int64)


def _compared(pairs: DataFrame, index: DataFrame, queries: DataFrame, width: int, k: int) -> DataFrame:
    """q (block and row of the query), vec_id, score: the k + 1 best of each query in each annulus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query, ids, counts, theirs, mine, n = (batch.column(c)[i].as_py() for c in range(6))
                ids, counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64)
                scores = _products(_unpacked(mine, n, width), _unpacked(theirs, len(counts), width))
                entry = np.repeat(np.arange(len(counts)), counts)
                out: list[tuple] = []
                for r, s in enumerate(scores):
                    full = s[entry]
                    if len(full) > k + 1:
                        keep = np.flatnonzero(full >= np.partition(full, -(k + 1))[-(k + 1)])
                    else:
                        keep = np.arange(len(full))
                    keep = keep[np.lexsort((ids[keep], -full[keep]))][: k + 1]
                    out += [(query, r, int(ids[e]), int(full[e])) for e in keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["query", "row", "vec_id", "score"],
                )

    # the pairs carry the queries' vectors, which are fewer, to the annuli
    mine = queries.select(F.col("block").alias("query"), F.col("vectors").alias("mine"), F.col("n").alias("asking"))
    joined = pairs.join(mine, "query").join(index.select("block", "ids", "counts", "vectors"), "block")
    found = joined.select("query", "ids", "counts", "vectors", "mine", "asking").mapInArrow(run, "query long, row int, vec_id long, score long")
    return _best(found, k + 1)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each row where `is_query`
    (over vec_id) holds."""
    spark = vectors.sparkSession
    rows = saved(quantized(vectors, id, vector).distinct(), "vectors")
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = total["n"], max(1, total["width"] or 0)
    least = Window.partitionBy("v").orderBy("vec_id")
    entries = saved(
        rows.withColumn("at", F.row_number().over(least))
        .where(F.col("at") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "entries",
    )
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = spark.sparkContext.broadcast(_pivots(entries, width, n))
    size = max(block, -(-n // MAX_BLOCKS))
    index = saved(_blocks(saved(_assigned(entries, pivots, width), "assigned"), width, size, True), "annuli")

    asking = rows.where(is_query)
    distinct = asking.groupBy("v").agg(F.array(F.min("vec_id")).alias("ids"))
    queries = saved(
        _blocks(saved(_assigned(distinct, pivots, width), "asked"), width, QUERIES, False), "queries"
    )
    columns = index.select("block", "pivot", "low", "high", "norm", "n").toPandas()
    meta = spark.sparkContext.broadcast({c: columns[c].to_numpy() for c in columns})

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query, data, n = (batch.column(c)[i].as_py() for c in range(3))
                x = _unpacked(data, n, width)
                bounds = _bounds(x, meta.value, pivots.value)
                first = _first(bounds, meta.value["n"], k)
                chosen = first
                if batch.num_columns > 3:
                    known = np.full(len(x), -np.inf)
                    for s in batch.column(3)[i].as_py() or ():
                        known[s["row"]] = s["score"]
                    reach = (bounds >= known[:, None]).any(axis=0)
                    reach[first] = False
                    chosen = np.flatnonzero(reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(chosen), query)), pa.array(meta.value["block"][chosen])], names=["query", "block"]
                )

    asked = queries.select(F.col("block").alias("query"), "vectors", "n")
    first = saved(_compared(asked.mapInArrow(plan, "query long, block long"), index, queries, width, k), "first-round")
    reached = (
        first.where(F.col("rank") == k + 1)
        .groupBy("query")
        .agg(F.collect_list(F.struct("row", "score")).alias("known"))
    )
    rest = asked.join(reached, "query", "left").select("query", "vectors", "n", "known")
    second = _compared(rest.mapInArrow(plan, "query long, block long"), index, queries, width, k)
    best = _best(first.drop("rank").unionByName(second.drop("rank")), k + 1)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query = batch.column(0)[i].as_py()
                ids = np.frombuffer(batch.column(1)[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), query)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)],
                    names=["query", "row", "head"],
                )

    heads = queries.select(F.col("block").alias("query"), "ids").mapInArrow(unpack, "query long, row int, head long")
    lists = (
        best.groupBy("query", "row")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found"))
        .join(heads, ["query", "row"])
        .select("head", "found")
    )
    of = asking.select("v", F.col("vec_id").alias("query_id")).join(
        distinct.select("v", F.col("ids")[0].alias("head")), "v"
    )
    others = F.slice(F.filter("found", lambda c: c["vec_id"] != F.col("query_id")), 1, k)
    return (
        of.join(lists, "head")
        .select("query_id", F.posexplode(others).alias("at", "c"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.s")).alias("score"))
    )
