"""Running totals, exact quantiles and numbers of a whole table, without sorting it in one task and
without a group that grows with it.

Asked ranks are found by counting passes: each cuts the ranges that still hold an asked rank into
smaller ones, counts them, and keeps those with an asked rank, until a range is one value or short.
No row moves in such a pass. Running totals and numbers put every row into one of as many short
ranges as it takes; totals of ranges, and of blocks of ranges, give each its starting point.
"""

from __future__ import annotations

import bisect
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.literals import doubles, longs, numbered
from cardflow.plans.workspace import written

ROWS_PER_RANGE = 100_000
#: Cuts of one counting pass, over all ranges that still hold an asked rank.
CUTS = 4096

Interval = tuple[float, float, int]  # from, below which, and rows before


def _levels(n: int) -> Column:
    return doubles([i / n for i in range(1, n)])


def _bucket(rows: DataFrame, value: str, splits: list[float], name: str) -> DataFrame:
    """`rows` plus the number of the interval [splits[k - 1], splits[k]) of each value, 0 below all."""
    return Bucketizer(
        splits=[float("-inf"), *splits, float("inf")], inputCol=value, outputCol=name
    ).transform(rows).withColumn(name, F.col(name).cast("int"))


def _within(rows: DataFrame, intervals: list[Interval]) -> DataFrame:
    """Rows of the intervals, which are apart and in order, with `_k`, the interval's number."""
    edges = sorted({e for low, high, _ in intervals for e in (low, high) if not math.isinf(e)})
    if not edges:
        return rows.withColumn("_k", F.lit(0))
    number = {low: k for k, (low, _, _) in enumerate(intervals)}
    at = longs([number.get(e, -1) for e in [float("-inf"), *edges]])
    found = _bucket(rows, "_v", edges, "_edge")
    return (
        found.withColumn("_k", F.element_at(at, F.col("_edge") + 1).cast("int"))
        .where(F.col("_k") >= 0)
        .drop("_edge")
    )


def _narrowed(rows: DataFrame, wide: list[Interval], ranks: list[int]) -> list[Interval]:
    """Parts of the intervals that hold an asked rank. A cut value is a part of its own, so that one
    frequent value cannot keep a part from shrinking."""
    fan = max(16, CUTS // len(wide))
    cut = _within(rows, wide).groupBy("_k").agg(F.percentile_approx("_v", _levels(fan), 4 * fan))
    inner = {e for r in cut.collect() for c in r[1] for e in (c, math.nextafter(c, math.inf))}
    outer = {e for low, high, _ in wide for e in (low, high)}
    edges = sorted(e for e in inner | outer if not math.isinf(e))
    counted = _bucket(_within(rows, wide), "_v", edges, "_part").groupBy("_part").count().collect()
    rows_of = dict(counted)
    bounds = [float("-inf"), *edges, float("inf")]
    out, k = [], 0
    before = wide[0][2]
    for part, (low, high) in enumerate(zip(bounds, bounds[1:])):
        while k < len(wide) and low >= wide[k][1]:
            k += 1
        if k == len(wide):
            break
        if low < wide[k][0]:
            continue
        if low == wide[k][0]:
            before = wide[k][2]
        n = rows_of.get(part, 0)
        if bisect.bisect_left(ranks, before) < bisect.bisect_left(ranks, before + n):
            out.append((low, high, before, n))
        before += n
    return out


def values_at(df: DataFrame, value: str, ranks: list[int] | None = None, levels: list[float] | None = None, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Values at the given ranks from 0 in ascending order, nulls left out; or exact quantiles with
    linear interpolation between neighbours. Empty if there are no values. Infinite values come at
    their ends, then values that are no number."""
    v = F.col(value).cast("double") + F.lit(0.0)  # one zero
    rows = df.where(F.col(value).isNotNull()).select(v.alias("_v"))
    infinite = F.lit(float("inf"))
    total, low, high, odd = rows.agg(
        F.count("*"),
        F.count(F.when(F.col("_v") == -infinite, 1)),
        F.count(F.when(F.col("_v") == infinite, 1)),
        F.count(F.when(F.isnan("_v"), 1)),
    ).first()
    if not total:
        return []
    positions = [level * (total - 1) for level in levels or []]
    if levels is not None:
        ranks = [r for p in positions for r in (int(p), min(int(p) + 1, total - 1))]
    finite = total - low - high - odd
    found: dict[int, float] = {}
    asked = []
    for r in sorted(set(ranks or [])):
        if low <= r < low + finite:
            asked.append(r - low)
        else:
            found[r] = float("-inf") if r < low else float("inf") if r < total - odd else float("nan")
    rows = rows.where(~F.isnan("_v") & (F.abs("_v") < infinite))
    wide: list[Interval] = [(float("-inf"), float("inf"), 0)] if asked else []
    short: list[Interval] = []
    rows_of_wide = finite
    while wide and rows_of_wide > rows_per_range:
        parts = _narrowed(rows, wide, asked)
        wide = []
        rows_of_wide = 0
        for a, b, before, n in parts:
            if b == math.nextafter(a, math.inf):
                for i in range(bisect.bisect_left(asked, before), bisect.bisect_left(asked, before + n)):
                    found[asked[i] + low] = a
            elif n <= rows_per_range:
                short.append((a, b, before))
            else:
                wide.append((a, b, before))
                rows_of_wide = max(rows_of_wide, n)
    short = sorted(short + wide)
    if short:
        here = longs([before for _, _, before in short])
        upto = Window.partitionBy("_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        last = F.element_at(here, F.col("_k") + 1) + F.sum("_n").over(upto)
        counts = _within(rows, short).groupBy("_k", "_v").agg(F.count("*").alias("_n"))
        held = counts.select("_v", "_n", last.alias("_last")).select(
            "_v",
            F.explode(
                F.filter(longs(asked), lambda r: (r < F.col("_last")) & (r >= F.col("_last") - F.col("_n")))
            ).alias("_rank"),
        )
        for r in held.collect():
            found[r["_rank"] + low] = r["_v"]
    if levels is None:
        return [found[r] for r in ranks or []]
    out = []
    for p in positions:
        a, b = found[int(p)], found[min(int(p) + 1, total - 1)]
        out.append(a if a == b else a + (b - a) * (p - int(p)))
    return out


def quantiles(
    df: DataFrame, value: str, levels: list[float], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours: rows (i, level, value),
    i counting from 1. Nulls are left out."""
    found = values_at(df, value, levels=levels, rows_per_range=rows_per_range)
    if not found:
        return df.sparkSession.createDataFrame([], "i int, level double, value double")
    special = {"inf": "Infinity", "-inf": "-Infinity", "nan": "NaN"}
    texts = ", ".join(f"double('{special.get(repr(v), repr(v))}')" for v in found)
    return numbered(df.sparkSession, levels, "level").withColumn(
        "value", F.element_at(F.expr(f"array({texts})"), F.col("i"))
    )


def ranged(values: DataFrame, by: str, rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, int]:
    """`values`, one row per value of `by`, with `_range`: numbers, in the order of `by`, of ranges of
    at most `rows_per_range` rows; and how many there are. Written to the shared folder, so that all
    that is computed from it sees the same ranges."""
    values = written(values, "values")
    rows = values.count()
    if rows <= rows_per_range:
        return values.withColumn("_range", F.lit(0)), 1
    spare = 2
    while True:  # cuts come from a sample, so a range may be too long; more ranges are shorter
        n = min(rows, -(-spare * rows // rows_per_range))
        cut = values.repartitionByRange(n, by).withColumn("_range", F.spark_partition_id())
        cut = written(cut, "ranges")
        longest = cut.groupBy("_range").count().agg(F.max("count")).first()[0]
        if longest <= rows_per_range or n == rows:
            return cut, n
        spare *= 2


def _starts(
    totals: DataFrame, measures: list[str], n: int, most: int, descending: bool
) -> DataFrame:
    """For each of at most `n` ranges with their totals: _start_<m>, the totals of all before it. No
    window holds more than `most` ranges: blocks of ranges carry theirs over in the same way."""
    order = F.desc("_range") if descending else F.asc("_range")
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"_start_{m}": F.coalesce(F.sum(m).over(before.partitionBy("_block")), F.lit(0)) for m in measures}
    if n <= most:
        return totals.withColumn("_block", F.lit(0)).select("_range", *[c.alias(k) for k, c in sums.items()])
    blocked = totals.withColumn("_block", F.floor(F.col("_range") / most).cast("int"))
    blocks = blocked.groupBy(F.col("_block").alias("_range")).agg(*[F.sum(m).alias(m) for m in measures])
    carried = _starts(blocks, measures, -(-n // most), most, descending).select(
        F.col("_range").alias("_block"), *[F.col(k).alias("_b" + k) for k in sums]
    )
    return (
        blocked.select("_range", "_block", *[c.alias(k) for k, c in sums.items()])
        .join(carried, "_block")
        .select("_range", *[(F.col(k) + F.col("_b" + k)).alias(k) for k in sums])
    )


def running_totals(
    values: DataFrame,
    value: str,
    measures: list[str],
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Adds `cum_<m>` for every measure: its total up to and including the row's value.

    `values` holds one row per value (aggregate first).
    """
    cut, n = ranged(values, value, rows_per_range)
    sign = F.desc if descending else F.asc
    totals = cut.groupBy("_range").agg(*[F.sum(m).alias(m) for m in measures])
    starts = _starts(totals, measures, n, max(2, rows_per_range), descending)
    inside = (
        Window.partitionBy("_range")
        .orderBy(sign(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.withColumns({f"_cum_{m}": F.sum(m).over(inside) for m in measures})
        .join(starts, "_range")
        .select(
            *values.columns,
            *[(F.col(f"_start_{m}") + F.col(f"_cum_{m}")).alias(f"cum_{m}") for m in measures],
        )
    )


def number_values(
    df: DataFrame, column: str, name: str = "index", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Distinct non-null texts numbered from 1 in byte order, whatever beginnings they share."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    cut, n = ranged(values, column, rows_per_range)
    totals = cut.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = _starts(totals, ["_n"], n, max(2, rows_per_range), False)
    inside = Window.partitionBy("_range").orderBy(column)
    return (
        cut.withColumn("_i", F.row_number().over(inside))
        .join(starts, "_range")
        .select(column, (F.col("_start__n") + F.col("_i")).cast("int").alias(name))
    )
