"""Point-in-time history features of every transaction.

A transaction sees only strictly earlier seconds of its card in the counts and amounts. The
first-category flag and the distance to the previous transaction follow the order
(epoch_s, tx_id), in which transactions of the same second do see each other.

Rows may carry a weight (how many transactions they stand for), which lets a card state be put
in front of new transactions as a few rows.

Rows without a card or a time have no place in a history: their counts are 0, nothing is new to them
and their other features are null, and no other row sees them. A missing amount counts as a
transaction, but neither in sums nor in the mean. A missing category is a category of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.geo import haversine_km
from cardflow.functions.literals import longs
from cardflow.operators.skew import DEFAULT, SkewPolicy, by_skew
from cardflow.schema import WINDOWS

HOT_SEGMENT_S = 3600


def history_features(
    tx: DataFrame,
    windows: Mapping[str, int] = WINDOWS,
    policy: SkewPolicy = DEFAULT,
    weight: str | None = None,
) -> DataFrame:
    """`tx` plus one count per window, prior_amount, amount_ratio, is_new_category,
    prev_distance_km and implied_speed_kmh.

    Needs card_id, epoch_s, tx_id (unique within a card), category, amount, merch_lat and
    merch_lon. Ordinary cards take one shuffle by card; see `_hot` for cards too large for that.
    """
    rows = tx.withColumn("_w", F.col(weight) if weight else F.lit(1).cast("long"))
    rows = rows.withColumn("_a", F.when(F.col("amount").isNotNull(), F.col("_w")))
    placed, outside = _placed(rows)
    counts = {name: F.lit(0).cast("long") for name in windows}
    nothing = {
        **{name: F.lit(None).cast("double") for name in _outputs({})},
        "is_new_category": F.lit(False),
    }
    return by_skew(
        [placed],
        "card_id",
        policy,
        lambda t: _finish(_ordinary(t, windows), windows).select(
            *tx.columns, *_outputs(windows)
        ),
        lambda t: _finish(_hot(t, windows), windows).select(*tx.columns, *_outputs(windows)),
        # The range frames of the ordinary way visit every row in the window of every row.
        time="epoch_s",
        window=max(windows.values(), default=0),
    ).unionByName(outside.withColumns({**counts, **nothing}).select(*tx.columns, *_outputs(windows)))


def _placed(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a card and a time, the others)."""
    known = F.col("card_id").isNotNull() & F.col("epoch_s").isNotNull()
    return tx.where(known), tx.where(~known)


def _outputs(windows: Mapping[str, int]) -> list[str]:
    return [
        *windows,
        "prior_amount",
        "amount_ratio",
        "is_new_category",
        "prev_distance_km",
        "implied_speed_kmh",
    ]


def _place() -> Column:
    return F.struct("epoch_s", "merch_lat", "merch_lon")


def _ordinary(tx: DataFrame, windows: Mapping[str, int]) -> DataFrame:
    """One exchange and two sorts. The lag and the range frames share the sort by
    (card, epoch, id); the (card, category) window comes last, so that the exchange by card,
    which also clusters (card, category), is already there."""
    by_category = Window.partitionBy("card_id", "category").orderBy("epoch_s", "tx_id")
    in_order = Window.partitionBy("card_id").orderBy("epoch_s", "tx_id")
    by_time = Window.partitionBy("card_id").orderBy("epoch_s")
    before = by_time.rangeBetween(Window.unboundedPreceding, -1)
    return (
        tx.withColumn("_prev", F.lag(_place()).over(in_order))
        .withColumns(
            {
                "_n": F.sum("_a").over(before),
                "prior_amount": F.sum("amount").over(before),
                **{
                    name: F.coalesce(
                        F.sum("_w").over(by_time.rangeBetween(-seconds, -1)),
                        F.lit(0).cast("long"),
                    )
                    for name, seconds in windows.items()
                },
            }
        )
        .withColumn("is_new_category", F.row_number().over(by_category) == 1)
    )


def _hot(tx: DataFrame, windows: Mapping[str, int]) -> DataFrame:
    """The same columns with no group larger than a card's second or a short time segment.

    A card's seconds are summed first (combined before the shuffle); `totals_before` gives each
    second its counts and amounts, and the rows join their second by (card, second).
    """
    seconds = tx.groupBy("card_id", "epoch_s").agg(
        F.sum("_w").alias("_w"),
        F.sum("_a").alias("_a"),
        F.sum("amount").alias("amount"),
        F.max(F.struct("tx_id", "merch_lat", "merch_lon")).alias("_end"),
    )
    data = seconds.select(
        "card_id",
        "epoch_s",
        "_w",
        "_a",
        "amount",
        F.struct("epoch_s", "_end.merch_lat", "_end.merch_lon").alias("_here"),
    )
    per_second = totals_before(data, seconds.select("card_id", "epoch_s"), windows)
    # A second holds at most one first transaction per category.
    firsts = (
        tx.groupBy("card_id", "category")
        .agg(F.min(F.struct("epoch_s", "tx_id")).alias("_f"))
        .groupBy("card_id", F.col("_f.epoch_s").alias("epoch_s"))
        .agg(F.collect_set("_f.tx_id").alias("_firsts"))
    )
    same_second = Window.partitionBy("card_id", "epoch_s").orderBy("tx_id")
    return (
        tx.join(per_second.join(firsts, ["card_id", "epoch_s"], "left"), ["card_id", "epoch_s"])
        .withColumn("_prev", F.coalesce(F.lag(_place()).over(same_second), "_before"))
        .withColumn(
            "is_new_category",
            F.coalesce(F.array_contains("_firsts", F.col("tx_id")), F.lit(False)),
        )
    )


def totals_before(
    data: DataFrame, asked: DataFrame, windows: Mapping[str, int]
) -> DataFrame:
    """For every asked (card_id, epoch_s): the count in each window before it, `prior_amount` of
    everything before it and the count `_n` of amounts in it, and `_before`, the place of the last
    second before.

    `data` has one row per card and second: card_id, epoch_s, _w, amount, _here, and `_a`, the
    count of amounts, where some may be missing. `asked` is distinct. A window's count is the difference of two running totals "before time x", at the
    asked second and at the window's lower edge. Running totals are taken inside
    (card, segment) and raised by the totals of the card's earlier segments, so no group grows
    with the card's history beyond one row per segment.
    """
    if "_a" not in data.columns:
        data = data.withColumn("_a", F.col("_w"))
    offsets = longs([0, *windows.values()])
    probes = asked.select(
        "card_id",
        F.col("epoch_s").alias("_source"),
        F.posexplode(offsets).alias("_kind", "_offset"),
    ).select("card_id", "_source", "_kind", (F.col("_source") - F.col("_offset")).alias("_at"))
    points = (
        data.select("card_id", F.col("epoch_s").alias("_at"), "_w", "_a", "amount", "_here")
        .unionByName(probes, allowMissingColumns=True)
        .withColumn("_segment", F.floor(F.col("_at") / HOT_SEGMENT_S))
    )
    earlier = (
        Window.partitionBy("card_id")
        .orderBy("_segment")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        points.groupBy("card_id", "_segment")
        .agg(
            F.sum("_w").alias("_w"),
            F.sum("_a").alias("_a"),
            F.sum("amount").alias("amount"),
            # Numbers, unlike structs, keep this a hash aggregate.
            F.max("_here.epoch_s").alias("epoch_s"),
            F.max_by("_here.merch_lat", "_here.epoch_s").alias("merch_lat"),
            F.max_by("_here.merch_lon", "_here.epoch_s").alias("merch_lon"),
        )
        .withColumn("_here", F.when(F.col("epoch_s").isNotNull(), _place()))
        .select(
            "card_id",
            "_segment",
            F.sum("_w").over(earlier).alias("_w0"),
            F.sum("_a").over(earlier).alias("_a0"),
            F.sum("amount").over(earlier).alias("_amount0"),
            F.last("_here", ignorenulls=True).over(earlier).alias("_here0"),
        )
    )
    before = (
        Window.partitionBy("card_id", "_segment")
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    totals = (
        points.withColumns(
            {
                "_w1": F.sum("_w").over(before),
                "_a1": F.sum("_a").over(before),
                "_amount1": F.sum("amount").over(before),
                "_here1": F.last("_here", ignorenulls=True).over(before),
            }
        )
        .where(F.col("_kind").isNotNull())
        .join(carried, ["card_id", "_segment"])
        .withColumns(
            {
                "_n": F.coalesce("_w0", zero) + F.coalesce("_w1", zero),
                "_with": F.coalesce("_a0", zero) + F.coalesce("_a1", zero),
                "_sum": F.coalesce("_amount0", F.lit(0.0)) + F.coalesce("_amount1", F.lit(0.0)),
                "_here": F.coalesce("_here1", "_here0"),
            }
        )
    )

    def at(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col(column)))

    place = ["epoch_s", "merch_lat", "merch_lon"]
    return (
        totals.groupBy("card_id", F.col("_source").alias("epoch_s"))
        .agg(
            at(0, "_with").alias("_n"),
            at(0, "_sum").alias("_sum"),
            *[at(0, f"_here.{c}").alias(f"_p_{c}") for c in place],
            *[(at(0, "_n") - at(i, "_n")).alias(name) for i, name in enumerate(windows, 1)],
        )
        .select(
            "card_id",
            "epoch_s",
            "_n",
            F.when(F.col("_n") > 0, F.col("_sum")).alias("prior_amount"),
            F.when(
                F.col("_p_epoch_s").isNotNull(),
                F.struct(*[F.col(f"_p_{c}").alias(c) for c in place]),
            ).alias("_before"),
            *windows,
        )
    )


def _finish(df: DataFrame, windows: Mapping[str, int]) -> DataFrame:
    gap = F.col("epoch_s") - F.col("_prev.epoch_s")
    return df.withColumns(
        {
            "amount_ratio": F.try_divide("amount", F.try_divide("prior_amount", "_n")),
            "prev_distance_km": haversine_km(
                F.col("_prev.merch_lat"),
                F.col("_prev.merch_lon"),
                F.col("merch_lat"),
                F.col("merch_lon"),
            ),
        }
    ).withColumn(
        "implied_speed_kmh",
        F.when(gap > 0, F.try_divide(F.col("prev_distance_km"), gap / F.lit(3600.0))),
    )


def first_per_card(tx: DataFrame, k: int = 1) -> DataFrame:
    """First k transactions of each card. Spark keeps at most k rows per card and task before
    the shuffle, so a large card costs no more than a small one."""
    order = Window.partitionBy("card_id").orderBy("epoch_s", "tx_id")
    return tx.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop(
        "_rank"
    )


def position_in_card(tx: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """`tx` plus `position`: how many transactions of the card come before it, from 0. Null for a
    row without a card or a time."""
    tx, outside = _placed(tx)

    def ordinary(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("card_id").orderBy("epoch_s", "tx_id")
        return rows.withColumn("position", F.row_number().over(order).cast("long") - 1)

    def hot(rows: DataFrame) -> DataFrame:
        seconds = rows.groupBy("card_id", "epoch_s").agg(F.count("*").alias("_n"))
        seconds = seconds.withColumn("_segment", F.floor(F.col("epoch_s") / HOT_SEGMENT_S))
        earlier = Window.partitionBy("card_id").orderBy("_segment")
        inside = Window.partitionBy("card_id", "_segment").orderBy("epoch_s")
        frame = (Window.unboundedPreceding, -1)
        carried = (
            seconds.groupBy("card_id", "_segment")
            .agg(F.sum("_n").alias("_n"))
            .select(
                "card_id", "_segment", F.sum("_n").over(earlier.rowsBetween(*frame)).alias("_n0")
            )
        )
        starts = (
            seconds.withColumn("_n1", F.sum("_n").over(inside.rowsBetween(*frame)))
            .join(carried, ["card_id", "_segment"])
            .select(
                "card_id",
                "epoch_s",
                (
                    F.coalesce("_n0", F.lit(0).cast("long"))
                    + F.coalesce("_n1", F.lit(0).cast("long"))
                ).alias("_start"),
            )
        )
        in_second = Window.partitionBy("card_id", "epoch_s").orderBy("tx_id")
        return (
            rows.join(starts, ["card_id", "epoch_s"])
            .withColumn("position", F.col("_start") + F.row_number().over(in_second) - 1)
            .select(*rows.columns, "position")
        )

    done = by_skew([tx], "card_id", policy, ordinary, hot)
    missing = outside.withColumn("position", F.lit(None).cast("long"))
    return done.unionByName(missing).select(*tx.columns, "position")
