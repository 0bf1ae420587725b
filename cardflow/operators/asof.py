"""Point-in-time join: the latest feature row that an entity row could have known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardflow.operators.skew import DEFAULT, SkewPolicy, by_skew

HOT_SEGMENT_S = 60
#: Segments of a block, over a day of minutes: ten years are 2,567 blocks.
BLOCK = 2048


def asof_join(
    left: DataFrame,
    right: DataFrame,
    columns: list[str],
    key: str = "card_id",
    left_ts: str = "ts",
    right_ts: str = "ts",
    tie: str = "tx_id",
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Every row of `left` with `columns` of the right row of its key with the greatest
    right_ts <= left_ts; nulls if there is none.

    If several right rows share that time, the one whose `tie` equals the left row's wins when
    its time is the left row's own, else the one with the largest `tie`. If `left` has no `tie`
    column only the second rule applies. Keys above the row limit of `policy` are matched by
    (key, time segment) instead of in one window; the result is the same. Left rows without a key
    or a time match nothing and are not moved.
    """
    known = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    left, outside = left.where(known), left.where(~known)
    own = F.col(tie) if tie in left.columns else F.lit(None)
    tie_type = right.schema[tie].dataType
    lefts = left.select(
        F.col(key).alias("_key"),
        F.col(left_ts).alias("_ts"),
        own.cast(tie_type).alias("_tie"),
        F.struct(*left.columns).alias("_left"),
    )
    rights = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(right_ts).alias("_ts"),
        F.col(tie).alias("_tie"),
        F.struct(*columns).alias("_right"),
    )
    matched = by_skew([lefts, rights], "_key", policy, _ordinary, _hot)
    found = matched.select("_left.*", *[F.col("_match")[c].alias(c) for c in columns])
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]
    return found.union(outside.select(*[outside[c] for c in outside.columns], *nothing))


def _ordinary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One exchange and one sort by (key, ts, tie): the exact match is a maximum over
    (key, ts, tie), the latest row a running maximum by (key, ts) that includes equal times."""
    both = left.withColumn("_right", F.lit(None).cast(right.schema["_right"].dataType)).unionByName(
        right.withColumn("_left", F.lit(None).cast(left.schema["_left"].dataType))
    )
    same = Window.partitionBy("_key", "_ts", "_tie")
    until = (
        Window.partitionBy("_key")
        .orderBy("_ts")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    candidate = F.when(F.col("_right").isNotNull(), F.struct("_ts", "_tie", "_right"))
    return (
        both.repartition("_key")
        .withColumn("_exact", F.when(F.col("_tie").isNotNull(), F.max("_right").over(same)))
        .withColumn("_latest", F.max(candidate).over(until))
        .where(F.col("_left").isNotNull())
        .select(
            "_left",
            F.coalesce("_exact", "_latest._right").alias("_match"),
        )
    )


def _hot(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct times of the left side meet the best right row of each time inside
    (key, segment). The last right row of earlier segments is carried in, from the same block of
    segments or else from earlier blocks, so no window holds more than a block's segments or a
    key's blocks."""
    best = right.groupBy("_key", "_ts").agg(F.max(F.struct("_tie", "_right")).alias("_b"))
    candidate = F.struct("_ts", "_b")
    points = (
        best.select("_key", "_ts", candidate.alias("_c"))
        .unionByName(
            left.select("_key", "_ts").distinct(), allowMissingColumns=True
        )
        .withColumn(
            "_segment",
            F.floor(F.unix_micros(F.col("_ts").cast("timestamp")) / (HOT_SEGMENT_S * 1_000_000)),
        )
    )
    frame = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("_key", "_block").orderBy("_segment").rowsBetween(*frame)
    of_blocks = Window.partitionBy("_key").orderBy("_block").rowsBetween(*frame)
    segments = (
        points.groupBy("_key", "_segment")
        .agg(F.max("_c").alias("_c"))
        .withColumn("_block", F.floor(F.col("_segment") / BLOCK))
    )
    blocks = (
        segments.groupBy("_key", "_block")
        .agg(F.max("_c").alias("_c"))
        .select("_key", "_block", F.last("_c", ignorenulls=True).over(of_blocks).alias("_c2"))
    )
    carried = (
        segments.withColumn("_c1", F.last("_c", ignorenulls=True).over(in_block))
        .join(blocks, ["_key", "_block"])
        .select("_key", "_segment", F.coalesce("_c1", "_c2").alias("_c0"))
    )
    until = (
        Window.partitionBy("_key", "_segment")
        .orderBy("_ts")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_time = (
        points.withColumn("_c1", F.max("_c").over(until))
        .join(carried, ["_key", "_segment"])
        .groupBy("_key", "_ts")
        .agg(F.max(F.coalesce("_c1", "_c0")).alias("_latest"))
    )
    exact = right.groupBy("_key", "_ts", "_tie").agg(F.max("_right").alias("_exact"))
    return (
        left.join(per_time, ["_key", "_ts"], "left")
        .join(exact, ["_key", "_ts", "_tie"], "left")
        .select("_left", F.coalesce("_exact", "_latest._b._right").alias("_match"))
    )
