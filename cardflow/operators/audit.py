"""Cell-by-cell comparison of two tables that should agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.compare import same_value
from cardflow.schema import HISTORY_FEATURES, STATE_COLUMNS


def parity(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], rel: float = 1e-9
) -> DataFrame:
    """One row per column: rows on both sides, rows missing on either, differing cells, and
    whether the left column varies (more than two values), as a column that never varies
    proves nothing.

    One full join on `keys`, which should be unique. Counting distinct values is approximate;
    at the few values that matter here the sketch is exact in practice.
    """
    a = left.select(*keys, F.lit(True).alias("_a"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b = right.select(*keys, F.lit(True).alias("_b"), *[F.col(c).alias(f"b_{c}") for c in columns])
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    types = {f.name: f.dataType for f in left.schema}
    sums = a.join(b, keys, "full").agg(
        F.count(F.when(both, 1)).alias("rows"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("missing_left"),
        F.count(F.when(F.col("_b").isNull(), 1)).alias("missing_right"),
        *[
            F.count(
                F.when(both & ~same_value(F.col(f"a_{c}"), F.col(f"b_{c}"), types[c], rel), 1)
            ).alias(f"d_{c}")
            for c in columns
        ],
        *[
            (F.approx_count_distinct(F.when(F.col(f"a_{c}").isNotNull(), F.xxhash64(f"a_{c}"))) > 2).alias(f"v_{c}")
            for c in columns
        ],
    )
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"d_{c}").alias("different"),
                    F.col(f"v_{c}").alias("varies"),
                )
                for c in columns
            ]
        )
    )
    return sums.select("rows", "missing_left", "missing_right", cells.alias("_c")).select(
        "_c.column", "rows", "missing_left", "missing_right", "_c.different", "_c.varies"
    )


def feature_parity(
    left: DataFrame,
    right: DataFrame,
    keys: tuple[str, ...] = ("card_id", "tx_id"),
    columns: list[str] = HISTORY_FEATURES,
) -> DataFrame:
    """Features of two paths, by transaction."""
    return parity(left, right, list(keys), columns)


def state_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """States of two paths, by card. The amounts inside `recent` are compared second by second at
    the tolerance, its seconds and counts exactly."""
    flat = [
        df.select(
            *[c for c in STATE_COLUMNS if c != "recent"],
            F.transform("recent", lambda r: F.struct(r["epoch_s"], r["n"])).alias("recent_seconds"),
            F.transform("recent", lambda r: r["amount"]).alias("recent_amount"),
        )
        for df in (left, right)
    ]
    columns = [c for c in flat[0].columns if c != "card_id"]
    return parity(*flat, ["card_id"], columns)


def all_agree(report: DataFrame) -> DataFrame:
    """One row: True if nothing is missing or different and every column varies."""
    wrong = (
        (F.col("different") > 0)
        | (F.col("missing_left") > 0)
        | (F.col("missing_right") > 0)
        | ~F.col("varies")
    )
    return report.agg((F.count(F.when(wrong, 1)) == 0).alias("agree"))
