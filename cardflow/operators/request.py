"""Features of a scoring request from the card's state, without reading its history."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.arrays import (
    amount_at,
    count_at,
    count_between,
    total_amount,
    total_count,
)
from cardflow.functions.geo import haversine_km
from cardflow.operators.history import totals_before
from cardflow.operators.skew import DEFAULT, SkewPolicy, attach, hot_keys, split
from cardflow.schema import STATE_COLUMNS, WINDOWS

# A request scans the card's `recent` array, so a card is hot with fewer requests than rows.
SCANS_PER_ROW = 20
# Stands for everything older than `recent`; before any window of a request that can be answered.
FIRST_SECOND = -(10**12)

REQUEST_COLUMNS = [
    "card_id",
    "ts",
    "amount",
    "category",
    "gender",
    "birth_date",
    "home_lat",
    "home_lon",
    "merch_lat",
    "merch_lon",
    "city_pop",
]


def check_requests(requests: DataFrame) -> DataFrame:
    """`requests` plus `reject_reason`, null for a valid request: every field is present, and
    amount and city_pop are positive."""
    reason = F.lit(None).cast("string")
    for c in reversed(REQUEST_COLUMNS):
        reason = F.when(F.col(c).isNull(), F.lit(f"missing {c}")).otherwise(reason)
    for c in ("city_pop", "amount"):
        reason = F.when(F.col(c) <= 0, F.lit(f"{c} not positive")).otherwise(reason)
    return requests.withColumn("reject_reason", reason)


def request_features(
    requests: DataFrame,
    state: DataFrame,
    windows: Mapping[str, int] = WINDOWS,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """`requests` plus status, has_history and the history features.

    status is `new` for a card without state (zero counts, null amounts), `conflict` for a
    request older than the state, which already saw its future (all features null), else `ok`.
    A missing state table is an error of the read, never a table of new cards.
    """
    old = state.select("card_id", *[F.col(c).alias("_" + c) for c in STATE_COLUMNS[1:]])
    limits = replace(policy, hot_rows=policy.hot_rows // SCANS_PER_ROW)
    keys = hot_keys([requests], "card_id", limits)
    if keys is None:
        return _finish(_from_arrays(requests.join(old, "card_id", "left"), windows), requests, windows)
    cold, hot = split(requests, keys, "card_id")
    few = old.join(F.broadcast(keys), "card_id", "left_semi")
    parts = [
        _from_arrays(cold.join(old, "card_id", "left"), windows),
        attach(_from_totals(hot, few, windows), old.drop("_recent"), "card_id", keys, limits),
    ]
    return _finish(parts[0], requests, windows).unionByName(_finish(parts[1], requests, windows))


def _from_arrays(joined: DataFrame, windows: Mapping[str, int]) -> DataFrame:
    """Counts and amounts before the request by scanning the card's `recent`."""
    at, recent = F.col("epoch_s"), F.col("_recent")
    return joined.withColumns(
        {
            "_n": F.col("_n_total") - count_at(recent, at),
            "_before": F.col("_amount_total") - amount_at(recent, at),
            **{name: count_between(recent, at - s, at) for name, s in windows.items()},
        }
    )


def _from_totals(
    requests: DataFrame, old: DataFrame, windows: Mapping[str, int]
) -> DataFrame:
    """The same for cards with so many requests that a scan each would be too much: the seconds
    of the state become rows, and the requests' seconds are looked up among them."""
    older = F.struct(
        F.lit(FIRST_SECOND).cast("long").alias("epoch_s"),
        (F.col("_n_total") - total_count(F.col("_recent"))).alias("n"),
        (F.col("_amount_total") - total_amount(F.col("_recent"))).alias("amount"),
    )
    nowhere = "struct<epoch_s: bigint, merch_lat: double, merch_lon: double>"
    data = (
        old.select("card_id", F.explode(F.concat(F.array(older), F.col("_recent"))).alias("_r"))
        .where(F.col("_r.n") > 0)
        .select(
            "card_id",
            "_r.epoch_s",
            F.col("_r.n").alias("_w"),
            "_r.amount",
            F.lit(None).cast(nowhere).alias("_here"),
        )
    )
    asked = requests.select("card_id", "epoch_s").distinct()
    totals = totals_before(data, asked, windows).select(
        "card_id", "epoch_s", "_n", F.col("prior_amount").alias("_before"), *windows
    )
    return requests.join(totals, ["card_id", "epoch_s"], "left")


def _finish(
    df: DataFrame, requests: DataFrame, windows: Mapping[str, int]
) -> DataFrame:
    at = F.col("epoch_s")
    known = F.col("_last_epoch").isNotNull()
    gap = at - F.col("_last_epoch")
    status = F.when(~known, "new").when(gap < 0, "conflict").otherwise("ok")
    df = df.withColumns(
        {
            "status": status,
            "has_history": known,
            "_km": haversine_km(
                F.col("_last_lat"), F.col("_last_lon"), F.col("merch_lat"), F.col("merch_lon")
            ),
        }
    )
    usable = F.col("status") != "conflict"
    some = usable & (F.col("_n") > 0)
    seen = F.coalesce(F.array_contains("_categories_seen", F.col("category")), F.lit(False))
    features = {
        **{
            name: F.when(usable, F.coalesce(F.col(name), F.lit(0).cast("long")))
            for name in windows
        },
        "prior_amount": F.when(some, F.col("_before")),
        "amount_ratio": F.when(some, F.try_divide("amount", F.try_divide("_before", "_n"))),
        "is_new_category": F.when(usable, ~seen),
        "prev_distance_km": F.when(usable, F.col("_km")),
        "implied_speed_kmh": F.when(
            usable & (gap > 0), F.try_divide(F.col("_km"), gap / F.lit(3600.0))
        ),
    }
    return df.select(
        *requests.columns,
        "status",
        "has_history",
        *[column.alias(name) for name, column in features.items()],
    )
