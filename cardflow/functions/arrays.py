"""Expressions over the per-second array `recent` of a card state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_between(recent: Column, low: Column, high: Column) -> Column:
    """Transactions with low <= epoch_s < high; 0 for a null array."""
    kept = F.filter(recent, lambda r: (r["epoch_s"] >= low) & (r["epoch_s"] < high))
    return F.coalesce(F.aggregate(kept, F.lit(0).cast("long"), lambda a, r: a + r["n"]), F.lit(0))


def count_at(recent: Column, epoch: Column) -> Column:
    return count_between(recent, epoch, epoch + 1)


def amount_at(recent: Column, epoch: Column) -> Column:
    """Amount spent in one second; 0 for a null array."""
    kept = F.filter(recent, lambda r: r["epoch_s"] == epoch)
    total = F.aggregate(kept, F.lit(0.0), lambda a, r: a + r["amount"])
    return F.coalesce(total, F.lit(0.0))


def total_count(recent: Column) -> Column:
    return F.aggregate(recent, F.lit(0).cast("long"), lambda a, r: a + r["n"])


def total_amount(recent: Column) -> Column:
    return F.aggregate(recent, F.lit(0.0), lambda a, r: a + r["amount"])


def keep_since(recent: Column, epoch: Column) -> Column:
    return F.filter(recent, lambda r: r["epoch_s"] >= epoch)


def append_seconds(older: Column, newer: Column) -> Column:
    """Joins two arrays in time order; only the seam can share a second, and is merged."""
    last, first = F.element_at(older, -1), F.element_at(newer, 1)
    seam = F.array(
        F.struct(
            last["epoch_s"].alias("epoch_s"),
            (last["n"] + first["n"]).alias("n"),
            (last["amount"] + first["amount"]).alias("amount"),
        )
    )
    merged = F.concat(
        F.slice(older, F.lit(1), F.greatest(F.size(older) - 1, F.lit(0))),
        seam,
        F.slice(newer, F.lit(2), F.greatest(F.size(newer) - 1, F.lit(0))),
    )
    shares = (F.size(older) > 0) & (F.size(newer) > 0) & (last["epoch_s"] == first["epoch_s"])
    return F.when(older.isNull(), newer).when(shares, merged).otherwise(F.concat(older, newer))


def insert_sorted(seen: Column, new: Column) -> Column:
    """Sorted union of two string sets; a null set counts as empty."""
    return F.when(seen.isNull(), new).otherwise(F.array_sort(F.array_union(seen, new)))
