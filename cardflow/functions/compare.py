"""Null-aware comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def same_value(a: Column, b: Column, data_type: T.DataType, rel: float = 1e-9) -> Column:
    """True if both are null, equal, or floating values within a relative tolerance; arrays of
    floating values are compared entry by entry."""
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, (T.DoubleType, T.FloatType)):
        pairs = F.zip_with(a, b, lambda x, y: same_value(x, y, data_type.elementType, rel))
        close = (F.size(a) == F.size(b)) & F.forall(pairs, lambda p: p)
        return (a.isNull() & b.isNull()) | F.coalesce(close, F.lit(False))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        close = F.abs(a - b) <= F.lit(rel) * F.greatest(F.abs(a), F.abs(b))
        return F.coalesce(a.eqNullSafe(b) | close, F.lit(False))
    return a.eqNullSafe(b)


def is_later(epoch: Column, tx_id: Column, last_epoch: Column, last_tx_id: Column) -> Column:
    """(epoch, tx_id) strictly after the last pair; a null pair is before everything."""
    return (
        last_epoch.isNull()
        | (epoch > last_epoch)
        | ((epoch == last_epoch) & (tx_id > last_tx_id))
    )
