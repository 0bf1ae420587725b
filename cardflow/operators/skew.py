"""Keys that hold too many rows for one task.

Per-key windows put a whole key in one task. Operators built on them therefore take the keys
above a row limit out and compute those by (key, time segment) instead; both ways are exact, so
where the limit lies only affects speed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.plans.workspace import written


@dataclass(frozen=True)
class SkewPolicy:
    """A key is hot above `hot_rows` rows, or above `hot_steps` steps where the work of a row grows
    with the rows of its key that are near in time. At most `max_hot_keys` keys are ever called hot:
    the row limit rises with the table so that the list of hot keys, which is broadcast, cannot
    outgrow that number. `detect=False` says that the caller knows there are no hot keys.

    A table is broadcast up to `broadcast_bytes`, measured; beyond that another way is taken.
    """

    hot_rows: int = 20_000
    max_hot_keys: int = 2_000_000
    detect: bool = True
    hot_steps: int = 5_000_000
    broadcast_bytes: int = 128 << 20


DEFAULT = SkewPolicy()
UNIFORM = SkewPolicy(detect=False)


def hot_keys(
    frames: list[DataFrame],
    key: str,
    policy: SkewPolicy = DEFAULT,
    time: str | None = None,
    window: int = 0,
) -> DataFrame | None:
    """Hot keys with `_rows`, their rows over all frames, or None if there are none. With `time`, a
    row costs a step for each row of its key in a window: rows of equal stretches of that length
    are counted, and their squares summed.

    Runs one job that reads only these columns and returns a single row, and keeps the list, if
    there is one, in the shared folder. More than total / limit keys cannot exceed the row limit,
    which bounds the result.
    """
    if not policy.detect:
        return None
    columns = [key] if time is None else [key, time]
    keys = reduce(DataFrame.unionAll, [f.select(columns) for f in frames])
    keys = keys.where(F.col(key).isNotNull())
    if time is None:
        counts = keys.groupBy(key).agg(F.count("*").alias("_rows"))
        counts = counts.withColumn("_steps", F.lit(0.0))
    else:
        stretch = F.floor(F.col(time) / max(1, window)).alias("_stretch")
        near = keys.groupBy(key, stretch).agg(F.count("*").alias("_rows"))
        square = F.col("_rows").cast("double") * F.col("_rows")
        counts = near.groupBy(key).agg(F.sum(square).alias("_steps"), F.sum("_rows").alias("_rows"))
    hot = (F.col("_rows") > policy.hot_rows) | (F.col("_steps") > policy.hot_steps)
    total, above = counts.agg(F.sum("_rows"), F.sum(F.when(hot, 1))).first()
    if not above:
        return None
    if above > policy.max_hot_keys:
        hot = F.col("_rows") > max(policy.hot_rows, total // policy.max_hot_keys)
    return written(counts.where(hot).select(key, "_rows"), "hot-keys")


def split(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); rows with a null key are ordinary."""
    hot = F.broadcast(hot.select(key))
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def by_skew(
    frames: list[DataFrame],
    key: str,
    policy: SkewPolicy,
    ordinary: Callable[..., DataFrame],
    hot: Callable[..., DataFrame],
    time: str | None = None,
    window: int = 0,
) -> DataFrame:
    """Runs `ordinary` on the ordinary keys of all frames and `hot` on the hot ones."""
    keys = hot_keys(frames, key, policy, time, window)
    if keys is None:
        return ordinary(*frames)
    parts = [split(f, keys, key) for f in frames]
    return ordinary(*[p[0] for p in parts]).unionByName(hot(*[p[1] for p in parts]))


def lookup(
    left: DataFrame, right: DataFrame, key: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Left join against a table with one row per key.

    Rows of hot keys go through `attach`. The others go through an ordinary shuffle join, in which
    no key is large.
    """
    keys = hot_keys([left], key, policy)
    if keys is None:
        return left.join(right, key, "left")
    cold, hot = split(left, keys, key)
    columns = left.join(right, key, "left").columns
    both = cold.join(right, key, "left").unionByName(attach(hot, right, key, keys, policy))
    return both.select(*columns)


def attach(
    left: DataFrame, right: DataFrame, key: str, keys: DataFrame, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Left join of rows of the hot keys `keys` against a table with at most one row per key.

    What there is of `right` for hot keys is broadcast if it has at most `broadcast_bytes`. If not,
    each of its rows is repeated once for every `hot_rows` rows of its key, and a hash of the whole
    left row says which one it joins, so no key is large there either.
    """
    few = right.join(F.broadcast(keys.select(key)), key, "left_semi")
    if bytes_of(few) <= policy.broadcast_bytes:
        return left.join(F.broadcast(few), key, "left")
    copies = F.ceil(F.col("_rows") / max(1, policy.hot_rows)).cast("int")
    copies = F.broadcast(keys.select(key, F.greatest(copies, F.lit(1)).alias("_copies")))
    salted = left.join(copies, key).withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), F.col("_copies")).cast("int")
    )
    repeated = few.join(copies, key).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    )
    return salted.drop("_copies").join(repeated.drop("_copies"), [key, "_salt"], "left").drop("_salt")


def bytes_of(df: DataFrame) -> int:
    """About how much memory the rows of `df` take, from one job."""
    sizes = [_width(F.col(f.name), f.dataType) for f in df.schema.fields]
    row = reduce(lambda a, b: a + b, sizes, F.lit(16).cast("long"))
    return int(df.agg(F.sum(row)).first()[0] or 0)


def _width(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.lit(16) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_width(value[f.name], f.dataType) for f in kind.fields], F.lit(16))
    if isinstance(kind, T.ArrayType):
        fixed = 16 + 8 * (len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1)
        n = F.coalesce(F.size(value), F.lit(0)).cast("long")
        if isinstance(kind.elementType, T.StringType | T.BinaryType):
            texts = F.aggregate(value, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.octet_length(x), F.lit(0)))
            return F.lit(16) + n * 16 + F.coalesce(texts, F.lit(0).cast("long"))
        return F.lit(16) + n * fixed
    return F.lit(8)
