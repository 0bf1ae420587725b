"""Sets of 64-bit keys as bitmaps of fixed size, small enough to broadcast whatever the data. They
are sent compressed, so a set of few keys costs little.

A bitmap may hold keys nobody put in, so it only serves where a false member costs work and changes
no result. The more keys, the less it spares; its size, and what passes through the driver, stay."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm import kept

#: 16 MB each.
BITS = 27
_ROW = 15
#: Bitmaps a worker keeps open.
OPENED = 2


class Bitmap:
    """A broadcast bitmap; `value` opens it once in each worker."""

    def __init__(self, sent: Broadcast):
        self.sent, self.name = sent, uuid.uuid4().hex

    @property
    def value(self) -> np.ndarray:
        opened = kept.of(kept.WORDS).setdefault("bitmaps", {})
        if self.name not in opened:
            while len(opened) >= OPENED:
                del opened[next(iter(opened))]
            opened[self.name] = np.frombuffer(zlib.decompress(self.sent.value), dtype=np.uint8)
        return opened[self.name]


def drop(bitmaps: dict[str, Bitmap]) -> None:
    """Frees them everywhere, once nothing is left to compute with them."""
    for b in bitmaps.values():
        b.sent.destroy()


def build(keys: DataFrame, key: str, members: dict[str, Column], bits: int = BITS) -> dict[str, Bitmap]:
    """One broadcast bitmap for each condition in `members`, in one pass over `keys`."""
    at = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        keys.select(at.alias("at"), *[c.alias(n) for n, c in members.items()])
        .groupBy(F.shiftright("at", _ROW).alias("row"))
        .agg(*[F.bitmap_construct_agg(F.when(F.col(n), F.col("at") % (1 << _ROW))).alias(n) for n in members])
    )
    out = {n: np.zeros((1 << bits) // 8, dtype=np.uint8) for n in members}
    step = (1 << _ROW) // 8
    for row in rows.toLocalIterator():
        for n in members:
            out[n][row["row"] * step : (row["row"] + 1) * step] = np.frombuffer(row[n], dtype=np.uint8)
    context = keys.sparkSession.sparkContext
    return {n: Bitmap(context.broadcast(zlib.compress(b.tobytes(), 1))) for n, b in out.items()}


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
