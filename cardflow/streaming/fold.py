"""The same state kept in Spark's own state store, one card at a time.

An independent second form of the fold, and the one whose cost per batch depends on the batch
alone. Set the RocksDB state store for many cards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardflow.schema import RETENTION, STATE_COLUMNS

KEPT_SCHEMA = T.StructType(
    [
        T.StructField("n_total", T.LongType()),
        T.StructField("amount_total", T.DoubleType()),
        T.StructField("categories_seen", T.ArrayType(T.StringType())),
        T.StructField("recent_epochs", T.ArrayType(T.LongType())),
        T.StructField("recent_counts", T.ArrayType(T.LongType())),
        T.StructField("recent_amounts", T.ArrayType(T.DoubleType())),
        T.StructField("last_epoch", T.LongType()),
        T.StructField("last_tx_id", T.StringType()),
        T.StructField("last_lat", T.DoubleType()),
        T.StructField("last_lon", T.DoubleType()),
    ]
)
CHANGED_SCHEMA = T.StructType([T.StructField("card_id", T.LongType()), *KEPT_SCHEMA.fields])
CHANGED = CHANGED_SCHEMA.fieldNames()
EVENT_ORDER = ["epoch_s", "tx_id", "amount", "category", "merch_lat", "merch_lon"]


def stateful_fold(events: DataFrame, retention: int = RETENTION) -> DataFrame:
    """Streaming states of the cards each batch changed, from streaming events.

    A card's rows of one batch are sorted in memory; the size of a batch bounds them.
    """

    def update(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else None
        last = (old[6], old[7]) if old is not None else None
        # In plain values: a frame for each card and step would cost more than all of its rows.
        rows = sorted(row for f in frames for row in zip(*[f[c].tolist() for c in EVENT_ORDER]))
        n, total, categories, epochs, counts, amounts = (
            old[:6] if old is not None else (0, 0.0, [], [], [], [])
        )
        seconds = {e: (k, a) for e, k, a in zip(epochs, counts, amounts)}
        seen, added, here = set(categories), 0.0, last
        for epoch, tx_id, amount, category, lat, lon in rows:
            if here is not None and (epoch, tx_id) <= here:
                continue
            here, end = (epoch, tx_id), (lat, lon)
            k, a = seconds.get(epoch, (0, 0.0))
            seconds[epoch] = k + 1, a + amount
            n, added = n + 1, added + amount
            seen.add(category)
        if here == last:
            return
        recent = [e for e in seconds if e >= here[0] - retention]
        new = (
            int(n),
            float(total) + added,
            sorted(seen),
            recent,
            [seconds[e][0] for e in recent],
            [seconds[e][1] for e in recent],
            int(here[0]),
            str(here[1]),
            float(end[0]),
            float(end[1]),
        )
        state.update(new)
        yield pd.DataFrame([(int(key[0]), *new)], columns=CHANGED)

    return events.groupBy("card_id").applyInPandasWithState(
        update, CHANGED_SCHEMA, KEPT_SCHEMA, "update", GroupStateTimeout.NoTimeout
    )


def to_state(changed: DataFrame) -> DataFrame:
    """Output rows of the fold in the layout of the other operators."""
    recent = F.transform(
        F.arrays_zip("recent_epochs", "recent_counts", "recent_amounts"),
        lambda r: F.struct(
            r["recent_epochs"].alias("epoch_s"),
            r["recent_counts"].alias("n"),
            r["recent_amounts"].alias("amount"),
        ),
    )
    return changed.withColumn("recent", recent).select(*STATE_COLUMNS)
