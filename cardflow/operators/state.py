"""Per-card state: what scoring needs to know about everything a card did so far.

`recent` holds the last day as one entry per second (epoch_s, n, amount), so a card has at most
86,401 entries however busy it is. Counts over windows and amounts of a second are the same as
from one entry per transaction. `recent_transactions` gives those as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.arrays import (
    append_seconds,
    insert_sorted,
    keep_since,
    total_amount,
    total_count,
)
from cardflow.functions.compare import is_later
from cardflow.operators.skew import DEFAULT, SkewPolicy, by_skew, lookup
from cardflow.plans.workspace import written
from cardflow.schema import RECENT_TYPE, RETENTION, STATE_COLUMNS


def _end():
    return F.max(F.struct("epoch_s", "tx_id", "merch_lat", "merch_lon"))


#: About what a card and its last second take in a broadcast table.
NEWEST_BYTES = 48


def card_state(
    tx: DataFrame, retention: int = RETENTION, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """State of every card after all of `tx`. Rows without a card belong to no state; one without
    a time counts in the totals and is never recent.

    Sums, categories and last seconds of the cards are combined before their shuffles. The last
    seconds, if they are few enough bytes to be broadcast, then tell every task which of its rows
    are recent, and only those are shuffled. With more cards, or where the caller knows that `tx`
    is small, whole rows are shuffled by card.
    """
    tx = tx.where(F.col("card_id").isNotNull())
    if not policy.detect:
        return _ordinary_state(tx, retention)
    cards = tx.groupBy("card_id").agg(
        F.max("epoch_s").alias("_newest"),
        F.count("*").alias("n_total"),
        F.sum("amount").alias("amount_total"),
    )
    cards = written(cards, "cards")
    if cards.count() * NEWEST_BYTES <= policy.broadcast_bytes:
        return _pruned_state(tx, cards, retention)
    return by_skew(
        [tx],
        "card_id",
        policy,
        lambda t: _ordinary_state(t, retention),
        lambda t: _hot_state(t, retention),
    )


def _pruned_state(tx: DataFrame, cards: DataFrame, retention: int) -> DataFrame:
    """`cards` holds the last second and the sums of every card. Rows of a card without any time
    all stand for its end."""
    categories = (
        tx.where(F.col("category").isNotNull())
        .groupBy("card_id", "category")
        .agg(F.lit(1).alias("_one"))
        .groupBy("card_id")
        .agg(F.array_sort(F.collect_list("category")).alias("categories_seen"))
    )
    newest = F.broadcast(cards.select("card_id", "_newest"))
    near = F.col("_newest").isNull() | (F.col("epoch_s") >= F.col("_newest") - retention)
    seconds = (
        tx.select("card_id", "epoch_s", "tx_id", "amount", "merch_lat", "merch_lon")
        .join(newest, "card_id")
        .where(near)
        .groupBy("card_id", "epoch_s")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("amount"),
            F.max(F.struct("tx_id", "merch_lat", "merch_lon")).alias("_e"),
        )
    )
    recent = F.when(F.col("epoch_s").isNotNull(), F.struct("epoch_s", "n", "amount"))
    ends = seconds.groupBy("card_id").agg(
        F.array_sort(F.collect_list(recent)).alias("recent"),
        F.max(F.struct("epoch_s", "_e.tx_id", "_e.merch_lat", "_e.merch_lon")).alias("_end"),
    )
    none = F.array().cast("array<string>")
    return _shape(
        cards.join(ends, "card_id")
        .join(categories, "card_id", "left")
        .withColumn("categories_seen", F.coalesce("categories_seen", none))
    )


def _ordinary_state(tx: DataFrame, retention: int) -> DataFrame:
    """One exchange: the card's last second, the sums per second and the sums per card all need
    the same clustering by card."""
    card = Window.partitionBy("card_id")
    seconds = (
        tx.withColumn("_newest", F.max("epoch_s").over(card))
        .groupBy("card_id", "epoch_s", "_newest")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("amount"),
            F.collect_set("category").alias("_categories"),
            F.max(F.struct("tx_id", "merch_lat", "merch_lon")).alias("_e"),
        )
    )
    recent = F.when(
        F.col("epoch_s") >= F.col("_newest") - retention, F.struct("epoch_s", "n", "amount")
    )
    return _shape(
        seconds.groupBy("card_id").agg(
            F.sum("n").alias("n_total"),
            F.sum("amount").alias("amount_total"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("_categories")))).alias(
                "categories_seen"
            ),
            F.array_sort(F.collect_list(recent)).alias("recent"),
            F.max(F.struct("epoch_s", "_e.tx_id", "_e.merch_lat", "_e.merch_lon")).alias("_end"),
        )
    )


def _hot_state(tx: DataFrame, retention: int) -> DataFrame:
    """Totals combine before the shuffle; there are few hot cards, so their last times are
    broadcast and old rows never leave the task that reads them."""
    totals = tx.groupBy("card_id").agg(
        F.count("*").alias("n_total"),
        F.sum("amount").alias("amount_total"),
        F.array_sort(F.collect_set("category")).alias("categories_seen"),
        _end().alias("_end"),
    )
    newest = totals.select("card_id", F.col("_end.epoch_s").alias("_newest"))
    recent = (
        tx.join(F.broadcast(newest), "card_id")
        .where(F.col("epoch_s") >= F.col("_newest") - retention)
        .groupBy("card_id", "epoch_s")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
        .groupBy("card_id")
        .agg(F.array_sort(F.collect_list(F.struct("epoch_s", "n", "amount"))).alias("recent"))
    )
    none = F.array().cast(RECENT_TYPE)
    return _shape(
        totals.join(recent, "card_id", "left").withColumn("recent", F.coalesce("recent", none))
    )


def _shape(df: DataFrame) -> DataFrame:
    return df.select(
        "card_id",
        "n_total",
        "amount_total",
        "categories_seen",
        "recent",
        F.col("_end.epoch_s").alias("last_epoch"),
        F.col("_end.tx_id").alias("last_tx_id"),
        F.col("_end.merch_lat").alias("last_lat"),
        F.col("_end.merch_lon").alias("last_lon"),
    )


def recent_transactions(
    tx: DataFrame, retention: int = RETENTION, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Transactions within `retention` seconds of their card's last one, as rows. Rows without a
    card or a time are never recent. The cards' last seconds are combined before their shuffle; if
    they can be broadcast, no row is shuffled at all."""
    tx = tx.where(F.col("card_id").isNotNull() & F.col("epoch_s").isNotNull())
    if policy.detect:
        last = tx.groupBy("card_id").agg(F.max("epoch_s").alias("_newest"))
        last = written(last, "last-seconds")
        if last.count() * NEWEST_BYTES <= policy.broadcast_bytes:
            return (
                tx.join(F.broadcast(last), "card_id")
                .where(F.col("epoch_s") >= F.col("_newest") - retention)
                .select(*tx.columns)
            )

    def ordinary(rows: DataFrame) -> DataFrame:
        newest = F.max("epoch_s").over(Window.partitionBy("card_id"))
        return (
            rows.withColumn("_newest", newest)
            .where(F.col("epoch_s") >= F.col("_newest") - retention)
            .drop("_newest")
        )

    def hot(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy("card_id").agg(F.max("epoch_s").alias("_newest"))
        return (
            rows.join(F.broadcast(newest), "card_id")
            .where(F.col("epoch_s") >= F.col("_newest") - retention)
            .drop("_newest")
        )

    return by_skew([tx], "card_id", policy, ordinary, hot).select(*tx.columns)


def recent_arrays(state: DataFrame) -> DataFrame:
    """State with `recent` as parallel arrays recent_epochs, recent_counts, recent_amounts."""
    return state.select(
        *[c for c in state.columns if c != "recent"],
        F.transform("recent", lambda r: r["epoch_s"]).alias("recent_epochs"),
        F.transform("recent", lambda r: r["n"]).alias("recent_counts"),
        F.transform("recent", lambda r: r["amount"]).alias("recent_amounts"),
    )


def fresh_rows(tx: DataFrame, state: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Rows of `tx` that come after their card's state, each (card, second, id) once.

    Repeated deliveries and late rows drop out here, which makes the fold idempotent. Of rows
    that share an id and second the smallest payload stays, so replays agree. Adds `_seen`, the
    categories of the state.
    """
    payload = [c for c in tx.columns if c not in ("card_id", "epoch_s", "tx_id")]
    once = (
        tx.groupBy("card_id", "epoch_s", "tx_id")
        .agg(F.min(F.struct(*payload)).alias("_p"))
        .select("card_id", "epoch_s", "tx_id", *[F.col("_p")[c].alias(c) for c in payload])
    )
    marks = state.select(
        "card_id",
        F.col("last_epoch").alias("_epoch"),
        F.col("last_tx_id").alias("_id"),
        F.col("categories_seen").alias("_seen"),
    )
    return (
        lookup(once, marks, "card_id", policy)
        .where(is_later(F.col("epoch_s"), F.col("tx_id"), F.col("_epoch"), F.col("_id")))
        .select(*tx.columns, "_seen")
    )


def merge_state(state: DataFrame, delta: DataFrame, retention: int = RETENTION) -> DataFrame:
    """State of the cards in `delta` after it; every row of `delta` is later than `state`."""
    old = state.select("card_id", *[F.col(c).alias("_" + c) for c in STATE_COLUMNS[1:]])
    zero = F.lit(0)
    merged = delta.join(old, "card_id", "left")
    recent = append_seconds(F.col("_recent"), F.col("recent"))
    return merged.select(
        "card_id",
        (F.coalesce("_n_total", zero) + F.col("n_total")).alias("n_total"),
        (F.coalesce("_amount_total", F.lit(0.0)) + F.col("amount_total")).alias("amount_total"),
        insert_sorted(F.col("_categories_seen"), F.col("categories_seen")).alias(
            "categories_seen"
        ),
        keep_since(recent, F.col("last_epoch") - retention).alias("recent"),
        "last_epoch",
        "last_tx_id",
        "last_lat",
        "last_lon",
    )


def fold(
    state: DataFrame, tx: DataFrame, retention: int = RETENTION, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """New states of the cards that `tx` changes; cards without a fresh row are left out."""
    fresh = fresh_rows(tx, state, policy).drop("_seen")
    return merge_state(state, card_state(fresh, retention, policy), retention)


def replace_states(state: DataFrame, changed: DataFrame) -> DataFrame:
    """All states after `changed` replaced the rows of its cards."""
    kept = state.join(changed.select("card_id"), "card_id", "left_anti")
    return kept.unionByName(changed)


def state_rows(state: DataFrame, retention: int = RETENTION) -> DataFrame:
    """A state as weighted transactions that give later ones the same history features.

    One row stands for everything older than `recent`, placed before any window; one row per
    recent second follows, the last of them at the card's last place and id. They carry no
    category: the categories seen are checked apart.
    """
    older = F.struct(
        (F.col("last_epoch") - retention - 1).alias("epoch_s"),
        (F.col("n_total") - total_count(F.col("recent"))).alias("n"),
        (F.col("amount_total") - total_amount(F.col("recent"))).alias("amount"),
    )
    row = F.explode(F.concat(F.array(older), F.col("recent")))
    is_last = F.col("_r.epoch_s") == F.col("last_epoch")
    return (
        state.withColumn("_r", row)
        .where(F.col("_r.n") > 0)
        .select(
            "card_id",
            F.col("_r.epoch_s").alias("epoch_s"),
            F.when(is_last, F.col("last_tx_id")).otherwise(F.lit("")).alias("tx_id"),
            F.lit(None).cast("string").alias("category"),
            F.col("_r.amount").alias("amount"),
            F.when(is_last, F.col("last_lat")).alias("merch_lat"),
            F.when(is_last, F.col("last_lon")).alias("merch_lon"),
            F.col("_r.n").alias("weight"),
        )
    )
