"""Transaction messages: batch export and streaming source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.functions.messages import message_key, message_value
from cardflow.operators.skew import SkewPolicy, hot_keys, split
from cardflow.plans.workspace import children, move_in_order, new_dir, remove, written
from cardflow.schema import MESSAGE_FIELDS

FILE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)
# Batches never pass through the driver, so the default caps are far above ones for small memory:
# a batch costs about the same up to some hundred thousand messages.
MAX_PER_TRIGGER = 1_000_000
MAX_BYTES = 256 << 20
# Rows of one card that one task may write; a busier card is written in several parts.
CARD_ROWS = 1_000_000
NO_CARD_TASKS = 64
# Before any time: messages without one come first.
NO_TIME = -(1 << 40)


def message_fields(tx: DataFrame) -> DataFrame:
    """The fields of a message, in the order of the transactions. No label, no other personal
    data and no other clock leaves the table."""
    return tx.select(*MESSAGE_FIELDS).orderBy("ts", "tx_id")


def messages(tx: DataFrame, names: Mapping[str, str] = MESSAGE_FIELDS) -> DataFrame:
    """(key, value) of every transaction in the order (ts, tx_id).

    The sort is by ranges of time, so no card has to fit in one task. Files do not keep this
    order; `export_messages` keeps that of each card.
    """
    return message_fields(tx).select(
        message_key().alias("key"), message_value(names).alias("value")
    )


def export_messages(
    tx: DataFrame,
    path: str | None = None,
    fmt: str = "json",
    limit: int | None = None,
    options: Mapping[str, str] | None = None,
    card_rows: int = CARD_ROWS,
) -> None:
    """Writes the messages, the first `limit` if given: to files, or with fmt="kafka" and its
    options to a topic.

    A card's messages are in order wherever the reader cuts: one task writes all of a card, in
    order of (ts, tx_id), so all of it is in one file or goes to the topic in that order. Cards
    of more than `card_rows` messages are cut into parts of consecutive times of about that many.
    One partitioning by (part, card) writes all parts at once to the shared folder. Then files are
    put in place part after part, with later names and times, as a stream reads files by their
    times; a topic gets the parts in one small job each. How often `tx` is read does not depend on
    the number of parts. Messages without a card have no order among themselves.
    """
    rows = tx.select(*MESSAGE_FIELDS)
    if limit is not None:
        rows = written(rows.orderBy("ts", "tx_id").limit(limit), "first-messages")
    busy = hot_keys([rows], "card_id", SkewPolicy(hot_rows=card_rows))
    parted = _parted(rows, busy, card_rows) if busy is not None else rows.withColumn("_part", F.lit(0))
    spread = F.when(F.col("card_id").isNull(), F.pmod(F.xxhash64("tx_id"), F.lit(NO_CARD_TASKS)))
    out = (
        parted.repartition("card_id", "_part", F.coalesce(spread, F.lit(0)))
        .sortWithinPartitions("_part", "card_id", "ts", "tx_id")
        .select(
            message_key().alias("key"), message_value(names=MESSAGE_FIELDS).alias("value"), "_part"
        )
    )
    if busy is None:
        _save(out.drop("_part"), path, fmt, options)
        return
    spark, staged = tx.sparkSession, new_dir(tx.sparkSession, "parts")
    kept = "parquet" if path is None else fmt
    extra = {} if path is None else dict(options or {})
    out.write.format(kept).options(**extra).partitionBy("_part").save(staged)
    if path is not None:
        _place(spark, staged, path)
        return
    for part in _part_numbers(spark, staged):
        rows = spark.read.schema(FILE_SCHEMA).parquet(f"{staged}/_part={part}")
        _save(rows, None, fmt, options, ordered=True)
    remove(spark, staged)


def export_parts(tx: DataFrame, path: str, part: str) -> None:
    """Writes the messages as one JSON file for each value of the whole number `part`, and puts the
    files in place in the order of those numbers. `tx` is read once, however many parts there are.

    Inside a file each card's messages are in order of (ts, tx_id); the caller sees to it that a later
    part holds nothing earlier of a card. One task sorts and writes a part.
    """
    spark, staged = tx.sparkSession, new_dir(tx.sparkSession, "parts")
    (
        tx.select(*MESSAGE_FIELDS, F.col(part).alias("_part"))
        .repartition("_part")
        .sortWithinPartitions("_part", "card_id", "ts", "tx_id")
        .select(
            message_key().alias("key"), message_value(names=MESSAGE_FIELDS).alias("value"), "_part"
        )
        .write.partitionBy("_part")
        .json(staged)
    )
    _place(spark, staged, path)


def _place(spark: SparkSession, staged: str, path: str) -> None:
    """Moves the files of `staged` to `path`, part after part, with later names and times."""
    for part in _part_numbers(spark, staged):
        folder = f"{staged}/_part={part}"
        names = [n for n in children(spark, folder) if not n.startswith((".", "_"))]
        targets = [f"{path}/part-{part:06d}-{n}" for n in names]
        move_in_order(spark, [f"{folder}/{n}" for n in names], targets)
    remove(spark, staged)


def _part_numbers(spark: SparkSession, staged: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in children(spark, staged) if n.startswith("_part="))


def _save(
    out: DataFrame, path: str | None, fmt: str, options: Mapping[str, str] | None, ordered: bool = False
) -> None:
    if ordered:  # a file's rows stay together and in order in one task
        out = out.coalesce(max(1, len(out.inputFiles())))
    writer = out.write.format(fmt).options(**(options or {}))
    if path is None:
        writer.save()
    else:
        writer.mode("append").save(path)


def _parted(rows: DataFrame, busy: DataFrame, card_rows: int) -> DataFrame:
    """`rows` plus `_part`: 0 for ordinary cards; for busy ones how often the card had `card_rows`
    messages in earlier seconds. Seconds are summed first; days carry their totals over, so the
    largest window is a card's days or a day's seconds, and a second's messages are one part."""
    ordinary, hot = split(rows, busy, "card_id")
    at = F.coalesce(F.unix_timestamp(F.col("ts").cast("timestamp")), F.lit(NO_TIME))
    hot = hot.withColumn("_at", at)
    seconds = (
        hot.groupBy("card_id", "_at")
        .agg(F.count("*").alias("_n"))
        .withColumn("_day", F.floor(F.col("_at") / 86400))
    )
    before = (Window.unboundedPreceding, -1)
    days = (
        seconds.groupBy("card_id", "_day")
        .agg(F.sum("_n").alias("_n"))
        .select(
            "card_id",
            "_day",
            F.sum("_n").over(Window.partitionBy("card_id").orderBy("_day").rowsBetween(*before)).alias("_n0"),
        )
    )
    inside = Window.partitionBy("card_id", "_day").orderBy("_at").rowsBetween(*before)
    zero = F.lit(0).cast("long")
    earlier = F.coalesce("_n0", zero) + F.coalesce("_n1", zero)
    parts = (
        seconds.withColumn("_n1", F.sum("_n").over(inside))
        .join(days, ["card_id", "_day"])
        .select("card_id", "_at", F.floor(earlier / card_rows).cast("int").alias("_part"))
    )
    hot = hot.join(parts, ["card_id", "_at"]).select(*rows.columns, "_part")
    return ordinary.withColumn("_part", F.lit(0)).unionByName(hot)


def read_message_stream(
    spark: SparkSession,
    fmt: str = "json",
    path: str | None = None,
    max_per_trigger: int = MAX_PER_TRIGGER,
    options: Mapping[str, str] | None = None,
    max_bytes: int | None = MAX_BYTES,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming (key, value) from the earliest message on.

    For Kafka `max_per_trigger` caps the messages of a batch. Files are capped by their bytes, or
    by `max_files` if that is given. No cap changes the states: see `export_messages`.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return (
            reader.option("startingOffsets", "earliest")
            .option("maxOffsetsPerTrigger", max_per_trigger)
            .load()
            .select("key", "value")
        )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return (
        reader.schema(FILE_SCHEMA)
        .load(path)
        .select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    )
