"""JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.functions.times import epoch_seconds, message_timestamp
from cardflow.schema import (
    EVENT_COLUMNS,
    EVENT_TYPES,
    MESSAGE_FIELDS,
    MESSAGE_TIME_FORMAT,
    REQUEST_TYPES,
)


def message_value(names: Mapping[str, str] = MESSAGE_FIELDS) -> Column:
    """Compact JSON of the message fields; times go out as ISO text without a zone."""
    fields = [
        (F.date_format(c, MESSAGE_TIME_FORMAT) if c in ("ts", "birth_date") else F.col(c)).alias(
            wire
        )
        for c, wire in names.items()
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message_key() -> Column:
    return F.col("card_id").cast("string")


def parse_messages(
    messages: DataFrame, names: Mapping[str, str] = MESSAGE_FIELDS, requests: bool = False
) -> DataFrame:
    """Typed event columns from the JSON in `value`.

    Text that is not JSON gives a row of nulls, a mistyped field or an unreadable time gives a
    null in that field, unknown fields are ignored: nothing here can fail a batch. `inline`
    keeps later filters from repeating the parse once per field. With `requests` also the time and
    the other fields that scoring needs.
    """
    types = {**EVENT_TYPES, **(REQUEST_TYPES if requests else {})}
    schema = T.StructType([T.StructField(names[c], t) for c, t in types.items()])
    parsed = messages.select(
        F.inline(F.array(F.from_json(F.col("value").cast("string"), schema)))
    ).select(*[F.col(names[c]).alias(c) for c in types])
    parsed = parsed.withColumn("ts", message_timestamp(F.col("ts")))
    parsed = parsed.withColumn("epoch_s", epoch_seconds(F.col("ts")))
    if not requests:
        return parsed.select(*EVENT_COLUMNS)
    return parsed.withColumn("birth_date", message_timestamp(F.col("birth_date"))).select(
        *EVENT_COLUMNS, "ts", *REQUEST_TYPES
    )


def is_complete(columns: list[str] = EVENT_COLUMNS) -> Column:
    """True if no event field is null."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return complete


def valid_events(events: DataFrame) -> DataFrame:
    return events.where(is_complete())


def rejected_events(events: DataFrame) -> DataFrame:
    return events.where(~is_complete())
