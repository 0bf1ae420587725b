"""Keeps card states up to date from a stream of messages.

Delivery is at least once. A batch reads the states written before it, drops what they already
contain, and writes the states and features of the rest to places that depend only on the run
and batch number, so a repeated batch repeats its result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cardflow.functions.messages import is_complete, parse_messages, valid_events
from cardflow.operators.history import history_features
from cardflow.operators.request import check_requests
from cardflow.operators.rowfeatures import row_features
from cardflow.operators.skew import DEFAULT, UNIFORM, SkewPolicy
from cardflow.operators.state import card_state, fresh_rows, merge_state, state_rows
from cardflow.plans.training import score_requests
from cardflow.plans.workspace import temporary
from cardflow.schema import HISTORY_FEATURES, MESSAGE_FIELDS, REQUEST_TYPES, RETENTION, WINDOWS
from cardflow.streaming.state_log import StateLog

TRIGGER_SECONDS = 2
# Lets adaptive execution merge the small partitions of what a batch keeps in memory.
MERGE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


@dataclass(frozen=True)
class Scorer:
    """A saved model with its threshold and version, and where decision records go."""

    model: PipelineModel
    threshold: float
    version: str
    path: str


@dataclass(frozen=True)
class StateJob:
    """Where a stream writes and how it counts.

    `run` numbers the checkpoints that ever fed this log, from 1; a fresh checkpoint takes a
    higher one. `retention` must be at least the longest window. Features, rejected events and
    the audit row of each batch are written if their path is given, decision records if there is a
    scorer.
    """

    log: StateLog
    run: int = 1
    features_path: str | None = None
    rejects_path: str | None = None
    audit_path: str | None = None
    scorer: Scorer | None = None
    windows: Mapping[str, int] = field(default_factory=lambda: dict(WINDOWS))
    retention: int = RETENTION
    policy: SkewPolicy = DEFAULT
    names: Mapping[str, str] = field(default_factory=lambda: dict(MESSAGE_FIELDS))

    def __post_init__(self) -> None:
        if max(self.windows.values(), default=0) > self.retention:
            raise ValueError("the state must keep at least the longest window")

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """One micro-batch; the callback of the stream, and callable on a plain DataFrame."""
        spark = messages.sparkSession
        self.log.check_run(spark, self.run, batch_id)
        before = spark.conf.get(MERGE_CACHED)
        spark.conf.set(MERGE_CACHED, "true")
        events = parse_messages(messages, self.names, self.scorer is not None).persist()
        try:
            with temporary(spark):
                self._process(spark, events, batch_id)
        finally:
            events.unpersist()
            spark.conf.set(MERGE_CACHED, before)

    def _process(self, spark: SparkSession, events: DataFrame, batch_id: int) -> None:
        complete = is_complete()
        seen = events.agg(
            F.count("*").alias("rows"),
            F.count(F.when(~complete, 1)).alias("rejected"),
            F.collect_set(F.when(complete, self.log.bucket())).alias("buckets"),
        ).first()
        if seen["rejected"] and self.rejects_path:
            rejected = events.where(~complete)
            rejected.write.mode("overwrite").parquet(self._path(self.rejects_path, batch_id))
        tx = valid_events(events)
        cards = tx.groupBy("card_id").agg(F.count("*").alias("_rows")).persist()
        policy = self._policy(seen["rows"], cards)
        state = (
            self.log.before(spark, self.run, batch_id, sorted(seen["buckets"]))
            .join(cards.select("card_id"), "card_id", "left_semi")
            .persist()
        )
        fresh = fresh_rows(tx, state, policy).persist()
        try:
            if self.features_path or self.scorer:
                # A small batch can still meet a card with a long day in its state.
                features = stream_features(fresh, state, self.windows, self.retention, self.policy)
                if self.features_path and self.scorer:
                    features.persist()
                if self.features_path:
                    shown = features.drop(*[c for c in ("ts", *REQUEST_TYPES) if c in features.columns])
                    shown.write.mode("overwrite").parquet(self._path(self.features_path, batch_id))
                if self.scorer:
                    records = stream_scores(features, self.scorer)
                    records.write.mode("overwrite").parquet(self._path(self.scorer.path, batch_id))
                features.unpersist()
            delta = card_state(fresh.drop("_seen"), self.retention, policy)
            self.log.write(merge_state(state, delta, self.retention), self.run, batch_id)
            if self.audit_path:
                self._audit(spark, seen, cards, fresh, batch_id)
        finally:
            fresh.unpersist()
            state.unpersist()
            cards.unpersist()

    def _policy(self, rows: int, cards: DataFrame) -> SkewPolicy:
        """The cards of a batch are counted once: if none is hot, no step has to look for hot ones."""
        if rows <= self.policy.hot_rows or not self.policy.detect:
            return UNIFORM
        most = cards.agg(F.max("_rows")).first()[0] or 0
        return self.policy if most > self.policy.hot_rows else UNIFORM

    def _audit(
        self, spark: SparkSession, seen, cards: DataFrame, fresh: DataFrame, batch_id: int
    ) -> None:
        """Messages, rejects, cards, rows that were late or repeated, and cards changed."""
        changed = fresh.groupBy("card_id").agg(F.count("*").alias("_n"))
        counts = changed.agg(F.count("*").alias("changed"), F.sum("_n").alias("n")).first()
        row = {
            "rows": seen["rows"],
            "rejected": seen["rejected"],
            "cards": cards.count(),
            "late_or_repeated": seen["rows"] - seen["rejected"] - (counts["n"] or 0),
            "cards_changed": counts["changed"],
        }
        out = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in row.items()])
        out.write.mode("overwrite").parquet(self._path(self.audit_path, batch_id))

    def _path(self, base: str, batch_id: int) -> str:
        return f"{base}/run={self.run}/batch_id={batch_id}"


def stream_features(
    fresh: DataFrame,
    state: DataFrame,
    windows: Mapping[str, int] = WINDOWS,
    retention: int = RETENTION,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """History features of the fresh rows of a batch, from the states before it.

    The states become a few weighted rows in front of the batch, and the features are those of
    the batch operator. A category is new if neither the state nor the batch had it before.
    """
    past = state_rows(state, retention).withColumn("_fresh", F.lit(False))
    now = fresh.withColumns({"weight": F.lit(1).cast("long"), "_fresh": F.lit(True)})
    both = now.unionByName(past, allowMissingColumns=True)
    unseen = ~F.coalesce(F.array_contains("_seen", F.col("category")), F.lit(False))
    return (
        history_features(both, windows, policy, weight="weight")
        .where("_fresh")
        .withColumn("is_new_category", F.col("is_new_category") & unseen)
        .drop("_fresh", "_seen", "weight")
    )


def stream_scores(features: DataFrame, scorer: Scorer) -> DataFrame:
    """Decision records of the fresh rows of a batch with their features. A row that lacks a field
    only scoring needs, or has a value it cannot take, gets a record with the reason and no decision.
    Late and repeated rows are not fresh, so each transaction is decided once."""
    asked = check_requests(features)
    known = F.col("prev_distance_km").isNotNull()
    asked = asked.withColumns({"has_history": known, "status": F.when(known, "ok").otherwise("new")})
    columns = [
        "card_id", "tx_id", "epoch_s", "status", "has_history", "reject_reason",
        "probability", "decision", "threshold", "model_version", "history",
    ]
    model = (scorer.model, scorer.threshold, scorer.version)
    valid = F.col("reject_reason").isNull()
    scored = score_requests(row_features(asked.where(valid)), *model).select(*columns)
    nothing = {
        "probability": F.lit(None).cast("double"),
        "decision": F.lit(None).cast("boolean"),
        "threshold": F.lit(float(scorer.threshold)),
        "model_version": F.lit(scorer.version),
        "history": F.struct(*HISTORY_FEATURES),
    }
    return scored.unionByName(asked.where(~valid).withColumns(nothing).select(*columns))


def start(
    messages: DataFrame,
    job: StateJob,
    checkpoint: str,
    drain: bool = False,
    trigger_seconds: int = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Starts the stream. `drain` processes what there is and stops; offsets are kept in
    `checkpoint`, from which a restart goes on."""
    writer = messages.writeStream.foreachBatch(job.process).option(
        "checkpointLocation", checkpoint
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Features, rejects or audit rows of all batches, with run and batch_id."""
    return spark.read.parquet(path)



