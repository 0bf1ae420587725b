"""Batch jobs from files to files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.messages import rejected_events, valid_events
from cardflow.operators.asof import asof_join
from cardflow.operators.cost import champion_report
from cardflow.operators.history import history_features
from cardflow.operators.request import check_requests, request_features
from cardflow.operators.rowfeatures import row_features
from cardflow.operators.skew import DEFAULT, SkewPolicy
from cardflow.operators.split import Splits, time_split
from cardflow.operators.state import card_state
from cardflow.plans.training import TREES, metrics_table, score_requests, train_candidates
from cardflow.plans.workspace import cut_lineage, remove
from cardflow.schema import HISTORY_FEATURES, VALIDATION_START
from cardflow.sources.csv import read_raw, read_transactions, with_epoch
from cardflow.sources.messages import export_messages
from cardflow.sources.tables import read_features, write_features, write_state_snapshot
from cardflow.streaming.state_log import StateLog


def build_history(
    spark: SparkSession, csv_paths: list[str], out: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Feature table of all files as one history. Returns the rows left out because a field is
    missing; the stream leaves the same rows out."""
    tx = read_transactions(spark, csv_paths)
    write_features(history_features(valid_events(tx), policy=policy), out)
    return rejected_events(tx)


def build_state(
    spark: SparkSession,
    csv_paths: list[str],
    out: str,
    policy: SkewPolicy = DEFAULT,
    files: int | None = None,
) -> None:
    """State snapshot after the given files."""
    tx = valid_events(read_transactions(spark, csv_paths))
    write_state_snapshot(card_state(tx, policy=policy), out, files)


def seed_stream(spark: SparkSession, snapshot: DataFrame, log: StateLog) -> None:
    """Cold start: the batch states become the states the stream goes on from."""
    log.seed(spark, snapshot)


def reset_stream(
    spark: SparkSession, snapshot: DataFrame, log: StateLog, checkpoint: str, outputs: list[str]
) -> None:
    """Everything back to the start: no offsets, no states but those of the snapshot, no outputs.
    The states must go first: cards that only the stream knew would keep theirs."""
    states = cut_lineage(snapshot)
    for path in (log.path, checkpoint, *outputs):
        remove(spark, path)
    log.seed(spark, states)


def publish(
    spark: SparkSession,
    csv_paths: list[str],
    out: str | None = None,
    fmt: str = "json",
    limit: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Messages of the given files in the order they happened."""
    export_messages(read_raw(spark, csv_paths), out, fmt, limit, options)


def training_set(
    spark: SparkSession, transactions: DataFrame, features_path: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Transactions with the history features known at their time."""
    features = read_features(spark, features_path)
    return asof_join(transactions, features, HISTORY_FEATURES, policy=policy)


def train(
    spark: SparkSession,
    train_csv: list[str],
    test_csv: list[str],
    out: str,
    champion: DataFrame | None = None,
    start: str = VALIDATION_START,
    trees: int = TREES,
) -> DataFrame:
    """Fits all candidates, writes their metrics to <out>/metrics and the models to
    <out>/models/<name>, and returns the report against the champion, if there is one.

    Promoting a model stays a decision of its own; nothing here does it.
    """
    history, test = (row_features(read_raw(spark, p)) for p in (train_csv, test_csv))
    splits = Splits(*[s.persist() for s in time_split(history, test, start)])
    try:
        candidates = train_candidates(splits, trees)
    finally:
        for s in splits:
            s.unpersist()
    metrics = metrics_table(candidates)
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{out}/metrics")
    for candidate in candidates:
        if candidate.model is not None:
            candidate.model.write().overwrite().save(f"{out}/models/{candidate.name}")
    if champion is None:
        champion = spark.createDataFrame([], "model string, test_cost double")
    # The rule is the floor to beat, not a candidate for promotion.
    return champion_report(metrics.where(F.col("model") != "amount_rule"), champion)


def load_trained(spark: SparkSession, trained: str, name: str) -> tuple[PipelineModel, float]:
    """A model that `train` wrote, and its threshold."""
    metrics = spark.read.parquet(f"{trained}/metrics").where(F.col("model") == name)
    row = metrics.select("threshold").first()
    if row is None:
        raise ValueError(f"{trained} has no model {name}")
    return PipelineModel.load(f"{trained}/models/{name}"), row["threshold"]


def score(
    requests: DataFrame,
    state: DataFrame,
    model: PipelineModel,
    threshold: float,
    version: str,
    policy: SkewPolicy = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """(decision records of the valid requests, rejected requests with their reason).

    `state` comes from a state table; if that cannot be read the job fails, since treating its
    cards as new would give wrong features without a sign of it.
    """
    checked = check_requests(requests)
    valid = with_epoch(checked.where(F.col("reject_reason").isNull()).drop("reject_reason"))
    features = request_features(row_features(valid), state, policy=policy)
    return (
        score_requests(features, model, threshold, version),
        checked.where(F.col("reject_reason").isNotNull()),
    )
