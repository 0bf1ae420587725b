"""Command line: python -m cardflow <job> ..., or spark-submit of this file.

The session is the caller's: memory, parallelism and packages are set with spark-submit.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cardflow.plans import jobs
from cardflow.schema import VALIDATION_START
from cardflow.sources.csv import read_raw
from cardflow.sources.messages import MAX_PER_TRIGGER, read_message_stream
from cardflow.sources.tables import read_state_snapshot
from cardflow.streaming.job import TRIGGER_SECONDS, Scorer, StateJob, start
from cardflow.streaming.state_log import StateLog


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cardflow", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    history = commands.add_parser("history", help="feature table of raw CSV files")
    history.add_argument("csv", nargs="+")
    history.add_argument("--out", required=True)

    state = commands.add_parser("state", help="state snapshot after raw CSV files")
    state.add_argument("csv", nargs="+")
    state.add_argument("--out", required=True)
    state.add_argument("--files", type=int)

    seed = commands.add_parser("seed", help="start a state table from a snapshot")
    seed.add_argument("snapshot")
    seed.add_argument("--states", required=True)
    seed.add_argument("--buckets", type=int, default=64)

    reset = commands.add_parser("reset", help="delete what a stream wrote and seed it again")
    reset.add_argument("snapshot")
    reset.add_argument("--states", required=True)
    reset.add_argument("--buckets", type=int, default=64)
    reset.add_argument("--checkpoint", required=True)
    reset.add_argument("--output", action="append", default=[], help="features, rejects or audit")

    publish = commands.add_parser("publish", help="messages of raw CSV files")
    publish.add_argument("csv", nargs="+")
    publish.add_argument("--out")
    publish.add_argument("--format", default="json")
    publish.add_argument("--limit", type=int)
    publish.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")

    stream = commands.add_parser("stream", help="keep the states up to date from messages")
    stream.add_argument("--source", help="folder of messages, unless the format has none")
    stream.add_argument("--format", default="json")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    stream.add_argument("--states", required=True)
    stream.add_argument("--buckets", type=int, default=64)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--run", type=int, default=1)
    stream.add_argument("--features")
    stream.add_argument("--rejects")
    stream.add_argument("--audit")
    stream.add_argument("--drain", action="store_true")
    stream.add_argument("--interval", type=int, default=TRIGGER_SECONDS)
    stream.add_argument("--max-per-batch", type=int, default=MAX_PER_TRIGGER)

    stream.add_argument("--trained", help="output of train; with --model: decide as well")
    stream.add_argument("--model")
    stream.add_argument("--scores", help="where decision records go")

    score = commands.add_parser("score", help="decide on the requests of raw CSV files")
    score.add_argument("csv", nargs="+")
    score.add_argument("--states", required=True, help="state table of a stream")
    score.add_argument("--buckets", type=int, default=64)
    score.add_argument("--trained", required=True)
    score.add_argument("--model", required=True)
    score.add_argument("--out", required=True)
    score.add_argument("--rejects")

    train = commands.add_parser("train", help="fit, choose thresholds, compare with the champion")
    train.add_argument("--train", nargs="+", required=True)
    train.add_argument("--test", nargs="+", required=True)
    train.add_argument("--out", required=True)
    train.add_argument("--champion", help="metrics table with one row per promoted model")
    train.add_argument("--validation-start", default=VALIDATION_START)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"cardflow-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.job == "history":
        rejected = jobs.build_history(spark, args.csv, args.out)
        print(f"rows left out: {rejected.count()}")
    elif args.job == "state":
        jobs.build_state(spark, args.csv, args.out, files=args.files)
    elif args.job == "seed":
        snapshot = read_state_snapshot(spark, args.snapshot)
        jobs.seed_stream(spark, snapshot, StateLog(args.states, args.buckets))
    elif args.job == "reset":
        snapshot = read_state_snapshot(spark, args.snapshot)
        log = StateLog(args.states, args.buckets)
        jobs.reset_stream(spark, snapshot, log, args.checkpoint, args.output)
    elif args.job == "publish":
        options = _options(args.option)
        jobs.publish(spark, args.csv, args.out, args.format, args.limit, options)
    elif args.job == "stream":
        scorer = None
        if args.scores:
            if not (args.trained and args.model):
                raise SystemExit("--scores needs --trained and --model")
            model, threshold = jobs.load_trained(spark, args.trained, args.model)
            scorer = Scorer(model, threshold, args.model, args.scores)
        job = StateJob(
            StateLog(args.states, args.buckets),
            run=args.run,
            features_path=args.features,
            rejects_path=args.rejects,
            audit_path=args.audit,
            scorer=scorer,
        )
        messages = read_message_stream(
            spark, args.format, args.source, args.max_per_batch, _options(args.option)
        )
        start(messages, job, args.checkpoint, args.drain, args.interval).awaitTermination()
    elif args.job == "score":
        model, threshold = jobs.load_trained(spark, args.trained, args.model)
        states = StateLog(args.states, args.buckets).current(spark)
        requests = read_raw(spark, args.csv)
        records, rejected = jobs.score(requests, states, model, threshold, args.model)
        records.write.mode("overwrite").parquet(args.out)
        if args.rejects:
            rejected.write.mode("overwrite").parquet(args.rejects)
    elif args.job == "train":
        champion = None
        if args.champion:
            champion = spark.read.parquet(args.champion).select("model", "test_cost")
        report = jobs.train(
            spark, args.train, args.test, args.out, champion, args.validation_start
        )
        report.select(*[F.col(c).cast("string") for c in report.columns]).show(truncate=False)


if __name__ == "__main__":
    main()
