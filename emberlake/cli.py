"""Command line: ``python -m emberlake.cli <job> ...`` or the same through ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime
import logging
import os

from emberlake.operators import labels
from emberlake.operators.learning import TreeSettings
from emberlake.plans import history, live, load, profiles, training
from emberlake.session import get_spark, shared_dir
from emberlake.sinks.compaction import Output, compact, drop_superseded
from emberlake.sinks.jdbc import Store
from emberlake.sinks.tables import RAW_SAMPLE_ROWS
from emberlake.sources.files import read_partitioned
from emberlake.sources.streams import Topic
from emberlake.streaming import flows, run

ALL_YEARS = labels.TRAIN_YEARS + labels.VALIDATION_YEARS + labels.TEST_YEARS


def _years(args) -> list[int]:
    if args.all_years:
        return ALL_YEARS
    return sorted(args.years or labels.TEST_YEARS)


def _history(spark, args):
    layout = history.Layout.under(args.output, args.raw_sample)
    history.run(spark, args.data_dir, _years(args), layout, args.sample, raw_sample_rows=args.raw_sample_rows).show(truncate=False)


def _profile(spark, args):
    profiles.run(spark, args.data_dir, _years(args), args.output, args.sample).show(truncate=False)


def _train(spark, args):
    features = read_partitioned(spark, args.features)
    settings = TreeSettings(args.rf_num_trees, args.rf_max_depth, args.gbt_max_iter, args.gbt_max_depth, args.seed)
    print(training.run(spark, features, args.models, args.reports, settings,
                       args.years_train, args.years_val, args.years_test,
                       (args.low_quantile, args.high_quantile)))


def _train_anomaly(spark, args):
    years = args.years or labels.TRAIN_YEARS + labels.VALIDATION_YEARS
    training.run_anomaly(spark, read_partitioned(spark, args.features), years, args.model).show()


def _load(spark, args):
    store = Store(args.url, os.environ["SERVING_USER"], os.environ["SERVING_PASSWORD"], args.schema)
    load.load_events(spark, args.curated, args.years, store, args.mode, rejected=args.rejected)


def _compact(spark, args):
    output = Output(args.stream, args.compacted, spark.read.parquet(args.stream).schema)
    months = compact(spark, output, args.before, args.least_files)
    removed = drop_superseded(spark, output) if args.drop_superseded else 0
    logging.getLogger(__name__).info("compacted %s, removed %s older copies", months, removed)


#: Topics that scoring and alerts read.
SCORED = ("fire_to_score", "risk", "anomalies")


def _topics(args) -> live.Topics:
    default = live.Topics()
    named = {role: getattr(default, role) for role in default.__dataclass_fields__}
    return live.Topics(**{
        role: Topic(t.location, servers=args.kafka_bootstrap, per_trigger=args.rate if role in SCORED else t.per_trigger) for role, t in named.items()
    })


def _stream(spark, args):
    checkpoints = args.checkpoints or f"{shared_dir(spark)}/streams"
    topics = _topics(args)
    if args.job == "ingest":
        writers = run.choose(live.ingest(spark, topics, args.output, checkpoints), args.mode)
    elif args.job == "anomalies":
        writers = [live.detect_anomalies(spark, topics, args.model, checkpoints)]
    elif args.job == "risk":
        writers = [live.infer_risk(spark, topics, args.models, checkpoints)]
    elif args.job == "actions":
        topic = Topic(args.actions, servers=args.kafka_bootstrap)
        writers = [flows.action_archive(spark, topic, args.output, f"{checkpoints}/actions")]
    else:
        writers = [live.generate_alerts(spark, topics, checkpoints)]
    run.run(spark, writers, args.duration)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="emberlake")
    jobs = top.add_subparsers(dest="command", required=True)

    def job(name, action):
        sub = jobs.add_parser(name)
        sub.set_defaults(action=action)
        return sub

    for name, action in (("history", _history), ("profile", _profile)):
        sub = job(name, action)
        sub.add_argument("--data-dir", required=True)
        sub.add_argument("--output", required=True)
        sub.add_argument("--years", "--year", type=int, nargs="+")
        sub.add_argument("--all-years", action="store_true")
        sub.add_argument("--sample", type=int, help="first rows of every file only")
        if name == "history":
            sub.add_argument("--raw-sample", action="store_true")
            sub.add_argument("--raw-sample-rows", type=int, default=RAW_SAMPLE_ROWS, help="rows a year")

    sub = job("train", _train)
    for option in ("--features", "--models", "--reports"):
        sub.add_argument(option, required=True)
    for option, years in (("--years-train", labels.TRAIN_YEARS), ("--years-val", labels.VALIDATION_YEARS),
                          ("--years-test", labels.TEST_YEARS)):
        sub.add_argument(option, type=int, nargs="+", default=years)
    sizes = TreeSettings()
    for option, value in (("--rf-num-trees", sizes.forest_trees), ("--rf-max-depth", sizes.forest_depth),
                          ("--gbt-max-iter", sizes.boost_rounds), ("--gbt-max-depth", sizes.boost_depth),
                          ("--seed", sizes.seed)):
        sub.add_argument(option, type=int, default=value)
    for option, value in (("--low-quantile", labels.LOW_QUANTILE), ("--high-quantile", labels.HIGH_QUANTILE)):
        sub.add_argument(option, type=float, default=value)

    sub = job("train-anomaly", _train_anomaly)
    sub.add_argument("--features", required=True)
    sub.add_argument("--model", required=True)
    sub.add_argument("--years", type=int, nargs="+")

    sub = job("load", _load)
    sub.add_argument("--curated", required=True)
    sub.add_argument("--years", type=int, nargs="+", required=True)
    sub.add_argument("--mode", choices=["append", "overwrite"], default="overwrite")
    sub.add_argument("--url", required=True)
    sub.add_argument("--schema", default="public")
    sub.add_argument("--rejected", help="folder for rows that the table refuses; only counted, if not given")

    sub = job("stream", _stream)
    sub.add_argument("job", choices=["ingest", "anomalies", "risk", "alerts", "actions"])
    sub.add_argument("--mode", choices=["fire", "environmental", "both"], default="both")
    sub.add_argument("--kafka-bootstrap", default="localhost:9092")
    sub.add_argument("--rate", type=int, help="most messages per source and trigger when scoring; all, if not given")
    sub.add_argument("--actions", default="user_actions", help="topic of user actions, archived to --output")
    sub.add_argument("--output")
    sub.add_argument("--model")
    sub.add_argument("--models")
    sub.add_argument("--checkpoints")
    sub.add_argument("--duration", type=int, default=0, help="seconds, 0 for no limit")

    sub = job("compact", _compact)
    sub.add_argument("--stream", required=True, help="folder that the ingest stream writes")
    sub.add_argument("--compacted", required=True)
    sub.add_argument("--before", type=datetime.date.fromisoformat, required=True, help="months before that of this day are closed")
    sub.add_argument("--least-files", type=int, default=2)
    sub.add_argument("--drop-superseded", action="store_true", help="only when nothing reads older copies any more")
    return top


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    spark = get_spark(f"emberlake-{args.command}")
    try:
        args.action(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
