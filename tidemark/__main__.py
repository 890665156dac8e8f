"""Command line: ``python -m tidemark <step> …`` (or through spark-submit).

build       event log (CSV or Parquet) to metric, label and feature tables
preprocess  feature tables to coerced train / valid / current data
train       grid search, evaluation reports, stored model
score       predictions, histogram and summary for the current accounts
explain     contributions per account and feature on the validation rows
summary     distribution of every column of a dataset
cohorts     churn rate per quantile cohort of every feature
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import profile
from tidemark.operators.prepare import SEED, TEST_SIZE, Prepared, coerce_features
from tidemark.operators.train import FULL_GRID
from tidemark.plans import pipeline
from tidemark.sources.definitions import read_definitions, spec_with_definitions
from tidemark.sources.events import as_event_log, read_event_csv, read_event_table
from tidemark.sources.storage import read_dataset, read_json, write_csv
from tidemark.spec import DEFAULT_SPEC, TARGET


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    steps = parser.add_subparsers(dest="step", required=True)

    build = steps.add_parser("build")
    log = build.add_mutually_exclusive_group(required=True)
    log.add_argument("--events", help="CSV or Parquet path")
    log.add_argument("--events-table", help="name in the session's catalog")
    build.add_argument("--definitions", help="CSV table of metric definitions")
    build.add_argument("--database", help="enter tables and views into this database")
    build.add_argument("--out", required=True)
    build.add_argument("--cutoff", type=dt.date.fromisoformat, default=DEFAULT_SPEC.cutoff)
    build.add_argument("--multi-line", action="store_true")

    preprocess = steps.add_parser("preprocess")
    preprocess.add_argument("--train-path", required=True)
    preprocess.add_argument("--current-path", required=True)
    preprocess.add_argument("--output-dir", required=True)
    preprocess.add_argument("--test-size", type=float, default=TEST_SIZE)
    preprocess.add_argument("--random-state", type=int, default=SEED)

    train = steps.add_parser("train")
    train.add_argument("--processed-dir", required=True)
    train.add_argument("--out", required=True)
    train.add_argument("--grid", type=json.loads, default=FULL_GRID, help="JSON: parameter to list of values")

    for name in ("score", "explain"):
        step = steps.add_parser(name)
        step.add_argument("--processed-dir", required=True)
        step.add_argument("--out", required=True)

    for name in ("summary", "cohorts"):
        step = steps.add_parser(name)
        step.add_argument("--path", required=True)
        step.add_argument("--out", required=True)
    step.add_argument("--cohorts", type=int, default=10)
    step.add_argument("--exclude-zeros", action="store_true")
    return parser


def _events(spark: SparkSession, args) -> DataFrame:
    if args.events_table:
        return read_event_table(spark, args.events_table)
    if args.events.lower().endswith(".csv"):
        return read_event_csv(spark, args.events, multi_line=args.multi_line)
    return as_event_log(spark.read.parquet(args.events))


def _dataset(spark: SparkSession, path: str) -> DataFrame:
    """A wide dataset; columns read as text become numbers, except the two ids and the label."""
    df = read_dataset(spark, path)
    text = [c for c, t in df.dtypes[2:] if t == "string" and c != TARGET]
    df = coerce_features(df, text)
    return df.withColumn(TARGET, df[TARGET].cast("boolean")) if TARGET in df.columns else df


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tidemark-{args.step}").getOrCreate()
    if args.step == "build":
        spec = DEFAULT_SPEC.at(args.cutoff)
        if args.definitions:
            spec = spec_with_definitions(read_definitions(spark, args.definitions), spec)
        marts = pipeline.build_marts(_events(spark, args), spec, args.out, args.database)
        pipeline.export_csv(marts, f"{args.out}/exports")
    elif args.step == "preprocess":
        pipeline.prepare_data(
            read_dataset(spark, args.train_path),
            read_dataset(spark, args.current_path),
            args.output_dir,
            test_size=args.test_size,
            seed=args.random_state,
        )
    elif args.step == "train":
        parts = [spark.read.parquet(f"{args.processed_dir}/{n}") for n in ("train", "valid", "current")]
        data = Prepared(*parts, read_json(spark, f"{args.processed_dir}/feature_columns.json"))
        _, report = pipeline.train_and_evaluate(data, args.out, args.grid)
        print(json.dumps(report, indent=2))
    elif args.step == "score":
        current = read_dataset(spark, f"{args.processed_dir}/current")
        print(json.dumps(pipeline.score_and_report(spark, current, args.out), indent=2))
    elif args.step == "explain":
        pipeline.explain_model(spark, read_dataset(spark, f"{args.processed_dir}/valid"), args.out).show()
    elif args.step == "summary":
        write_csv(profile.dataset_summary(_dataset(spark, args.path)), args.out)
    elif args.step == "cohorts":
        df = _dataset(spark, args.path)
        features = [c for c in df.columns[2:] if c != TARGET]
        write_csv(profile.churn_cohorts(df, features, args.cohorts, args.exclude_zeros), args.out)


if __name__ == "__main__":
    main()
