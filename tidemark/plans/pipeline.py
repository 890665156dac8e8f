"""The whole flow: event log to stored marts, marts to model, model to scores and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import sql_text
from tidemark.operators import evaluate, explain, prepare, profile, quality, score
from tidemark.operators.datasets import current_dataset_from_metrics, training_dataset_from_metrics
from tidemark.operators.grid import Grid
from tidemark.operators.labels import observation
from tidemark.operators.metrics import all_counters, sweep, union_metrics, unpivot
from tidemark.operators.train import FULL_GRID, Trained, feature_importance, train_model
from tidemark.sources.storage import (
    load_model,
    qualified,
    read_json,
    save_model,
    stored,
    write_csv,
    write_json,
    write_metric_table,
    write_parquet,
)
from tidemark.spec import TARGET, ChurnSpec


@dataclass(frozen=True)
class Marts:
    metric: DataFrame
    metric_derived: DataFrame
    all_metrics: DataFrame
    observation: DataFrame
    training: DataFrame
    current: DataFrame
    metric_stats: DataFrame


def build_marts(events: DataFrame, spec: ChurnSpec, out: str, database: str | None = None) -> Marts:
    """Write the metric, label and feature tables below ``out``; the union and its statistics become views.

    The log is swept once: the counters are stored wide, and both metric tables are read off them. With ``database``, tables and
    views are also entered into that database of the catalog, where other sessions find them.
    """
    spark = events.sparkSession
    grid = Grid.of(events, spec)

    def table(name: str, df: DataFrame, write=write_parquet) -> DataFrame:
        return spark.read.schema(df.schema).parquet(write(df, f"{out}/{name}"))

    counters = all_counters(spec)
    values, n_base = counters.values(), len(counters.base)
    wide = stored(sweep(events, counters, grid))
    metric = table("metric", unpivot(wide, values[:n_base]), write_metric_table)
    derived = table("metric_derived", unpivot(wide, values[n_base:]), write_metric_table)
    metrics = union_metrics(metric, derived)
    labels = table("observation", observation(events, spec, grid))
    training = table("churn_training_dataset", training_dataset_from_metrics(metrics, labels, spec))
    current = table("current_customer_dataset", current_dataset_from_metrics(metrics, spec))
    statistics = quality.metric_stats_over_time(metrics, spec)
    metrics.createOrReplaceTempView("all_metrics")
    statistics.createOrReplaceTempView("metric_stats_over_time")
    marts = Marts(metric, derived, metrics, labels, training, current, statistics)
    if database is not None:
        register_marts(marts, spec, out, database)
    return marts


def register_marts(marts: Marts, spec: ChurnSpec, out: str, database: str) -> None:
    """Tables over the files below ``out``, and the views ``all_metrics`` and ``metric_stats_over_time`` over those."""
    spark = marts.metric.sparkSession
    place = qualified(spark, out)
    names = {"metric": "metric", "metric_derived": "metric_derived", "observation": "observation"}
    names |= {"training": "churn_training_dataset", "current": "current_customer_dataset"}
    spark.sql(f"create database if not exists `{database}`")
    for field, name in names.items():
        df = getattr(marts, field)
        by_time = "partitioned by (metric_time)" if field in ("metric", "metric_derived") else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"drop table if exists `{database}`.`{name}`")  # an external table: its files stay
        spark.sql(f"create table `{database}`.`{name}` ({columns}) using parquet {by_time} location {sql_text(f'{place}/{name}')}")
        if by_time:
            spark.sql(f"alter table `{database}`.`{name}` recover partitions")
    keys = "account_id, metric_time, metric_name_id, cast(metric_value as double) as metric_value"
    spark.sql(
        f"""create or replace view `{database}`.all_metrics as
        select {keys} from `{database}`.metric union all select {keys} from `{database}`.metric_derived"""
    )
    titles = ", ".join(f"({d.metric_name_id}, {sql_text(d.metric_name)})" for d in spec.definitions)
    spark.sql(
        f"""create or replace view `{database}`.metric_stats_over_time as
        select metric_name, count(distinct metric_time) as n_metric_dates, min(metric_time) as earliest_metric,
          max(metric_time) as latest_metric, min(metric_value) as min_metric_value,
          avg(metric_value) as avg_metric_value, max(metric_value) as max_metric_value
        from `{database}`.all_metrics join values {titles} as names(metric_name_id, metric_name) using (metric_name_id)
        group by metric_name order by metric_name"""
    )


def export_csv(marts: Marts, out: str) -> None:
    write_csv(marts.training, f"{out}/churn_training_dataset_csv")
    write_csv(marts.current, f"{out}/current_customer_dataset_csv")


def prepare_data(training: DataFrame, current: DataFrame, out: str, **options) -> prepare.Prepared:
    """Write the coerced splits, the feature list and the metadata."""
    spark = training.sparkSession
    p = prepare.prepare(training, current, **options)
    names = ("train", "valid", "current")
    frames = [
        spark.read.schema(df.schema).parquet(write_parquet(df, f"{out}/{name}"))
        for name, df in zip(names, (p.train, p.valid, p.current), strict=True)
    ]
    written = prepare.Prepared(*frames, p.features)
    write_json(spark, p.features, f"{out}/feature_columns.json")
    metadata = prepare.preprocess_metadata(written).first().asDict()
    write_json(spark, metadata | {"feature_columns": p.features}, f"{out}/preprocess_metadata.json")
    return written


def train_and_evaluate(
    data: prepare.Prepared, out: str, grid: Mapping[str, Sequence] = FULL_GRID
) -> tuple[Trained, dict]:
    """Train, evaluate on the validation rows, and write model and reports.

    The search is kept below ``out``: a run that was stopped goes on where it was.
    """
    spark = data.train.sparkSession
    trained = train_model(data.train, data.features, grid, folder=f"{out}/searches")
    scored = score.with_probability(trained.model, data.valid).select(TARGET, evaluate.SCORE).persist()
    try:
        report = evaluate.binary_metrics(scored).first().asDict()
        cells = evaluate.confusion_matrix(scored).orderBy("actual", "predicted").collect()  # four rows
        report["confusion_matrix"] = [[c["n"] for c in cells if c["actual"] == a] for a in (0, 1)]
        report["classification_report"] = report_document(evaluate.classification_report(scored))
        write_parquet(evaluate.roc_curve(scored), f"{out}/reports/roc_curve")
    finally:
        scored.unpersist()
    report["best_params"] = trained.best_params
    report["best_cv_roc_auc"] = trained.best_cv_roc_auc
    write_csv(feature_importance(trained, data.train), f"{out}/reports/feature_importance")
    save_model(trained.model, f"{out}/models/churn_model")
    write_json(spark, trained.features, f"{out}/models/feature_columns.json")
    write_json(spark, report, f"{out}/reports/training_metrics.json")
    return trained, report


def report_document(report: DataFrame) -> dict[str, object]:
    """The classification report as a nested document: per class and mean its four numbers, the accuracy as one number."""
    keys = {"precision": "precision", "recall": "recall", "f1_score": "f1-score", "support": "support"}
    rows = report.collect()  # five of them
    return {
        r["class"]: r["precision"] if r["class"] == "accuracy" else {name: r[c] for c, name in keys.items()} for r in rows
    }


def score_and_report(spark: SparkSession, current: DataFrame, out: str) -> dict:
    """Score the current accounts with the stored model; write predictions, histogram and summary."""
    model = load_model(f"{out}/models/churn_model")
    features = read_json(spark, f"{out}/models/feature_columns.json")
    path = write_parquet(score.score_current(model, current, features), f"{out}/predictions")
    predicted = spark.read.parquet(path)
    table = write_csv(predicted.orderBy(F.desc(evaluate.SCORE)), f"{out}/predictions_csv")
    histogram = profile.histogram(predicted, evaluate.SCORE)
    summary = score.score_summary(predicted).first().asDict() | {
        "prediction_output_path": path,
        "prediction_csv_path": table,
        "histogram_output_path": write_parquet(histogram, f"{out}/reports/probability_histogram"),
    }
    write_json(spark, summary, f"{out}/reports/scoring_summary.json")
    return summary


def explain_model(spark: SparkSession, valid: DataFrame, out: str) -> DataFrame:
    """Contributions on the validation rows; writes them and the importance table."""
    model = load_model(f"{out}/models/churn_model")
    features = read_json(spark, f"{out}/models/feature_columns.json")
    path = write_parquet(explain.shapley_values(model, valid, features), f"{out}/reports/contributions")
    importance = explain.shapley_importance(spark.read.parquet(path))
    write_csv(importance, f"{out}/reports/contribution_importance")
    return importance


def run(
    events: DataFrame, spec: ChurnSpec, out: str, grid: Mapping[str, Sequence] = FULL_GRID, database: str | None = None
) -> dict:
    """Everything, below one output folder."""
    spark = events.sparkSession
    marts = build_marts(events, spec, f"{out}/marts", database)
    export_csv(marts, f"{out}/exports")
    data = prepare_data(marts.training, marts.current, f"{out}/processed")
    _, report = train_and_evaluate(data, out, grid)
    summary = score_and_report(spark, data.current, out)
    explain_model(spark, data.valid, out)
    return {"training": report, "scoring": summary}
