"""Every operator as a named query over the test tables.

Each query takes ``(spark, folder)`` and reads whole tables. Names end in ``_e`` (event
log from the activity stream) or ``_o`` (event log from order lines). Averages and other
sums of fractions are rounded to six digits, dates are given as text, so that
two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import (
    datasets,
    evaluate,
    explain,
    grid,
    labels,
    metrics,
    prepare,
    profile,
    quality,
    score,
    train,
)
from tidemark.plans import models
from tidemark.sources import definitions
from tidemark.sources import events as ev
from tidemark.sources.storage import lasting_dir, read_dataset, release, shared_dir, stored, write_csv, write_parquet
from tidemark.spec import TARGET, ChurnSpec

Query = Callable[[SparkSession, str], DataFrame]

LOGS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], ChurnSpec]] = {
    "e": (ev.activity_events, ev.ACTIVITY_SPEC),
    "o": (ev.order_events, ev.ORDER_SPEC),
}

# A fixed score for checking the evaluation: the quieter the account, the higher.
FIXED_SCORE = "1d / (1d + 0.3d * n_total_events_last_90d + 0.5d * n_readingownedbook_last_28d)"

# Ways a cell of a text dataset can be unreadable or odd, by account_id modulo 7.
MESSY_CELL = """case cast(account_id as bigint) % 7
    when 0 then 'x' when 1 then '' when 2 then 'nan' when 3 then concat(' ', cast({c} as string), ' ')
    when 4 then cast(null as string) else cast({c} as string) end as {c}"""

# The grid that the model queries search: the operators' own.
QUERY_GRID = train.FULL_GRID


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def date_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def _scored_training(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    dataset = prepare.coerce_label(datasets.churn_training_dataset(events, spec))
    return dataset.withColumn(evaluate.SCORE, F.expr(FIXED_SCORE))


def _scored_current(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    dataset = datasets.current_customer_dataset(events, spec)
    return score.predictions(dataset.withColumn(evaluate.SCORE, F.expr(FIXED_SCORE)))


def _labelled(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    """Stored, because splitting reads it several times."""
    return stored(prepare.coerce_label(datasets.churn_training_dataset(events, spec)))


def _prepared(events: DataFrame, spec: ChurnSpec) -> prepare.Prepared:
    return _prepared_log(_log(events), spec)


def _prepared_log(log: DataFrame, spec: ChurnSpec) -> prepare.Prepared:
    """The two snapshots share the stored log and the grid."""
    shared = grid.Grid.of(log, spec)
    return prepare.prepare(
        stored(datasets.churn_training_dataset(log, spec, shared)),
        stored(datasets.current_customer_dataset(log, spec, shared)),
    )


def _trained(events: DataFrame, spec: ChurnSpec) -> tuple[prepare.Prepared, train.Trained]:
    """The model of a log, from the store below the shared folder; the first query to ask for it fits it.

    The log is made once: its name in the store and the snapshots come from one stored table of the columns that they need.
    """
    spark, log = events.sparkSession, _log(events)
    key = models.store_key(train.fingerprint(log), spec, QUERY_GRID, prepare.SEED)
    found = models.fitted(spark, f"{lasting_dir(spark, 'models')}/{key}", lambda: _prepared_log(log, spec), QUERY_GRID)
    release(log)
    return found


#: Metrics that only the table of definitions knows: a sum, a sum with a sum, a ratio of the two, another look-back.
NEW_METRICS = (
    (13, "n_reading_last_28d", "*", 28, "total_metric", "1;3", None, None),
    (14, "n_reading_and_search_last_28d", "*", 28, "total_metric", "13;5", None, None),
    (15, "share_of_reading_last_28d", "*", 28, "ratio_metric", None, 13, 14),
    (16, "n_SearchMade_last_14d", "SearchMade", 14, "basic_event_count", None, None, None),
)


def _from_definitions(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    spark = events.sparkSession
    table = definitions.definitions_frame(spark, spec)
    table = table.union(spark.createDataFrame(NEW_METRICS, definitions.DEFINITION_SCHEMA))
    path = write_csv(table.coalesce(1), shared_dir(spark))
    known = definitions.spec_with_definitions(definitions.read_definitions(spark, path), spec)
    return metrics.all_metrics(events, known).where(F.col("metric_name_id") > len(spec.definitions))


def _messy(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    dataset = datasets.current_customer_dataset(events, spec)
    return dataset.selectExpr("account_id", "metric_time", *[MESSY_CELL.format(c=c) for c in spec.features])


def _csv_roundtrip(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    spark = events.sparkSession
    back = ev.read_event_csv(spark, write_csv(events, shared_dir(spark)))
    return back.fillna(-1, ["product_id"])


def _parquet_roundtrip(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    spark = events.sparkSession
    path = write_parquet(datasets.churn_training_dataset(events, spec), shared_dir(spark))
    return date_text(read_dataset(spark, path), "observation_date")


def _dataset_csv_roundtrip(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    spark = events.sparkSession
    path = write_csv(datasets.current_customer_dataset(events, spec), shared_dir(spark))
    back = score.prepare_features(read_dataset(spark, path), spec.features)
    return back.withColumn("metric_time", F.col("metric_time").cast("timestamp_ntz"))


def _log(events: DataFrame) -> DataFrame:
    """One read of the log: what metrics and labels need of it is stored."""
    return stored(events.select("account_id", "event_time", "event_type", "product_id"))


def _stored_metrics(log: DataFrame, spec: ChurnSpec, shared: grid.Grid) -> DataFrame:
    """Both metric tables, stored, from one sweep."""
    swept = stored(metrics.sweep(log, metrics.all_counters(spec), shared))
    tables = (
        stored(metrics.event_count_metrics(log, spec, shared, swept)),
        stored(metrics.derived_metrics(log, spec, grid=shared, swept=swept)),
    )
    release(swept)
    return metrics.union_metrics(*tables)


def _from_stored_metrics(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    log = _log(events)
    shared = grid.Grid.of(log, spec)
    table = _stored_metrics(log, spec, shared)
    dataset = datasets.training_dataset_from_metrics(table, labels.observation(log, spec, shared), spec)
    return date_text(dataset, "observation_date")


def _current_from_stored_metrics(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    log = _log(events)
    table = _stored_metrics(log, spec, grid.Grid.of(log, spec))
    return datasets.current_dataset_from_metrics(table, spec)


def _model_scores(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    data, trained = _trained(events, spec)
    return score.score_current(trained.model, data.current, data.features)


def _model_metrics(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    data, trained = _trained(events, spec)
    return evaluate.binary_metrics(score.with_probability(trained.model, data.valid))


def _search(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    data, trained = _trained(events, spec)
    return trained.search_results(data.train)


def _importance(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    data, trained = _trained(events, spec)
    return train.feature_importance(trained, data.train)


def _shapley(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    data, trained = _trained(events, spec)
    return date_text(explain.shapley_values(trained.model, data.valid, data.features), "observation_date")


def _shapley_importance(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    return explain.shapley_importance(_shapley(events, spec))


def _model_facts(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    """One row of facts that hold for every fitted model, whatever its values."""
    data, trained = _trained(events, spec)
    p = F.col(evaluate.SCORE)
    scored = score.score_current(trained.model, data.current, data.features)
    current = scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(~p.between(0, 1)).alias("n_outside"),
        F.count_if((p >= evaluate.THRESHOLD).cast("int") != F.col(score.PREDICTED)).alias("n_contradicting"),
    )
    contributions = explain.shapley_values(trained.model, data.valid, data.features)
    summed = contributions.groupBy("account_id").agg(F.sum("contribution").alias("explained"))
    odds = score.with_probability(trained.model, data.valid).select("account_id", F.log(p / (1 - p)).alias("odds"))
    # contributions add up to log-odds minus one baseline, the same for all accounts
    rest = odds.join(summed, "account_id").select((F.col("odds") - F.col("explained")).alias("rest"))
    explained = rest.agg(
        F.count(F.lit(1)).alias("n_explained"), (F.max("rest") - F.min("rest") < 1e-6).alias("adds_up")
    )
    gain = train.feature_importance(trained, data.train).agg(F.round(F.sum("importance"), 6).alias("total"))
    best = trained.search_results(data.train).where(F.col("rank") == 1)
    return events.sparkSession.range(1).select(
        *[current.select(c).scalar().alias(c) for c in current.columns],
        *[explained.select(c).scalar().alias(c) for c in explained.columns],
        gain.scalar().alias("total_importance"),
        F.lit(len(trained.search)).cast("long").alias("n_candidates"),
        best.agg(F.count(F.lit(1))).scalar().alias("n_best"),
    )


SUMMARY_COLUMNS = ("nonzero", "mean", "std", "skew", "1pct", "25pct", "50pct", "75pct", "99pct")

ON_EVENTS: dict[str, Callable[[DataFrame, ChurnSpec], DataFrame]] = {
    "metric_grid": grid.metric_grid,
    "event_count_metrics": metrics.event_count_metrics,
    "total_events_90d": metrics.total_events,
    "unique_products_90d": metrics.unique_products,
    "free_content_actions": lambda e, s: metrics.sum_of_metrics(e, s, 9),
    "enhanced_reading_actions": lambda e, s: metrics.sum_of_metrics(e, s, 10),
    "owned_book_ratio": lambda e, s: metrics.ratio_of_metrics(e, s, 11),
    "downloads_per_product": lambda e, s: metrics.ratio_of_metrics(e, s, 12),
    "metric_derived": metrics.derived_metrics,
    "all_metrics": metrics.all_metrics,
    "metrics_from_definitions": _from_definitions,
    "observation": lambda e, s: date_text(labels.observation(e, s), "observation_date"),
    "metric_snapshot": datasets.metric_snapshot,
    "latest_metric_time": datasets.latest_metric_time,
    "churn_training_dataset": lambda e, s: date_text(
        datasets.churn_training_dataset(e, s), "observation_date"
    ),
    "training_dataset_from_metrics": _from_stored_metrics,
    "current_customer_dataset": datasets.current_customer_dataset,
    "current_dataset_from_metrics": _current_from_stored_metrics,
    "events_per_account_per_month": lambda e, s: rounded(
        quality.events_per_account_per_month(e),
        "events_per_account",
        "n_months",
        "events_per_account_per_month",
    ),
    "metric_coverage": lambda e, s: rounded(
        quality.metric_coverage(metrics.event_count_metrics(e, s), e, s), "pcnt_with_metric", "avg_value"
    ),
    "metric_stats_over_time": lambda e, s: rounded(
        quality.metric_stats_over_time(metrics.metric_times(e, s), s), "avg_metric_value"
    ),
    "metric_qa_series": lambda e, s: rounded(
        quality.metric_qa_series(metrics.metric_times(e, s), s), "avg_value"
    ),
    "daily_event_counts": lambda e, s: date_text(
        quality.daily_event_counts(e, s.event_types), "event_date"
    ),
    "dataset_summary": lambda e, s: rounded(
        profile.dataset_summary(datasets.churn_training_dataset(e, s)), *SUMMARY_COLUMNS
    ),
    "churn_cohorts": lambda e, s: rounded(
        profile.churn_cohorts(datasets.churn_training_dataset(e, s), s.features), "cohort_mean", "churn_rate"
    ),
    "churn_cohorts_without_zeros": lambda e, s: rounded(
        profile.churn_cohorts(datasets.churn_training_dataset(e, s), s.features, exclude_zeros=True),
        "cohort_mean",
        "churn_rate",
    ),
    "coerced_features": lambda e, s: prepare.coerce_features(_messy(e, s), s.features),
    "stratified_split": lambda e, s: prepare.assign_split(_labelled(e, s)).select("account_id", TARGET, "split"),
    "cv_folds": lambda e, s: prepare.assign_folds(_labelled(e, s)).select("account_id", TARGET, "fold"),
    "preprocess_metadata": lambda e, s: prepare.preprocess_metadata(_prepared(e, s)),
    "confusion_matrix": lambda e, s: evaluate.confusion_matrix(_scored_training(e, s)),
    "binary_metrics": lambda e, s: rounded(
        evaluate.binary_metrics(_scored_training(e, s)), "roc_auc", "accuracy", "precision", "recall"
    ),
    "classification_report": lambda e, s: rounded(
        evaluate.classification_report(_scored_training(e, s)), "precision", "recall", "f1_score"
    ),
    "roc_auc": lambda e, s: rounded(evaluate.roc_auc(_scored_training(e, s)), "roc_auc"),
    "roc_curve": lambda e, s: rounded(
        evaluate.roc_curve(_scored_training(e, s)), "threshold", "fpr", "tpr"
    ),
    "predictions": lambda e, s: rounded(_scored_current(e, s), evaluate.SCORE),
    "score_histogram": lambda e, s: rounded(
        profile.histogram(_scored_current(e, s), evaluate.SCORE), "bin_start", "bin_end"
    ),
    "score_summary": lambda e, s: rounded(
        score.score_summary(_scored_current(e, s)),
        "mean_churn_probability",
        "median_churn_probability",
        "min_churn_probability",
        "max_churn_probability",
    ),
    "top_risk": lambda e, s: rounded(score.top_risk(_scored_current(e, s)), evaluate.SCORE),
    "event_csv_roundtrip": _csv_roundtrip,
    "parquet_export_roundtrip": _parquet_roundtrip,
    "csv_export_roundtrip": _dataset_csv_roundtrip,
}

# Fitted models. SQL can state the facts, not the values.
ON_MODELS: dict[str, Callable[[DataFrame, ChurnSpec], DataFrame]] = {
    "model_facts": _model_facts,
    "trained_model_scores": _model_scores,
    "trained_model_metrics": _model_metrics,
    "grid_search_results": _search,
    "feature_importance": _importance,
    "shapley_values": _shapley,
    "shapley_importance": _shapley_importance,
}


def _bind(make: Callable[[DataFrame, ChurnSpec], DataFrame], log: str) -> Query:
    load, spec = LOGS[log]
    return lambda spark, folder: make(load(spark, folder), spec)


def all_queries() -> dict[str, Query]:
    out = {f"{name}_{log}": _bind(make, log) for name, make in ON_EVENTS.items() for log in LOGS}
    return out | {f"{name}_o": _bind(make, "o") for name, make in ON_MODELS.items()}
