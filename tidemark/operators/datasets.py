"""Wide feature tables: one row per labelled or per current account.

Each table can be built straight from the event log (only the one window it needs
is read) or from a stored tall metric table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import timestamp_literal
from tidemark.operators.grid import Grid
from tidemark.operators.labels import observation
from tidemark.operators.metrics import all_counters, counters_at, find_measured_time, last_measured_time
from tidemark.spec import CURRENT_IDS, TARGET, TRAIN_IDS, ChurnSpec


def metric_snapshot(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """One row: the last measured time not after the cut-off."""
    return last_measured_time(events, spec, spec.cutoff, grid)


def latest_metric_time(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """One row: the last measured time."""
    return last_measured_time(events, spec, grid=grid)


def churn_training_dataset(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """Labels with the features at the snapshot; accounts without any metric there get zeros."""
    grid = grid or Grid.of(events, spec)
    counters = all_counters(spec)
    snapshot = find_measured_time(events, spec, spec.cutoff, grid)
    features = counters_at(events, counters, snapshot).select("account_id", *counters.features())
    return _onto_labels(observation(events, spec, grid), features, spec)


def current_customer_dataset(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """Accounts with any metric at the last measured time, and their features."""
    counters = all_counters(spec)
    latest = find_measured_time(events, spec, grid=grid)
    time = timestamp_literal(latest) if latest else F.lit(None).cast("timestamp_ntz")
    return counters_at(events, counters, latest).select(
        "account_id", time.alias("metric_time"), *counters.features()
    )


# --- from a stored tall table ------------------------------------------------------


def measured_time(metrics: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    rows = metrics if cutoff is None else metrics.where(F.col("metric_time") <= F.lit(cutoff).cast("timestamp_ntz"))
    return rows.agg(F.max("metric_time").alias("metric_time"))


def pivot_metrics(metrics: DataFrame, spec: ChurnSpec, *keys: str) -> DataFrame:
    """Tall to wide, one column per feature, in a single aggregation."""

    def feature(i: int) -> Column:
        value = F.max(F.when(F.col("metric_name_id") == i, F.col("metric_value")))
        return F.coalesce(value, F.lit(0.0)).alias(spec.by_id[i].feature)

    return metrics.groupBy(*keys).agg(*[feature(i) for i in spec.feature_order])


def training_dataset_from_metrics(metrics: DataFrame, labels: DataFrame, spec: ChurnSpec) -> DataFrame:
    (snapshot,) = measured_time(metrics, spec.cutoff).first()
    features = pivot_metrics(_measured_at(metrics, snapshot), spec, "account_id")
    return _onto_labels(labels.where(F.col("observation_date") == F.lit(spec.cutoff)), features, spec)


def current_dataset_from_metrics(metrics: DataFrame, spec: ChurnSpec) -> DataFrame:
    (latest,) = measured_time(metrics).first()
    return pivot_metrics(_measured_at(metrics, latest), spec, *CURRENT_IDS)


def _measured_at(metrics: DataFrame, at: dt.datetime | None) -> DataFrame:
    """A literal time, so that the filter skips row groups of a stored table."""
    return metrics.where(F.col("metric_time") == timestamp_literal(at) if at else F.lit(False))


def _onto_labels(labels: DataFrame, features: DataFrame, spec: ChurnSpec) -> DataFrame:
    """Both sides hold one row per account, so the join cannot fan out."""
    return labels.join(features, "account_id", "left").select(
        *TRAIN_IDS, TARGET, *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in spec.features]
    )
