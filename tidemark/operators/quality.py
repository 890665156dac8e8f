"""Checks and reports on the event log and the metrics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_double, safe_divide
from tidemark.operators.grid import complete, log_bounds
from tidemark.spec import ChurnSpec

MONTH_DAYS = 28.0


def metric_names(spark: SparkSession, spec: ChurnSpec) -> DataFrame:
    """``metric_name_id, metric_name``: as many rows as the spec has definitions."""
    return spark.createDataFrame(
        [(d.metric_name_id, d.metric_name) for d in spec.definitions], "metric_name_id int, metric_name string"
    )


def events_per_account_per_month(events: DataFrame) -> DataFrame:
    """Events of each type per account and 28-day month of the log. Missing mandatory values fail the job."""
    n_account = events.agg(F.count_distinct("account_id")).scalar()
    per_type = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_event"), F.min("event_time").alias("first"), F.max("event_time").alias("last")
    )
    # one row per event type from here on
    everything = Window.partitionBy()
    days = F.datediff(
        F.to_date(F.max("last").over(everything)), F.to_date(F.min("first").over(everything))
    )
    rate = safe_divide(F.col("n_event"), F.col("n_account"))
    return (
        per_type.withColumn("n_account", n_account)
        .withColumn("n_months", days / F.lit(MONTH_DAYS))
        .where(complete(events))
        .select(
            "event_type",
            "n_account",
            "n_event",
            rate.alias("events_per_account"),
            "n_months",
            safe_divide(rate, F.col("n_months")).alias("events_per_account_per_month"),
        )
        .orderBy(F.desc_nulls_first("events_per_account_per_month"))
    )


def metric_coverage(metric: DataFrame, events: DataFrame, spec: ChurnSpec) -> DataFrame:
    """Share of all accounts that have each base metric, and the range of its values and times."""
    value = F.col("metric_value")
    per_account = metric.groupBy("account_id", "metric_name_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.min("metric_time").alias("first"),
        F.max("metric_time").alias("last"),
    )
    per_metric = per_account.groupBy("metric_name_id").agg(
        F.count(F.lit(1)).alias("count_with_metric"),
        (as_double(F.sum("total")) / F.sum("n")).alias("avg_value"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        F.min("first").alias("earliest_metric"),
        F.max("last").alias("latest_metric"),
    )
    n_account = events.agg(F.count_distinct("account_id")).scalar()
    return (
        per_metric.join(F.broadcast(metric_names(events.sparkSession, spec)), "metric_name_id")
        .withColumn("n_account", n_account)
        .select(
            "metric_name",
            "n_account",
            "count_with_metric",
            safe_divide(F.col("count_with_metric"), F.col("n_account")).alias("pcnt_with_metric"),
            "avg_value",
            "min_value",
            "max_value",
            "earliest_metric",
            "latest_metric",
        )
        .orderBy(F.desc_nulls_first("pcnt_with_metric"))
    )


def _per_time(metrics: DataFrame) -> DataFrame:
    """At most one row per metric and grid time; map-side combine does nearly all the work.

    ``metrics`` is a table of single values, or already what ``metric_times`` gives.
    """
    if "n_calc" in metrics.columns:
        return metrics
    value = F.col("metric_value")
    return metrics.groupBy("metric_name_id", "metric_time").agg(
        F.count(F.lit(1)).alias("n_calc"),
        as_double(F.sum(value)).alias("total"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def metric_stats_over_time(metrics: DataFrame, spec: ChurnSpec) -> DataFrame:
    """Per metric: number of measured times, their range, and the range of the values."""
    return (
        _per_time(metrics)
        .groupBy("metric_name_id")
        .agg(
            F.count(F.lit(1)).alias("n_metric_dates"),
            F.min("metric_time").alias("earliest_metric"),
            F.max("metric_time").alias("latest_metric"),
            F.min("min_value").alias("min_metric_value"),
            (F.sum("total") / F.sum("n_calc")).alias("avg_metric_value"),
            F.max("max_value").alias("max_metric_value"),
        )
        .join(F.broadcast(metric_names(metrics.sparkSession, spec)), "metric_name_id")
        .select(
            "metric_name",
            "n_metric_dates",
            "earliest_metric",
            "latest_metric",
            "min_metric_value",
            "avg_metric_value",
            "max_metric_value",
        )
        .orderBy("metric_name")
    )


def metric_qa_series(metrics: DataFrame, spec: ChurnSpec) -> DataFrame:
    """Per metric and time: value range and number of accounts, the series behind the QA plots."""
    return (
        _per_time(metrics)
        .join(F.broadcast(metric_names(metrics.sparkSession, spec)), "metric_name_id")
        .select(
            "metric_name",
            "metric_time",
            (F.col("total") / F.col("n_calc")).alias("avg_value"),
            "min_value",
            "max_value",
            "n_calc",
        )
        .orderBy("metric_name", "metric_time")
    )


def daily_event_counts(events: DataFrame, event_types: Iterable[str]) -> DataFrame:
    """Events per type and calendar day of the log, zero-filled, all types in one job."""
    types = list(event_types)
    one_day = F.expr("interval 1 day")
    calendar = (
        log_bounds(events)
        .select(F.explode(F.sequence("first_day", "last_day", one_day)).alias("event_date"))
        .select("event_date", F.explode(F.array(*map(F.lit, types))).alias("event_type"))
    )
    counts = (
        events.where(F.col("event_type").isin(types))
        .groupBy("event_type", F.to_date("event_time").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("n_event"))
    )
    return (
        calendar.join(counts, ["event_type", "event_date"], "left")
        .select("event_type", "event_date", F.coalesce("n_event", F.lit(0)).alias("n_event"))
        .orderBy("event_type", "event_date")
    )
