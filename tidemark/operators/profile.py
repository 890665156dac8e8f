"""Distribution reports on a wide dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_double, quantile_name
from tidemark.operators.ranks import (
    exact_quantiles,
    group_ranges,
    quantile_columns,
    value_counts,
)
from tidemark.spec import TARGET

SUMMARY_QUANTILES = (0.01, 0.25, 0.50, 0.75, 0.99)
EDGE_DECIMALS = 12


def to_tall(df: DataFrame, columns: Sequence[str], *carry: Column) -> DataFrame:
    """One row per input row and column: ``name, value`` (DOUBLE, NaN as NULL)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), _value(df, c).alias("value")) for c in columns])
    return df.select(*carry, F.inline(pairs))


def _value(df: DataFrame, c: str) -> Column:
    """A column as DOUBLE, NaN as NULL."""
    v = as_double(F.col(c).cast("int") if dict(df.dtypes)[c] == "boolean" else F.col(c))
    return F.when(~F.isnan(v), v)


def _sketched_summary(df: DataFrame, columns: Sequence[str], accuracy: int) -> DataFrame:
    """The summary from one aggregate over the rows, without a shuffle of values."""
    parts = []
    for c in columns:
        v = _value(df, c)
        n = as_double(F.count(v))
        skew = F.when(F.min(v) == F.max(v), F.lit(0.0)).otherwise(F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(v))
        found = F.percentile_approx(v, list(SUMMARY_QUANTILES), accuracy)
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(v).alias("count"),
                F.avg(F.when(v.isNull() | (v != 0), 1.0).otherwise(0.0)).alias("nonzero"),
                F.avg(v).alias("mean"),
                F.when(n > 1, F.stddev_samp(v)).alias("std"),
                F.when(n > 2, skew).alias("skew"),
                F.min(v).alias("min"),
                *[F.get(found, F.lit(i)).alias(quantile_name(p)) for i, p in enumerate(SUMMARY_QUANTILES)],
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def dataset_summary(df: DataFrame, ids: int = 2, accuracy: int | None = None) -> DataFrame:
    """One row per column after the first ``ids``: size, moments and exact quantiles.

    Everything is computed from the distinct values of each column, so the dataset
    is read once and heavy repetition (counts, zeros) costs nothing. With ``accuracy``, quantiles come from a mergeable sketch instead: each is a
    value of the column whose rank is off by at most 1 / ``accuracy`` of the rows, and nothing is shuffled but the sketches.
    """
    columns = df.columns[ids:]
    if accuracy is not None:
        return _sketched_summary(df, columns, accuracy)
    counts = value_counts(to_tall(df, columns), "name", "value")
    ranges = group_ranges(counts, "name", "value")
    n, v = F.col("n"), F.col("value")
    d = v - F.col("mean")
    moments = (
        counts.join(F.broadcast(ranges.select("name", "mean", "low", "high")), "name", "left")
        .groupBy("name")
        .agg(
            F.sum(F.when(v.isNotNull(), n).otherwise(0)).alias("count"),
            F.sum(n).alias("rows"),
            F.sum(F.when(v.isNull() | (v != 0), n).otherwise(0)).alias("nonzero_rows"),
            F.first("mean", True).alias("mean"),
            F.first("low", True).alias("min"),
            F.first("high", True).alias("max"),
            F.sum(d * d * n).alias("m2"),
            F.sum(d * d * d * n).alias("m3"),
        )
    )
    count = as_double("count")
    std = F.when(count > 1, F.sqrt(F.col("m2") / (count - 1)))
    population = F.col("m2") / count
    skew = F.when(
        count > 2,
        F.when(F.col("min") == F.col("max"), F.lit(0.0)).otherwise(
            F.sqrt(count * (count - 1)) / (count - 2) * (F.col("m3") / count) / (population * F.sqrt(population))
        ),
    )
    quantiles = quantile_columns(
        exact_quantiles(counts, "name", "value", SUMMARY_QUANTILES), "name", SUMMARY_QUANTILES
    )
    order = F.array_position(F.array(*map(F.lit, columns)), F.col("name"))
    # one row per column on both sides
    return (
        moments.join(quantiles, "name", "left")
        .orderBy(order)
        .select(
            F.col("name").alias("column_name"),
            "count",
            (F.col("nonzero_rows") / F.col("rows")).alias("nonzero"),
            "mean",
            std.alias("std"),
            skew.alias("skew"),
            "min",
            "1pct",
            "25pct",
            "50pct",
            "75pct",
            "99pct",
            "max",
        )
    )


def churn_cohorts(
    df: DataFrame,
    metrics: Sequence[str],
    n_cohorts: int = 10,
    exclude_zeros: bool = False,
    target: str = TARGET,
    accuracy: int | None = None,
) -> DataFrame:
    """Mean and churn rate per quantile cohort of every metric, all metrics in one job.

    Cohorts are right-closed ranges between the distinct quantile edges (the lowest
    value belongs to the first cohort). A range without rows stays, with NULL means;
    a constant metric has no cohorts. With ``accuracy``, the edges come from a sketch, off by at most 1 / ``accuracy`` of the rows in
    rank, and rows are counted in their cohorts where they are read.
    """
    tall = to_tall(df, metrics, F.col(target).cast("boolean").cast("int").alias("label")).where(
        "value is not null"
    )
    if exclude_zeros:
        tall = tall.where("value <> 0")
    probabilities = [i / n_cohorts for i in range(n_cohorts + 1)]
    rounded = F.round("quantile", EDGE_DECIMALS)
    if accuracy is None:
        counts = value_counts(tall, "name", "value", churned=F.col("label"))
        quantiles = exact_quantiles(counts, "name", "value", probabilities)
    else:
        counts = tall.select("name", "value", F.lit(1).alias("n"), F.col("label").alias("churned"))
        sketch = F.percentile_approx("value", probabilities, accuracy)
        quantiles = tall.groupBy("name").agg(sketch.alias("q")).select("name", F.explode("q").alias("quantile"))
    edges = (
        quantiles.groupBy("name")
        .agg(F.array_sort(F.collect_set(rounded)).alias("edges"))  # at most n_cohorts + 1 numbers
        .where(F.size("edges") > 1)
    )
    value = F.round("value", EDGE_DECIMALS)
    below = F.size(F.filter("edges", lambda e: e < value))
    n_cohort = F.size("edges") - 1
    cohorts = (
        counts.join(F.broadcast(edges), "name")
        .select("name", n_cohort.alias("n_cohort"), (F.greatest(below, F.lit(1)) - 1).alias("cohort"), "value", "n", "churned")
        .groupBy("name", "n_cohort", "cohort")
        .agg(
            F.sum("n").alias("n_accounts"),
            (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("cohort_mean"),
            (F.sum("churned") / F.sum("n")).alias("churn_rate"),
        )
    )
    # at most n_cohorts entries per metric; the sequence puts back the empty ones
    entry = F.struct("cohort", F.struct("n_accounts", "cohort_mean", "churn_rate"))
    return (
        cohorts.groupBy("name", "n_cohort")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
        .select("name", "found", F.explode(F.sequence(F.lit(0), F.col("n_cohort") - 1)).alias("cohort"))
        .withColumn("row", F.try_element_at("found", F.col("cohort")))
        .select(
            F.col("name").alias("metric"),
            "cohort",
            F.coalesce("row.n_accounts", F.lit(0)).alias("n_accounts"),
            "row.cohort_mean",
            "row.churn_rate",
        )
        .orderBy("metric", "cohort")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from the minimum to the maximum, the last one closed on the right.

    A single-valued column gets bins over half a unit either side. Empty bins are kept.
    """
    x = F.col(column)
    bounds = df.agg(F.min(x).alias("low"), F.max(x).alias("high")).select(
        F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(F.col("low") == F.col("high"), F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    low, high = bounds.first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, n_rows bigint")
    step = (high - low) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(high)).otherwise(F.lit(low) + i * F.lit(step))

    guess = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    # rounding can put a value next to an edge on the wrong side; the edges decide
    fixed = guess - (x < edge(guess)).cast("int") + ((x >= edge(guess + 1)) & (guess < bins - 1)).cast("int")
    counted = df.where(x.isNotNull()).groupBy(fixed.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(F.broadcast(counted), "bin", "left")  # at most `bins` rows
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n_rows"),
        )
        .orderBy("bin")
    )
