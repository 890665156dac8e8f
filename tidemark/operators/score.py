"""Scoring current accounts and reporting on the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.schema import expect_columns
from tidemark.operators.evaluate import SCORE, THRESHOLD
from tidemark.operators.prepare import coerce_features
from tidemark.operators.ranks import exact_quantiles, value_counts
from tidemark.spec import CURRENT_IDS

PREDICTED = "predicted_is_churn"


def prepare_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All features must be there (extra columns are fine) and are read as numbers."""
    expect_columns(df, features, "current table")
    return coerce_features(df, features)


def with_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds the probability of churn."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(SCORE))


def predictions(scored: DataFrame, ids: Sequence[str] = CURRENT_IDS) -> DataFrame:
    """Ids that exist, probability and 0/1 prediction, riskiest first."""
    kept = [c for c in ids if c in scored.columns]
    return scored.select(*kept, SCORE, (F.col(SCORE) >= THRESHOLD).cast("int").alias(PREDICTED)).orderBy(
        F.desc(SCORE), *kept
    )


def score_current(model: PipelineModel, current: DataFrame, features: Sequence[str]) -> DataFrame:
    return predictions(with_probability(model, prepare_features(current, features)))


def score_summary(predicted: DataFrame) -> DataFrame:
    """One row: number scored, mean, median, lowest and highest probability, number predicted to churn."""
    counts = value_counts(predicted.select(F.lit(0).alias("all"), SCORE), "all", SCORE)
    median = exact_quantiles(counts, "all", SCORE, [0.5]).select("quantile")
    return predicted.agg(
        F.count(F.lit(1)).alias("n_customers_scored"),
        F.avg(SCORE).alias("mean_churn_probability"),
        F.min(SCORE).alias("min_churn_probability"),
        F.max(SCORE).alias("max_churn_probability"),
        F.count_if(F.col(SCORE) >= THRESHOLD).alias("n_predicted_churn_at_0_5"),
    ).select(
        "n_customers_scored",
        "mean_churn_probability",
        median.scalar().alias("median_churn_probability"),
        "min_churn_probability",
        "max_churn_probability",
        "n_predicted_churn_at_0_5",
    )


def top_risk(predicted: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` riskiest accounts."""
    ids = [c for c in CURRENT_IDS if c in predicted.columns]
    return predicted.orderBy(F.desc(SCORE), *ids).limit(n)
