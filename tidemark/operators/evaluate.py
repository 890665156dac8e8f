"""Quality of a binary score: frames hold one row per account with a 0/1 label and a score in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_divide
from tidemark.operators.ranks import range_buckets, running_totals
from tidemark.spec import TARGET

THRESHOLD = 0.5
SCORE = "churn_probability"


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_divide(numerator, denominator), F.lit(0.0))


def confusion_counts(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """One row: ``tn, fp, fn, tp``."""
    actual, predicted = F.col(label) == 1, F.col(score) >= THRESHOLD
    return scored.agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )


def confusion_matrix(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """``actual, predicted, n``: always all four cells."""
    return confusion_counts(scored, label, score).selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, n)"
    )


def classification_report(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, plain and weighted means.

    Undefined ratios are 0. The accuracy row repeats the accuracy in every column.
    """
    c = confusion_counts(scored, label, score)

    def row(name: str, hit: str, predicted: str, actual: str) -> list[Column]:
        p = _or_zero(F.expr(hit), F.expr(predicted))
        r = _or_zero(F.expr(hit), F.expr(actual))
        f = _or_zero(F.expr(f"2 * {hit}"), F.expr(f"{predicted} + {actual}"))
        return [p.alias(f"p{name}"), r.alias(f"r{name}"), f.alias(f"f{name}"), F.expr(f"{actual} as s{name}")]

    per_class = c.select(
        *row("0", "tn", "(tn + fn)", "(tn + fp)"),
        *row("1", "tp", "(tp + fp)", "(tp + fn)"),
        _or_zero(F.expr("tn + tp"), F.expr("tn + fp + fn + tp")).alias("acc"),
    )

    def weighted(x: str) -> str:
        return f"coalesce(try_divide({x}0 * s0 + {x}1 * s1, s0 + s1), 0d)"

    return per_class.selectExpr(
        "stack(5, "
        "'0', p0, r0, f0, s0, "
        "'1', p1, r1, f1, s1, "
        "'accuracy', acc, acc, acc, s0 + s1, "
        "'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1, "
        f"'weighted avg', {weighted('p')}, {weighted('r')}, {weighted('f')}, s0 + s1"
        ") as (class, precision, recall, f1_score, support)"
    )


def _by_score(scored: DataFrame, label: str, score: str, descending: bool) -> DataFrame:
    """Positives and negatives per distinct score (stored when called), with running totals in score order."""
    steps = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    steps = range_buckets(steps, "score")
    if descending:
        steps = steps.withColumn("bucket", -F.col("bucket"))
    order = F.col("score").desc() if descending else F.col("score").asc()
    return running_totals(steps, "bucket", order, ["pos", "neg"])


def roc_auc(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """One row ``roc_auc``: chance that a positive outranks a negative, ties counting half; NULL with one class."""
    steps = _by_score(scored, label, score, descending=False)
    below = F.col("neg_upto") - F.col("neg")
    wide = "decimal(19,0)"  # products of counts outgrow 64 bits
    wins = F.sum(F.col("pos").cast(wide) * (2 * below + F.col("neg")).cast(wide))
    pairs = F.sum("pos").cast(wide) * F.sum("neg").cast(wide)
    return steps.agg(safe_divide(wins, 2 * pairs.cast("double")).alias("roc_auc"))


def roc_curve(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """``threshold, fpr, tpr`` at every distinct score, highest first, after the point (0, 0)."""
    totals = scored.agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q")
    )
    points = (
        _by_score(scored, label, score, descending=True)
        .withColumn("all_pos", totals.select("p").scalar())
        .withColumn("all_neg", totals.select("q").scalar())
        .select(
            F.col("score").alias("threshold"),
            safe_divide(F.col("neg_upto"), F.col("all_neg")).alias("fpr"),
            safe_divide(F.col("pos_upto"), F.col("all_pos")).alias("tpr"),
        )
    )
    start = scored.sparkSession.range(1).selectExpr("double('inf') as threshold", "0d as fpr", "0d as tpr")
    return start.unionByName(points).orderBy(F.desc("threshold"))


def binary_metrics(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """One row: ``roc_auc, accuracy, precision, recall`` (0 where undefined, AUC NULL)."""
    return confusion_counts(scored, label, score).select(
        roc_auc(scored, label, score).scalar().alias("roc_auc"),
        _or_zero(F.expr("tp + tn"), F.expr("tp + tn + fp + fn")).alias("accuracy"),
        _or_zero(F.expr("tp"), F.expr("tp + fp")).alias("precision"),
        _or_zero(F.expr("tp"), F.expr("tp + fn")).alias("recall"),
    )
