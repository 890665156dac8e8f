"""From feature tables to model input."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import label_to_int, numeric_or_zero
from tidemark.functions.schema import expect_columns
from tidemark.operators.ranks import hash_cuts, hash_key
from tidemark.sources.storage import stored
from tidemark.spec import CURRENT_IDS, TARGET, TRAIN_IDS

SEED = 42
TEST_SIZE = 0.2


def feature_columns(train: DataFrame, current: DataFrame, target: str = TARGET) -> list[str]:
    """Features of the training table, which must be exactly those of the current table."""
    expect_columns(train, [target], "training table")
    features = [c for c in train.columns if c not in {*TRAIN_IDS, target}]
    expect_columns(current, features, "current table", allowed=CURRENT_IDS)
    return features


def coerce_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as numbers, everything unreadable or missing as 0; other columns unchanged."""
    chosen = set(features)
    return df.select(*[numeric_or_zero(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def coerce_label(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Label as 0 or 1; a label that is missing or anything else fails the job."""
    expect_columns(df, [target], "training table")
    return df.withColumn(target, label_to_int(target))


def split_sizes(df: DataFrame, test_size: float, target: str = TARGET) -> DataFrame:
    """Per class, how many rows go to validation.

    Validation takes ``ceil(test_size * n)`` rows. The training rows are shared out in
    proportion to the classes, left-over rows to the largest remainders (the smaller
    label first on a tie); validation takes the rest of each class.
    """
    # one row per class throughout
    classes = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return classes.selectExpr(target, "n", "sum(n) over () as total").selectExpr(
        target, "n", f"total - cast(ceil({test_size}d * total) as bigint) as n_train", "total"
    ).selectExpr(
        target, "n", "n_train", "cast(cast(n as decimal(19,0)) * cast(n_train as decimal(19,0)) div total as bigint) as share",
        "cast(n as decimal(19,0)) * cast(n_train as decimal(19,0)) % total as remainder"
    ).selectExpr(
        target,
        "n",
        "share + if(row_number() over (order by remainder desc, "
        f"{target}) <= n_train - sum(share) over (), 1, 0) as n_train",
    ).selectExpr(
        target,
        "0 as cut_no",
        "if(n < 2, raise_error('every class needs at least two rows'), n - n_train) as size",
    )


def assign_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    ids: Sequence[str] = TRAIN_IDS,
    target: str = TARGET,
) -> DataFrame:
    """Adds ``split`` ('train' or 'valid'): stratified, exact class sizes, the same on every run.

    The first rows of each class in hash order of the ids go to validation. The
    ids must identify a row.
    """
    keyed = df.withColumn("_key", hash_key(seed, ids))
    cuts = hash_cuts(keyed, split_sizes(df, test_size, target), target, "_key").select(target, "cut")
    valid = F.coalesce(F.col("_key") <= F.col("cut"), F.lit(False))
    return keyed.join(F.broadcast(cuts), target, "left").select(  # one cut per class
        *df.columns, F.when(valid, "valid").otherwise("train").alias("split")
    )


def assign_folds(
    df: DataFrame, folds: int = 3, seed: int = SEED, ids: Sequence[str] = TRAIN_IDS, target: str = TARGET
) -> DataFrame:
    """Adds ``fold`` (0 … folds-1): classes are spread evenly, fold sizes per class differ by at most one."""
    keyed = df.withColumn("_key", hash_key(seed, ids))
    classes = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    sizes = classes.select(target, "n", F.explode(F.sequence(F.lit(1), F.lit(folds - 1))).alias("cut_no")).select(
        target, "cut_no", F.expr(f"cut_no * n div {folds}").alias("size")
    )
    cuts = (
        hash_cuts(keyed, sizes, target, "_key")
        .groupBy(target)
        .agg(F.collect_list("cut").alias("cuts"))  # folds - 1 keys per class
    )
    fold = F.size(F.filter("cuts", lambda c: c < F.col("_key")))
    return keyed.join(F.broadcast(cuts), target, "left").select(
        *df.columns, F.when(F.col("cuts").isNull(), 0).otherwise(fold).alias("fold")
    )


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    valid: DataFrame
    current: DataFrame
    features: list[str]


def prepare(
    train: DataFrame,
    current: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    ids: Sequence[str] = TRAIN_IDS,
    target: str = TARGET,
) -> Prepared:
    """Check, coerce and split. The split rows are stored, so that both parts come from one computation."""
    features = feature_columns(train, current, target)
    labelled = coerce_label(coerce_features(train, features), target)
    split = stored(assign_split(labelled, test_size, seed, ids, target))
    return Prepared(
        split.where("split = 'train'").drop("split"),
        split.where("split = 'valid'").drop("split"),
        coerce_features(current, features),
        features,
    )


def preprocess_metadata(prepared: Prepared, target: str = TARGET) -> DataFrame:
    """One row describing the prepared data."""

    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    return prepared.train.sparkSession.range(1).select(
        rows(prepared.train).alias("n_train_rows"),
        rows(prepared.valid).alias("n_valid_rows"),
        rows(prepared.current).alias("n_current_rows"),
        F.lit(len(prepared.features)).alias("n_features"),
        F.lit(target).alias("target_column"),
        F.lit(",".join(prepared.features)).alias("feature_columns"),
    )
