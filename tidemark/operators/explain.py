"""Why an account got its score: exact Shapley contributions of a boosted-tree model.

A tree is a sum over its leaves of (leaf value) x (product over the features on the
path of "is this feature's condition met"). When a feature is unknown its condition is
replaced by the share of training rows that met it. For such a product game the Shapley
value of feature ``i`` has the closed form

    value * (met_i - share_i) * integral over t in (0, 1) of
            product over the other features j of  t * met_j + (1 - t) * share_j

The integrand is a polynomial whose degree is below the tree depth, so a few
Gauss-Legendre points give the integral exactly. Contributions are in log-odds and
add up to the score's log-odds minus the baseline.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.score import prepare_features
from tidemark.spec import TRAIN_IDS

LOG_ODDS_PER_MARGIN = 2.0  # the model's probability is 1 / (1 + exp(-2 * margin))


@dataclass(frozen=True)
class Leaf:
    value: float
    features: np.ndarray  # indices of the features on the path
    above: np.ndarray  # condition: above < x <= upto
    upto: np.ndarray
    share: np.ndarray  # share of training rows that meet it, given the rest of the path


def model_leaves(model: PipelineModel) -> list[Leaf]:
    """All leaves of the model; their number is bounded by trees times 2^depth."""
    booster = model.stages[-1]
    leaves: list[Leaf] = []
    for tree, weight in zip(booster.trees, booster.treeWeights, strict=True):
        root = tree._call_java("rootNode")
        _walk(root, root.impurityStats().count(), weight * LOG_ODDS_PER_MARGIN, {}, leaves)
    return leaves


def _walk(node, rows: int, scale: float, path: dict[int, tuple[float, float, float]], leaves: list[Leaf]) -> None:
    if node.subtreeDepth() == 0:
        conditions = np.array([path[f] for f in path], dtype=float).reshape(len(path), 3)
        leaves.append(
            Leaf(scale * node.prediction(), np.array(list(path), dtype=int), *(conditions[:, k] for k in range(3)))
        )
        return
    split = node.split()
    feature, threshold = split.featureIndex(), split.threshold()
    above, upto, share = path.get(feature, (-np.inf, np.inf, 1.0))
    for child, low, high in (
        (node.leftChild(), above, min(upto, threshold)),
        (node.rightChild(), max(above, threshold), upto),
    ):
        below = child.impurityStats().count()
        _walk(child, below, scale, path | {feature: (low, high, share * below / rows)}, leaves)


def baseline(leaves: Sequence[Leaf]) -> float:
    """Log-odds when no feature is known."""
    return float(sum(leaf.value * leaf.share.prod() for leaf in leaves))


def shapley_kernel(leaves: Sequence[Leaf]) -> Callable[[np.ndarray], np.ndarray]:
    """A function from a batch of rows to the contributions of every feature (columns).

    It carries plain arrays only, so executors need nothing but numpy to run it.
    """
    parts = [(x.value, x.features, *(v[:, None] for v in (x.above, x.upto, x.share))) for x in leaves if len(x.features)]
    depth = max((len(x.features) for x in leaves), default=0)
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (depth + 1) // 2))
    quadrature = list(zip((nodes + 1) / 2, weights / 2, strict=True))

    def contributions(x: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(x.T)  # long runs of one feature, as a path has few
        out = np.zeros(columns.shape)
        for value, features, above, upto, share in parts:
            on_path = columns[features]
            met = ((on_path > above) & (on_path <= upto)).astype(float)
            others = np.zeros(met.shape)
            for t, w in quadrature:
                factor = t * met + (1 - t) * share
                others += w * factor.prod(axis=0) / factor
            out[features] += value * (met - share) * others
        return out.T

    return contributions


def shapley_values(
    model: PipelineModel, df: DataFrame, features: Sequence[str], ids: Sequence[str] = TRAIN_IDS
) -> DataFrame:
    """``ids, feature, value, contribution``: one row per account and feature."""
    kernel = shapley_kernel(model_leaves(model))

    @F.pandas_udf("array<double>")
    def explain(*columns: pd.Series) -> pd.Series:
        return pd.Series(list(kernel(np.column_stack(columns))))

    prepared = prepare_features(df, features)
    names = F.array(*map(F.lit, features)).alias("feature")
    rows = prepared.select(*ids, names, F.array(*features).alias("value"), explain(*features).alias("contribution"))
    return rows.select(*ids, F.inline(F.arrays_zip("feature", "value", "contribution")))


def shapley_importance(values: DataFrame) -> DataFrame:
    """``feature, mean_abs_contribution``, highest first."""
    return (
        values.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )
