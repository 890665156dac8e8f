"""Training the churn classifier: boosted trees, grid-searched by cross-validated ROC AUC."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.schema import expect_columns
from tidemark.operators.boost import Chain, boost, to_model
from tidemark.operators.prepare import SEED, assign_folds
from tidemark.sources.storage import stored
from tidemark.spec import TARGET, TRAIN_IDS

# The full search, 48 candidates.
FULL_GRID: dict[str, list] = {
    "n_estimators": [100, 250],
    "max_depth": [2, 3, 4],
    "learning_rate": [0.03, 0.1],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.8, 1.0],
}

# The form in which a search keeps its states: one of another form is not taken up.
STATES = "lines of equal rows"

# Values of the parameters that a grid does not name.
DEFAULTS = {"n_estimators": 20, "max_depth": 5, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    features: list[str]
    best_params: dict[str, object]
    best_cv_roc_auc: float
    search: list[dict[str, object]]

    def search_results(self, like: DataFrame) -> DataFrame:
        """One row per candidate: its parameters, mean AUC over the folds and rank."""
        ranked = sorted(range(len(self.search)), key=lambda i: -self.search[i]["mean_roc_auc"])
        rank = {i: r + 1 for r, i in enumerate(ranked)}
        # a parameter that the grid leaves out has the estimator's default
        kinds = {"n_estimators": int, "max_depth": int, "learning_rate": float, "subsample": float, "colsample_bytree": float}
        rows = [
            (*(kind(c.get(name, DEFAULTS[name])) for name, kind in kinds.items()), float(c["mean_roc_auc"]), rank[i])
            for i, c in enumerate(self.search)
        ]
        return like.sparkSession.createDataFrame(
            rows,
            "n_estimators int, max_depth int, learning_rate double, subsample double, "
            "colsample_bytree double, mean_roc_auc double, rank int",
        )


def candidates_of(grid: Mapping[str, Sequence]) -> list[dict[str, object]]:
    """Every combination of the grid's values, in the order of its parameters."""
    unknown = sorted(set(grid) - set(DEFAULTS))
    if unknown:
        raise ValueError(f"unknown parameters: {unknown}")
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def _chain(candidate: Mapping[str, object], fold: int) -> Chain:
    p = DEFAULTS | candidate
    return Chain(
        fold, int(p["n_estimators"]), int(p["max_depth"]), float(p["learning_rate"]), float(p["subsample"]), float(p["colsample_bytree"])
    )


def fingerprint(df: DataFrame) -> str:
    """A text that changes with the rows of ``df``, whatever their order and the files they are read from."""
    n, total = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{df.schema.simpleString()}|{n}|{total}"


def train_model(
    train: DataFrame,
    features: Sequence[str],
    grid: Mapping[str, Sequence] = FULL_GRID,
    folds: int = 3,
    seed: int = SEED,
    ids: Sequence[str] = TRAIN_IDS,
    target: str = TARGET,
    folder: str | None = None,
) -> Trained:
    """Pick the candidate with the best mean fold AUC and refit it on all rows.

    ``grid`` is the searched grid, by default the full one. Candidates that differ in the number of trees only are one chain per fold,
    scored on the way; all chains are fitted side by side (:mod:`tidemark.operators.boost`). Folds and draws depend on
    the ids, so the same rows give the same model whatever their layout and the session's settings. A fold without one of the
    classes does not count. With ``folder``, the search is stored there under a name made of rows, grid, folds and seed: a search that
    was stopped goes on where it was, and one that has ended is read.
    """
    expect_columns(train, [*ids, *features, target], "training rows", numeric=features)
    rows = stored(assign_folds(train, folds, seed, ids, target).select(*ids, *features, target, "fold"))
    place = None
    if folder is not None:
        what = json.dumps([STATES, fingerprint(rows), {k: list(v) for k, v in grid.items()}, folds, seed, list(ids), target], default=str)
        place = f"{folder}/{hashlib.sha256(what.encode()).hexdigest()[:24]}"
    candidates = candidates_of(grid)
    lengths = sorted({_chain(c, 0).rounds for c in candidates})
    settings = {}  # without the number of trees: its greatest number
    for c in candidates:
        chain = _chain({**c, "n_estimators": 0}, 0)
        settings[chain] = max(settings.get(chain, 0), _chain(c, 0).rounds)
    chains = [_with(s, fold, n) for s, n in settings.items() for fold in range(folds)]
    common = {"ids": ids, "target": target, "seed": seed}
    _, _, auc = boost(
        rows, features, chains, fold="fold", evaluate=lengths, folder=place and f"{place}/search", **common
    )
    number = {(_with(c, c.fold, 0)): i for i, c in enumerate(chains)}

    def mean_auc(candidate) -> float:
        chain = _chain(candidate, 0)
        found = [auc[chain.rounds].get(number[_with(chain, f, 0)]) for f in range(folds)]
        found = [x for x in found if x is not None]
        return sum(found) / len(found) if found else 0.5

    results = [c | {"mean_roc_auc": mean_auc(c)} for c in candidates]
    best = max(range(len(results)), key=lambda i: results[i]["mean_roc_auc"])
    final = _chain(candidates[best], -1)
    trees, edges, _ = boost(rows, features, [final], fold=None, folder=place and f"{place}/final-{best}", **common)
    model = to_model(trees, final, edges, features, target)
    return Trained(model, list(features), candidates[best], float(results[best]["mean_roc_auc"]), results)


def _with(chain: Chain, fold: int, rounds: int) -> Chain:
    return Chain(fold, rounds, chain.max_depth, chain.learning_rate, chain.subsample, chain.colsample)


def feature_importance(trained: Trained, like: DataFrame) -> DataFrame:
    """``feature, importance``: normalised total gain, highest first."""
    weights = trained.model.stages[-1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(trained.features, weights, strict=True)]
    frame = like.sparkSession.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")
