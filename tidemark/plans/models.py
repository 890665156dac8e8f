"""Fitted models in a store: what was fitted once is read by every later query and application."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from tidemark.operators.prepare import Prepared
from tidemark.operators.train import Trained, train_model
from tidemark.sources.storage import exists, load_model, read_json, save_model, write_json, write_parquet

READY = "ready.json"


def store_key(*parts: object) -> str:
    """A name for what the parts (data, definitions, grid, seed) describe."""
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()[:24]


def fitted(
    spark: SparkSession, folder: str, make: Callable[[], Prepared], grid: Mapping[str, Sequence], **options
) -> tuple[Prepared, Trained]:
    """Splits and model in ``folder``. What is not there yet is made: splits first, then the search, which can be taken up again."""
    if not exists(spark, f"{folder}/{READY}"):
        if not exists(spark, f"{folder}/features.json"):
            data = make()
            for name in ("train", "valid", "current"):
                write_parquet(getattr(data, name), f"{folder}/{name}")
            write_json(spark, data.features, f"{folder}/features.json")
        data = _splits(spark, folder)
        trained = train_model(data.train, data.features, grid, folder=f"{folder}/searches", **options)
        save_model(trained.model, f"{folder}/model")
        found = {"best_params": trained.best_params, "best_cv_roc_auc": trained.best_cv_roc_auc, "search": trained.search}
        write_json(spark, found, f"{folder}/{READY}")
    data, found = _splits(spark, folder), read_json(spark, f"{folder}/{READY}")
    model = load_model(f"{folder}/model")
    return data, Trained(model, data.features, found["best_params"], found["best_cv_roc_auc"], found["search"])


def _splits(spark: SparkSession, folder: str) -> Prepared:
    frames = [spark.read.parquet(f"{folder}/{name}") for name in ("train", "valid", "current")]
    return Prepared(*frames, read_json(spark, f"{folder}/features.json"))
