"""Training, scoring and explanation on a planted signal, and the whole flow on a test log."""

import itertools
import json
import math

import numpy as np
import pytest
from conftest import TESTDATA

from tidemark.operators import boost, evaluate, explain, prepare, score, train
from tidemark.plans import catalog, models, pipeline
from tidemark.plans.catalog import LOGS, QUERY_GRID
from tidemark.sources.storage import load_model, save_model

FEATURES = ["a", "b", "c"]
GRID = {"n_estimators": [4], "max_depth": [2, 3], "subsample": [0.8]}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        a, b, c = rng.random(3) * 10
        p = 1 / (1 + math.exp(-(a - 5) - (2 if b > 7 else -0.5)))
        rows.append((f"{i}", "2020-03-01", bool(rng.random() < p), float(a), float(round(b)), float(c)))
    df = spark.createDataFrame(
        rows, "account_id string, observation_date string, is_churn boolean, a double, b double, c double"
    )
    return prepare.prepare(df, df.selectExpr("account_id", "1 as metric_time", "a", "b", "c"))


@pytest.fixture(scope="module")
def trained(data):
    return train.train_model(data.train, data.features, GRID)


def test_grid_of_the_full_search():
    assert math.prod(len(v) for v in train.FULL_GRID.values()) == 48


def test_queries_search_the_full_grid():
    assert QUERY_GRID == train.FULL_GRID
    assert QUERY_GRID["n_estimators"] == [100, 250] and QUERY_GRID["max_depth"] == [2, 3, 4]


def test_search_finds_the_signal(data, trained):
    assert data.features == FEATURES
    assert trained.best_cv_roc_auc > 0.8
    results = trained.search_results(data.train).collect()
    assert len(results) == 2
    best = next(r for r in results if r["rank"] == 1)
    assert best.max_depth == trained.best_params["max_depth"]
    assert best.mean_roc_auc == max(r.mean_roc_auc for r in results)
    metrics = evaluate.binary_metrics(score.with_probability(trained.model, data.valid)).first()
    assert metrics.roc_auc > 0.8
    ranking = [r.feature for r in train.feature_importance(trained, data.train).collect()]
    assert ranking[0] == "a"


def test_training_is_repeatable(data, trained):
    again = train.train_model(
        data.train.repartition(5), data.features, {k: [trained.best_params[k]] for k in GRID}
    )
    first = score.with_probability(trained.model, data.valid).orderBy("account_id").collect()
    second = score.with_probability(again.model, data.valid).orderBy("account_id").collect()
    assert [r.churn_probability for r in first] == [r.churn_probability for r in second]


def test_a_stored_search_is_read_again(data, tmp_path, monkeypatch):
    first = train.train_model(data.train, data.features, GRID, folder=str(tmp_path))
    grown = []
    monkeypatch.setattr(boost.Fit, "small_rounds", lambda *a: grown.append(a))
    again = train.train_model(data.train.repartition(3), data.features, GRID, folder=str(tmp_path))
    assert not grown and again.search == first.search and again.best_params == first.best_params
    a = [r.churn_probability for r in score.with_probability(first.model, data.valid).orderBy("account_id").collect()]
    b = [r.churn_probability for r in score.with_probability(again.model, data.valid).orderBy("account_id").collect()]
    assert a == b


def test_unknown_parameter(data):
    with pytest.raises(ValueError, match="leaves"):
        train.train_model(data.train, FEATURES, {"leaves": [3]})


def test_model_store(spark, data, tmp_path, monkeypatch):
    folder, made = str(tmp_path / "store"), []
    make = lambda: made.append(1) or data
    fit = train.train_model

    def stop(*args, **options):
        raise KeyboardInterrupt

    monkeypatch.setattr(models, "train_model", stop)
    with pytest.raises(KeyboardInterrupt):
        models.fitted(spark, folder, make, GRID)
    monkeypatch.setattr(models, "train_model", fit)
    _, one = models.fitted(spark, folder, make, GRID)
    monkeypatch.setattr(models, "train_model", stop)
    held, two = models.fitted(spark, folder, make, GRID)  # only read
    assert len(made) == 1 and one.search == two.search and two.best_params == one.best_params
    assert held.train.count() == data.train.count()
    key = models.store_key(train.fingerprint(data.train), GRID)
    assert key == models.store_key(train.fingerprint(data.train.repartition(7)), GRID)
    assert key != models.store_key(train.fingerprint(data.train.where("a < 9")), GRID)


def test_missing_columns(data):
    with pytest.raises(ValueError, match="zzz"):
        train.train_model(data.train, [*FEATURES, "zzz"], GRID)


def test_save_and_load(data, trained, tmp_path):
    path = save_model(trained.model, str(tmp_path / "m"))
    a = score.score_current(trained.model, data.current, data.features).collect()
    b = score.score_current(load_model(path), data.current, data.features).collect()
    assert a == b
    assert [r.churn_probability for r in a] == sorted((r.churn_probability for r in a), reverse=True)
    assert all(r.predicted_is_churn == (r.churn_probability >= 0.5) for r in a)


def test_contributions_add_up(data, trained):
    leaves = explain.model_leaves(trained.model)
    total = {
        r.account_id: r.total
        for r in explain.shapley_values(trained.model, data.valid, data.features)
        .groupBy("account_id")
        .agg({"contribution": "sum"})
        .withColumnRenamed("sum(contribution)", "total")
        .collect()
    }
    for r in score.with_probability(trained.model, data.valid).collect():
        log_odds = math.log(r.churn_probability / (1 - r.churn_probability))
        assert math.isclose(total[r.account_id] + explain.baseline(leaves), log_odds, abs_tol=1e-9)


def _expected(leaves, x, known):
    out = 0.0
    for leaf in leaves:
        p = leaf.value
        for f, low, high, share in zip(leaf.features, leaf.above, leaf.upto, leaf.share, strict=True):
            p *= float(low < x[f] <= high) if f in known else share
        out += p
    return out


def test_contributions_equal_the_definition(data, trained):
    leaves = explain.model_leaves(trained.model)
    rows = data.valid.select(*FEATURES).limit(5).toPandas().to_numpy(float)
    ours = explain.shapley_kernel(leaves)(rows)
    n = len(FEATURES)
    for x, phi in zip(rows, ours, strict=True):
        for i in range(n):
            others = [j for j in range(n) if j != i]
            value = 0.0
            for size in range(n):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                for s in itertools.combinations(others, size):
                    value += weight * (_expected(leaves, x, {*s, i}) - _expected(leaves, x, set(s)))
            assert math.isclose(phi[i], value, abs_tol=1e-12)


def test_importance(data, trained):
    rows = explain.shapley_importance(explain.shapley_values(trained.model, data.valid, data.features)).collect()
    assert {r.feature for r in rows} == set(FEATURES) and rows[0].feature == "a"


def test_whole_flow(spark, tmp_path):
    load, spec = LOGS["o"]
    out = str(tmp_path / "run")
    grid = {"n_estimators": [2], "max_depth": [2]}
    report = pipeline.run(load(spark, TESTDATA), spec, out, grid)
    assert report["scoring"]["n_customers_scored"] == 51
    assert 0 <= report["training"]["roc_auc"] <= 1
    document = report["training"]["classification_report"]
    assert set(document) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert document["accuracy"] == report["training"]["accuracy"]
    assert set(document["0"]) == {"precision", "recall", "f1-score", "support"}
    predicted = spark.read.option("header", True).csv(f"{out}/predictions_csv")
    assert predicted.columns == ["account_id", "metric_time", "churn_probability", "predicted_is_churn"] and predicted.count() == 51
    metadata = json.loads((tmp_path / "run/processed/preprocess_metadata.json").read_text())
    assert metadata["n_train_rows"] + metadata["n_valid_rows"] == 141
    assert metadata["feature_columns"] == spec.features
    valid = spark.read.parquet(f"{out}/processed/valid").count()
    assert spark.read.parquet(f"{out}/reports/contributions").count() == valid * 12
    assert spark.read.parquet(f"{out}/reports/probability_histogram").agg({"n_rows": "sum"}).first()[0] == 51
    assert spark.read.option("header", True).csv(f"{out}/exports/churn_training_dataset_csv").count() == 141


def test_the_model_of_a_log_reads_it_once(spark, monkeypatch):
    """Its name in the store and both snapshots come from one pass over the log, however costly that is."""
    load, spec = LOGS["o"]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = load(spark, TESTDATA)
    monkeypatch.setattr(catalog, "QUERY_GRID", {"n_estimators": [2], "max_depth": [2]})
    data, one = catalog._trained(given.mapInArrow(counted, given.schema), spec)
    assert seen.value == given.count()
    assert data.train.count() + data.valid.count() == 141
    monkeypatch.setattr(models, "train_model", None)  # the same log has the same model, whatever its layout
    _, two = catalog._trained(given.repartition(5), spec)
    assert one.search == two.search
