"""Reports and rank operators against pandas and numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import evaluate, prepare, profile, ranks

NUMBERS = st.floats(-1e12, 1e12, allow_nan=False) | st.integers(-5, 5).map(float)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, values):
    return spark.createDataFrame([(f"{i}", float(i), None if v is None else float(v)) for i, v in enumerate(values)],
                                 "id string, other double, x double")


@SLOW
@given(st.lists(NUMBERS, min_size=1, max_size=60))
def test_exact_quantiles(spark, values):
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    tall = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    counts = ranks.value_counts(tall, "g", "v")
    ours = {r.p: r.quantile for r in ranks.exact_quantiles(counts, "g", "v", ps).collect()}
    for p, q in zip(ps, np.quantile(values, ps), strict=True):
        assert math.isclose(ours[p], q, rel_tol=1e-9, abs_tol=1e-9 * max(1.0, *map(abs, values)))


def test_quantiles_of_long_tails(spark):
    values = [0.0] * 600 + [10.0**k for k in range(-8, 12)] * 3 + [-(10.0**k) for k in range(-8, 12)]
    tall = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    ps = [i / 20 for i in range(21)]
    counts = ranks.value_counts(tall, "g", "v")
    ours = {r.p: r.quantile for r in ranks.exact_quantiles(counts, "g", "v", ps).collect()}
    np.testing.assert_allclose([ours[p] for p in ps], np.quantile(values, ps), rtol=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [0, 0, 0, 1, 2, 3.5, 10, 0.25, 7],
        [5, 5, 5, 5],
        [1, None, 3, None, 8],
        [1, 2],
    ],
)
def test_summary_equals_describe(spark, values):
    (row,) = profile.dataset_summary(frame(spark, values)).collect()
    s = pd.Series(values, dtype=float)
    assert row["count"] == s.count()
    assert math.isclose(row["nonzero"], s.astype(bool).mean())
    for name, value in (
        ("mean", s.mean()),
        ("std", s.std()),
        ("min", s.min()),
        ("1pct", s.quantile(0.01)),
        ("25pct", s.quantile(0.25)),
        ("50pct", s.quantile(0.5)),
        ("75pct", s.quantile(0.75)),
        ("99pct", s.quantile(0.99)),
        ("max", s.max()),
        ("skew", s.skew()),
    ):
        if pd.isna(value):
            assert row[name] is None
        else:
            assert math.isclose(row[name], value, rel_tol=1e-9, abs_tol=1e-12), name


def _cohorts(spark, values, labels, **options):
    df = spark.createDataFrame([(float(v), bool(y)) for v, y in zip(values, labels, strict=True)], "x double, is_churn boolean")
    return profile.churn_cohorts(df, ["x"], **options).collect()


def _qcut(values, labels, n=10):
    df = pd.DataFrame({"x": np.asarray(values, float), "y": np.asarray(labels, float)})
    groups = pd.qcut(df.x, n, duplicates="drop")
    g = df.groupby(groups, observed=False)
    return g.x.mean().to_numpy(), g.y.mean().to_numpy(), g.x.count().to_numpy()


def test_cohorts_of_a_zero_heavy_metric(spark):
    values = [0] * 60 + list(range(1, 41))
    labels = [i % 3 == 0 for i in range(100)]
    rows = _cohorts(spark, values, labels)
    assert [r.n_accounts for r in rows] == [60, 10, 10, 10, 10]
    means, churn, _ = _qcut(values, labels)
    np.testing.assert_allclose([r.cohort_mean for r in rows], means)
    np.testing.assert_allclose([r.churn_rate for r in rows], churn)


@pytest.mark.parametrize("seed", range(3))
def test_cohorts_equal_qcut(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(200) < 0.3, 0, np.round(rng.gamma(2.0, 3.0, 200), 1))
    labels = rng.random(200) < 0.4
    rows = _cohorts(spark, values, labels)
    means, churn, sizes = _qcut(values, labels)
    assert [r.n_accounts for r in rows] == sizes.tolist()
    np.testing.assert_allclose([r.cohort_mean for r in rows], means)
    np.testing.assert_allclose([r.churn_rate for r in rows], churn)


def test_constant_metric_has_no_cohorts(spark):
    assert _cohorts(spark, [3, 3, 3], [1, 0, 1]) == []


def test_empty_cohort_is_kept(spark):
    values, labels = [0, 0, 0, 0, 0, 0, 1, 1, 1, 1], [1, 0] * 5
    rows = _cohorts(spark, values, labels, n_cohorts=4)
    means, _, sizes = _qcut(values, labels, 4)
    assert [r.n_accounts for r in rows] == sizes.tolist()
    assert [r.cohort_mean is None for r in rows] == np.isnan(means).tolist()


@SLOW
@given(st.lists(st.floats(0, 1) | st.sampled_from([0.1, 0.2, 0.3, 0.5]), min_size=1, max_size=80))
def test_histogram_equals_numpy(spark, values):
    if 0 < max(values) - min(values) < 1e-9:
        return
    df = spark.createDataFrame([(v,) for v in values], "p double")
    rows = profile.histogram(df, "p").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r.n_rows for r in rows] == counts.tolist()
    np.testing.assert_allclose([r.bin_start for r in rows] + [rows[-1].bin_end], edges, rtol=1e-12, atol=1e-15)


def _scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "is_churn int, churn_probability double")


@SLOW
@given(st.lists(st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.10001, 0.5, 0.7, 1.0]) | st.floats(0, 1)), min_size=1, max_size=50))
def test_auc_counts_pairs(spark, pairs):
    scored = _scored(spark, pairs)
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    (auc,) = evaluate.roc_auc(scored).first()
    if not pos or not neg:
        assert auc is None
    else:
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert math.isclose(auc, wins / len(pos) / len(neg), abs_tol=1e-12)
        curve = [(r.fpr, r.tpr) for r in evaluate.roc_curve(scored).collect()]
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:], strict=False))
        assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)
        assert math.isclose(area, auc, abs_tol=1e-12)


def test_one_class(spark):
    scored = _scored(spark, [(0, 0.1), (0, 0.2)])
    row = evaluate.binary_metrics(scored).first()
    assert (row.roc_auc, row.accuracy, row.precision, row.recall) == (None, 1.0, 0.0, 0.0)
    assert sum(r.n for r in evaluate.confusion_matrix(scored).collect()) == 2
    assert evaluate.confusion_matrix(scored).count() == 4


def _labelled(spark, sizes):
    rows = [(f"{label}-{i}", "2020-03-01", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "account_id string, observation_date string, is_churn int")


@pytest.mark.parametrize("sizes", [{0: 100, 1: 30}, {0: 7, 1: 5}, {0: 3, 1: 3}, {0: 1001, 1: 2}])
def test_split_sizes_and_repeatability(spark, sizes):
    df = _labelled(spark, sizes)
    split = prepare.assign_split(df)
    rows = split.collect()
    n = sum(sizes.values())
    valid = [r for r in rows if r.split == "valid"]
    assert len(rows) == n and len(valid) == math.ceil(0.2 * n)
    for label, size in sizes.items():
        exact = (n - len(valid)) * size / n
        train = sum(r.split == "train" and r.is_churn == label for r in rows)
        assert abs(train - exact) < 1
    again = prepare.assign_split(df.repartition(7)).collect()
    assert {r.account_id: r.split for r in rows} == {r.account_id: r.split for r in again}


def test_tiny_class_cannot_be_split(spark):
    with pytest.raises(Exception, match="at least two rows"):
        prepare.assign_split(_labelled(spark, {0: 10, 1: 1})).collect()


@pytest.mark.parametrize("sizes", [{0: 100, 1: 31}, {0: 9, 1: 4}])
def test_folds_are_even(spark, sizes):
    rows = prepare.assign_folds(_labelled(spark, sizes), folds=3).collect()
    for label in sizes:
        per_fold = [sum(r.fold == k and r.is_churn == label for r in rows) for k in range(3)]
        assert max(per_fold) - min(per_fold) <= 1 and sum(per_fold) == sizes[label]


@pytest.mark.parametrize("values", [
    [1000 + i / 50000 for i in range(5000)] + [1e300],
    [1 / (1 + 0.3 * n) for n in range(1000, 6000)],
    [float("inf"), float("-inf"), *map(float, range(3000))],
])
def test_buckets_follow_the_data(spark, values):
    """No bucket holds more than a few times the mean, however the values lie."""
    frame = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    counts = ranks.value_counts(frame, "g", "v").groupBy("bucket").count().toPandas()["count"]
    assert len(counts) > 50 and counts.max() <= 8 * counts.mean()


@pytest.mark.parametrize("accuracy", [20, 500])
def test_sketched_quantiles_keep_their_rank_error(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    values = np.round(np.exp(rng.normal(size=4000) * 2), 3)
    rows = [(f"a{i}", "t", float(v), float(i % 2), i % 3 == 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "account_id string, metric_time string, x double, y double, is_churn boolean").repartition(5)
    exact = {r.column_name: r for r in profile.dataset_summary(df).collect()}
    ordered = np.sort(values)
    for r in profile.dataset_summary(df, accuracy=accuracy).collect():
        for name in ("count", "nonzero", "mean", "std", "skew", "min", "max"):
            assert math.isclose(r[name], exact[r.column_name][name], rel_tol=1e-9, abs_tol=1e-12)
        if r.column_name == "x":
            for name, p in (("1pct", 0.01), ("25pct", 0.25), ("50pct", 0.5), ("75pct", 0.75), ("99pct", 0.99)):
                low, high = np.searchsorted(ordered, r[name], "left"), np.searchsorted(ordered, r[name], "right")
                assert low - 1 <= p * 4000 + 4000 / accuracy and high + 1 >= p * 4000 - 4000 / accuracy
    cohorts = profile.churn_cohorts(df, ["x"], accuracy=accuracy).collect()
    assert sum(c.n_accounts for c in cohorts) == 4000
    assert all(abs(c.n_accounts - 400) <= 2 * 4000 / accuracy + 2 for c in cohorts)
