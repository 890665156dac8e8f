"""Hand-made logs for the corners of the metric semantics."""

import datetime as dt
import random

import pytest

from tidemark.operators import datasets, labels, metrics
from tidemark.operators.grid import Grid, metric_grid
from tidemark.spec import (
    BASIC,
    DEFAULT_SPEC,
    RATIO,
    SUM_OF_METRICS,
    TOTAL_EVENTS,
    UNIQUE_PRODUCTS,
    ChurnSpec,
    MetricDefinition,
)

READ, LOAD, FREE = "ReadingOwnedBook", "EBookDownloaded", "ReadingFreePreview"
SPEC = DEFAULT_SPEC.at(dt.date(2020, 3, 1))


def table(df):
    return {(r.account_id, r.metric_time, r.metric_name_id): r.metric_value for r in df.collect()}


def day(text):
    return dt.datetime.fromisoformat(text)


def test_window_is_half_open(spark, log):
    events = log(
        ("origin", "2020-01-01 12:00:00", "Other", None),
        ("a", "2020-01-29 00:00:00", READ, None),  # exactly on grid time 4: seen from the next on
        ("b", "2020-01-28 23:59:59.999999", READ, None),
        ("c", "2020-01-01 00:00:00", READ, None),  # exactly 28 days before grid time 4: still seen
        ("end", "2020-03-31 00:00:00", "Other", None),
    )
    rows = table(metrics.event_count_metrics(events, SPEC))
    at = {a: sorted(t for (x, t, i) in rows if x == a and i == 1) for a in "abc"}
    week = dt.timedelta(days=7)
    assert at["a"] == [day("2020-02-05") + k * week for k in range(4)]
    assert at["b"] == [day("2020-01-29") + k * week for k in range(4)]
    assert at["c"] == [day("2020-01-08") + k * week for k in range(4)]


def test_events_one_microsecond_outside_the_window(spark, log):
    events = log(
        ("origin", "2020-01-02 00:00:00", "Other", None),
        ("just_out", "2020-01-01 23:59:59.999999", READ, None),
        ("end", "2020-02-28 00:00:00", "Other", None),
    )
    # the first event moves the origin to 2020-01-01, so grid time 4 is 2020-01-29
    rows = table(metrics.event_count_metrics(events, SPEC))
    assert max(t for (a, t, _) in rows if a == "just_out") == day("2020-01-29")


def test_missing_products_give_no_distinct_row(spark, log):
    events = log(
        ("p", "2020-01-01 10:00:00", READ, None),
        ("p", "2020-01-02 10:00:00", LOAD, None),
        ("q", "2020-01-02 10:00:00", LOAD, 5),
        ("q", "2020-01-03 10:00:00", LOAD, 5),
        ("q", "2020-01-09 10:00:00", LOAD, 6),
        ("end", "2020-01-20 00:00:00", "Other", None),
    )
    rows = table(metrics.derived_metrics(events, SPEC))
    ids = {i for (a, _, i) in rows if a == "p"}
    assert 7 in ids and 11 in ids and 8 not in ids and 12 not in ids
    assert rows["q", day("2020-01-08"), 8] == 1.0
    assert rows["q", day("2020-01-15"), 8] == 2.0
    assert rows["q", day("2020-01-15"), 12] == 1.5


def test_ratio_without_numerator_is_zero(spark, log):
    events = log(
        ("r", "2020-01-01 10:00:00", "Other", 1),
        ("r", "2020-01-01 11:00:00", "Other", 2),
        ("end", "2020-01-10 00:00:00", "Other", None),
    )
    rows = table(metrics.derived_metrics(events, SPEC))
    assert rows["r", day("2020-01-08"), 11] == 0.0
    assert rows["r", day("2020-01-08"), 12] == 0.0


def test_star_event_joins_the_star_definitions(spark, log):
    events = log(
        ("s", "2020-01-01 10:00:00", "*", 1),
        ("s", "2020-01-01 11:00:00", READ, 1),
        ("end", "2020-01-10 00:00:00", "Other", None),
    )
    at = day("2020-01-08")
    base = table(metrics.event_count_metrics(events, SPEC))
    assert {i: v for (a, t, i), v in base.items() if (a, t) == ("s", at)} == {
        1: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1, 12: 1,
    }
    rows = metrics.all_metrics(events, SPEC).where("account_id = 's' and metric_name_id = 7")
    assert sorted(r.metric_value for r in rows.where("metric_time = timestamp_ntz'2020-01-08'").collect()) == [1.0, 2.0]
    # the pivot keeps the larger of two rows of one metric
    stored = datasets.current_dataset_from_metrics(metrics.all_metrics(events, SPEC), SPEC)
    direct = datasets.current_customer_dataset(events, SPEC)
    assert direct.collect() == stored.select(direct.columns).collect()
    assert direct.where("account_id = 's'").first().n_total_events_last_90d == 2.0


def test_single_event_log(spark, log):
    events = log(("a", "2020-01-01 10:00:00", READ, 1))
    assert [r.metric_time for r in metric_grid(events, SPEC).collect()] == [day("2020-01-01")]
    assert metrics.all_metrics(events, SPEC).count() == 0
    assert datasets.latest_metric_time(events, SPEC).first() == (None,)
    assert datasets.current_customer_dataset(events, SPEC).count() == 0
    (row,) = datasets.churn_training_dataset(events, SPEC).collect()
    assert row.is_churn is True and set(row[3:]) == {0.0}


def test_empty_log(spark, log):
    events = log()
    assert Grid.of(events, SPEC).is_empty
    for result in (
        metric_grid(events, SPEC),
        metrics.event_count_metrics(events, SPEC),
        metrics.all_metrics(events, SPEC),
        labels.observation(events, SPEC),
        datasets.churn_training_dataset(events, SPEC),
        datasets.current_customer_dataset(events, SPEC),
    ):
        assert result.count() == 0


def test_labels(spark, log):
    events = log(
        ("kept", "2020-02-01 00:00:00", READ, 1),
        ("kept", "2020-03-01 00:00:00", LOAD, 1),  # on the cut-off day counts as after
        ("gone", "2020-02-29 23:59:59", LOAD, 1),
        ("gone", "2020-03-05 00:00:00", FREE, 1),  # not a retention event
        ("new", "2020-03-02 00:00:00", READ, 1),
    )
    rows = labels.observation(events, SPEC).collect()
    assert {r.account_id: r.is_churn for r in rows} == {"kept": False, "gone": True}
    assert {r.observation_date for r in rows} == {dt.date(2020, 3, 1)}


def test_account_quiet_before_the_snapshot_has_a_zero_row(spark, log):
    events = log(
        ("late", "2019-08-01 00:00:00", READ, 1),
        ("busy", "2020-02-20 00:00:00", READ, 1),
        ("busy", "2020-03-20 00:00:00", READ, 1),
    )
    rows = {r.account_id: r for r in datasets.churn_training_dataset(events, SPEC).collect()}
    assert set(rows["late"][3:]) == {0.0}
    assert rows["busy"].n_readingownedbook_last_28d == 1.0


def test_snapshot_falls_back_to_the_last_time_with_rows(spark, log):
    events = log(("a", "2019-01-01 10:00:00", READ, 1), ("a", "2020-06-01 00:00:00", READ, 1))
    every = metrics.all_metrics(events, SPEC)
    expected = datasets.measured_time(every, SPEC.cutoff).first()
    assert expected.metric_time == day("2019-03-26")
    assert datasets.metric_snapshot(events, SPEC).first() == expected
    assert metrics.find_measured_time(events, SPEC, SPEC.cutoff) == expected.metric_time
    assert datasets.latest_metric_time(events, SPEC).first() == datasets.measured_time(every).first()


def test_cutoff_before_the_log(spark, log):
    events = log(("a", "2021-01-01 10:00:00", READ, 1), ("a", "2021-06-01 00:00:00", READ, 1))
    assert datasets.metric_snapshot(events, SPEC).first() == (None,)
    assert datasets.churn_training_dataset(events, SPEC).count() == 0


def _other_spec():
    """Look-backs that are no multiple of the step, several components, no long total."""
    definitions = (
        MetricDefinition(1, "n_read_5", READ, 5, BASIC),
        MetricDefinition(2, "n_load_30", LOAD, 30, BASIC),
        MetricDefinition(3, "n_read_33", READ, 33, BASIC),
        MetricDefinition(4, "n_products_12", "*", 12, UNIQUE_PRODUCTS),
        MetricDefinition(5, "n_products_40", "*", 40, UNIQUE_PRODUCTS),
        MetricDefinition(6, "n_all_9", "*", 9, TOTAL_EVENTS),
        MetricDefinition(7, "n_read_and_load", "*", 30, SUM_OF_METRICS, components=(1, 2)),
        MetricDefinition(8, "load_per_product", "*", 30, RATIO, numerator=2, denominator=5),
        MetricDefinition(9, "read_per_event", "*", 30, RATIO, numerator=3, denominator=6),
    )
    return ChurnSpec(
        cutoff=dt.date(2020, 2, 20), step_days=4, definitions=definitions, feature_order=tuple(range(1, 10))
    )


def _naive(rows, spec):
    """Direct evaluation of every window."""
    days = [dt.datetime.fromisoformat(t) for _, t, _, _ in rows]
    time = dt.datetime.combine(min(days).date(), dt.time())
    out = {}
    while time <= dt.datetime.combine(max(days).date(), dt.time()):
        for account in {a for a, *_ in rows}:
            def seen(n, account=account, time=time):
                low = time - dt.timedelta(days=n)
                return [
                    (e, p) for (a, _, e, p), t in zip(rows, days, strict=True) if a == account and low <= t < time
                ]

            base = {
                d.metric_name_id: sum(e == d.event_type for e, _ in seen(d.lookback_days)) for d in spec.definitions
            }
            derived = {}
            for d in spec.definitions:
                window = seen(d.lookback_days)
                if d.metric_kind == TOTAL_EVENTS and window:
                    derived[d.metric_name_id] = float(len(window))
                products = {p for _, p in window if p is not None}
                if d.metric_kind == UNIQUE_PRODUCTS and products:
                    derived[d.metric_name_id] = float(len(products))
                total = sum(base[c] for c in d.components)
                if d.metric_kind == SUM_OF_METRICS and total:
                    derived[d.metric_name_id] = float(total)
            for d in spec.definitions:
                if d.metric_kind == RATIO and d.denominator in derived:
                    derived[d.metric_name_id] = base[d.numerator] / derived[d.denominator]
            for i, v in [*((i, v) for i, v in base.items() if v), *derived.items()]:
                out.setdefault((account, time, i), []).append(float(v))
        time += dt.timedelta(days=spec.step_days)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_equals_direct_evaluation(spark, log, seed):
    rng = random.Random(seed)
    spec = _other_spec()
    start = dt.datetime(2020, 1, 3)
    rows = []
    for _ in range(150):
        at = start + dt.timedelta(days=rng.randrange(75), seconds=rng.choice([0, 0, 1, 50_000, 86_399]))
        account = rng.choices(["hot", "x", "y"], [6, 2, 1])[0]
        rows.append((account, at.isoformat(" "), rng.choice([READ, LOAD, FREE, "*"]), rng.choice([None, 1, 2, 3, 4])))
    found = {}
    events = log(*rows)
    every = metrics.all_metrics(events, spec)
    for r in every.collect():
        found.setdefault((r.account_id, r.metric_time, r.metric_name_id), []).append(r.metric_value)
    assert {k: sorted(v) for k, v in found.items()} == _naive(rows, spec)
    for cutoff in (None, spec.cutoff, dt.date(2020, 1, 9), dt.date(2020, 1, 2)):
        (expected,) = datasets.measured_time(every, cutoff).first()
        assert metrics.last_measured_time(events, spec, cutoff).first() == (expected,)
        assert metrics.find_measured_time(events, spec, cutoff) == expected
    by_account = datasets.current_customer_dataset(events, spec).orderBy("account_id")
    stored = datasets.current_dataset_from_metrics(every, spec).select(by_account.columns).orderBy("account_id")
    assert by_account.collect() == stored.collect()


def test_spec_is_checked():
    with pytest.raises(ValueError, match="components"):
        ChurnSpec(definitions=(MetricDefinition(1, "m", "*", 7, SUM_OF_METRICS),), feature_order=(1,))
    with pytest.raises(ValueError, match="numerator"):
        ChurnSpec(definitions=(MetricDefinition(1, "m", "*", 7, RATIO),), feature_order=(1,))
    with pytest.raises(ValueError, match="unknown metric ids"):
        ChurnSpec(feature_order=(99,))
