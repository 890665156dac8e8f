"""Shape of the physical plans: what must (not) be in them at scale."""

import re

import pytest
from conftest import TESTDATA

from tidemark.operators import datasets, labels, metrics, quality
from tidemark.plans import pipeline
from tidemark.plans.catalog import LOGS, ON_EVENTS
from tidemark.sources.events import EVENT_SCHEMA
from tidemark.spec import DEFAULT_SPEC


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    load, spec = LOGS["o"]
    path = str(tmp_path_factory.mktemp("log") / "events")
    load(spark, TESTDATA).write.parquet(path)
    return spark.read.schema(EVENT_SCHEMA).parquet(path), spec


@pytest.mark.parametrize("name", sorted(ON_EVENTS))
def test_no_nested_loops_and_no_python(spark, stored_log, name):
    text = plan(ON_EVENTS[name](*stored_log))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"(Python|Pandas|ArrowEval)", text)


def test_sweep_exchanges(stored_log):
    """One exchange to aggregate, one to bring the compact rows of an account together."""
    text = plan(metrics.event_count_metrics(*stored_log))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"REPARTITION_BY_COL", text)) == 1
    text = plan(metrics.all_metrics(*stored_log))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5


def test_hot_accounts_are_aggregated_before_they_meet(stored_log):
    """No exchange on the account alone sees anything but aggregated rows."""
    text = plan(metrics.all_metrics(*stored_log))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    spread = [k for k in keys if "position" in k or "product_id" in k]
    assert len(spread) == 4


def test_filters_and_columns_reach_the_scan(stored_log):
    events, spec = stored_log
    text = plan(datasets.current_customer_dataset(events, spec))
    assert re.search(r"PushedFilters: \[.*LessThan\(event_time,2001-07-29.*GreaterThanOrEqual\(event_time,2001-04-30", text)
    assert "additional_data" not in text
    text = plan(labels.observation(events, spec))
    assert re.search(r"PushedFilters: \[.*In\(event_type, \[EBookDownloaded,ReadingOwnedBook\]\)", text)
    assert "product_id" not in text
    text = plan(metrics.event_count_metrics(events, spec))
    assert "additional_data" not in text and "product_id" not in text


def test_label_join_does_not_shuffle_again(spark, stored_log):
    """Both sides are already grouped by account."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(datasets.churn_training_dataset(*stored_log))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3  # labels, products, features


def test_a_stored_snapshot_reads_one_folder(spark, stored_log, tmp_path):
    """Metric tables are partitioned by time: both dataset builders read the folder of their time only."""
    events, spec = stored_log
    marts = pipeline.build_marts(events, spec, str(tmp_path))
    for table, time in (
        (datasets.training_dataset_from_metrics(marts.all_metrics, marts.observation, spec), "1999-06-27"),
        (datasets.current_dataset_from_metrics(marts.all_metrics, spec), "2001-07-29"),
    ):
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(table))
        assert sum(f"= {time}" in f for f in filters) == 2


def test_statistics_are_aggregated_before_they_are_rows(stored_log):
    """Only lines per grid time are turned into rows, after the aggregate over accounts."""
    events, spec = stored_log
    text = plan(quality.metric_stats_over_time(metrics.metric_times(events, spec), spec))
    tall = text.index("Generate inline(parts")
    assert re.search(r"HashAggregate\(keys=\[metric_time#\d+\]", text[tall:])
    assert not re.search(r"keys=\[metric_name_id#\d+, metric_time#\d+\]", text[tall:])


def test_one_scan_per_summary(stored_log):
    """Distinct values are stored once; quantiles and moments read only those."""
    events, spec = stored_log
    text = plan(ON_EVENTS["dataset_summary"](events, spec))
    assert "event_time" not in text


def test_every_definition_is_in_the_spec():
    assert DEFAULT_SPEC.features[0] == "n_ebookdownloaded_last_28d" and len(DEFAULT_SPEC.features) == 12


def test_tasks_of_the_sweep_go_with_the_log(spark, stored_log, monkeypatch):
    """Accounts of a large log are dealt out to as many tasks as its events need; the rows stay the same."""
    events, spec = stored_log
    expected = sorted(map(tuple, metrics.all_metrics(events, spec).collect()))
    n = events.count()
    monkeypatch.setattr(metrics, "EVENTS_A_TASK", max(1, n // 20))
    found = metrics.all_metrics(events, spec)
    tasks = -(-n // metrics.EVENTS_A_TASK)
    assert re.search(rf"hashpartitioning\(account_id[^)]*, {tasks}\), REPARTITION_BY_NUM", plan(found))
    assert sorted(map(tuple, found.collect())) == expected


def test_stored_metrics_are_swept_once(spark, stored_log, monkeypatch):
    calls, sweep = [], metrics.sweep
    monkeypatch.setattr(metrics, "sweep", lambda *a: calls.append(a) or sweep(*a))
    ON_EVENTS["training_dataset_from_metrics"](*stored_log)
    assert len(calls) == 1
