import json

from conftest import TESTDATA

from tidemark.__main__ import main
from tidemark.plans.catalog import LOGS, NEW_METRICS
from tidemark.sources import definitions
from tidemark.sources.storage import write_csv


def test_every_step(spark, tmp_path):
    load, _ = LOGS["o"]
    log = write_csv(load(spark, TESTDATA), str(tmp_path / "log.csv"))
    marts, processed, out = (str(tmp_path / n) for n in ("marts", "processed", "out"))

    def run(*args):
        main([*args], spark)

    run("build", "--events", log, "--out", marts, "--cutoff", "1999-07-01")
    exports = f"{marts}/exports"
    run(
        "preprocess",
        "--train-path", f"{exports}/churn_training_dataset_csv",
        "--current-path", f"{exports}/current_customer_dataset_csv",
        "--output-dir", processed,
    )
    assert spark.read.parquet(f"{processed}/train").count() == 112
    assert spark.read.parquet(f"{processed}/valid").count() == 29
    run("train", "--processed-dir", processed, "--out", out, "--grid", '{"n_estimators": [2], "max_depth": [2]}')
    run("score", "--processed-dir", processed, "--out", out)
    run("explain", "--processed-dir", processed, "--out", out)
    run("summary", "--path", f"{exports}/churn_training_dataset_csv", "--out", f"{out}/summary")
    run("cohorts", "--path", f"{marts}/churn_training_dataset", "--out", f"{out}/cohorts")
    assert json.loads((tmp_path / "out/reports/scoring_summary.json").read_text())["n_customers_scored"] == 51
    assert spark.read.option("header", True).csv(f"{out}/summary").count() == 13
    assert spark.table("metric_stats_over_time").count() == 11


def test_tables_definitions_and_lasting_views(spark, tmp_path):
    load, _ = LOGS["o"]
    load(spark, TESTDATA).write.mode("overwrite").option("path", str(tmp_path / "log")).saveAsTable("cli_log")
    table = definitions.definitions_frame(spark).union(spark.createDataFrame(NEW_METRICS, definitions.DEFINITION_SCHEMA))
    path = write_csv(table.coalesce(1), str(tmp_path / "definitions"))
    out = str(tmp_path / "marts")
    try:
        main(
            ["build", "--events-table", "cli_log", "--definitions", path, "--out", out, "--cutoff", "1999-07-01", "--database", "churn"],
            spark,
        )
        other = spark.newSession()  # it has none of the temporary views
        assert other.sql("select count(*) from churn.all_metrics where metric_name_id > 12").first()[0] > 0
        names = {r.metric_name for r in other.table("churn.metric_stats_over_time").collect()}
        assert len(names) == 15 and "share_of_reading_last_28d" in names
        assert other.table("churn.churn_training_dataset").count() == 141
        stored = {r.metric_name: r for r in spark.table("metric_stats_over_time").collect()}
        for r in other.table("churn.metric_stats_over_time").collect():
            assert r.n_metric_dates == stored[r.metric_name].n_metric_dates
            assert abs(r.avg_metric_value - stored[r.metric_name].avg_metric_value) < 1e-9
    finally:
        spark.sql("drop database if exists churn cascade")
        spark.sql("drop table if exists cli_log")
