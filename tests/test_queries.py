"""Every named query against its SQL text, on whole tables."""

import datetime as dt
import math
import re

import duckdb
import pandas as pd
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{TESTDATA}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (dt.datetime, pd.Timestamp)):
        return pd.Timestamp(v).isoformat()
    return float(v) if isinstance(v, (int, float)) else v


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    rows = [tuple(_cell(v) for v in row) for row in frame.itertuples(index=False)]
    return list(frame.columns), sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = canonical(QUERIES[name](spark, TESTDATA).toPandas())
    theirs = canonical(duck.execute(SQL[name]).df())
    assert ours == theirs
    assert ours[1]


def test_every_query_but_the_models_has_sql():
    # those of the optional training-data operators have tests of their own
    without = {n for n in QUERIES if n not in SQL and n != "pipeline" and not re.match(r"op\d+_", n)}
    assert without == {
        "trained_model_scores_o",
        "trained_model_metrics_o",
        "grid_search_results_o",
        "feature_importance_o",
        "shapley_values_o",
        "shapley_importance_o",
    }


def test_entry(spark):
    assert entry_module.entry(spark).count() == 141


# Row counts of the test logs, from the fixture notes.
GOLDEN = {
    "event_count_metrics": (298, 5762),
    "metric_derived": (359, 65006),
    "observation": (15, 141),
    "current_customer_dataset": (15, 51),
    "metric_grid": (5, 344),
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden_counts(spark, name):
    counts = tuple(QUERIES[f"{name}_{log}"](spark, TESTDATA).count() for log in "eo")
    assert counts == GOLDEN[name]
