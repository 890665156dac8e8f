import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import datasets, grid, labels, metrics, prepare, quality, score
from tidemark.plans.catalog import NEW_METRICS
from tidemark.sources import definitions, events, storage
from tidemark.sources.events import activity_events, as_event_log, read_event_csv
from tidemark.spec import DEFAULT_SPEC

HEADER = "account_id,event_time,event_type,product_id,additional_data\n"


def csv(tmp_path, body):
    path = tmp_path / "log.csv"
    path.write_text(HEADER + body, encoding="utf-8")
    return str(path)


def test_read_event_csv(spark, tmp_path):
    path = csv(
        tmp_path,
        'a,2020-01-01 10:00:00.123456,SearchMade,,\nb,2020-01-02 00:00:00,"x,y",7,"say ""hi"" – ü"\n',
    )
    rows = read_event_csv(spark, path).orderBy("account_id").collect()
    assert tuple(rows[0]) == ("a", dt.datetime(2020, 1, 1, 10, 0, 0, 123456), "SearchMade", None, None)
    assert tuple(rows[1]) == ("b", dt.datetime(2020, 1, 2), "x,y", 7, 'say "hi" – ü')


@pytest.mark.parametrize(
    "body",
    [
        ",2020-01-01 10:00:00,SearchMade,1,\n",
        "a,,SearchMade,1,\n",
        "a,2020-01-01 10:00:00,,1,\n",
        "a,yesterday,SearchMade,1,\n",
        "a,2020-01-01 10:00:00,SearchMade,one,\n",
    ],
)
def test_bad_rows_fail(spark, tmp_path, body):
    with pytest.raises(Exception):  # noqa: B017
        read_event_csv(spark, csv(tmp_path, body)).collect()


def test_line_breaks_need_multi_line(spark, tmp_path):
    path = csv(tmp_path, 'a,2020-01-01 10:00:00,SearchMade,1,"two\nlines"\n')
    assert read_event_csv(spark, path, multi_line=True).first().additional_data == "two\nlines"
    with pytest.raises(Exception):  # noqa: B017
        read_event_csv(spark, path).collect()


def test_as_event_log(spark):
    df = spark.sql(
        "select 12 as account_id, '2020-01-01 00:00:00' as event_time, 'x' as event_type, "
        "3L as product_id, cast(null as string) as additional_data"
    )
    assert tuple(as_event_log(df).first()) == ("12", dt.datetime(2020, 1, 1), "x", 3, None)
    with pytest.raises(ValueError, match="product_id"):
        as_event_log(df.drop("product_id"))


def test_definitions_roundtrip(spark, tmp_path):
    path = storage.write_csv(definitions.definitions_frame(spark), str(tmp_path / "defs"))
    table = definitions.read_definitions(spark, path)
    assert definitions.spec_with_definitions(table) == DEFAULT_SPEC
    changed = table.replace({"n_SearchMade_last_28d": "n_searches"}, subset=["metric_name"])
    assert "n_searches" in definitions.spec_with_definitions(changed).features


def test_read_dataset(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "account_id string, x double")
    as_parquet = storage.write_parquet(df, str(tmp_path / "p"))
    as_csv = storage.write_csv(df, str(tmp_path / "c"))
    assert sorted(storage.read_dataset(spark, as_parquet).collect()) == sorted(df.collect())
    back = prepare.coerce_features(storage.read_dataset(spark, as_csv), ["x"])
    assert {r.account_id: r.x for r in back.collect()} == {"a": 1.5, "b": 0.0}
    typed = storage.read_dataset(spark, as_csv, df.schema)
    assert sorted(typed.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(FileNotFoundError):
        storage.read_dataset(spark, str(tmp_path / "nothing"))


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.write_parquet(spark.range(5), path)
    storage.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_json(spark, tmp_path):
    path = storage.write_json(spark, ["a", "b"], str(tmp_path / "f.json"))
    assert storage.read_json(spark, path) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        storage.read_json(spark, str(tmp_path / "none.json"))


def test_bad_numbers(spark):
    cells = ["x", "", "nan", " 3 ", "1e3", "inf", None, "-2.5"]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    assert [r.v for r in prepare.coerce_features(df, ["v"]).collect()] == [
        0.0, 0.0, 0.0, 3.0, 1000.0, float("inf"), 0.0, -2.5,
    ]


def test_feature_mismatch_names_both_sides(spark):
    train = spark.sql("select 'a' account_id, current_date() observation_date, true is_churn, 1 f, 2 g")
    current = spark.sql("select 'a' account_id, 1 metric_time, 1 g, 2 h")
    with pytest.raises(ValueError, match="current table lacks f and does not expect h"):
        prepare.feature_columns(train, current)
    with pytest.raises(ValueError, match="is_churn"):
        prepare.feature_columns(train.drop("is_churn"), current)
    with pytest.raises(ValueError, match="current table lacks f"):
        score.prepare_features(current, ["f", "g"])


def test_missing_label_fails(spark):
    df = spark.createDataFrame([("a", True), ("b", None)], "account_id string, is_churn boolean")
    with pytest.raises(Exception, match="must not be NULL"):
        prepare.coerce_label(df).collect()


def test_shared_dir_is_below_the_checkpoint_dir(spark):
    assert storage.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_adapter_columns(spark):
    from conftest import TESTDATA

    df = activity_events(spark, TESTDATA)
    assert df.dtypes == [
        ("account_id", "string"),
        ("event_time", "timestamp_ntz"),
        ("event_type", "string"),
        ("product_id", "int"),
        ("additional_data", "string"),
    ]
    assert df.where("product_id is null").count() == 14


def test_csv_keeps_texts(spark, tmp_path):
    """Blanks at the ends, empty text, NULL, quotes and line breaks survive; only an empty field is NULL."""
    texts = [" a ", "  ", "", None, 'say "x"', "a,b", "line\nbreak", "NULL"]
    now = dt.datetime(2024, 1, 1)
    rows = [(f" id{i}", now, "view", i, t) for i, t in enumerate(texts)]
    path = storage.write_csv(spark.createDataFrame(rows, events.EVENT_SCHEMA), str(tmp_path / "log.csv"))
    back = events.read_event_csv(spark, path, multi_line=True).orderBy("product_id").collect()
    assert [tuple(r) for r in back] == rows


@pytest.mark.parametrize("column", ["account_id", "event_time", "event_type"])
def test_missing_mandatory_values_are_found(spark, column):
    row = {"account_id": "a", "event_time": dt.datetime(2024, 1, 1), "event_type": "view", "product_id": 1}
    log = spark.createDataFrame([row, row | {column: None}], "account_id string, event_time timestamp_ntz, event_type string, product_id int")
    with pytest.raises(ValueError, match=f"1 in {column}"):
        grid.Grid.of(log, DEFAULT_SPEC)


@pytest.mark.parametrize("label", ["NaN", "2", "0.5", "yes"])
def test_odd_labels_fail(spark, label):
    df = spark.createDataFrame([(label,)], "is_churn string")
    for kind in ("string", "double") if label != "yes" else ("string",):
        with pytest.raises(Exception, match="must be boolean, 0 or 1"):
            prepare.coerce_label(df.withColumn("is_churn", df["is_churn"].cast(kind))).collect()


def test_good_labels(spark):
    df = spark.createDataFrame([("True",), ("1",), ("0.0",), ("false",)], "is_churn string")
    assert [r[0] for r in prepare.coerce_label(df).collect()] == [1, 1, 0, 0]


# --- contracts, definitions, tables that are replaced --------------------------------


def _with_null(spark, column):
    cells = {"account_id": "'a'", "event_time": "timestamp_ntz'2020-01-05 10:00:00'", "event_type": "'ReadingOwnedBook'"}
    row = ", ".join(f"{v} as {c}" for c, v in cells.items())
    hole = ", ".join(f"{'null' if c == column else v} as {c}" for c, v in cells.items())
    rest = "cast(1 as int) as product_id, cast(null as string) as additional_data"
    return as_event_log(spark.sql(f"select {row}, {rest} union all select {hole}, {rest}"))


@pytest.mark.parametrize("column", ["account_id", "event_time", "event_type"])
@pytest.mark.parametrize(
    "path",
    [
        lambda e: labels.observation(e, DEFAULT_SPEC),
        lambda e: quality.daily_event_counts(e, DEFAULT_SPEC.event_types),
        lambda e: quality.events_per_account_per_month(e),
        lambda e: grid.metric_grid(e, DEFAULT_SPEC),
        lambda e: metrics.all_metrics(e, DEFAULT_SPEC),
        lambda e: datasets.churn_training_dataset(e, DEFAULT_SPEC),
        lambda e: datasets.current_customer_dataset(e, DEFAULT_SPEC),
        lambda e: quality.metric_coverage(metrics.event_count_metrics(e, DEFAULT_SPEC), e, DEFAULT_SPEC),
    ],
)
def test_missing_mandatory_values_are_found_on_every_path(spark, column, path):
    with pytest.raises(Exception, match="NULL values where none may be"):
        path(_with_null(spark, column)).collect()


def test_event_table_by_name(spark, tmp_path):
    _with_null(spark, "none").write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("bound_log")
    try:
        assert events.read_event_table(spark, "bound_log").schema == as_event_log(spark.table("bound_log")).schema
        assert events.read_event_table(spark, "bound_log").count() == 2
        _with_null(spark, "event_type").write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("bound_log")
        with pytest.raises(ValueError, match="1 in event_type"):
            events.read_event_table(spark, "bound_log")
    finally:
        spark.sql("drop table if exists bound_log")


def test_definitions_with_their_composition(spark, tmp_path):
    table = definitions.definitions_frame(spark).union(spark.createDataFrame(NEW_METRICS, definitions.DEFINITION_SCHEMA))
    path = storage.write_csv(table.orderBy(F.desc("metric_name_id")).coalesce(1), str(tmp_path / "d"))
    spec = definitions.spec_with_definitions(definitions.read_definitions(spark, path))
    ids = [d.metric_name_id for d in spec.definitions]
    assert spec.by_id[14].components == (13, 5) and spec.by_id[15].sources == (13, 14)
    assert all(ids.index(i) < ids.index(d.metric_name_id) for d in spec.definitions for i in d.sources)
    assert spec.features[-4:] == [r[1].lower() for r in NEW_METRICS]
    assert spec.by_id[12] == DEFAULT_SPEC.by_id[12]


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([(20, "a", "*", 28, "total_metric", "21", None, None), (21, "b", "*", 28, "total_metric", "20", None, None)], "each other"),
        ([(20, "a", "*", 28, "total_metric", "99", None, None)], "not defined"),
        ([(20, "a", "*", 28, "ratio_metric", None, 1, None), (1, "c", "x", 28, "basic_event_count", None, None, None)], "not defined"),
        ([(20, "a", "*", 28, "total_metric", None, None, None)], "unknown composition"),
    ],
)
def test_wrong_compositions(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        definitions.spec_with_definitions(spark.createDataFrame(rows, definitions.DEFINITION_SCHEMA))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """Until the driver collected its garbage, the exchanges of all tables of a query lay on the disks."""

    def shuffle_files():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f.name for folder in folders for f in Path(folder).rglob("shuffle_*")}

    before, setting = shuffle_files(), spark.conf.get(storage.SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    found = storage.stored(counts.join(counts.select("k", F.col("count").alias("n")), "k"))
    until = time.time() + 20
    while shuffle_files() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files() - before
    assert found.count() == 7 and found.where("count = n").count() == 7
    assert spark.conf.get(storage.SHUFFLE_CLEANUP) == setting


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = storage.write_parquet(spark.range(3), str(tmp_path / "t"))
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('no'), id) as id")
    with pytest.raises(Exception, match="no"):
        storage.write_parquet(broken, path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    # also from its own rows
    storage.write_parquet(spark.read.parquet(path).selectExpr("id + 1 as id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="no"):
        storage.write_csv(broken, path)
    assert spark.read.parquet(path).count() == 3


def test_one_time_of_a_metric_table_is_rewritten_alone(spark, tmp_path):
    rows = spark.range(30).selectExpr(
        "cast(id % 5 as string) as account_id", "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 3 as int) * 7) as metric_time",
        "cast(1 as int) as metric_name_id", "id as metric_value",
    )
    path = storage.write_metric_table(rows, str(tmp_path / "m"))
    read = lambda: spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    before = {p: [f.stat().st_mtime_ns for f in sorted(p.glob("*.parquet"))] for p in sorted((tmp_path / "m").glob("metric_time=*"))}
    assert len(before) == 3 and read().exceptAll(rows).isEmpty() and rows.exceptAll(read()).isEmpty()
    late = rows.where("metric_time = timestamp_ntz'2020-01-08'").selectExpr("account_id", "metric_time", "metric_name_id", "metric_value + 100L as metric_value")
    storage.rewrite_metric_times(late, path)
    after = {p: [f.stat().st_mtime_ns for f in sorted(p.glob("*.parquet"))] for p in sorted((tmp_path / "m").glob("metric_time=*"))}
    assert [before[p] == after[p] for p in before] == [True, False, True]
    assert read().where("metric_value >= 100").count() == 10 and read().count() == 30
