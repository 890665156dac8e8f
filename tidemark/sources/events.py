"""The event log: schema, CSV loader and bindings to the star-schema test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import required
from tidemark.functions.schema import expect_columns
from tidemark.operators.grid import checked_bounds
from tidemark.sources.storage import NO_VALUE
from tidemark.spec import DEFAULT_SPEC, ChurnSpec

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampNTZType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("product_id", T.IntegerType(), True),
        T.StructField("additional_data", T.StringType(), True),
    ]
)

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()


def read_event_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Event log from CSV with a header row.

    Malformed rows and missing mandatory values fail the job. ``multi_line`` allows
    line breaks inside quoted fields, at the price of one task per file; without
    it such a row counts as malformed.
    """
    raw = (
        spark.read.schema(EVENT_SCHEMA)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("nullValue", NO_VALUE)  # an empty field is NULL, quoted empty text stays text
        .option("multiLine", multi_line)
        .csv(path)
    )
    return raw.select(
        *[
            F.col(f.name)
            if f.nullable
            else required(f.name, f"event log: {f.name} must not be NULL").alias(f.name)
            for f in EVENT_SCHEMA
        ]
    )


def as_event_log(df: DataFrame) -> DataFrame:
    """Bring any frame that has the five columns to the canonical types."""
    expect_columns(df, EVENT_COLUMNS, "event log")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA])


def read_event_table(spark: SparkSession, name: str) -> DataFrame:
    """The event log by its name in the session's catalog, with the contract of the log: types, and no missing mandatory values."""
    events = as_event_log(spark.table(name))
    checked_bounds(events)
    return events


# --- bindings to the test tables ---------------------------------------------------

ACTIVITY_TYPES = {
    "view": "ReadingOwnedBook",
    "purchase": "EBookDownloaded",
    "click": "ReadingFreePreview",
    "signup": "HighlightCreated",
    "error": "SearchMade",
}

PRIORITY_TYPES = {
    "1-URGENT": "ReadingOwnedBook",
    "2-HIGH": "EBookDownloaded",
    "3-MEDIUM": "ReadingFreePreview",
    "4-NOT SPECIFIED": "HighlightCreated",
    "5-LOW": "SearchMade",
}

ACTIVITY_SPEC: ChurnSpec = DEFAULT_SPEC.at(dt.date(2024, 1, 30))
ORDER_SPEC: ChurnSpec = DEFAULT_SPEC.at(dt.date(1999, 7, 1))


def _relabel(column: str, names: dict[str, str]):
    """Rename known values, leave others as they are."""
    out = F.col(column)
    for source, target in reversed(names.items()):
        out = F.when(F.col(column) == source, F.lit(target)).otherwise(out)
    return out


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log from the ``events`` table; product 0 stands for "no product"."""
    product = F.get_json_object("props", "$.k").cast("int")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").cast("string").alias("account_id"),
        F.col("ts").alias("event_time"),
        _relabel("event_type", ACTIVITY_TYPES).alias("event_type"),
        F.nullif(product, F.lit(0)).alias("product_id"),
        F.col("props").alias("additional_data"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log from order lines: one event per line, at its order's date."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderdate").alias("event_time"),
        _relabel("o_orderpriority", PRIORITY_TYPES).alias("event_type"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("l_returnflag").alias("additional_data"),
    )
