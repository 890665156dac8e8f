"""Metric definitions from a CSV table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schema import expect_columns
from tidemark.spec import DEFAULT_SPEC, RATIO, SUM_OF_METRICS, ChurnSpec, MetricDefinition, in_order

PLAIN_SCHEMA = "metric_name_id int, metric_name string, event_type string, lookback_days int, metric_kind string"
#: Optional columns: metric ids of a sum, joined by semicolons, and the two of a ratio.
DEFINITION_SCHEMA = f"{PLAIN_SCHEMA}, components string, numerator int, denominator int"


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table of definitions, with or without the columns of the composition."""
    (header,) = spark.read.text(path).first()  # a table of definitions is a small file
    schema = DEFINITION_SCHEMA if "components" in header.split(",") else PLAIN_SCHEMA
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def definitions_frame(spark: SparkSession, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    rows = [
        (
            d.metric_name_id, d.metric_name, d.event_type, d.lookback_days, d.metric_kind,
            ";".join(map(str, d.components)) or None, d.numerator, d.denominator,
        )
        for d in spec.definitions
    ]
    return spark.createDataFrame(rows, DEFINITION_SCHEMA)


def spec_with_definitions(table: DataFrame, like: ChurnSpec = DEFAULT_SPEC) -> ChurnSpec:
    """A spec with the metrics of the table, each behind those that it is made of.

    Sums and ratios are made of what the table says; where it does not say, of what the metric of the same id in ``like`` is made of.
    Metrics that ``like`` does not know become features behind those it knows.
    """
    for name, kind in (("components", "string"), ("numerator", "int"), ("denominator", "int")):
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast(kind))
    names = ["metric_name_id", "metric_name", "event_type", "lookback_days", "metric_kind", "components", "numerator", "denominator"]
    expect_columns(table, names, "metric definitions")
    definitions = []
    for r in table.select(*names).orderBy("metric_name_id").collect():  # each definition is a column of every plan
        d = MetricDefinition(*r[:5], tuple(int(x) for x in (r.components or "").split(";") if x.strip()), r.numerator, r.denominator)
        if d.metric_kind in (SUM_OF_METRICS, RATIO) and not any(d.sources):
            known = like.by_id.get(d.metric_name_id)
            if known is None or known.metric_kind != d.metric_kind:
                raise ValueError(f"metric {d.metric_name_id}: unknown composition of a {d.metric_kind}")
            d = replace(d, components=known.components, numerator=known.numerator, denominator=known.denominator)
        definitions.append(d)
    ids = [d.metric_name_id for d in definitions]
    order = [i for i in like.feature_order if i in ids] + [i for i in ids if i not in like.feature_order]
    return replace(like, definitions=in_order(tuple(definitions)), feature_order=tuple(order))
