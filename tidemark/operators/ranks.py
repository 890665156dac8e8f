"""Exact order statistics without bringing a group into one task.

Ranks and running totals over a sorted order are computed in two levels. Distinct values are
first put into buckets by range, the edges coming from a sample of the values themselves, so that
buckets hold about as many values each, however the values are distributed. Bucket totals
(at most ``BUCKETS`` in all) give every bucket its offset; the order inside a bucket is
resolved per (group, bucket), which spreads one group over many tasks. Any monotone
bucketing gives the exact answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import quantile_name
from tidemark.sources.storage import stored

BUCKETS = 256


def range_buckets(df: DataFrame, *order: str) -> DataFrame:
    """``df``, stored, with ``bucket``: the number of its range in the order of the given columns."""
    ranged = df.repartitionByRange(BUCKETS, *order)
    return stored(ranged.withColumn("bucket", F.spark_partition_id()))


def value_counts(df: DataFrame, group: str, value: str, **sums: Column) -> DataFrame:
    """Rows per (group, value) and optional sums, stored in range buckets when the function is called.

    All later steps read only these distinct values, several times over.
    """
    counts = df.groupBy(group, value).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    return range_buckets(counts, group, value)


def group_ranges(counts: DataFrame, group: str, value: str) -> DataFrame:
    """One row per group: lowest and highest value, number of values and their mean."""
    v = F.col(value)
    return counts.where(v.isNotNull()).groupBy(group).agg(
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        F.sum("n").alias("total"),
        (F.sum(v * F.col("n")) / F.sum("n")).alias("mean"),
    )


def exact_quantiles(counts: DataFrame, group: str, value: str, probabilities: Sequence[float]) -> DataFrame:
    """``group, p, quantile``: linear interpolation between the two neighbouring ranks.

    ``counts`` comes from :func:`value_counts`; groups are few (columns of a dataset).
    Only values in the few buckets that hold a wanted rank are sorted.
    """
    bucketed = counts.where(F.col(value).isNotNull()).select(group, value, "n", "bucket")
    by_bucket = Window.partitionBy(group).orderBy("bucket")
    totals = (
        bucketed.groupBy(group, "bucket")
        .agg(F.sum("n").alias("in_bucket"))
        .withColumn("upto", F.sum("in_bucket").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("upto") - F.col("in_bucket"))
    )
    rank = F.col("p") * (F.col("total") - 1)
    neighbours = F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))
    # at most two ranks per group and probability
    targets = (
        totals.withColumn("total", F.sum("in_bucket").over(Window.partitionBy(group)))
        .withColumn("p", F.explode(F.array(*map(F.lit, probabilities))))
        .withColumn("rank", rank)
        .where((F.col("rank") > F.col("before") - 1) & (F.col("rank") < F.col("upto")))
        .withColumn("at", F.explode(neighbours))
        .where((F.col("before") <= F.col("at")) & (F.col("at") < F.col("upto")))
        .groupBy(group, "bucket")
        .agg(F.collect_list(F.struct("p", "rank", (F.col("at") - F.col("before")).alias("place"))).alias("targets"))
    )
    inside = Window.partitionBy(group, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("upto")
    found = (
        bucketed.join(F.broadcast(targets), [group, "bucket"])
        .withColumn("upto", F.sum("n").over(inside))
        .withColumn("hits", F.filter("targets", lambda t: (t.place < upto) & (t.place >= upto - F.col("n"))))
        .select(group, value, F.inline("hits"))
    )
    fraction = F.max(F.col("rank") - F.floor("rank"))
    low, high = F.min(value), F.max(value)
    return found.groupBy(group, "p").agg((low + (high - low) * fraction).alias("quantile"))


def quantile_columns(quantiles: DataFrame, group: str, probabilities: Sequence[float]) -> DataFrame:
    """One row per group, one column per probability."""
    return quantiles.groupBy(group).agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(quantile_name(p)) for p in probabilities]
    )


def running_totals(df: DataFrame, bucket: str, order: Column, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_upto``: the total of a column over all rows up to and including this one.

    ``bucket`` must be monotone in ``order`` and bounded in number.
    """
    before = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(F.col(bucket).alias("bucket_"))
        .agg(*[F.sum(c).alias(c) for c in columns])
        .select("bucket_", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in columns])
    )
    inside = Window.partitionBy(bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(F.broadcast(offsets), F.col(bucket) == F.col("bucket_")).select(
        *df.columns, *[(F.sum(c).over(inside) + F.col(f"{c}_before")).alias(f"{c}_upto") for c in columns]
    )


# --- hash order --------------------------------------------------------------------

HASH_PREFIX = 4  # hex digits, 65,536 buckets


def hash_key(seed: int, columns: Sequence[str]) -> Column:
    """A reproducible pseudo-random order of rows: hex text, uniform and independent of layout."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def hash_cuts(keyed: DataFrame, sizes: DataFrame, group: str, key: str) -> DataFrame:
    """``group, cut_no, cut``: the key of the row at each wanted position of the hash order.

    ``sizes`` holds ``group, cut_no, size`` (a handful of rows): the number of rows of
    the group whose key is at most the cut. Rows are then assigned by comparing their
    key with the cuts, so the data itself is never sorted.
    """
    prefix = F.substring(key, 1, HASH_PREFIX)
    by_bucket = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        keyed.groupBy(group, prefix.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("in_bucket"))
        .withColumn("upto", F.sum("in_bucket").over(by_bucket))
        .withColumn("before", F.col("upto") - F.col("in_bucket"))
    )
    targets = (
        totals.join(F.broadcast(sizes), group)
        .where((F.col("before") < F.col("size")) & (F.col("size") <= F.col("upto")))
        .groupBy(group, "bucket")
        .agg(F.collect_list(F.struct("cut_no", (F.col("size") - F.col("before")).alias("place"))).alias("targets"))
    )
    inside = Window.partitionBy(group, "bucket").orderBy(key)
    return (
        keyed.select(group, key, prefix.alias("bucket"))
        .join(F.broadcast(targets), [group, "bucket"])
        .withColumn("rank", F.row_number().over(inside))
        .select(group, F.col(key).alias("cut"), "rank", F.inline("targets"))
        .where(F.col("rank") == F.col("place"))
        .select(group, "cut_no", "cut")
    )
