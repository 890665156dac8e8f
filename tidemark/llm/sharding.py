"""Sharding by rendezvous hashing.

Each shard scores each key with a hash of both; the highest score wins. With weights the score is
``-weight / ln(u)``, u being the hash as a fraction, so a shard gets its share of the keys. A
further shard changes no score of the others: only keys that it wins move, all of them into it.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sources.storage import stored

#: Text that stands for a missing key, so that such rows also have one fixed shard.
NO_KEY = "\x00null"


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The winning shard, 0 to ``len(weights) - 1``. Equal scores go to the higher number."""
    text = F.coalesce(key.cast("string"), F.lit(NO_KEY))

    def score(shard: int, weight: float) -> Column:
        # the highest 53 bits of the hash, as a fraction strictly between 0 and 1
        fraction = (F.shiftrightunsigned(F.xxhash64(text, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(-float(weight)) / F.log(fraction)).alias("score"), F.lit(shard).alias("shard"))

    return F.greatest(*[score(s, w) for s, w in enumerate(weights)])["shard"] if len(weights) > 1 else F.lit(0)


def assign(
    df: DataFrame,
    weights: Sequence[float],
    *,
    key_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each row's shard, its place there and its shard if there were one more of the mean weight.

    Columns: the key, size (UTF-8 bytes + 1), text_crc32, law (``key``), shard, slot (gapless from 0 within a shard),
    grown_shard. A null text has size 1 and the checksum of an empty text; a null key has a fixed shard of its
    own; equal keys share a shard and get different slots; an empty table gives no rows.

    Slots need no window over a whole shard: rows are numbered within (task, shard), which is bounded by
    the size of a scan task, and shifted by the counts of the tasks before it.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key, text = F.col(key_column), F.coalesce(F.col(text_column), F.lit(""))
    grown = [*weights, sum(weights) / len(weights)]
    # written once, so that both uses below see the same task numbers even if an executor is lost
    rows = stored(
        df.select(
            key,
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(key, weights).cast("int").alias("shard"),
            shard_of(key, grown).cast("int").alias("grown_shard"),
            F.monotonically_increasing_id().alias("_row"),
        )
    ).withColumn("_task", F.shiftright("_row", 33))
    counts = rows.groupBy("shard", "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = Window.partitionBy("shard", "_task").orderBy("_row")
    return (
        rows.withColumn("_place", F.row_number().over(place) - 1)
        .join(offsets, ["shard", "_task"])
        .select(
            key_column,
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_before") + F.col("_place")).alias("slot"),
            "grown_shard",
        )
    )
