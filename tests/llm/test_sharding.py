import zlib
from collections import Counter, defaultdict

import pytest
from brute import ODD, odd_table
from pyspark.sql import functions as F

from tidemark.llm.queries import op10_sharding
from tidemark.llm.sharding import assign, shard_of

TEST = "/root/testdata/sf0.01"


def test_all_documents(spark):
    texts = dict(spark.read.parquet(f"{TEST}/documents.parquet").select("doc_id", "text").collect())
    rows = op10_sharding(spark, TEST).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights_and_growth_moves_little(spark):
    keys = spark.range(40000)
    weights = [1.0, 1.0, 2.0, 4.0]
    shares = Counter(r[0] for r in keys.select(shard_of(F.col("id"), weights)).collect())
    assert all(shares[s] == pytest.approx(40000 * w / 8, rel=0.05) for s, w in enumerate(weights))
    moved = keys.select(shard_of(F.col("id"), [1] * 16).alias("a"), shard_of(F.col("id"), [1] * 17).alias("b"))
    assert moved.where("a != b and b != 16").count() == 0
    assert moved.where("b = 16").count() == pytest.approx(40000 / 17, rel=0.1)


def test_shard_is_the_highest_score(spark):
    rows = spark.range(300).select("id", shard_of(F.col("id"), [1.0] * 5).alias("shard"))
    hashes = spark.range(300).select(
        "id", *[F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit(s)), 11).alias(str(s)) for s in range(5)]
    )
    best = {r.id: max(range(5), key=lambda s: r[str(s)]) for r in hashes.collect()}
    assert dict(rows.collect()) == best


def test_odd_rows(spark):
    rows = assign(odd_table(spark).repartition(4), [1.0, 3.0]).collect()
    assert len(rows) == len(ODD) + 3
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1  # equal keys share a shard
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (0, 1)} == {(1, 0)}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert assign(odd_table(spark).limit(0), [1.0]).count() == 0
    with pytest.raises(ValueError, match="positive"):
        assign(odd_table(spark), [1.0, 0.0])
