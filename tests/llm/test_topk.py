import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import OP6_SQL, op6_topk
from tidemark.llm.topk import search

TEST = "/root/testdata/sf0.01"


def test_all_embeddings_like_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{TEST}/embeddings.parquet'")
    expected = con.sql(f"select query_id, rank, vec_id, score from ({OP6_SQL}) order by all").fetchall()
    assert sorted(tuple(r) for r in op6_topk(spark, TEST).collect()) == expected


def brute(rows, is_query, k, scale=1024):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in ok if is_query(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)  # noqa: B905
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "chunk", "k"), [(8192, 64, 10), (10, 2, 3), (1, 1, 1), (70, 5, 200)])
def test_ties_repeats_and_odd_vectors(spark, block, chunk, k):
    rng = random.Random(block)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(150)]
    rows += [(7, rows[7][1]), (200, [0.5]), (201, []), (202, [3e3, -3e3, 0.0, 1e-9]), (-5, [0.5] * 4), (0, rows[0][1])]
    odd = [(300, None), (301, [1.0, None]), (302, [math.nan, 1.0]), (303, [math.inf]), (None, [1.0] * 4)]
    table = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], "vec_id long, embedding array<float>, rank string, score double")
    got = search(table, F.col("vec_id") % 10 == 0, block=block, chunk=chunk, k=k).collect()
    assert sorted(tuple(r) for r in got) == brute(rows + odd, lambda i: i % 10 == 0, k)


def test_empty_and_alone(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], empty.schema)
    assert search(one, F.lit(True)).count() == 0
    zero = spark.createDataFrame([(0, [0.0]), (1, [0.0])], empty.schema)
    assert sorted(map(tuple, search(zero, F.lit(True)).collect())) == [(0, 1, 1, 0), (1, 1, 0, 0)]
    with pytest.raises(ValueError, match="62 bits"):
        search(spark.createDataFrame([(0, [1e30])], empty.schema), F.lit(True))
