"""Exact top-k search by inner product on a bit-sliced index.

Components are quantised to integers. A block of rows is indexed as bitmaps: bit j of component d of all its rows is one
bitmap (slice). For a query the slices are added up by bitmap arithmetic: each set bit i of a query component
contributes slice j with weight i + j, and full adders (sum: exclusive or, carry: majority) reduce the bitmaps
of a weight to one, with carries to the next weight. What remains are the slices of the scores of all rows.

Top rows are selected from the most significant slice downward: rows that are certain to be in, rows
that may still be. Rows left at the boundary have equal scores and are taken by smallest id.

Queries meet the blocks as chunks: each chunk of queries is sent to each block. The best of each block are merged
with a limit per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import ship_package
from tidemark.llm.hashing import hash64
from tidemark.sources.storage import stored

SCALE = 1024
TOP = 10
#: Rows in a block and queries in a chunk, on average.
BLOCK = 8192
CHUNK = 64


class Slices:
    """The bit-sliced index of a block of rows, sorted by id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, low: int, bits: int):
        self.ids, self.low, self.bits = ids, low, bits
        self.words = -(-len(ids) // 64)
        # shifted to be non-negative: value = shifted + low
        shifted = np.zeros((values.shape[1], self.words * 64), np.uint64)
        shifted[:, : len(ids)] = (values - low).T.astype(np.uint64)
        planes = [
            np.packbits(((shifted >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little") for j in range(bits)
        ]
        self.planes = np.stack([p.view(np.uint64) for p in planes], axis=1) if bits else None
        every = np.zeros(self.words * 64, np.uint8)
        every[: len(ids)] = 1
        self.every = np.packbits(every, bitorder="little").view(np.uint64)

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the scores, least significant first, and what to add to each score."""
        by_weight: dict[int, list[np.ndarray]] = {}
        # -q * x = q * (complement of x) - q * (2 ** bits - 1)
        add = int(self.low) * int(query.sum()) + sum(int(q) for q in query if q < 0) * ((1 << self.bits) - 1)
        if not self.bits:
            return [], add
        size = np.abs(query)
        for i in range(int(size.max()).bit_length()):
            for negative in (False, True):
                rows = np.flatnonzero(((size >> i) & 1).astype(bool) & ((query < 0) == negative))
                if len(rows):
                    for j in range(self.bits):
                        picked = self.planes[rows, j]
                        by_weight.setdefault(i + j, []).append(~picked if negative else picked)
        out, weight = [], 0
        while weight in by_weight or weight < max(by_weight, default=0):
            maps = np.concatenate(by_weight.pop(weight)) if weight in by_weight else np.zeros((1, self.words), np.uint64)
            while len(maps) > 1:
                third = len(maps) // 3
                if third:
                    a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
                    either = a ^ b
                    total, carry, rest = either ^ c, (a & b) | (c & either), maps[3 * third :]
                else:
                    total, carry, rest = maps[:1] ^ maps[1:2], maps[:1] & maps[1:2], maps[2:]
                maps = np.concatenate([total, rest])
                by_weight.setdefault(weight + 1, []).append(carry)
            out.append(maps[0])
            weight += 1
        return out, add

    def top(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows, in no order; rows with the query's own id take no part."""
        slices, add = self.score_slices(query)
        maybe, certain = self.every.copy(), np.zeros(self.words, np.uint64)
        for own in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            maybe[own >> 6] &= ~np.uint64(1 << (own & 63))
        for one in reversed(slices):
            better = maybe & one
            found = int(np.bitwise_count(certain | better).sum())
            if found > k:
                maybe = better
            else:
                certain |= better
                maybe &= ~one
                if found == k:
                    break
        rows = self._rows(certain)
        rows = np.concatenate([rows, self._rows(maybe)[: k - len(rows)]])  # the boundary: equal scores, smallest ids
        scores = [add] * len(rows)
        for w, one in enumerate(slices):
            bits = (one[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
            scores = [s + (int(b) << w) for s, b in zip(scores, bits, strict=True)]
        return list(zip(self.ids[rows].tolist(), scores, strict=True))

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def search(
    df: DataFrame,
    is_query: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = TOP,
    scale: int = SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best rows for each row where ``is_query`` holds.

    Components count as floor(scale * x); the score is their inner product; equal scores go by smaller id. Rows
    whose id or vector is null, or whose vector holds null or non-finite components, take no part. Shorter
    vectors are filled with zeros. The id names a row: no row is a result of a query with the same id; a repeated
    row is a result as often as it occurs, but one query. An empty table gives no rows. If scores might not fit 62
    bits, a ``ValueError`` says so. Other columns are ignored.
    """
    spark = df.sparkSession
    ship_package(spark)
    key, vector = F.col(id_column).cast("long"), F.col(vector_column)
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    taken = df.where(F.col(id_column).isNotNull() & vector.isNotNull()).where(finite)
    size = F.greatest(F.abs(F.array_max(vector)), F.abs(F.array_min(vector))).cast("double")
    facts = taken.agg(
        F.count("*").alias("n"), F.sum(F.when(is_query, 1)).alias("queries"), F.max(F.size(vector)).alias("dims"), F.max(size).alias("most")
    ).first()
    dims, most = facts["dims"] or 0, abs(facts["most"] or 0.0) * scale + 1
    if most * most * max(dims, 1) >= 2**62:
        raise ValueError("scores might not fit 62 bits")
    blocks, chunks = max(1, -(-facts["n"] // block)), max(1, -(-(facts["queries"] or 0) // chunk))
    filled = F.concat(quantised(vector, scale), F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(vector)))
    table = stored(taken.select(key.alias("id"), filled.alias("v"), is_query.alias("q"), F.monotonically_increasing_id().alias("row")))
    ends = table.agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).first()
    low, high = ends["lo"] or 0, ends["hi"] or 0
    bits = (high - low).bit_length()

    rows = table.select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(0).alias("step"),
        F.col("id").alias("first"),
        F.array("id").alias("ids"),
        F.col("v").alias("values"),
    )
    grouped = (
        table.where("q")
        .select("id", "v")
        .distinct()
        .groupBy(F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("qs"))  # about ``chunk`` distinct queries
    )
    asked = grouped.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(1).alias("step"),
        F.col("chunk").alias("first"),
        F.col("qs.id").alias("ids"),
        F.flatten("qs.v").alias("values"),
    )
    dealt = rows.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "step", "first")
    schema = "query_id long, query_key long, vec_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "query_key", "vec_id", "score"]
        current, ids, parts, index = None, [], [], None
        for given in batches:
            for i in range(given.num_rows):
                at, step = given.column("block")[i].as_py(), given.column("step")[i].as_py()
                if at != current:
                    current, ids, parts, index = at, [], [], None
                mine = given.column("ids")[i].values.to_numpy(zero_copy_only=False)
                values = given.column("values")[i].values.to_numpy(zero_copy_only=False).reshape(len(mine), dims)
                if step == 0:
                    ids.append(mine)
                    parts.append(values)
                    continue
                if not ids:
                    continue
                index = index or Slices(np.concatenate(ids), np.concatenate(parts), low, bits)
                out = [
                    (int(q), hash64(v.tobytes()), *found)
                    for q, v in zip(mine, values, strict=True)
                    for found in index.top(int(q), v, k)
                ]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4, names)

    best = dealt.select("block", "step", "ids", "values").mapInArrow(run, schema)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
