"""Boosted trees for many settings at once.

A search fits the same rows again and again: every candidate on every fold. Here all of these *chains* grow side by side. Rows are
cut into bins once and kept in a table with the running score of each chain, so one pass over the table serves all
chains, where fitting them one by one would read it once per chain, tree and level.

* Rows with the same bins, label and fold have the same scores in every chain. They are kept as one line with the hashes of its rows, so
  draws and sums are those of the single rows, and the work grows with the distinct lines.
* A pass adds up gradients and curvatures per (chain, node, feature, bin) inside its tasks; the sums meet per chain, where the best
  split of every node is chosen. The driver receives splits, whose number the grid bounds.
* Sums are whole numbers (fixed-point fractions), so they do not depend on the order of rows or the cut into tasks. Rows and
  columns are drawn by hashes of row ids, seed and round. The same rows give the same trees on any cluster.
* A table of at most ``SMALL`` lines, and eight times as many rows, is one part. Its sums are complete where they are made, so a task can go on to the next level
  by itself, and chains are dealt out to tasks instead of rows. The trees are the same.
* After every ``step`` rounds scores and trees are stored. A search that was stopped goes on from there.

Splits maximise the second-order gain with ridge ``RIDGE``; a child needs a curvature of ``LEAST``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import (
    exists,
    read_bytes,
    read_json,
    remove,
    shared_dir,
    ship_package,
    write_bytes,
    write_json,
    write_parquet,
)

RIDGE, LEAST = 1.0, 1.0
BINS = 64
#: Lines that one task may hold with the scores of its chains, rows for each of them on average, and the rows of a part of a larger table.
SMALL, ROWS_A_LINE, PART = 1_000_000, 8, 200_000
#: Lines that are added up at a time, few enough for a processor's cache.
CHUNK = 1 << 15
#: Rounds between two stored states of a small and of a large table.
STEP_SMALL, STEP = 50, 10
_UNIT, _SHARE = float(1 << 20), 1 << 17
_STATE = "block int, label byte, fold int, h array<long>, bins binary, scores binary"


@dataclass(frozen=True)
class Chain:
    """One setting on the rows outside of ``fold`` (-1: on all rows)."""

    fold: int
    rounds: int
    max_depth: int
    learning_rate: float
    subsample: float
    colsample: float


@dataclass
class Trees:
    """Trees as heaps: the children of node i are 2 i + 1 and 2 i + 2. Arrays are indexed by chain, round and node."""

    feature: np.ndarray  # -1: no split
    split: np.ndarray  # bins up to this one go left
    value: np.ndarray
    gain: np.ndarray
    count: np.ndarray

    @classmethod
    def none(cls, chains: int, rounds: int, depth: int) -> Trees:
        shape = chains, rounds, 2 ** (depth + 1) - 1
        kinds = np.int16, np.int16, float, float, np.int64
        return cls(*(np.full(shape, -1 if i == 0 else 0, k) for i, k in enumerate(kinds)))

    def part(self, chains, rounds) -> Trees:
        return Trees(*(getattr(self, f.name)[chains][:, rounds] for f in fields(self)))

    def put(self, chain: int, rounds: slice, other: Trees) -> None:
        for f in fields(self):
            getattr(self, f.name)[chain, rounds] = getattr(other, f.name)[0]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Trees:
        held = np.load(io.BytesIO(data))
        return cls(*(held[f.name] for f in fields(cls)))


# --- inside a task -----------------------------------------------------------------


def nodes_of(bins: np.ndarray, feature: np.ndarray, split: np.ndarray, depth: int) -> np.ndarray:
    """The node of every row after at most ``depth`` splits."""
    at = np.zeros(len(bins), np.int64)
    for _ in range(depth):
        at = below(bins, feature, split, at)
    return at


def below(bins: np.ndarray, feature: np.ndarray, split: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The node of every row after one more split."""
    chosen = feature[at]
    right = bins[np.arange(len(bins)), chosen] > split[at]
    return np.where(chosen >= 0, 2 * at + 1 + right, at)


def drawn(h: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Which rows a round draws."""
    if share >= 1:
        return np.ones(len(h), bool)
    kept = np.empty(len(h), bool)
    for i in range(0, len(h), CHUNK):
        x = h[i : i + CHUNK] + np.uint64((seed * 1_000_003 + turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        kept[i : i + CHUNK] = (x ^ (x >> np.uint64(31))) >> np.uint64(40) < np.uint64(share * (1 << 24))
    return kept


def columns_drawn(n: int, seed: int, turn: int, share: float) -> np.ndarray:
    """Which features a tree may use."""
    kept = np.zeros(n, bool)
    kept[np.random.default_rng([seed, turn]).permutation(n)[: max(1, int(share * n))]] = True
    return kept


class Rows:
    """Some lines of the state, for the chains of one block."""

    def __init__(self, table, chains: Sequence[Chain], n_features: int):
        self.chains = chains
        column = {n: table.column(n) for n in ("label", "fold", "h", "bins", "scores")}
        hashes = column["h"].combine_chunks() if isinstance(column["h"], pa.ChunkedArray) else column["h"]
        self.label = column["label"].to_numpy(zero_copy_only=False).astype(float)
        self.fold = column["fold"].to_numpy(zero_copy_only=False)
        self.h = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        self.count = pc.list_value_length(hashes).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.draws = None, {}
        n = len(self.label)
        given = np.frombuffer(b"".join(column["bins"].to_pylist()), np.uint8).reshape(n, n_features)
        self.bins = np.ascontiguousarray(given.T).T  # sums go through one feature after the other
        self.scores = np.frombuffer(b"".join(column["scores"].to_pylist()), float).reshape(n, len(chains)).copy()

    def add(self, c: int, trees: Trees) -> None:
        """Adds the trees of chain ``c`` (the only one in ``trees``) to its scores."""
        chain = self.chains[c]
        for feature, split, value in zip(trees.feature[0], trees.split[0], trees.value[0], strict=True):
            self.scores[:, c] += chain.learning_rate * value[nodes_of(self.bins, feature, split, chain.max_depth)]

    def drawn(self, seed: int, turn: int, share: float) -> np.ndarray:
        """How many rows of each line a round draws; chains with the same share have the same rows."""
        if share >= 1:
            return self.count
        if self.draws[0] != (seed, turn):
            self.draws = (seed, turn), {}
        if share not in self.draws[1]:
            self.draws[1][share] = np.add.reduceat(drawn(self.h, seed, turn, share), self.start, dtype=np.int64)
        return self.draws[1][share]

    def given(self, c: int, turn: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What a round adds up, on all of its levels: the lines that take part, their gradients, curvatures and rows."""
        chain = self.chains[c]
        weight = self.drawn(seed, turn, chain.subsample)
        lines = np.flatnonzero((self.fold != chain.fold) & (weight > 0))
        weight = weight[lines].astype(float)
        p = 1 / (1 + np.exp(-self.scores[lines, c]))
        return lines, weight * np.rint((p - self.label[lines]) * _UNIT), weight * np.rint(p * (1 - p) * _UNIT), weight

    def sums(self, given: tuple[np.ndarray, ...], at: np.ndarray, level: int, bins: int, allowed: np.ndarray) -> np.ndarray:
        """Gradients, curvatures and rows per node of the level, feature and bin; ``at`` is the node of every line.

        Whole numbers below 2^53 are exact in double precision, so curvatures (up to 2^18 each) and rows share one sum
        where there are few enough rows.
        """
        total = np.zeros((3, 2**level, len(allowed), bins), np.int64)
        cells = 2**level * bins
        for i in range(0, len(given[0]), CHUNK):
            lines, gradient, curvature, weight = (x[i : i + CHUNK] for x in given)
            slot = at[lines] - (2**level - 1)
            inside = slot >= 0
            if not inside.all():
                lines, slot, gradient, curvature, weight = (x[inside] for x in (lines, slot, gradient, curvature, weight))
            slot *= bins
            packed = weight.sum() < _SHARE
            both = curvature * _SHARE + weight if packed else None
            for f in np.flatnonzero(allowed):
                place = slot + self.bins[:, f][lines]
                add = lambda w: np.bincount(place, w, cells).astype(np.int64).reshape(2**level, bins)  # noqa: B023, E731
                total[0, :, f] += add(gradient)
                if packed:
                    found = add(both)
                    total[1, :, f] += found // _SHARE
                    total[2, :, f] += found % _SHARE
                else:
                    total[1, :, f] += add(curvature)
                    total[2, :, f] += add(weight)
        return total


def choose(sums: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """For every node: feature (-1: none), bin, gain, and value and rows of the node and its two children."""
    running = sums.cumsum(axis=-1)
    one = int(allowed.argmax())  # every feature adds up to the whole node
    whole = running[:, :, one : one + 1, -1:]
    (g, h, _), (gl, hl, _), (gr, hr, _) = whole / _UNIT, running / _UNIT, (whole - running) / _UNIT
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g**2 / (h + RIDGE)
    gain[(hl < LEAST) | (hr < LEAST) | ~allowed[:, None]] = -np.inf
    nodes, n, bins = gain.shape
    best = gain.reshape(nodes, -1).argmax(axis=1)
    at = np.arange(nodes), best // bins, best % bins
    found = np.where(gain[at] > 1e-6, best // bins, -1)
    value = lambda a, b: -a / (b + RIDGE)
    return np.column_stack(
        [found, best % bins, gain[at], value(g, h)[:, 0, 0], whole[2, :, 0, 0], value(gl[at], hl[at]), running[2][at]]
        + [value(gr[at], hr[at]), (whole - running)[2][at]]
    )


def place(trees: Trees, chain: int, turn: int, level: int, chosen: np.ndarray) -> None:
    """Writes the choice for a level into the tree; nodes that no row can reach stay empty."""
    for k, (feature, split, gain, value, n, left, n_left, right, n_right) in enumerate(chosen):
        node = 2**level - 1 + k
        if level and (trees.feature[chain, turn, (node - 1) // 2] < 0):
            continue
        if not level:
            trees.value[chain, turn, node], trees.count[chain, turn, node] = value, n
        if feature >= 0:
            trees.feature[chain, turn, node], trees.split[chain, turn, node], trees.gain[chain, turn, node] = feature, split, gain
            trees.value[chain, turn, 2 * node + 1 : 2 * node + 3] = left, right
            trees.count[chain, turn, 2 * node + 1 : 2 * node + 3] = n_left, n_right


def grow(rows: Rows, first: int, last: int, seed: int, bins: int) -> list[Trees]:
    """Rounds ``first`` to ``last`` of all chains of a block, from rows that are all there.

    Chains go on round by round, so that one draw of rows serves all of them.
    """
    grown = [Trees.none(1, max(0, min(last, x.rounds) - first), x.max_depth) for x in rows.chains]
    for i, turn in enumerate(range(first, last)):
        for c, (chain, trees) in enumerate(zip(rows.chains, grown, strict=True)):
            if turn >= chain.rounds:
                continue
            allowed = columns_drawn(rows.bins.shape[1], seed, turn, chain.colsample)
            given, at = rows.given(c, turn, seed), np.zeros(len(rows.label), np.int64)
            for level in range(chain.max_depth):
                place(trees, 0, i, level, choose(rows.sums(given, at, level, bins, allowed), allowed))
                at = below(rows.bins, trees.feature[0, i], trees.split[0, i], at)
            rows.scores[:, c] += chain.learning_rate * trees.value[0, i][at]
    return grown


# --- the table of rows and scores ----------------------------------------------------


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """For each feature the values at which bins end; exact for up to some thousand distinct values."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f), shares, 10_000).alias(f"f{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(found[i] or [], float)) for i in range(len(features))]


def binned_rows(
    rows: DataFrame, features: Sequence[str], ids: Sequence[str], target: str, fold: Column, seed: int, edges: Sequence[np.ndarray]
) -> DataFrame:
    """``label, fold, h, bins``: hash of the ids, and one byte for the bin of every feature."""
    h = F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in ids])
    given = rows.select(F.col(target).cast("byte"), fold.cast("int"), h, *[F.col(f).cast("double") for f in features])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, fold_, h_, *values = batch.columns
            cut = np.column_stack([np.searchsorted(e, v.to_numpy(zero_copy_only=False)) for e, v in zip(edges, values, strict=True)])
            lines = pa.array([r.tobytes() for r in cut.astype(np.uint8)], pa.binary())
            yield pa.record_batch([label, fold_, h_, lines], names=["label", "fold", "h", "bins"])

    return given.mapInArrow(binned, "label byte, fold int, h long, bins binary")


@dataclass
class Fit:
    """One run: what is fixed, and the folder of its states."""

    spark: SparkSession
    chains: list[Chain]
    blocks: list[list[int]]
    edges: list[np.ndarray]
    small: bool
    seed: int
    bins: int
    folder: str

    @property
    def n_features(self) -> int:
        return len(self.edges)

    def state(self, done: int) -> DataFrame:
        return self.spark.read.schema(_STATE).parquet(f"{self.folder}/state-{done}")

    def begin(self, given: DataFrame, parts: int) -> None:
        """Writes the first state: the lines of ``given`` in each part, once for every block of chains."""
        part = F.pmod(F.col("h"), F.lit(parts))
        lines = given.groupBy("label", "fold", "bins", part.alias("part")).agg(F.collect_list("h").alias("h"))
        blocks = F.array(*[
            F.struct(F.lit(b).alias("block"), F.unhex(F.lit("00" * 8 * len(chains))).alias("scores")) for b, chains in enumerate(self.blocks)
        ])
        # a part of a block is one file, so later passes find their rows together
        table = lines.select("*", F.inline(blocks)).repartition(4 * parts * len(self.blocks), "block", "part")
        write_parquet(table.select("block", "label", "fold", "h", "bins", "scores"), f"{self.folder}/state-0")

    def _by_block(self, batch, chains) -> Iterator[tuple[int, Rows]]:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        for b in np.unique(block):
            yield int(b), Rows(batch.filter(pa.array(block == b)), [chains[c] for c in self.blocks[b]], len(self.edges))

    def small_rounds(self, trees: Trees, first: int, last: int) -> None:
        """All rounds of a stretch in one pass; a task has a block of chains and all of the few rows."""
        chains, blocks, seed, bins, n = self.chains, self.blocks, self.seed, self.bins, self.n_features

        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            rows = Rows(table, [chains[c] for c in blocks[key[0].as_py()]], n)
            mine = blocks[key[0].as_py()]
            grown = [trees.to_bytes() for trees in grow(rows, first, last, seed, bins)]
            return pa.table({"chain": pa.array(mine, pa.int32()), "trees": pa.array(grown, pa.binary())})

        run.__annotations__ = {"key": tuple[pa.Scalar, ...], "table": pa.Table, "return": pa.Table}
        state = self.state(first).repartition(4 * len(blocks), "block")
        for chain, data in state.groupBy("block").applyInArrow(run, "chain int, trees binary").collect():
            found = Trees.from_bytes(data)
            nodes = found.feature.shape[2]
            rounds = slice(first, first + found.feature.shape[1])
            for f in fields(Trees):
                getattr(trees, f.name)[chain, rounds, :nodes] = getattr(found, f.name)[0]

    def level(self, trees: Trees, first: int, turn: int, level: int) -> None:
        """One pass over the rows for one level of the trees of all chains."""
        fit, seed, bins = self._plain(), self.seed, self.bins
        chains = self.chains
        live = {c for c, x in enumerate(chains) if level < x.max_depth and turn < x.rounds}
        shared = self.spark.sparkContext.broadcast(trees.part(slice(None), slice(first, turn + 1)))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, total = shared.value, {}
            for batch in batches:
                for b, rows in fit._by_block(batch, chains):
                    for i, c in enumerate(fit.blocks[b]):
                        if c not in live:
                            continue
                        rows.add(i, known.part([c], slice(0, turn - first)))
                        at = nodes_of(rows.bins, known.feature[c, -1], known.split[c, -1], level)
                        sums = rows.sums(rows.given(i, turn, seed), at, level, bins, columns_drawn(fit.n_features, seed, turn, chains[c].colsample))
                        total[c] = total[c] + sums if c in total else sums
            for c, sums in total.items():
                yield pa.record_batch([pa.array([c], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["chain", "sums"])

        n = self.n_features

        def best(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = 0
            for batch in batches:
                for data in batch.column("sums").to_pylist():
                    sums = sums + np.frombuffer(data, np.int64)
            c = key[0].as_py()
            allowed = columns_drawn(n, seed, turn, chains[c].colsample)
            chosen = choose(sums.reshape(3, 2**level, n, bins), allowed)
            yield pa.record_batch([pa.array([c], pa.int32()), pa.array([chosen.tobytes()], pa.binary())], names=["chain", "chosen"])

        best.__annotations__ = {
            "key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]
        }
        passed = self.state(first).mapInArrow(summed, "chain int, sums binary")
        for c, data in passed.groupBy("chain").applyInArrow(best, "chain int, chosen binary").collect():
            place(trees, c, turn, level, np.frombuffer(data).reshape(2**level, -1))
        shared.unpersist()

    def _plain(self) -> Fit:
        """Without the session, to be sent to tasks."""
        return Fit(None, self.chains, self.blocks, self.edges, self.small, self.seed, self.bins, self.folder)

    def advance(self, trees: Trees, first: int, last: int) -> None:
        """The state after round ``last``: the scores with the trees since ``first``."""
        fit, chains = self._plain(), self.chains
        shared = self.spark.sparkContext.broadcast(trees.part(slice(None), slice(first, last)))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block = batch.column("block").to_numpy(zero_copy_only=False)
                for b, rows in fit._by_block(batch, chains):
                    mine = batch.filter(pa.array(block == b))
                    for i, c in enumerate(fit.blocks[b]):
                        rows.add(i, shared.value.part([c], slice(0, max(0, min(last, chains[c].rounds) - first))))
                    scores = pa.array([r.tobytes() for r in rows.scores], pa.binary())
                    yield pa.record_batch([*mine.columns[:-1], scores], names=mine.schema.names)

        write_parquet(self.state(first).mapInArrow(add, _STATE), f"{self.folder}/state-{last}")

    def held_out_auc(self, done: int) -> dict[int, float]:
        """For every chain that leaves a fold out: the area under the ROC curve of its scores on that fold."""
        fit, chains = self._plain(), self.chains

        def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b, rows in fit._by_block(batch, chains):
                    for i, c in enumerate(fit.blocks[b]):
                        own = rows.fold == chains[c].fold
                        if own.any():
                            columns = [np.full(own.sum(), c, np.int32), rows.scores[own, i], rows.label[own].astype(np.int8), rows.count[own]]
                            yield pa.record_batch([pa.array(x) for x in columns], names=["chain", "score", "label", "n"])

        scored = self.state(done).mapInArrow(left_out, "chain int, score double, label byte, n long")
        return {r["chain"]: r["auc"] for r in grouped_auc(scored, "chain", "score", "label", n="n").collect()}


def grouped_auc(scored: DataFrame, group: str, score: str, label: str, cells: int = 4096, n: str | None = None) -> DataFrame:
    """The exact area under the ROC curve of every group, ties at half; null if a group lacks one of the classes.

    Scores (log-odds) are counted per value first. Values lie in ``cells`` ranges; only the order inside a range is sorted, and
    ranges add up to the ranks. ``n`` is the column that says how many rows a line stands for, one each if there is none.
    """
    count = F.col(n) if n else F.lit(1)
    values = scored.groupBy(group, score).agg(F.sum(F.col(label) * count).alias("pos"), F.sum((1 - F.col(label)) * count).alias("neg"))
    cell = F.floor(cells / (1 + F.exp(-F.col(score))))
    below = Window.partitionBy(group, "cell").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    inside = values.withColumn("cell", cell).withColumn("before", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    per_cell = inside.groupBy(group, "cell").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (2 * F.col("before") + F.col("neg")).cast("decimal(38,0)")).alias("twice"),
    )
    lower = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    twice = F.col("twice") + F.col("pos") * (2 * F.coalesce(F.sum("neg").over(lower), F.lit(0))).cast("decimal(38,0)")
    total = per_cell.select(group, "pos", "neg", twice.alias("twice")).groupBy(group)
    sums = total.agg(F.sum("twice").cast("double").alias("twice"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return sums.select(group, F.try_divide(F.col("twice"), 2.0 * F.col("p") * F.col("q")).alias("auc"))


# --- driver ---------------------------------------------------------------------------


def boost(
    rows: DataFrame,
    features: Sequence[str],
    chains: Sequence[Chain],
    *,
    ids: Sequence[str],
    target: str,
    fold: str | None,
    seed: int,
    evaluate: Sequence[int] = (),
    folder: str | None = None,
    bins: int = BINS,
    small: int = SMALL,
    part: int = PART,
) -> tuple[Trees, list[np.ndarray], dict[int, dict[int, float]]]:
    """Fits all chains. Gives the trees, the bin edges, and the held-out AUC per chain after each number of rounds in ``evaluate``.

    With ``folder`` the states stay there, and a run over the same rows and chains takes up where the last one ended. ``small`` and ``part``
    change the cut into tasks, not the result.
    """
    spark = rows.sparkSession
    ship_package(spark)
    folder = folder or shared_dir(spark)
    n = rows.count()
    edges = bin_edges(rows, features, bins)
    given = binned_rows(rows, features, ids, target, F.col(fold) if fold else F.lit(-2), seed, edges)
    few = n <= small or (n <= ROWS_A_LINE * small and given.select("label", "fold", "bins").distinct().count() <= small)
    parts = 1 if few else -(-n // part)
    tasks = spark.sparkContext.defaultParallelism
    count = max(1, min(len(chains), -(-2 * tasks // parts) if parts < tasks else 1))
    blocks = [list(range(b, len(chains), count)) for b in range(count)]
    last = max(c.rounds for c in chains)
    depth = max(c.max_depth for c in chains)
    step = STEP_SMALL if few else STEP
    marks = sorted({*range(step, last + 1, step), *evaluate, last})

    plan = f"{folder}/plan.json"
    if exists(spark, plan):  # the cut of the run that began
        held = read_json(spark, plan)
        blocks, marks, edges = held["blocks"], held["marks"], [np.array(e, float) for e in held["edges"]]
        run = Fit(spark, list(chains), blocks, edges, held["small"], seed, bins, folder)
    else:
        run = Fit(spark, list(chains), blocks, edges, few, seed, bins, folder)
        run.begin(given, parts)
        write_json(spark, {"blocks": blocks, "marks": marks, "edges": [e.tolist() for e in edges], "small": few}, plan)

    trees, done, auc = Trees.none(len(chains), last, depth), 0, {}
    for mark in marks:
        if exists(spark, f"{folder}/done-{mark}.json"):
            done = mark
            found = read_json(spark, f"{folder}/done-{mark}.json")
            auc |= {mark: {int(c): x for c, x in found.items()}} if mark in evaluate else {}
    if done:
        trees = Trees.from_bytes(read_bytes(spark, f"{folder}/trees-{done}.npz"))
    for first, mark in zip([0, *marks], marks, strict=False):
        if mark <= done:
            continue
        if run.small:
            run.small_rounds(trees, first, mark)
        else:
            for turn in range(first, mark):
                for level in range(depth):
                    run.level(trees, first, turn, level)
        run.advance(trees, first, mark)
        if mark in evaluate:
            auc[mark] = run.held_out_auc(mark)
        write_bytes(spark, trees.to_bytes(), f"{folder}/trees-{mark}.npz")
        write_json(spark, {str(c): x for c, x in auc.get(mark, {}).items()}, f"{folder}/done-{mark}.json")
        remove(spark, f"{folder}/state-{first}")
    return trees, edges, auc


def to_model(trees: Trees, chain: Chain, edges: Sequence[np.ndarray], features: Sequence[str], target: str) -> PipelineModel:
    """The first chain as a model of Spark's own kind, which scores on the JVM and is saved and loaded as usual.

    Spark's probability is 1 / (1 + exp(-2 * margin)), so values are halved. Gains are per row of a node, as Spark weighs them
    by rows for the importance of a feature.
    """
    gateway = SparkContext._active_spark_context._gateway
    ml, java = gateway.jvm.org.apache.spark.ml, gateway.jvm.java
    # every mention of a class asks the JVM: once each, as there are thousands of nodes
    leaf, inner, split, tree = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    variance, part = gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, java.util.Arrays.copyOfRange
    n, values = trees.count[0, : chain.rounds].astype(float), trees.value[0, : chain.rounds] / 2
    held = np.stack([n, n * values, n * values * values], axis=-1)
    stats = gateway.new_array(gateway.jvm.double, held.size)
    java.nio.ByteBuffer.wrap(held.astype(">f8").tobytes()).asDoubleBuffer().get(stats)

    def node(turn: int, i: int):
        feature, value, count = int(trees.feature[0, turn, i]), float(values[turn, i]), float(n[turn, i])
        at = 3 * (turn * n.shape[1] + i)
        own = variance(part(stats, at, at + 3), int(count))
        if feature < 0:
            return leaf(value, 0.0, own)
        gain = float(trees.gain[0, turn, i]) / max(count, 1.0)
        cut = split(feature, float(edges[feature][int(trees.split[0, turn, i])]))
        return inner(value, 0.0, gain, node(turn, 2 * i + 1), node(turn, 2 * i + 2), cut, own)

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, chain.rounds)
    weights = gateway.new_array(gateway.jvm.double, chain.rounds)
    for turn in range(chain.rounds):
        made[turn] = tree(f"tree_{turn}", node(turn, 0), len(features))
        weights[turn] = chain.learning_rate
    model = GBTClassificationModel(ml.classification.GBTClassificationModel("boosted", made, weights, len(features), 2))
    model = model.setFeaturesCol("features")
    model._set(labelCol=target) if model.hasParam("labelCol") else None
    return PipelineModel(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), model])
