"""Trees grown side by side: against a plain version, in every cut into tasks, and taken up again."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import boost
from tidemark.operators.boost import Chain

FEATURES = ["a", "b", "c"]
CHAINS = [Chain(0, 6, 3, 0.3, 0.8, 1.0), Chain(1, 6, 2, 0.3, 1.0, 0.7), Chain(0, 3, 2, 0.1, 1.0, 1.0), Chain(-1, 6, 3, 0.1, 1.0, 1.0)]
COMMON = {"ids": ["id"], "target": "y", "fold": "fold", "seed": 9, "evaluate": [3, 6]}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for i in range(500):
        a, b, c = rng.integers(0, 12), rng.random() * 4, float(rng.integers(0, 3))
        p = 1 / (1 + math.exp(4 - a + 2 * (b > 3)))
        out.append((f"r{i}", int(rng.random() < p), i % 3, float(a), b, c))
    return spark.createDataFrame(out, "id string, y int, fold int, a double, b double, c double").repartition(4).cache()


@pytest.fixture(scope="module")
def grown(rows):
    return boost.boost(rows, FEATURES, CHAINS, **COMMON)


def same(one, two):
    return all(np.array_equal(getattr(one, n), getattr(two, n)) for n in ("feature", "split", "value", "gain", "count"))


def test_parts_give_the_same_trees(rows, grown):
    trees, edges, auc = boost.boost(rows.repartition(2), FEATURES, CHAINS, small=0, part=120, **COMMON)
    assert same(trees, grown[0]) and auc == grown[2]
    assert all(np.array_equal(a, b) for a, b in zip(edges, grown[1], strict=True))


def plain(data, edges, chain, seed, hashes):
    """The scores of a chain on all rows, tree by tree and node by node."""
    bins = np.column_stack([np.searchsorted(e, data[f]) for e, f in zip(edges, FEATURES, strict=True)])
    y, scores = data["y"].to_numpy(float), np.zeros(len(data))
    for turn in range(chain.rounds):
        p = 1 / (1 + np.exp(-scores))
        g, h = np.rint((p - y) * 2**20) / 2**20, np.rint(p * (1 - p) * 2**20) / 2**20
        used = (data["fold"].to_numpy() != chain.fold) & boost.drawn(hashes, seed, turn, chain.subsample)
        allowed = boost.columns_drawn(3, seed, turn, chain.colsample)

        def leaf(mask):
            return -g[mask & used].sum() / (h[mask & used].sum() + 1)

        def grow(mask, depth):
            best = (1e-6, None)
            if depth < chain.max_depth:
                for f in np.flatnonzero(allowed):
                    for b in range(len(edges[f])):
                        left, right = mask & used & (bins[:, f] <= b), mask & used & (bins[:, f] > b)
                        if h[left].sum() < 1 or h[right].sum() < 1:
                            continue
                        both = mask & used
                        gain = sum(s * g[m].sum() ** 2 / (h[m].sum() + 1) for m, s in ((left, 1), (right, 1), (both, -1)))
                        if gain > best[0] + 1e-12:
                            best = (gain, (f, b))
            if best[1] is None:
                scores[mask] += chain.learning_rate * leaf(mask)
                return
            f, b = best[1]
            grow(mask & (bins[:, f] <= b), depth + 1)
            grow(mask & (bins[:, f] > b), depth + 1)

        grow(np.ones(len(data), bool), 0)
    return scores


def test_scores_equal_a_plain_version(rows, grown):
    trees, edges, auc = grown
    data = rows.selectExpr("*", "xxhash64(9, id) as h").toPandas()
    hashes = data["h"].to_numpy().view(np.uint64)
    bins = np.column_stack([np.searchsorted(e, data[f]) for e, f in zip(edges, FEATURES, strict=True)])
    for c, chain in enumerate(CHAINS):
        ours = np.zeros(len(data))
        for turn in range(chain.rounds):
            at = boost.nodes_of(bins, trees.feature[c, turn], trees.split[c, turn], chain.max_depth)
            ours += chain.learning_rate * trees.value[c, turn][at]
        expected = plain(data, edges, chain, 9, hashes)
        assert np.allclose(ours, expected, atol=1e-9)
        out = (data["fold"] == chain.fold).to_numpy()
        if chain.fold >= 0 and chain.rounds == 6:
            pos, neg = ours[out & (data["y"] == 1)], ours[out & (data["y"] == 0)]
            wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
            assert math.isclose(auc[6][c], wins / len(pos) / len(neg), abs_tol=1e-9)


def test_a_stopped_run_goes_on(rows, grown, tmp_path, monkeypatch):
    folder, calls = str(tmp_path), []
    step = boost.Fit.small_rounds

    def stops(self, trees, first, last):
        calls.append((first, last))
        if first:
            raise KeyboardInterrupt
        step(self, trees, first, last)

    monkeypatch.setattr(boost.Fit, "small_rounds", stops)
    with pytest.raises(KeyboardInterrupt):
        boost.boost(rows, FEATURES, CHAINS, folder=folder, **COMMON)
    monkeypatch.setattr(boost.Fit, "small_rounds", lambda *a: calls.append(a[2:]) or step(*a))
    trees, _, auc = boost.boost(rows, FEATURES, CHAINS, folder=folder, **COMMON)
    assert calls == [(0, 3), (3, 6), (3, 6)]
    assert same(trees, grown[0]) and auc == grown[2]


def test_model_scores_as_the_trees_do(rows, grown):
    trees, edges, _ = grown
    chain = CHAINS[3]
    own = trees.part([3], slice(0, chain.rounds))
    model = boost.to_model(own, chain, edges, FEATURES, "y")
    found = {r.id: r.probability[1] for r in model.transform(rows).select("id", "probability").collect()}
    data = rows.toPandas()
    bins = np.column_stack([np.searchsorted(e, data[f]) for e, f in zip(edges, FEATURES, strict=True)])
    total = sum(
        chain.learning_rate * own.value[0, t][boost.nodes_of(bins, own.feature[0, t], own.split[0, t], chain.max_depth)] for t in range(6)
    )
    for name, s in zip(data["id"], total, strict=True):
        assert math.isclose(found[name], 1 / (1 + math.exp(-s)), abs_tol=1e-12)


def test_one_class_and_no_rows(spark):
    rows = spark.createDataFrame([(f"r{i}", 1, i % 2, float(i)) for i in range(20)], "id string, y int, fold int, a double")
    _, _, auc = boost.boost(rows, ["a"], [Chain(0, 2, 2, 0.1, 1.0, 1.0)], **{**COMMON, "evaluate": [2]})
    assert auc == {2: {0: None}}


def test_grouped_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    data = [(int(k), float(s), int(y)) for k, s, y in zip(rng.integers(0, 3, 900), rng.integers(-9, 9, 900) / 3, rng.integers(0, 2, 900))]
    found = {r.k: r.auc for r in boost.grouped_auc(spark.createDataFrame(data, "k int, s double, y int"), "k", "s", "y", cells=7).collect()}
    for k in range(3):
        pos, neg = ([s for g, s, y in data if g == k and y == c] for c in (1, 0))
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert math.isclose(found[k], wins / len(pos) / len(neg), abs_tol=1e-12)


def test_equal_rows_are_one_line(spark, tmp_path, monkeypatch):
    """Many rows of few kinds: what decides on the cut is the number of lines, and the trees are those of the single rows."""
    rng = np.random.default_rng(5)
    data = [(f"r{i}", int(rng.random() < 0.3), i % 3, float(rng.integers(0, 3)), float(i % 2), 1.0) for i in range(600)]
    rows = spark.createDataFrame(data, "id string, y int, fold int, a double, b double, c double").repartition(3)
    expected = boost.boost(rows, FEATURES, CHAINS, small=0, part=150, **COMMON)

    def passes(*_):
        raise AssertionError("one pass for each level of a table that one task can hold")

    monkeypatch.setattr(boost.Fit, "level", passes)
    folder = str(tmp_path / "run")
    found = boost.boost(rows, FEATURES, CHAINS, small=100, folder=folder, **COMMON)
    assert same(found[0], expected[0]) and found[2] == expected[2]
    state = spark.read.parquet(f"{folder}/state-6")
    blocks = state.select("block").distinct().count()
    assert state.count() <= 3 * 2 * 6 * blocks
    assert state.selectExpr("sum(size(h)) as n").first().n == 600 * blocks


def lines_of(labels, folds, hashes, bins, chains):
    """Lines of a state without scores, for the chains of one block."""
    empty = [bytes(8 * len(chains))] * len(labels)
    data = {"label": pa.array(labels, pa.int8()), "fold": pa.array(folds, pa.int32()), "h": pa.array(hashes, pa.list_(pa.int64()))}
    data |= {"bins": pa.array([bytes(b) for b in bins], pa.binary()), "scores": pa.array(empty, pa.binary())}
    return boost.Rows(pa.table(data), chains, len(bins[0]))


def test_one_draw_serves_the_chains_of_a_block(monkeypatch):
    rng = np.random.default_rng(2)
    n, chains = 300, [Chain(f, 4, d, 0.3, share, 0.7) for f in (0, 1) for d in (2, 3) for share in (0.5, 0.8)]
    given = rng.integers(0, 2, n), np.arange(n) % 3, [[int(x)] for x in rng.integers(-(2**62), 2**62, n)], rng.integers(0, 6, (n, 3)).astype(np.uint8)
    calls, draw = [], boost.drawn
    monkeypatch.setattr(boost, "drawn", lambda *a: calls.append(a[1:]) or draw(*a))
    together = boost.grow(lines_of(*given, chains), 0, 4, 9, 8)
    assert sorted(calls) == [(9, turn, share) for turn in range(4) for share in (0.5, 0.8)]
    for chain, trees in zip(chains, together, strict=True):
        assert same(trees, boost.grow(lines_of(*given, [chain]), 0, 4, 9, 8)[0])


def test_sums_of_lines_with_many_rows(monkeypatch):
    """Lines of so many rows that curvatures and rows no longer fit into one number."""
    rng = np.random.default_rng(4)
    counts = [3, 200_000, 1, 70_000, 70_000, 5]
    hashes, bins = [list(range(k)) for k in counts], rng.integers(0, 4, (6, 2)).astype(np.uint8)
    rows = lines_of([0, 1, 1, 0, 0, 1], [0, 1, 2, 0, 1, 2], hashes, bins, [Chain(0, 1, 2, 0.3, 1.0, 1.0)])
    rows.scores[:, 0] = [0.3, -2, 1, 0.1, 4, -0.2]
    p = 1 / (1 + np.exp(-rows.scores[:, 0]))
    at = np.array([1, 2, 1, 2, 0, 1])
    for size in (2, 4, 6):
        monkeypatch.setattr(boost, "CHUNK", size)
        found = rows.sums(rows.given(0, 0, 9), at, 1, 4, np.array([True, True]))
        expected = np.zeros((3, 2, 2, 4), np.int64)
        for i in (1, 2, 5):  # outside of fold 0 and in a node of the level
            for f in range(2):
                g, h = round((p[i] - rows.label[i]) * 2**20), round(p[i] * (1 - p[i]) * 2**20)
                expected[:, at[i] - 1, f, bins[i, f]] += counts[i] * np.array([g, h, 1])
        assert np.array_equal(found, expected)
