import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from brute import ODD, WORD, odd_table

from pyspark.sql import functions as F

from tidemark.llm import near_dedup
from tidemark.llm.near_dedup import (
    BANDS, PERCENT, ROWS, components, differing_bytes, hash_functions, least_equal, minima, near_duplicates, shingle_set,
    signature,
)

TEST = "/root/testdata/sf0.001"


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def union(parent, a, b):
    while parent[a] != a:
        a = parent[a]
    while parent[b] != b:
        b = parent[b]
    parent[max(a, b)] = min(a, b)


def brute(texts):
    """n_shingles and component of each document: all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in texts.items()}
    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    parent = {k: k for k in texts}
    for a, b in {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1 :]}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            union(parent, a, b)
    out = {}
    for k in texts:
        top = k
        while parent[top] != top:
            top = parent[top]
        out[k] = (len(sets[k]), top)
    return out


def held(rows, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)
    assert len(rows) == len(texts) and all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_signatures_lose_less_than_bands():
    p = PERCENT / 100
    count, same = BANDS * ROWS, Fraction(PERCENT, 100) + Fraction(100 - PERCENT, 100) / 256
    least = least_equal(count, PERCENT)
    lost = sum(math.comb(count, k) * same**k * (1 - same) ** (count - k) for k in range(least))
    assert lost < (1 - p**ROWS) ** BANDS


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_all_documents(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    held(near_duplicates(docs).collect(), dict(docs.select("doc_id", "text").collect()))


def text(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


def test_copies_chains_and_passages(spark):
    """A large group of copies and one of near copies, chains near the limit, a passage in very many documents."""
    rng = random.Random(9)
    texts, passage = {}, text(rng, 30)
    base = text(rng, 120)
    for i in range(150):
        texts[len(texts) * 7 % 10007 + 1] = base
    for i in range(150):  # edits at a few places each, so that many pairs lie close to the limit
        words = base.split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(120)] = f"edit{i}"
        texts[len(texts) * 7 % 10007 + 1] = " ".join(words)
    chain = text(rng, 80).split()
    for i in range(40):  # neighbours are linked, distant ones are not
        chain = [*chain[2:], *text(rng, 2).split()]
        texts[len(texts) * 7 % 10007 + 1] = " ".join(chain)
    for i in range(200):
        texts[len(texts) * 7 % 10007 + 1] = f"{text(rng, rng.randint(5, 60))} {passage} {text(rng, 5)}"
    for n in range(1, 8):
        texts[len(texts) * 7 % 10007 + 1] = text(rng, n)
        texts[len(texts) * 7 % 10007 + 1] = next(reversed(texts.values())).upper()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    held(near_duplicates(docs).collect(), texts)


def test_documents_just_outside_of_a_group(spark, monkeypatch):
    """They are held against the group's union, not against each member, and none that is linked is lost."""
    rng, texts, counts = random.Random(2), {}, []
    base = text(rng, 100).split()

    def edited(n):
        words = list(base)
        for at in rng.sample(range(100), n):
            words[at] = text(rng, 1) + "x"
        return " ".join(words)

    for i in range(300):
        texts[i] = edited(1)
    for i in range(80):
        texts[1000 + i] = edited(rng.choice([3, 4, 5]))
    possible = near_dedup.possible_pairs

    def counted(*given):
        pairs = possible(*given)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dedup, "possible_pairs", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    held(near_duplicates(docs).collect(), texts)
    outside = sum(c >= 1000 for _, c in brute(texts).values())
    assert outside > 20 and counts[0] < 20 * outside


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    functions = hash_functions(384)
    for share in (0.5, 0.75, 0.9):
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
            n = int(400 * share)
            a, b = np.sort(pool[: n + (400 - n) // 2]), np.sort(np.concatenate([pool[:n], pool[n + (400 - n) // 2 :]]))
            la, lb = minima(a, functions), minima(b, functions)
            errors.append((la == lb).mean() - share)
            bytes_equal = signature(la).view(np.uint8) == signature(lb).view(np.uint8)
            assert ((la == lb) <= bytes_equal).all() and bytes_equal.mean() - (la == lb).mean() < 0.02
        assert abs(np.mean(errors)) < 0.02


def test_differing_bytes(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(-(1 << 62), 1 << 62, (2, 300))
    y[:150] = x[:150] ^ (rng.integers(0, 256, 150) << rng.integers(0, 7, 150))
    table = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x long, y long")
    for r in table.select("x", "y", differing_bytes(F.col("x"), F.col("y")).alias("n")).collect():
        z = (r.x ^ r.y) & (1 << 64) - 1
        assert r.n == sum(b != 0 for b in z.to_bytes(8, "little"))


def test_components_of_random_links(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (30, 12), (60, 45), (60, 200)):
        pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)} | {(i, i + 1) for i in range(100, 130)}
        parent = {v: v for p in pairs for v in p}
        for a, b in pairs:
            union(parent, a, b)
        links = spark.createDataFrame(list(pairs), "a long, b long")
        got = dict(components(links).collect())
        for v in {v for a, b in pairs for v in (a, b) if a != b}:
            top = v
            while parent[top] != top:
                top = parent[top]
            assert got[v] == top


def test_odd_rows(spark):
    rows = near_duplicates(odd_table(spark)).collect()
    assert len(rows) == len(ODD) + 3
    plain = brute({i: t for i, t in enumerate(ODD) if i != 3})
    for r in rows:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        elif r.doc_id != 3:
            assert (r.n_shingles, r.component_id) == plain[r.doc_id]
        else:
            assert r.component_id == 3 and r.kept
    assert near_duplicates(odd_table(spark).limit(0)).count() == 0
    assert len(shingle_set("A b\tc")) == 1 and list(shingle_set("A b\tc")) == list(shingle_set("a B c"))


def test_open_pairs_are_made_once(spark):
    """Two documents that share many buckets meet in each of them and are one pair."""
    sign = [0] * (BANDS * ROWS // 8)
    rows = [(k, i, c, 100, sign, 7) for i, c, keys in ((1, 1, range(9)), (2, 2, range(2, 12)), (3, 2, (5, 8, 20)), (4, 2, (30,))) for k in keys]
    placed = spark.createDataFrame(rows, "key long, id long, component long, n_shingles long, signature array<long>, band int")
    open_ = spark.createDataFrame([(1, 2, 7)], "id long, of long, band int")
    pairs = near_dedup.open_pairs(open_, placed, PERCENT, BANDS * ROWS).collect()
    assert sorted(map(tuple, pairs)) == [(1, 2), (1, 3)]


def test_bytes_may_be_read_as_others(spark):
    """Texts that are equal but for what the table makes equal are copies; without it they are not."""
    table = bytes.maketrans(b"123456789", b"0" * 9)
    docs = spark.createDataFrame([(i, " ".join(f"w {i}{k}" for k in range(20))) for i in range(1, 4)], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(docs, table=table).collect()} == {1}
    assert {r.component_id for r in near_duplicates(docs).collect()} == {1, 2, 3}
