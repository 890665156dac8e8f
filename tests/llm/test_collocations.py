"""Phrases against a plain count, with groups and prefixes of several sizes."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import odd_table

import __spark_entry__ as entry_module
from tidemark.llm import collocations

TESTDATA = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, top=2000):
    """rows of (lang, text)."""
    f, n = {}, Counter()
    for lang, text in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in (1, 2, 3):
                counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        longer = [p for p, a in counts.items() if len(p) == 3 and a >= least]
        most = Counter()
        for p in longer:
            for part in (p[:2], p[1:]):
                most[part] = max(most[part], counts[p])
        for p, a in counts.items():
            if len(p) < 2 or a < least or (len(p) == 2 and most[p] and 100 * most[p] >= 50 * a):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(df, expected):
    found = sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())
    differing = [(a, b) for a, b in zip(found, expected, strict=False) if a != b]
    assert not differing[:1] and len(found) == len(expected)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").select("lang", "text").collect()]
    query = entry_module.queries()["op11_collocations"](spark, TESTDATA)
    assert query.columns == COLUMNS
    assert dict(query.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}
    check(query, plain(rows))


def made(seed, n=400):
    """Texts over few words with very frequent ones, ties, all kinds of ends, nulls and a long text."""
    rng = random.Random(seed)
    words = ["the", "The", "a", "é", "b.c", "x\x0bz", "d", "e\x1c", "f" * 300, *(f"w{i}" for i in range(12))]
    texts = [
        (rng.choice(["en", "de", None, ""]), "".join(rng.choice(words[: rng.randrange(2, 21)]) + rng.choice(" \t  .,;:!?\n\r ") for _ in range(rng.randrange(40))))
        for _ in range(n)
    ]
    return [*texts, ("en", "the a d " * 5000), ("en", None), (None, ""), (None, "und"), ("en", "no end")]


@pytest.mark.parametrize("budget", [50, 700, 1 << 20])
def test_prefixes_are_extended(spark, budget):
    rows = made(budget)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string").repartition(3)
    check(collocations.collocations(docs, budget=budget), plain(rows))


def test_top_and_least(spark):
    rows = made(3)
    docs = spark.createDataFrame(rows, "lang string, text string")
    check(collocations.collocations(docs, least=3, top=7, budget=200), plain(rows, 3, 7))


def test_odd_rows(spark):
    docs = odd_table(spark)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    check(collocations.collocations(docs), plain(rows))
    assert collocations.collocations(docs.where("false")).collect() == []
    by_source = [tuple(r) for r in docs.select("source", "text").collect()]
    check(collocations.collocations(docs, group_column="source", least=2), plain(by_source, 2))


def test_products_beyond_64_bits(spark):
    big = 10**13
    nodes = spark.createDataFrame(
        [("x", 1, "a", None, None, big, big, None), ("x", 1, "b", None, None, big + 7, big + 7, None), ("x", 2, "a", "b", None, big - 3, big, None)],
        "lang string, size int, one string, two string, three string, f long, f1 long, f2 long",
    )
    none = spark.createDataFrame([], "lang string, phrase string, f long")
    words = spark.createDataFrame([("x", 2 * big + 7)], "lang string, f long")
    (row,) = collocations.ranked(nodes, none, words, 5).collect()
    assert row.score == 10**6 * (big - 3) ** 2 // (big * (big + 7))


def test_tasks_send_before_they_hold_too_much(spark, monkeypatch):
    held = collocations.Held()
    lists = [["a", "b"], ["c"], ["a", "b", "c"], ["d"] * 9, []]
    line = [w.encode() for x in lists for w in x] + [b"\xff", b"\xff"]
    pairs = Counter()
    rng = random.Random(1)
    at = 0
    while at < len(line):
        step = rng.randrange(1, 4)
        held.add(line[at : at + step])
        at += step
        words, taken = held.take()
        pairs.update((words[a], words[b]) for a, b, _ in zip(taken, taken[1:], taken[2:], strict=False))
    assert pairs == Counter(zip(line, line[1:-1], strict=False))


def test_groups_hold_about_a_budget():
    totals = np.random.default_rng(1).integers(0, 90, 5000)
    groups = collocations.pack(totals, 100)
    assert (np.diff(groups) >= 0).all()
    assert np.bincount(groups, totals).max() < 200


def test_long_texts_are_read_in_slices():
    text = (b"Word one. " * 300_000) + b"last" * 1_000_000
    words = [w for x in collocations.word_lists(text) for w in x]
    assert len(words) == 900_001 and words[-1] == b"last" * 1_000_000 and words[:3] == [b"word", b"one", b"\xff"]
