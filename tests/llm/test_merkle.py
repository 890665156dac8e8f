"""The manifest against a plain tree over all rows."""

import hashlib
import random
import zlib

import pytest
from brute import ODD, odd_table

import __spark_entry__ as entry_module
from tidemark.llm import merkle

TESTDATA = "/root/testdata/sf0.001"
NAMES = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for each node the list of (place, siblings) level by level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_groups = [], []
        for at in range(0, len(nodes), 8):
            run, members = nodes[at : at + 8], groups[at : at + 8]
            for place, below in enumerate(members):
                for i in below:
                    paths[i].append((place, run[:place] + run[place + 1 :]))
            up.append(h(*run))
            up_groups.append([i for below in members for i in below])
        nodes, groups = up, up_groups
    return nodes[0], paths


def plain(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in by_lang[lang]]))
    root, over = tree([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), above in zip(langs, trees, over, strict=True):
        for (_, _, own, row), path in zip(by_lang[lang], paths, strict=True):
            path = path + above
            folded = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                folded = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for place, siblings in path:
                folded = h(*siblings[:place], folded, *siblings[place:])
            proof = h(*(s for _, siblings in path for s in siblings))
            out.append((row[0], own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def check(rows, found, id_name="doc_id"):
    assert sorted((tuple(r[c] for c in [id_name, *NAMES]) for r in found), key=repr) == plain(rows)


def given(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    found = entry_module.queries()["op13_merkle_manifest"](spark, TESTDATA)
    assert found.columns == ["doc_id", *NAMES]
    rows = found.collect()
    check(given(docs), rows)
    assert 0 < sum(not r.verified for r in rows) < len(rows)


def test_odd_rows(spark):
    docs = odd_table(spark)
    check(given(docs), merkle.manifest(docs).collect())
    assert len(ODD) < docs.count()


@pytest.mark.parametrize("levels", [1, 2])
@pytest.mark.parametrize("sizes", [(1,), (8, 9), (64, 65, 1), (700, 3, 512, 513)])
def test_many_blocks(spark, levels, sizes):
    rng = random.Random(7)
    rows = [
        (rng.randrange(10**6), None, None if k == 1 else f"l{k}é", i, rng.choice([None, "", "Ab", "x"]))
        for k, n in enumerate(sizes)
        for i in range(n)
    ]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    check(rows, merkle.manifest(docs, levels=levels).collect())


def test_many_groups(spark):
    rows = [(i, "s", f"g{i % 70}", 1, "T") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    check(rows, merkle.manifest(docs, levels=1).collect())


def test_copies_of_one_row_spread_over_parts(spark):
    rows = [(5, "s", "en", 1, "Same")] * 300 + [(None, "s", "en", 1, "Same")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    check(rows, merkle.manifest(docs, levels=2).collect())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("false")
    assert merkle.manifest(docs).collect() == []


def test_witnesses_grow_with_later_siblings():
    frontier = merkle.Frontier(arity=2)
    frontier.append("a" * 64)
    assert frontier.witnesses[0] == []
    frontier.append("b" * 64)
    assert frontier.witnesses == [[(0, "b" * 64)], [(1, "a" * 64)]]
    frontier.append("c" * 64)
    frontier.append("d" * 64)
    assert [len(w) for w in frontier.witnesses] == [2] * 4
    root = frontier.finish(None)
    assert all(merkle.fold(x * 64, w) == root for x, w in zip("abcd", frontier.witnesses, strict=True))
