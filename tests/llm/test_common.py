"""Memos and batches stay within their bytes."""

import numpy as np
import pytest
from brute import WORD

from tidemark.llm import common, hashing, packing, token_counts


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(common.Memo, "budget", 64_000)
    monkeypatch.setattr(common.Memo, "_live", [])


def held():
    return sum(m.size + m.old_size for r in common.Memo._live if (m := r()) is not None)


def test_memos_share_one_budget(small):
    one, two = common.Memo(str.upper), common.Memo(str.lower)
    for i in range(2000):
        assert one[f"a{i}"] == f"A{i}"
    assert 0 < held() <= 64_000 and len(one) + len(one.old) < 2000
    for i in range(2000):
        assert two[f"B{i}"] == f"b{i}"
    assert held() <= 64_000 and not one and not one.old  # the memo that is out of use let everything go
    assert one["a1"] == "A1"


def test_a_memo_that_is_gone_counts_no_more(small):
    for _ in range(20):
        memo = common.Memo(str.upper)
        for i in range(300):
            assert memo[f"x{i}"] == f"X{i}"
    memo._share()
    assert len(common.Memo._live) == 1 or held() <= 64_000


def test_long_keys_are_not_remembered(small):
    memo = common.Memo(len)
    assert memo["x" * 100_000] == 100_000 and not memo and memo.size == 0


def test_lacking():
    memo = common.Memo(len)
    memo["a"]
    assert sorted(memo.lacking(["a", "b", "b", "c"])) == ["b", "c"]


def test_unbroken_texts_of_megabytes(spark):
    texts = ["é" * 2_000_000, "ab" * 1_500_000, "x" * 3_000_000 + " y", "日本語" * 400_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = "/opt/tokenizers/byte_bpe_50k.json"
    counted = {r.doc_id: r.n_bytes for r in token_counts.token_counts(docs.where("doc_id <> 1"), path).collect()}
    assert counted == {i: len(t.encode()) for i, t in enumerate(texts) if i != 1}
    assert len(hashing.word_hashes([t.encode() for t in texts])) == 4
    assert WORD.findall(texts[2])[1] == "y"


def test_batches_go_back_by_bytes(spark, monkeypatch):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])
    docs = spark.range(40).repartition(1)
    out = common.map_rows(docs, schema, lambda: lambda i: [(i, "z" * 1_000_000)])
    sizes = out.mapInArrow(lambda batches: (b.select(["n"]) for b in batches), "n long")
    assert sizes.count() == 40 and common.BATCH_BYTES < 10_000_000


def test_ids_of_words_in_batches():
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/word_bpe_49k.json"
    words = [f"word{i % 3000}".encode() for i in range(5000)]
    found = packing.word_ids(path)(words)
    tokenizer = Tokenizer.from_file(path)
    for i in range(0, 5000, 617):
        assert np.frombuffer(found[i], "<u4").tolist() == tokenizer.encode(words[i].decode(), add_special_tokens=False).ids


def test_many_texts_are_remembered_at_once(monkeypatch):
    monkeypatch.setattr(common.Memo, "_live", [])
    made = []
    memo = common.Memo(lambda key: made.append(key) or b"new")
    assert memo.fill({b"a": b"1", b"b": b"2"})
    assert not memo.fill({b"c": b"3", b"d" * 300: b"4"}) and b"d" * 300 not in memo
    assert [memo[k] for k in (b"a", b"b", b"c")] == [b"1", b"2", b"3"] and made == []
    assert memo.size == 3 * (2 + 200) and memo.added == 3
    monkeypatch.setattr(common.Memo, "budget", 2000)
    memo.fill({b"%d" % i: b"x" for i in range(5)})  # half the budget is passed: all of it is the older half now
    assert not dict(memo) and memo.old_size == 3 * 202 + 5 * 202
    assert memo[b"a"] == b"1" and made == []
    other = common.Memo(lambda key: key)
    other.fill({b"%d" % i: b"x" for i in range(300)})  # the budget is that of all memos together
    assert not memo.old and not dict(memo)


def test_memos_of_a_worker_stay_small():
    """Two workers with 128 MB of memos each took an executor beyond its memory."""
    memo, lines = common.Memo(hashing.hash64), common.Memo(len)
    for i in range(300_000):
        memo[b"w%d" % i], lines[b"l%d" % i]
    assert held() <= common.Memo.budget <= 64 << 20
