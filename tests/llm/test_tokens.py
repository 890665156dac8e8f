import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import ODD, odd_table
from tokenizers import Tokenizer

from tidemark.llm.packing import choose, pack, windows, word_ids, words_of
from tidemark.llm.queries import op7_token_counts, op8_packing, tokenizer_path
from tidemark.llm.token_counts import count_in_chunks, token_counts

TEST = "/root/testdata/sf0.001"
BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(WORDS)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_counts_of_all_documents(spark, byte_bpe):
    texts = dict(spark.read.parquet(f"{TEST}/documents.parquet").select("doc_id", "text").collect())
    for r in op7_token_counts(spark, TEST).collect():
        n = len(ids(byte_bpe, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


@pytest.mark.parametrize(("chunk", "overlap"), [(65536, 512), (200, 8), (31, 4), (7, 1)])
def test_counts_of_odd_texts(spark, byte_bpe, chunk, overlap):
    rows = token_counts(odd_table(spark), BYTES, chunk=chunk, overlap=overlap).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        if r.doc_id is not None and r.doc_id != 3:
            assert r.n_tokens == len(ids(byte_bpe, ODD[r.doc_id])), r.doc_id
    assert token_counts(odd_table(spark).limit(0), BYTES).count() == 0


def test_splicing_random_texts(byte_bpe):
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "word", "Don't", "'ll", "éß", "123", "...", " ", "\U0001f600", "<|endoftext|>", "x" * 9]
    starts = lambda t: [o[0] for o in byte_bpe.encode(t, add_special_tokens=False).offsets]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(1, 60)))
        for chunk, overlap in ((5, 1), (16, 3), (40, 10)):
            assert count_in_chunks(starts, text, chunk, overlap) == len(ids(byte_bpe, text)), repr(text)


def test_subset_sums_are_the_nearest():
    rng = random.Random(2)
    for _ in range(200):
        stock = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        target = rng.randint(0, 60)
        sums = {0}
        for x, n in stock.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        taken = choose(stock, target)
        assert all(0 < n <= stock[x] for x, n in taken.items())
        assert sum(x * n for x, n in taken.items()) == max(s for s in sums if s <= target)


def test_windows_are_full_and_hold_every_token_once():
    rng = random.Random(4)
    for _ in range(100):
        lengths = [rng.randint(1, 63) for _ in range(rng.randint(0, 200))]
        held = defaultdict(list)
        for pieces in windows(lengths, 64):
            size = sum(p[2] for p in pieces)
            assert size == 64 or size & (size - 1) == 0 and size < 64
            for item, start, length in pieces:
                held[item] += range(start, start + length)
        assert {i: sorted(h) for i, h in held.items()} == {i: list(range(n)) for i, n in enumerate(lengths)}


def check_packing(rows, all_ids, capacity=2048):
    """``all_ids``: the ids of each document, end included. One document for each key."""
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        parts[r.doc_id].append(r)
    assert set(parts) == set(all_ids)
    for key, pieces in parts.items():
        expected, at = all_ids[key], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(expected) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(expected[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(expected)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at < capacity and at & (at - 1) == 0  # nothing is padded


def test_packing_of_all_documents(spark, word_bpe):
    texts = dict(spark.read.parquet(f"{TEST}/documents.parquet").select("doc_id", "text").collect())
    check_packing(op8_packing(spark, TEST).collect(), {k: [*ids(word_bpe, t), 1] for k, t in texts.items()})


@pytest.mark.parametrize(("capacity", "group"), [(2048, 4096), (64, 5), (16, 1)])
def test_packing_of_odd_texts(spark, word_bpe, capacity, group):
    table = odd_table(spark).where("doc_id is not null and doc_id != 3").repartition(3)
    rows = pack(table, WORDS, capacity=capacity, group=group).collect()
    check_packing(rows, {i: [*ids(word_bpe, t), 1] for i, t in enumerate(ODD) if i != 3}, capacity)
    whole = pack(odd_table(spark), WORDS).collect()
    assert sum(r.length for r in whole if r.doc_id is None) == 61
    assert sum(r.length for r in whole if r.doc_id == 3) == 31 * 2 + 1
    assert pack(odd_table(spark).limit(0), WORDS).count() == 0


def test_punctuation_behind_a_letter_is_a_word(word_bpe):
    """Words are cut where the tokenizer cuts them too, so that a word is remembered once."""
    assert words_of(b'Alpha, alpha. (alpha) "alpha"! it\'s') == [b"alpha", b",", b"alpha", b".", b"(alpha", b")", b'"alpha', b'"!', b"it's"]
    texts = [
        "Alpha, beta...gamma?! it's, we'll; they'd.x a.b,c d$$$ e&&&f (g) h-i/j k:l m@n o's. p'", "x<|endoftext|>. y<|endoftext|>,z<|startoftext",
        "a.\u0301 b,\u0308 e\u0301, \u00e9. \u00c9, \u0130. \u00df! \u4e2d, 3. 3,4 a3. .a,", "q=\u0338, r<\u0338. s>\u0338; t!\u0338= u#*+%",
    ]
    read = word_ids(WORDS)
    for text in texts:
        assert np.frombuffer(b"".join(read(words_of(text.encode()))), "<u4").tolist() == ids(word_bpe, text)
