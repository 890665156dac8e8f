import random

import numpy as np
import pytest
from brute import ODD, base_facts, odd_table

from pyspark.sql import functions as F

from tidemark.llm.quality_rules import quality_rules, repeated_words, text_facts, word_hashes

TEST = "/root/testdata/sf0.001"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_facts_of_all_documents(spark):
    docs = spark.read.parquet(f"{TEST}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    rows = quality_rules(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in BASE) == base_facts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_repeated_words_like_the_definition():
    rng = random.Random(3)
    for n in (0, 7, 8, 9, 16, 40, 300):
        for letters in ("ab", "abcde"):
            words = [rng.choice(letters) for _ in range(n)]
            got = repeated_words(word_hashes([w.encode() for w in words]))
            assert got == base_facts(" ".join(words))[4]
    assert repeated_words(np.zeros(0, np.uint64)) == 0


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


@pytest.fixture(scope="module")
def crowd(spark):
    """One host with a line in most documents, one large group of copies, a depleted document."""
    rng = random.Random(5)
    boiler = "Subscribe to our newsletter 12 now and follow us on every channel you can think of today please"
    rows = [(i, f"{words(rng, 30)}\n{boiler.replace('12', str(10 + i))}", "h") for i in range(60)]
    copy = f"{words(rng, 40)}\n{words(rng, 40)}"
    rows += [(100 + i, copy, "h") for i in range(200)]
    rows += [(400 + i, copy.replace(copy.split()[i], "changed"), "h") for i in range(40)]  # near copies
    rows += [(500, f"{boiler}\nonly these few words", "h"), (501, f"{boiler}\n{boiler}\nmore", "h")]
    rows += [(600, f"{boiler}\nonly these few words", "other")]  # a host of its own, where the line is rare
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_boilerplate_goes_and_copies_stay(crowd):
    got = {r.doc_id: r for r in quality_rules(crowd).collect()}
    assert len(got) == 303
    assert all(got[i].kept and got[i].n_words_left == 30 for i in range(60))
    assert all(got[i].kept and got[i].n_words_left == 80 for i in (*range(100, 300), *range(400, 440)))
    assert not got[500].kept and not got[500].base_failed and got[500].n_words_left == 4
    assert not got[501].kept
    assert got[600].kept and got[600].n_words_left == got[600].n_words


def test_documents_that_are_mostly_boilerplate(spark):
    """A shared license with a line of its own in each document goes; near copies changed in any line stay."""
    rng = random.Random(8)
    license_text = "\n".join(words(rng, 50) for _ in range(8))
    rows = [(i, f"{license_text}\n{words(rng, 5)}", "h") for i in range(60)]
    lines = [words(rng, 10).split() for _ in range(8)]
    for i in range(60):
        near = [list(line) for line in lines]
        near[i % 8][i % 10] = words(rng, 1)
        rows.append((100 + i, "\n".join(map(" ".join, near)), "h"))
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(not got[i].kept and not got[i].base_failed and got[i].n_words_left == 5 for i in range(60))
    assert all(got[100 + i].kept and got[100 + i].n_words_left == 80 for i in range(60))


def test_odd_rows(spark):
    rows = quality_rules(odd_table(spark)).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        if r.doc_id is not None and r.doc_id != 3:
            assert tuple(r[c] for c in BASE) == base_facts(ODD[r.doc_id])
    assert quality_rules(odd_table(spark).limit(0)).count() == 0


def test_texts_are_normalised_in_python_only(crowd, monkeypatch):
    """Functions of Spark that go through a text character by character took most of the JVM's time, in every pass."""

    def slow(*_):
        raise AssertionError("a text is normalised by the JVM")

    expected = sorted(map(tuple, quality_rules(crowd).collect()))
    for name in ("translate", "regexp_replace"):
        monkeypatch.setattr(F, name, slow)
    assert sorted(map(tuple, quality_rules(crowd).collect())) == expected


def test_whole_texts_are_equal_once_normalised():
    """A-Z, digits and blanks do not tell documents apart; other characters do."""
    same = ["One 12  two\n\n THREE", "one 34 two three", "\tone\x0b99 two\r\nthree "]
    assert len({text_facts(t)[0] for t in same}) == 1 and len(text_facts(same[0])[0]) == 16
    assert len({text_facts(t)[0] for t in ("a b", "ab", "", "a \u00a0b", "\u00c9 a", "\u00e9 a")}) == 6
