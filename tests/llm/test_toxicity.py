import random
import zlib

import pytest
from brute import ODD, odd_table

from tidemark.llm import toxicity
from tidemark.llm.queries import op3_toxicity
from tidemark.llm.toxicity import FEATURES, features, fit, plain_word, score, word_flags

TEST = "/root/testdata/sf0.1"


def auc(pairs):
    pairs = sorted(pairs)
    ranks, i = {}, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        for k in range(i, j):
            ranks[k] = (i + j + 1) / 2
        i = j
    ones = [ranks[k] for k, p in enumerate(pairs) if p[1]]
    zeros = len(pairs) - len(ones)
    return (sum(ones) - len(ones) * (len(ones) + 1) / 2) / (len(ones) * zeros)


def test_held_out_accuracy(spark):
    rows = op3_toxicity(spark, TEST).collect()
    labels = dict(spark.read.parquet(f"{TEST}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == spark.read.parquet(f"{TEST}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    test = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert auc([t[:2] for t in test]) > 0.95
    hits = sum(y and p for _, y, p in test)
    assert hits / sum(y for _, y, _ in test) > 0.85  # recall
    assert hits / max(1, sum(p for _, _, p in test)) > 0.9  # precision


def test_words():
    assert plain_word("Idiot!!!") == ("idiot", False)
    assert plain_word("1d10t") == ("idiot", True)
    assert plain_word("i.d.i.o.t") == ("idiot", True)
    assert plain_word("loooooser") == ("loser", True)
    assert plain_word("1999") == ("1999", False)
    assert plain_word("***") == ("", False)


def test_features():
    flags = word_flags(frozenset(["schuf*"]))
    f = dict(zip(FEATURES, features("YOU are an 1diot, you SCHUFT! schufte", flags), strict=True))
    assert (f["insults"], f["terms"], f["hidden_hits"]) == (1, 2, 1)
    assert f["near_second_person"] == 3 / 7 and f["second_person_density"] == 2 / 7
    assert f["capital_words"] == 2 / 7
    for text in ODD:
        assert len(features(text, flags)) == len(FEATURES)
    far = dict(zip(FEATURES, features("you " + "x " * 9 + "idiot", flags), strict=True))
    assert far["near_second_person"] == 0


def test_odd_rows_and_missing_classes(spark):
    table = odd_table(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score(table, fit(table, none)).collect()
    assert len(rows) == len(ODD) + 3 and {r.score for r in rows} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(15)] + [(None, 1, 1), (4, 1, None)], none.schema)
    assert all(r.score < 0.5 and r.predicted == 0 for r in score(table, fit(table, one)).collect())
    assert all(r.held_out for r in rows if r.doc_id is None)


def test_small_training_and_bounds(spark, monkeypatch):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefg", k=5))
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        docs.append((i, " ".join(word() for _ in range(20)) + (" du grobian" if bad else "")))
        labels.append((i, 1, int(bad)))
    labels += labels[:50]  # repeated rows
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit(docs, labels, max_toxic=60, max_clean=120)
    assert any(t.startswith("grob") for t in model.terms)
    rows = score(docs, model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows if r.held_out) > 0.95 * sum(r.held_out for r in rows)
    both = score(odd_table(spark), model)
    assert both.count() == len(ODD) + 3
    assert score(odd_table(spark).limit(0), model).count() == 0
    assert toxicity.MAX_TERMS >= len(model.terms)
    with pytest.raises(Exception, match="toxic"):
        fit(docs, labels.drop("toxic"))
