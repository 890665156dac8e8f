"""Each stage against plain versions, on its own input; the whole run; odd rows."""

from collections import defaultdict
from pathlib import Path

import pytest
from brute import base_facts, base_secrets, odd_table
from pyspark.sql import functions as F
from test_near_dedup import brute

import corpus_pipeline

TEST = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of each stage, written and read again."""
    docs = spark.read.parquet(f"{TEST}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, TEST).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(stages):
    before, after = rows(stages["documents"]), rows(stages["quality_rules"])
    assert stages["quality_rules"].columns == stages["documents"].columns
    assert all(before[k] == after[k] for k in after)
    passing = {k for k, r in before.items() if not base_facts(r.text)[5]}
    assert set(after) <= passing
    assert len(after) > 0.95 * len(passing)  # clean documents stay


def test_toxicity(spark, stages):
    before, after = rows(stages["quality_rules"]), rows(stages["toxicity"])
    assert stages["toxicity"].columns == stages["documents"].columns
    assert all(before[k] == after[k] for k in after)
    labels = dict(spark.read.parquet(f"{TEST}/labels.parquet").select("doc_id", "toxic").collect())
    clean = [k for k in before if labels.get(k) == 0]
    assert sum(k in after for k in clean) > 0.97 * len(clean)
    assert len(after) < len(before)


def test_near_duplicates(stages):
    before, after = rows(stages["toxicity"]), rows(stages["near_dedup"])
    assert stages["near_dedup"].columns == stages["documents"].columns
    groups = defaultdict(list)
    for k, (_, top) in brute({k: r.text for k, r in before.items()}).items():
        groups[top].append(k)
    assert set(after) == {min(g) for g in groups.values()}
    assert all(before[k] == after[k] for k in after)


def test_secrets(stages):
    before, after = rows(stages["near_dedup"]), rows(stages["secret_scan"])
    assert set(before) == set(after) and stages["secret_scan"].columns == stages["documents"].columns
    for k, r in after.items():
        assert r.n_chars == len(r.text) and not base_secrets(r.text)
        if not base_secrets(before[k].text):
            assert r.text == before[k].text or "[SECRET]" in r.text


def test_packing(stages):
    held, ends = defaultdict(int), {}
    for r in stages["packing"].collect():
        held[r.doc_id] += r.length
        ends[r.doc_id] = r.doc_tokens
    assert held == ends and set(held) == set(rows(stages["secret_scan"]))


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, TEST)
    assert got.columns == stages["packing"].columns
    assert got.agg({"length": "sum"}).first() == stages["packing"].agg({"length": "sum"}).first()


def test_clean_rows_stay_beside_rejected_ones_with_their_id(spark, stages):
    docs = stages["documents"].where("length(text) > 400").orderBy("doc_id").limit(40)
    clean = sorted(r.doc_id for r in stages["secret_scan"].join(docs.select("doc_id"), "doc_id").collect())[:4]
    texts = rows(docs)
    shared = [(None, "short"), (None, texts[clean[0]].text), (7, None), (7, texts[clean[1]].text)]
    table = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in shared], "doc_id long, text string, lang string, source string, n_chars long"
    )
    after = corpus_pipeline.quality(spark, table, TEST)
    assert after.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in after.collect()) == sorted((i or 0, t) for i, t in shared[1::2])
    # of near duplicates one row goes, not the other rows with its id
    more = [(1, texts[clean[2]].text), (7, texts[clean[2]].text), (7, texts[clean[3]].text), (None, texts[clean[3]].text)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in more], table.schema)
    after = corpus_pipeline.near_duplicates(spark, table, TEST).collect()
    assert sorted((r.doc_id, r.text) for r in after) == [more[0], more[2]]


def shared_files(spark):
    return {f for f in Path(spark.conf.get("spark.checkpoint.dir")).rglob("*.parquet") if f.is_file()}


@pytest.mark.parametrize("name", ["quality_rules", "toxicity", "near_dedup"])
def test_a_stage_keeps_no_copy_of_the_texts(spark, name):
    """Each stage left its whole input, and all tables on its way, on the disk until the application ended."""
    before = shared_files(spark)
    after = dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{TEST}/documents.parquet"), TEST)
    left = [f for f in shared_files(spark) - before]
    assert after.count() > 0
    for f in left:
        assert "text" not in spark.read.parquet(str(f)).columns
    assert len({f.parent for f in left}) <= 3


def test_rows_are_numbered_alike_in_every_read(spark, tmp_path):
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(90)], "doc_id long, text string")
    docs.repartition(4).write.parquet(str(tmp_path / "d"))
    before = shared_files(spark)
    read, key = corpus_pipeline.keyed(spark.read.parquet(str(tmp_path / "d")))
    assert shared_files(spark) == before
    one = {r[key]: r.text for r in read.collect()}
    assert len(one) == 90 and one == {r[key]: r.text for r in read.select("text", key).repartition(3).collect()}
    # rows of a file keep their order; a file that is read twice has two numbers for a row, and so has a frame of other kinds
    file = next(f for f in (tmp_path / "d").iterdir() if f.suffix == ".parquet")
    numbers = [r[key] for r in corpus_pipeline.keyed(spark.read.parquet(str(file)))[0].collect()]
    assert numbers == sorted(set(numbers))
    once = spark.read.parquet(str(tmp_path / "d"))
    for other in (spark.read.parquet(str(file), str(file)), once.limit(50), once.union(once), docs):
        read, key = corpus_pipeline.keyed(other)
        assert read.select(key).distinct().count() == read.count() == other.count()


def test_odd_rows(spark, tmp_path):
    odd = odd_table(spark)
    words = " ".join(f"w{'abcdefghij'[i % 10]}{'klmno'[i // 10]}" for i in range(50))
    clean = odd.where("doc_id = 4").withColumns({"doc_id": F.lit(900).cast("long"), "text": F.lit(words)})
    docs = odd.unionByName(clean)  # the odd ones all fail the base rules
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TEST).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == docs.columns
            docs = after
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "packing")).collect()} == {900}
    empty = odd_table(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, TEST).count() == 0
