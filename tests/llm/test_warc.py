"""The archive against a plain version, and record for record."""

import base64
import hashlib

import pytest
from brute import ODD

import __spark_entry__ as entry_module
from tidemark.llm import warc

TESTDATA = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def plain(rows, min_bytes=0):
    """rows of (page_id, url, html)."""
    out, groups = [], {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    for body, ids in groups.items():
        ids.sort(key=lambda x: (x is None, -(x or 0)))
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for k, page in enumerate(ids):
            revisit = k > 0 and len(body) >= min_bytes
            out.append((page, len(body), digest, "revisit" if revisit else "response", ids[0] if revisit else None))
    return sorted(out, key=repr)


def found(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    query = entry_module.queries()["op12_warc"](spark, TESTDATA)
    assert query.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert found(query) == plain([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


ROWS = [(i, f"http://x/{i}", t) for i, t in enumerate(ODD)] + [
    (100, None, "a"),
    (101, "u\r\nWARC-Type: fake", "a"),
    (101, "again", "a"),
    (None, "none", "a"),
    (None, "none", "only without id"),
    (None, "none", "only without id"),
    (7, "repeated", "x"),
    (7, "repeated", "x"),
    (200, "breaks", "one\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"),
]


@pytest.mark.parametrize("min_bytes", [0, 2])
def test_odd_rows(spark, min_bytes):
    clash = "digest string, payload string, n string, row string, header string, parts string"
    pages = spark.createDataFrame([(*r, *"abcdef") for r in ROWS], f"{SCHEMA}, {clash}").repartition(3)
    assert found(warc.archived(pages, min_bytes=min_bytes)) == plain(ROWS, min_bytes)


def test_empty_table(spark):
    assert found(warc.archived(spark.createDataFrame([], SCHEMA))) == []


def test_payloads_once_and_records_exact(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    archive = warc.write_archive(pages, str(tmp_path / "a"))
    bodies = [r.payload for r in archive.payloads(spark).collect()]
    assert sorted(map(bytes, bodies)) == sorted({(t or "").encode() for _, _, t in ROWS})
    back = {(r.page_id, bytes(r.payload)) for r in warc.read_archive(spark, archive).collect()}
    assert back == {(p, (t or "").encode()) for p, _, t in ROWS}
    for r in archive.headers(spark).collect():
        assert bytes(r.header).startswith(b"WARC/1.1\r\nWARC-Type: re") and bytes(r.header).endswith(b"\r\n\r\n")


def test_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    records = warc.read_archive(spark, warc.write_archive(pages, str(tmp_path / "a")))
    back = warc.read_files(spark, warc.export_files(records, str(tmp_path / "files"), records_per_file=4))
    given = sorted(
        (bytes(r.header), b"" if b"WARC-Type: revisit" in r.header else bytes(r.payload)) for r in records.collect()
    )
    assert sorted((bytes(r.header), bytes(r.payload)) for r in back.collect()) == given


def test_hot_payload_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_LEAST", 5)
    rows = [(i, "u", "hot" if i % 3 else f"own {i}") for i in range(90)]
    hot = warc.hot_payloads(spark.createDataFrame([(b"x", 60), (b"y", 3)], "digest binary, n long"))
    assert [(bytes(r.digest), r.parts) for r in hot.collect()] == [(b"x", 12)]
    assert found(warc.archived(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_damaged_payload_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], SCHEMA)
    archive = warc.write_archive(pages, str(tmp_path / "a"))
    damaged = spark.createDataFrame([(hashlib.sha256(b"text").digest(), b"other")], "digest binary, payload binary")
    damaged.write.mode("overwrite").parquet(f"{archive.path}/payloads")
    with pytest.raises(Exception, match="does not have its SHA-256"):
        warc.read_archive(spark, archive).collect()
