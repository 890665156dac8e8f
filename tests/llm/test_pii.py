import random
import re

import pytest
from brute import ODD, joined, odd_table, sha
from pyspark.sql import functions as F

from tidemark.llm.pii import KINDS, candidates, estimate, find_pii, luhn, running_sums, train
from tidemark.llm.queries import op2_pii

TEST = "/root/testdata/sf0.01"


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out += [("ip", *m.span()) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out += [("card", *m.span()) for m in cards if 16 <= len(digits(m)) <= 19 and luhn_ok(digits(m))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    out += [("phone", *m.span()) for m in phones if 8 <= len(digits(m)) <= 15]
    return out


def test_base_spans_of_all_documents(spark):
    texts = dict(spark.read.parquet(f"{TEST}/documents.parquet").select("doc_id", "text").collect())
    rows = op2_pii(spark, TEST).collect()
    assert len(rows) == len(texts)
    assert min(sum(r[f"n_{k}"] for r in rows) for k in KINDS) >= 5
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        assert tuple(r[f"n_{k}"] for k in KINDS) == tuple(sum(s[0] == k for s in spans) for k in KINDS)
        assert r.base_sha256 == sha(spans)
        assert set(joined(spans).split(",")) <= set(r.spans.split(",")) | {""}


def test_random_texts_like_regular_expressions(spark):
    rng = random.Random(6)
    parts = [
        "@", ".", "a", "b.c", "-", "+", " ", "_", "%", "1", "23", "255", "256", "0000012", "4111111111111111", "4012 8888",
        "é", "\U0001f600", "(", ")", "foo@bar.com", "+1 555", "192.168", "1.2.3.4", "\n", "4", "0",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 16))) for _ in range(3000)]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        got = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert got == base_spans(texts[r.doc_id]), texts[r.doc_id]


def test_wide_matches_do_not_depend_on_the_rest_of_the_text(spark):
    alone = {
        "email": ["jo at mail [dot] com", "jo at mail(dot)com", "jo at mail dot com", "jo[at]mail dot com", "jo[at]mail[dot]com"],
        "ip": ["fe:dc:ba:ab:cd:ef:fa:ce", "1:2:3:4:5:6:7:8"],
        "card": ["4111.1111.1111.1111"],
        "phone": ["(555) 123-4567"],
    }
    opener = "[at] (at) 1 dot [dot] (dot) :a: 0000.0000. 000-0000 "  # opens every gate
    texts = [(kind, before, t) for kind, some in alone.items() for t in some for before in ("", opener)]
    table = spark.createDataFrame([(i, b + t) for i, (_, b, t) in enumerate(texts)], "doc_id long, text string")
    for r in candidates(table, "doc_id", "text").collect():
        kind, before, text = texts[r.doc_id]
        found = {(c.kind, c.start, c.end) for c in r.candidates}
        assert (kind, len(before), len(before) + len(text)) in found, before + text


def test_many_matches_and_long_runs(spark):
    texts = {
        1: "é x@y.zz " * 3000,
        2: "a" * 3000 + "@",
        3: "1" * 3000 + " 1.2.3.4",
        4: "+1" + " " * 100_000 + "2345678",
        5: "1-" * 60_000,
        6: "a@" * 50_000,
    }
    rows = find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == base_spans(texts[r.doc_id])


def test_added_spans(spark):
    """Forms that the base patterns miss are found once the labelers have seen enough of them."""
    rng = random.Random(8)
    rows = []
    for i in range(400):
        n = rng.randint(100, 999)
        rows.append((i, f"please call (415) {n}-{rng.randint(1000, 9999)} or write to jo{n} [at] mail [dot] com today"))
        rows.append((1000 + i, f"call +1 415 {n} {rng.randint(1000, 9999)}, mail jo.{n}@mail.com"))
        rows.append((2000 + i, f"the invoice {n}-{n}-{rng.randint(1000, 9999)}x and version {n}.{n}.3.4 are old"))
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = [{s.kind for s in got[i] if not s.base} for i in range(400)]
    assert sum({"email", "phone"} <= a for a in added) > 380
    # versions that look like addresses are base spans and stay; nothing is added
    assert sum(any(not s.base for s in got[2000 + i]) for i in range(400)) < 20


def test_estimate_finds_the_bad_labeler():
    rng = random.Random(3)
    counts = {}
    for _ in range(4000):
        truth = 1 if rng.random() < 0.3 else -1
        votes = tuple(truth if rng.random() < p else -truth for p in (0.9, 0.85, 0.8, 0.5))
        counts[votes] = counts.get(votes, 0) + 1
    found = estimate([("ip", v, n) for v, n in sorted(counts.items())])
    spread = [abs(w[1] - w[-1]) for w in found.weights["ip"]]
    assert spread[3] < 0.6 < 2 < min(spread[:3])
    assert found.prior["ip"] == pytest.approx(-0.85, abs=0.35)
    weights = train([("ip", (1, 0), 90.0, 10.0), ("ip", (0, 1), 5.0, 95.0)])["ip"]
    assert weights[1] > 0 > weights[2]


def test_helpers(spark):
    numbers = list(range(1, 1001))
    table = spark.createDataFrame([(numbers,), ([],), ([5],)], "a array<int>")
    got = [r[0] for r in table.select(running_sums(F.col("a"))).collect()]
    assert got == [[n * (n + 1) // 2 for n in numbers], [], [5]]
    cards = ["4111111111111111", "4111111111111112", "79927398713", "0"]
    rows = spark.createDataFrame([(c,) for c in cards], "c string").select("c", luhn(F.col("c")).alias("ok")).collect()
    assert all(r.ok == luhn_ok(r.c) for r in rows)


def test_odd_rows(spark):
    rows = find_pii(odd_table(spark)).collect()
    assert len(rows) == len(ODD) + 3 and all(r.spans == [] for r in rows)
    assert find_pii(odd_table(spark).limit(0)).count() == 0
