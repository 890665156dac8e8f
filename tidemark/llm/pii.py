"""Personal data by weak supervision. DataFrame functions only.

Candidates are the matches of the base patterns, those that fail their filters included, and matches of wider patterns
(spelled-out e-mail addresses, telephone numbers without a country code, dotted card numbers, IPv6).
Six labelers vote on each: two by form (regular expressions), one by gazetteers, two by the words and characters around it, and one by
company: whether the document has base spans of another kind. Expectation-
maximisation over the counts of vote patterns estimates how reliable each labeler is, and so a probability for each candidate.
With these as soft labels a logistic classifier on properties of the span is trained; it decides on
the candidates that are no base spans. Base spans always stay.

The driver only sees counts per vote pattern (at most 4 * 3**6 rows) and per feature pattern (at most 4 * 2**8).
Texts are read once; what is written to the shared folder are candidates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.storage import stored

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns of the contract, written so that a match attempt never starts inside a run that has already failed
# and never gives back what it has read: the matches are the same, the time is linear.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider patterns, as (kind, pattern).
WIDE = (
    (
        "email",
        r"[A-Za-z0-9._%+-]++(?: ?\[at\] ?| ?\(at\) ?| at )[A-Za-z0-9-]++(?: ?\[dot\] ?| ?\(dot\) ?| dot )[A-Za-z]{2,}+",
    ),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9])"),
    ("phone", r"(?<![0-9+])(?:\([0-9]{3}\) |[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
)
#: A candidate that is no base span is added from this probability on.
THRESHOLD = 0.9
ROUNDS = 50

_BEFORE = 30
_FOR = r"(?i)(mail|contact|reach|write|call|tel|phone|fax|mobile|card|visa|pay|credit|debit|ip|host|server|login|address)\W*(\w+\W+)?$"
_AGAINST = r"(?i)(version|release|isbn|issn|order|invoice|serial|item|part|section|build|ticket|model)\W*(\w+\W+)?$"
_DOMAINS = r"(?:\.|dot[\])]? ?)(com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|nl|be|pl|se|pt|ca|au|in|br|jp)$"
_ROLES = r"^(info|support|noreply|no-reply|admin|webmaster|postmaster|sales|office)@"
_RESERVED = r"^(0|127|255)\.|^(22[4-9]|2[3-5][0-9])\."
_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|62)"
_COUNTRIES = r"^\+?(1|7|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def running_sums(numbers: Column, block: int = 256) -> Column:
    """The sums of the first 1, 2, ... elements; in blocks, so that arrays of many thousands stay cheap."""

    def sums(values: Column, first: Column) -> Column:
        grown = F.aggregate(values, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(grown, F.lit(2), F.size(values))

    count = F.ceil(F.size(numbers) / F.lit(block)).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), count), lambda k: F.slice(numbers, (k - 1) * block + 1, F.lit(block)))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
    before = F.concat(F.array(F.lit(0)), sums(totals, F.lit(0)))
    summed = F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), count), lambda b, first: sums(b, first)))
    return F.when(F.size(numbers) > 0, summed).otherwise(F.slice(numbers, 1, 0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    mirrored = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substr(mirrored, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """The filter of the base kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(found, r"\."), lambda p: F.when(F.length(small(p)) <= 3, small(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(_digits(found)).between(16, 19), luhn(_digits(found))).otherwise(False)
    return F.length(_digits(found)).between(8, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(kind: str, m: Column, before: Column, after: Column, base: Column, wide: bool) -> list[Column]:
    """Six votes: 1 for personal data, -1 against, 0 for no opinion. On wide matches the base filter has no opinion.

    Each looks at something of its own. The fourth, on the company in the document, is put in by ``with_company``.
    """
    clean = F.rlike(F.right(before, F.lit(1)), F.lit(r"^[^A-Za-z0-9]?$")) & F.rlike(after, F.lit(r"^[^A-Za-z0-9]?$"))
    rare = {  # gazetteers: (for, against)
        "email": (F.rlike(F.lower(m), F.lit(_DOMAINS)), F.rlike(F.lower(m), F.lit(_ROLES))),
        "ip": (F.rlike(m, F.lit(":")), F.rlike(m, F.lit(_RESERVED))),
        "card": (F.rlike(_digits(m), F.lit(_ISSUERS)), F.rlike(_digits(m), F.lit(r"^(0|1|9)"))),
        "phone": (F.rlike(m, F.lit(_COUNTRIES)), F.rlike(_digits(m), F.lit(r"^0{3}"))),
    }[kind]
    shape = {  # stricter forms than the base pattern
        "email": F.rlike(m, F.lit(r"[A-Za-z0-9] ?(@|\[at\]|\(at\)|at).*[. ][A-Za-z]{2,24}$")),
        "ip": F.rlike(m, F.lit(r"^(?!0)[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$|:")),
        "card": F.rlike(m, F.lit(r"^[0-9]{16}$|^[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$")),
        "phone": F.length(_digits(m)).between(10, 13),
    }[kind]
    return [
        F.lit(0) if wide else _vote(base, ~base),
        _vote(shape, ~shape),
        _vote(rare[0], rare[1]),
        F.lit(0),
        _vote(F.rlike(before, F.lit(_FOR)), F.rlike(before, F.lit(_AGAINST))),
        _vote(F.lit(False), ~clean),
    ]


def properties(kind: str, m: Column, before: Column, after: Column, base: Column) -> list[Column]:
    """Eight properties of the span, 0 or 1, that the classifier sees."""
    flags = [
        base,
        F.length(m) >= 16,
        F.length(_digits(m)) * 5 >= F.length(m) * 4,
        F.rlike(m, F.lit(r"[ ().-]")),
        F.rlike(m, F.lit(r"^[+(]|@|:")),
        F.rlike(before, F.lit(r"(^|\s)$")) & F.rlike(after, F.lit(r"^([\s.,;:!?)]|$)")),
        F.rlike(before, F.lit(_FOR)),
        F.rlike(before, F.lit(_AGAINST)),
    ]
    return [f.cast("int") for f in flags]


def _with_matches(df: DataFrame, name: str, kind: str, pattern: str, worth: Column, wide: bool) -> DataFrame:
    """``df`` with the matches of ``pattern`` in ``_text`` as array column ``name``; ``worth``: whether to look at all."""
    text, none = F.col("_text"), F.array().cast("array<string>")
    df = df.withColumn("_found", F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_parts", F.when(F.size("_found") > 0, F.split(text, pattern, -1)).otherwise(none))
    step = F.zip_with("_found", F.slice("_parts", F.lit(1), F.size("_found")), lambda m, p: F.length(m) + F.length(p))
    df = df.withColumn("_ends", running_sums(step))
    # one pass over the matches, each with what stands around it
    around = F.arrays_zip(
        F.col("_found").alias("m"),
        F.slice("_parts", F.lit(1), F.size("_found")).alias("before"),
        F.slice("_parts", F.lit(2), F.size("_found")).alias("after"),
        F.col("_ends").alias("end"),
    )

    def span(x: Column) -> Column:
        m = x["m"]
        return F.struct(
            m.alias("m"),
            F.right(x["before"], F.lit(_BEFORE)).alias("before"),
            F.left(x["after"], F.lit(1)).alias("after"),
            (x["end"] - F.length(m)).cast("long").alias("start"),
            x["end"].cast("long").alias("end"),
            (F.lit(False) if wide else passes(kind, m)).alias("base"),
        )

    def judged(x: Column) -> Column:
        known = (kind, x["m"], x["before"], x["after"], x["base"])
        return F.struct(
            F.lit(kind).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["base"].alias("base"),
            F.array(*votes(*known, wide)).alias("votes"),
            F.array(*properties(*known)).alias("properties"),
        )

    return df.withColumn(name, F.transform(F.transform(around, span), judged)).drop("_found", "_parts", "_ends")


def candidates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The id and an array of candidates (kind, start, end, base, votes, properties) of every row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = df.select(F.col(id_column).alias("_id"), text.alias("_text"))
    has = lambda *parts: F.greatest(*[F.contains("_text", F.lit(p)) for p in parts], F.lit(False))
    digit = F.rlike("_text", F.lit("[0-9]"))
    rows = rows.withColumn("_digit", digit)
    worth = {
        "email": has("@"),
        "ip": F.when(F.col("_digit"), F.rlike("_text", F.lit(r"[0-9]\.[0-9]"))).otherwise(False),
        "card": F.when(F.col("_digit"), F.rlike("_text", F.lit(r"[0-9](?:[ -]?[0-9]){9}"))).otherwise(False),
        "phone": F.col("_digit") & has("+"),
    }
    # each is a necessary condition of its pattern
    wide = {
        "email": has("[dot]", "(dot)", " dot "),
        "ip": F.when(has(":"), F.rlike("_text", F.lit(r":[0-9A-Fa-f]{1,4}:"))).otherwise(False),
        "card": F.when(F.col("_digit"), F.rlike("_text", F.lit(r"[0-9]{4}\.[0-9]{4}\."))).otherwise(False),
        "phone": F.when(F.col("_digit"), F.rlike("_text", F.lit(r"[0-9]{3}[.-][0-9]{4}"))).otherwise(False),
    }
    names = []
    for kind in KINDS:
        names.append(f"_{kind}")
        rows = _with_matches(rows, names[-1], kind, BASE[kind], worth[kind], wide=False)
    for kind, pattern in WIDE:
        names.append(f"_wide_{kind}")
        rows = _with_matches(rows, names[-1], kind, pattern, wide[kind], wide=True)
    rows = rows.select(F.col("_id").alias(id_column), F.concat(*names).alias("candidates"))
    return rows.withColumn("candidates", with_company(F.col("candidates")))


def with_company(found: Column) -> Column:
    """The candidates of a document, with the vote on their company: base spans of other kinds speak for a candidate."""

    def bases(kind: str) -> Column:
        return F.aggregate(found, F.lit(0), lambda s, c: s + (c["base"] & (c["kind"] == kind)).cast("int"))

    counts = F.struct(F.aggregate(found, F.lit(0), lambda s, c: s + c["base"].cast("int")).alias("all"), *[bases(k).alias(k) for k in KINDS])

    def voted(c: Column, count: Column) -> Column:
        own = F.lit(0)
        for k in KINDS:
            own = F.when(c["kind"] == k, count[k]).otherwise(own)
        vote = F.when(count["all"] > own, 1).otherwise(0)
        return c.withField("votes", F.concat(F.slice(c["votes"], 1, 3), F.array(vote), F.slice(c["votes"], 5, 2)))

    # the counts are an array of one element, so that they are taken once for each document
    return F.flatten(F.transform(F.array(counts), lambda count: F.transform(found, lambda c: voted(c, count))))


@dataclass
class Labelers:
    """For each kind: log odds of the prior, and for each labeler and vote the log of the likelihood ratio."""

    prior: dict[str, float]
    weights: dict[str, list[dict[int, float]]]


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS) -> Labelers:
    """Expectation-maximisation over (kind, votes, count): labelers are independent given whether the span is personal.

    It starts from the majority of the votes. Counts are smoothed, so that a labeler never decides alone.
    """
    prior, weights = {}, {}
    for kind in KINDS:
        mine = [(v, n) for k, v, n in patterns if k == kind]
        labelers = len(mine[0][0]) if mine else 0
        belief = [0.9 if sum(v) > 0 else 0.1 if sum(v) < 0 else 0.5 for v, _ in mine]
        prior[kind], weights[kind] = 0.0, []
        for _ in range(rounds if mine else 0):
            yes = sum(b * n for b, (_, n) in zip(belief, mine, strict=True))
            no = sum((1 - b) * n for b, (_, n) in zip(belief, mine, strict=True))
            prior[kind] = math.log((yes + 1) / (no + 1))
            weights[kind] = []
            for j in range(labelers):
                ratio = {}
                for vote in (-1, 0, 1):
                    y = sum(b * n for b, (v, n) in zip(belief, mine, strict=True) if v[j] == vote)
                    x = sum((1 - b) * n for b, (v, n) in zip(belief, mine, strict=True) if v[j] == vote)
                    # a labeler is assumed to be better than chance: its vote starts with a pseudo-count of its sign
                    good, bad = (2.0, 1.0) if vote > 0 else (1.0, 2.0) if vote < 0 else (1.0, 1.0)
                    ratio[vote] = math.log((y + good) / (yes + 4)) - math.log((x + bad) / (no + 4))
                weights[kind].append(ratio)
            odds = [prior[kind] + sum(weights[kind][j][v[j]] for j in range(labelers)) for v, _ in mine]
            belief = [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]
    return Labelers(prior, weights)


def belief_of(labelers: Labelers, span: Column) -> Column:
    """The estimated probability of a candidate, from its votes."""
    odds = F.lit(0.0)
    for kind, weights in labelers.weights.items():
        total = F.lit(labelers.prior[kind])
        for j, ratio in enumerate(weights):
            vote = F.get(span["votes"], F.lit(j))
            total += F.when(vote > 0, ratio[1]).when(vote < 0, ratio[-1]).otherwise(ratio[0])
        odds = F.when(span["kind"] == kind, total).otherwise(odds)
    return F.lit(1.0) / (1 + F.exp(-odds))


def train(patterns: list[tuple[str, tuple[int, ...], float, float]], steps: int = 300) -> dict[str, list[float]]:
    """Logistic weights (constant first) for each kind, from (kind, properties, weight of personal, weight of not)."""
    out = {}
    for kind in KINDS:
        mine = [((1, *p), y, n) for k, p, y, n in patterns if k == kind]
        size = len(mine[0][0]) if mine else 1
        w, total = [0.0] * size, sum(y + n for _, y, n in mine) or 1.0
        for _ in range(steps if mine else 0):
            slope = [-1e-3 * x for x in w]
            for p, y, n in mine:
                chance = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, p, strict=True))))
                error = (y - chance * (y + n)) / total
                for j, x in enumerate(p):
                    slope[j] += error * x
            w = [max(-15.0, min(15.0, a + 4 * s)) for a, s in zip(w, slope, strict=True)]
        out[kind] = w
    return out


def chance_of(weights: dict[str, list[float]], span: Column) -> Column:
    """The classifier's probability of a candidate, from its properties."""
    odds = F.lit(-15.0)
    for kind, w in weights.items():
        total = F.lit(w[0])
        for j, x in enumerate(w[1:]):
            total += F.get(span["properties"], F.lit(j)) * F.lit(x)
        odds = F.when(span["kind"] == kind, total).otherwise(odds)
    return F.lit(1.0) / (1 + F.exp(-odds))


def find_pii(
    df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The id and ``spans`` of every row: array of (kind, start, end, base), by kind as listed, then start.

    ``base`` tells base spans from added ones; an added span never overlaps a base span of its kind. Offsets are
    code points, end exclusive. Null and empty texts have no spans. Rows are searched one by one:
    repeated and null ids stay; other columns are ignored. Labelers and classifier are fitted on all rows.
    """
    found = stored(candidates(df, id_column, text_column))
    every = found.select(F.explode("candidates").alias("c"))
    counts = every.groupBy("c.kind", "c.votes").agg(F.count("*").alias("n"))
    labelers = estimate(sorted((r["kind"], tuple(r["votes"]), r["n"]) for r in counts.collect()))
    soft = every.select("c.kind", "c.properties", belief_of(labelers, F.col("c")).alias("p"))
    sums = soft.groupBy("kind", "properties").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    weights = train(sorted((r["kind"], tuple(r["properties"]), r["yes"], r["no"]) for r in sums))

    def chosen(c: Column) -> Column:
        apart = ~F.exists(
            "candidates", lambda b: b["base"] & (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"])
        )
        return F.when(c["base"], True).when(chance_of(weights, c) >= threshold, apart).otherwise(False)

    order = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        F.array_sort(
            F.transform(
                F.filter("candidates", chosen),
                lambda c: F.struct(F.array_position(order, c["kind"]).alias("o"), c["start"], c["end"], c["base"], c["kind"]),
            )
        ),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")),
    )
    return found.select(id_column, spans.alias("spans"))
