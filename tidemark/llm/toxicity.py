"""Toxicity: boosted trees over dense text features, with isotonic calibration.

Training uses at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled rows (those with the smallest hash of their id) and splits
them by another hash into ``PARTS`` parts. Words and word beginnings that are typical of toxic texts make a lexicon of at most
``MAX_TERMS`` entries. The features of a training row use the lexicon of the other parts, so that the trees
see hits as they will be in unknown texts; scoring uses the lexicon of all parts. One part calibrates, the others train
the trees. Rows are weighted so that the classes count as in all labelled rows. Every text is scored whole.

Features are rates and counts: lexicon hits and densities, hits near words of the second person, capitals, punctuation,
symbols, and signs of obfuscation (digits for letters, letters parted by signs, letters repeated).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Memo, map_rows
from tidemark.sources.storage import release, stored

THRESHOLD = 0.7
MAX_TOXIC = 20_000
MAX_CLEAN = 40_000
MAX_TERMS = 500
#: Toxic documents of the sample that a term must be in, and its least log odds ratio.
MIN_SUPPORT = 4
MIN_LOG_ODDS = 3.0
#: Lengths of the word beginnings that may become terms, so that inflected forms are found by their stem.
STEMS = (4, 5, 6, 7)
#: A hit counts as near if a word of the second person is at most so many words away.
NEAR = 5
TREES, DEPTH = 20, 3
PARTS = 4

#: Common insults; the learned terms add those of the labelled texts.
INSULTS = frozenset(
    "idiot moron loser scum trash worthless stupid pathetic disgusting clown dumb fool ugly garbage jerk liar coward filth "
    "filthy freak creep imbecile bastard".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dein deine ihr tu toi ton vous votre usted tú ustedes".split())

_LEET = str.maketrans("013457@$!|", "oieastasil")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_DIGITS = re.compile(r"\d")
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")
_HIT, _YOU, _HIDDEN, _CAPS, _DIGIT, _LEARNED = 1, 2, 4, 8, 16, 32  # _LEARNED << i: in lexicon i
_UPPER, _PUNCTUATION, _SYMBOLS, _MARKS = bytes(range(65, 91)), b".,;:'\"()-", b"#*$%&@^~<>|_=+", b"!?"

FEATURES = (
    "log_words", "insults", "insult_density", "terms", "term_density", "near_second_person", "second_person_density",
    "capitals", "capital_words", "marks", "punctuation", "symbols", "hidden_words", "hidden_hits", "digit_words",
    "word_length",
)


def plain_word(word: str) -> tuple[str, bool]:
    """The word in lower case without what hides it, and whether something hid it."""
    bare = letters = word.strip(_SIGNS).lower()
    if not bare.isalpha():
        bare = _EDGES.sub("", bare)
        letters = _INNER.sub("", bare)
        if not letters.isdigit():
            letters = letters.translate(_LEET)
    letters = _REPEAT.sub(r"\1", letters)
    return letters, letters != bare and any(c.isalpha() for c in bare)


def keys_of(plain: str) -> list[str]:
    """What may be a term: the word itself, and its beginnings, marked with a star."""
    return [plain, *(f"{plain[:n]}*" for n in STEMS if len(plain) >= n)] if plain else []


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def word_flags(*lexicons: frozenset[str]) -> Memo:
    """What a word is, as bits; at most eight lexicons."""

    def make(word: bytes) -> int:
        raw = word.decode()
        plain, hidden = plain_word(raw)
        keys = keys_of(plain)
        return (
            _HIT * (plain in INSULTS)
            + _YOU * (plain in SECOND_PERSON)
            + _HIDDEN * hidden
            + _CAPS * (raw.isupper() and len(plain) > 1)
            + _DIGIT * bool(_DIGITS.search(raw))
            + sum(_LEARNED << i for i, terms in enumerate(lexicons) if not terms.isdisjoint(keys))
        )

    return Memo(make)


def features(text: str | None, flags: Memo, lexicon: int = 0) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    n, size = max(len(words), 1), max(len(data), 1)
    of = np.fromiter(map(flags.__getitem__, words), np.int16, len(words))
    learned = _LEARNED << lexicon
    hits = (of & (_HIT | learned)) > 0
    you = np.flatnonzero(of & _YOU)
    near = 0
    if len(you) and hits.any():
        at = np.flatnonzero(hits)
        after = np.searchsorted(you, at)
        gaps = np.minimum(
            np.where(after < len(you), you[np.minimum(after, len(you) - 1)] - at, NEAR + 1),
            np.where(after > 0, at - you[np.maximum(after - 1, 0)], NEAR + 1),
        )
        near = int((gaps <= NEAR).sum())

    def count(bit: int) -> int:
        return int(((of & bit) > 0).sum())

    def rate(chars: bytes) -> float:
        return (len(data) - len(data.translate(None, chars))) / size

    insults, terms = count(_HIT), count(learned)
    return [
        math.log1p(len(words)),
        float(min(insults, 20)),
        insults / n,
        float(min(terms, 20)),
        terms / n,
        near / n,
        len(you) / n,
        rate(_UPPER),
        count(_CAPS) / n,
        rate(_MARKS),
        rate(_PUNCTUATION),
        rate(_SYMBOLS),
        count(_HIDDEN) / n,
        float((hits & ((of & _HIDDEN) > 0)).sum()),
        count(_DIGIT) / n,
        sum(map(len, words)) / n,
    ]


def with_features(df: DataFrame, text_column: str, lexicons: list[frozenset[str]], part_column: str | None = None) -> DataFrame:
    """``df`` with the text replaced by an array of ``FEATURES``; the lexicon is the first, or that of the row's part."""
    others = [c for c in df.columns if c != text_column]
    schema = T.StructType([*(df.schema[c] for c in others), T.StructField("features", T.ArrayType(T.DoubleType()))])
    place = others.index(part_column) if part_column else None

    def start():
        flags = word_flags(*lexicons)
        return lambda *row: [(*row[:-1], features(row[-1], flags, 0 if place is None else row[place]))]

    return map_rows(df.select(*others, text_column), schema, start)


@dataclass
class ToxicityModel:
    """Fitted parts. Without both classes among the labels there are no trees: every text gets ``prior``."""

    terms: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def held_out(key: Column) -> Column:
    """Rows that must not be learned from; a missing id is one of them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def learned_terms(texts: DataFrame, max_terms: int) -> list[frozenset[str]]:
    """Lexicons of ``texts`` (text, toxic, part): for each part the one of all other parts, at last that of all.

    Documents with a term are counted in tasks first; the counts meet by term.
    """
    schema = T.StructType(
        [T.StructField("term", T.StringType()), T.StructField("counts", T.ArrayType(T.LongType()))]
    )  # counts: clean and toxic documents of part 0, of part 1, ...

    def start():
        seen = [Counter() for _ in range(2 * PARTS)]
        keys = Memo(lambda word: keys_of(plain_word(word.decode())[0]))

        def flush():
            rows: dict[str, list[int]] = {}
            for slot, counts in enumerate(seen):
                for key, n in counts.items():
                    rows.setdefault(key, [0] * (2 * PARTS))[slot] = n
                counts.clear()
            return list(rows.items())

        def call(text, toxic, part):
            seen[2 * part + toxic].update(set().union(*map(keys.__getitem__, set(text_words(text)))))
            return flush() if sum(map(len, seen)) > 300_000 else ()

        call.close = flush
        return call

    slots = range(2 * PARTS)
    per_term = map_rows(texts.select("text", "toxic", "part"), schema, start).groupBy("term")
    per_term = per_term.agg(*[F.sum(F.get("counts", F.lit(s))).alias(f"n{s}") for s in slots])
    per_term = stored(per_term.where(sum(F.col(f"n{s}") for s in slots if s % 2) >= MIN_SUPPORT))
    total = Counter({(r["part"], r["toxic"]): r["n"] for r in texts.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()})
    out = []
    for left_out in [*range(PARTS), None]:
        t, c = (sum(F.col(f"n{s}") for s in slots if s % 2 == y and s // 2 != left_out) for y in (1, 0))
        all_t, all_c = (sum(n for (p, l), n in total.items() if l == y and p != left_out) for y in (1, 0))
        odds = F.log((t + 0.5) / (all_t + 1.0)) - F.log((c + 0.5) / (all_c + 1.0))
        chosen = per_term.where((t >= MIN_SUPPORT) & (odds >= MIN_LOG_ODDS))
        top = chosen.orderBy(F.desc(t * odds), "term").limit(max_terms)  # the lexicon is a bounded list
        out.append(frozenset(r["term"] for r in top.select("term").collect()))
    release(per_term)
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_terms: int = MAX_TERMS,
) -> ToxicityModel:
    """Learn from the labelled rows that are not held out.

    Ids that are missing in either table, null labels and null ids are left out; an id with
    different labels counts as toxic. ``max_toxic`` and ``max_clean`` bound the rows learned from.
    """
    key = F.col(id_column)
    known = (
        labels.where(key.isNotNull() & ~held_out(key) & F.col(label_column).isin(0, 1))
        .groupBy(key.alias("key"))
        .agg(F.max(F.col(label_column).cast("int")).alias("toxic"))
    )
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    taken = {0: max_clean, 1: max_toxic}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("key"), "key").limit(n) for y, n in taken.items()]
    sample = stored(chosen[0].unionByName(chosen[1]))
    # at most max_toxic + max_clean small rows, so this side may be broadcast
    texts = docs.select(key.alias("key"), F.col(text_column).alias("text")).join(F.broadcast(sample), "key")
    part = (F.crc32(F.concat(F.lit("part "), F.col("key").cast("string")).cast("binary")) % PARTS).cast("int")
    chosen_texts = stored(texts.select("text", "toxic", part.alias("part")))
    release(sample)
    weight = {y: max(1.0, n / taken[y]) for y, n in total.items()}
    texts = chosen_texts.withColumn("weight", F.when(F.col("toxic") == 1, weight.get(1, 1.0)).otherwise(weight.get(0, 1.0)))
    *others, terms = learned_terms(texts, max_terms)
    featured = stored(with_features(texts.select("toxic", "part", "weight", "text"), "text", others, "part"))
    release(chosen_texts)
    rows = featured.withColumn("features", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double"))
    classes = {(r["part"], r["toxic"]) for r in rows.select("part", "toxic").distinct().collect()}
    if len({y for _, y in classes}) < 2:
        return ToxicityModel(terms, None, None, (total.get(1, 0) + 1) / (sum(total.values()) + 2))
    last = PARTS - 1
    # tiny tables may leave either side without one of the classes: then both use all rows
    both = {(last, 0), (last, 1)} <= classes and {y for p, y in classes if p != last} == {0, 1}
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="weight")
    fitted = trees.fit(rows.where(F.col("part") != last) if both else rows)
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="calibrated")
    scored = with_raw(fitted, rows.where(F.col("part") == last) if both else rows)
    # equal scores are one point of the regression, so no score is a hot key
    points = scored.groupBy("raw").agg(
        F.sum("weight").alias("weight"), (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("label")
    )
    calibration = isotonic.fit(points)
    release(featured)
    return ToxicityModel(terms, fitted, calibration, 0.0)


def with_raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


def score(
    df: DataFrame, model: ToxicityModel, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on) of every row.

    Null and empty texts get the score of a text without words. Repeated and null ids stay; other columns are
    ignored. A hundredth of the score is the trees' own, so that texts on one step of the calibration stay in order.
    """
    if model.trees is None:
        scored = df.select(id_column, F.lit(model.prior).alias("score"))
    else:
        rows = with_features(df.select(F.col(id_column).alias("key"), F.col(text_column).alias("text")), "text", [model.terms])
        scored = model.calibration.transform(with_raw(model.trees, rows.withColumn("features", array_to_vector("features"))))
        mixed = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("calibrated") + 0.01 * F.col("raw")))
        scored = scored.select(F.col("key").alias(id_column), mixed.alias("score"))
    return scored.select(
        id_column,
        held_out(F.col(id_column)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
