"""Phrase collocations by vertical partitioning and depth-truncated suffix subtrees.

1. *Vertical partitioning.* Words are counted per language. A word is a prefix of suffixes; one that begins more suffixes than
   the memory budget is extended by a second word, and a pair that still exceeds it by a third. Prefixes are hashed to slots, and
   neighbouring slots are packed into groups of about one budget. At most ``GROUPS`` words and as many pairs can exceed a
   budget, which grows with the corpus where needed, so the lists of them and the map of slots have a fixed bound.
2. Every occurrence of a word begins a suffix, cut after three words, at the end of its piece and before a rare word (no phrase that
   is frequent enough holds one). Tasks merge equal suffixes before they send them to the group of their prefix.
3. *Subtrees.* Each group sorts its suffixes; nodes of the subtree are runs of equal beginnings, and the count of a node is the total of
   its leaves. Groups do not know of each other.
4. Scores need the count of a phrase's first and last words. First words are ancestors in the same subtree (or an
   extended prefix, whose count is known); last words are looked up in the counts of all subtrees, those of extended prefixes in a
   broadcast of the bounded lists. A word of another group begins at most a budget of suffixes, so no lookup is hot.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.hashing import hash64
from tidemark.sources.storage import ship_package, stored

WORDS = 3
LEAST, TOP, SCALE = 10, 2000, 1_000_000
#: A longer candidate with this share of a phrase's occurrences (in per cent) replaces it.
INSIDE = 50
#: Suffixes in a group; the groups, and the slots that prefixes are hashed to.
BUDGET, GROUPS, SLOTS = 1 << 20, 1 << 18, 1 << 20
#: Words that a task holds before it merges and sends, and bytes of distinct ones among them.
HELD_WORDS, HELD_BYTES = 1 << 20, 1 << 26
#: Bits of the map of frequent words (4 MB). Rare words that it lets through by chance do no harm.
MAP_BITS = 1 << 25

_BREAK = b"\xff"  # in no UTF-8 text
_SLICE = 1 << 20
_UPPER, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + b"\n" * len(_ENDS))
_CUT = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words in order, with a break between pieces, in lists of about a megabyte of text."""
    at = 0
    while at < len(text):
        end = at + _SLICE
        if end < len(text):
            cut = _CUT.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end].translate(_TABLE).replace(b"\n", b" \xff ").split()
        at = end


class Numbers(dict):
    """Numbers words from 1 on; a break is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.bytes += len(word)
        return number


class Held:
    """The words of one language, in order, that a task has read and not sent yet."""

    def __init__(self):
        self.numbers, self.lists, self.size = Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.lists.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def take(self) -> tuple[list[bytes], np.ndarray]:
        """All words held, and the numbers in order. The last two stay: the next words may go on with them."""
        words, line = list(self.numbers), np.concatenate(self.lists)
        self.__init__()
        self.add([words[i] for i in line[-2:]])
        return words, line


def hashes(lang: str, words: list[bytes]) -> np.ndarray:
    head = lang.encode() + b"\0"
    return np.fromiter((hash64(head + w) for w in words), np.int64, len(words)).view(np.uint64)


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a prefix and a further word."""
    out = (prefix ^ (prefix >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + word
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _mapped(docs: DataFrame, make: Callable, schema: str, columns: pa.Schema) -> DataFrame:
    """Runs ``make(lang, words, line)``, which gives columns, on what tasks hold whenever it is enough, and at their end."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Held] = {}

        def sent():
            for lang, h in held.items():
                words, line = h.take()
                out = make(lang, words, line)
                if out is not None:
                    yield pa.record_batch([pa.array([lang] * len(out[0]), pa.string()), *out], schema=columns)

        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                lang, text = lang.as_py(), text.as_py()
                if lang not in held:
                    held[lang] = Held()
                for words in word_lists(text):
                    held[lang].add(words)
                    if sum(h.size for h in held.values()) >= HELD_WORDS or sum(h.numbers.bytes for h in held.values()) >= HELD_BYTES:
                        yield from sent()
                held[lang].add([_BREAK, _BREAK])
            if len(held) > 1000:  # many languages
                yield from sent()
                held = {}
        yield from sent()

    return docs.mapInArrow(run, schema)


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array([None, *words[1:]], pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, h (hash of both) and f (occurrences)."""

    def make(lang, words, line):
        counts = np.bincount(line[:-2], minlength=len(words))  # the last two are counted with what follows
        some = np.flatnonzero(counts[1:]) + 1
        if not len(some):
            return None
        named = _strings(words)
        return named.take(pa.array(some)), pa.array(hashes(lang, words)[some].view(np.int64)), pa.array(counts[some])

    columns = pa.schema([("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("f", pa.int64())])
    sent = _mapped(docs, make, "lang string, word string, h long, f long", columns)
    return sent.groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


class Suffixes:
    """Merges the suffixes in a line of words. Carried to the tasks in a broadcast variable."""

    def __init__(self, frequent: np.ndarray, heavy_words: np.ndarray, heavy_pairs: np.ndarray):
        self.frequent, self.heavy_words, self.heavy_pairs = frequent, heavy_words, heavy_pairs

    def merged(self, lang: str, words: list[bytes], line: np.ndarray):
        """Distinct suffixes as numbers of words (0: none) with their counts, hashes of their first words, and depth of their prefix."""
        h = hashes(lang, words)
        place = h % np.uint64(MAP_BITS)
        kept = (self.frequent[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
        kept[0] = 0
        line = line * kept[line]
        one, two, three = line[:-2], line[1:-1], line[2:]
        some = one > 0
        size = len(words)
        key = ((one * size + two) * size + np.where(two > 0, three, 0))[some]
        key, counts = np.unique(key, return_counts=True)
        one, two, three = key // (size * size), key // size % size, key % size
        pair = longer(h[one], h[two])
        heavy = _is_in(h[one], self.heavy_words)
        depth = 1 + heavy.astype(np.int8) + (heavy & _is_in(pair, self.heavy_pairs)).astype(np.int8)
        return (one, two, three), counts, (h[one], pair, longer(pair, h[three])), depth


def heavy_pair_counts(docs: DataFrame, suffixes) -> DataFrame:
    """lang, one, two, h and f of the pairs that begin with an extended word."""

    def make(lang, words, line):
        (one, two, _), counts, (_, pair, _), depth = suffixes.value.merged(lang, words, line)
        first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])][: len(one)])
        if not len(first):
            return None
        totals = np.add.reduceat(counts, first)
        some = (depth[first] > 1) & (two[first] > 0)
        at, named = first[some], _strings(words)
        return (
            named.take(pa.array(one[at])), named.take(pa.array(two[at])), pa.array(pair[at].view(np.int64)), pa.array(totals[some])
        )

    columns = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("h", pa.int64()), ("f", pa.int64())])
    sent = _mapped(docs, make, "lang string, one string, two string, h long, f long", columns)
    return sent.groupBy("lang", "one", "two", "h").agg(F.sum("f").alias("f"))


def grouped_suffixes(docs: DataFrame, suffixes, group_of_slot) -> DataFrame:
    """The suffixes, merged within tasks, as one row per task's share of a group.

    lang, group, ``words`` (the distinct ones, a line each) and arrays as bytes: ``places`` (three numbers of words for each suffix, 0:
    none), ``depth`` (words in its prefix) and ``f``. So words are sent once per share, and Spark moves shares and not suffixes.
    """
    shift = np.uint64(64 - SLOTS.bit_length() + 1)

    def make(lang, words, line):
        numbers, counts, prefixes, depth = suffixes.value.merged(lang, words, line)
        # what ends before its prefix does adds to no node: the counts of extended prefixes are known
        whole = np.flatnonzero((depth == 1) | ((depth == 2) & (numbers[1] > 0)) | (numbers[2] > 0))
        group = group_of_slot.value[(np.choose(depth - 1, prefixes) >> shift).astype(np.int64)][whole]
        order = np.argsort(group, kind="stable")
        whole, group = whole[order], group[order]
        if not len(whole):
            return None
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        share = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(group)]))
        # the words of each share: numbers within it, from 1 on
        size = len(words)
        triples = np.stack([n[whole] for n in numbers], axis=1)
        used, place = np.unique(share[:, None] * size + triples, return_inverse=True)
        place = place.reshape(triples.shape)
        begin = np.searchsorted(used, np.arange(len(first) + 1) * size)
        has_none = used[np.minimum(begin[:-1], len(used) - 1)] % size == 0
        place = (place - (begin[:-1] + has_none)[share][:, None] + 1).astype(np.int32)
        place[triples == 0] = 0
        used = used % size
        end = np.r_[first[1:], len(group)]
        depth, counts = depth[whole], counts[whole]
        texts = [b"\n".join([words[i] for i in used[x + n : y]]) for x, y, n in zip(begin[:-1], begin[1:], has_none, strict=True)]
        parts = [[v[x:y].tobytes() for x, y in zip(first, end, strict=True)] for v in (place, depth, counts)]
        return pa.array(group[first]), *(pa.array(x, pa.binary()) for x in (texts, *parts))

    columns = [("lang", pa.string()), ("group", pa.int32()), *((n, pa.binary()) for n in ("words", "places", "depth", "f"))]
    return _mapped(docs, make, "lang string, group int, words binary, places binary, depth binary, f binary", pa.schema(columns))


_NODES = "lang string, size int, one string, two string, three string, f long, f1 long, f2 long"


def subtree(shares: pa.Table, least: int) -> pa.Table:
    """The nodes of one group's subtree with at least ``least`` leaves, and the counts of their ancestors (null above the prefix)."""
    firsts: dict[tuple[str, bytes], int] = {}  # first words, with their language
    others: dict[bytes, int] = {b"": 0}
    keys, depths, counts = [], [], []
    for share in shares.to_pylist():
        lang, words = share["lang"], [b"", *share["words"].split(b"\n")]
        places = np.frombuffer(share["places"], np.int32).reshape(-1, WORDS)
        number = np.array([others.setdefault(w, len(others)) for w in words], np.int64)
        first = np.zeros(len(words), np.int64)
        for i in np.unique(places[:, 0]):
            first[i] = firsts.setdefault((lang, words[i]), len(firsts))
        keys.append(np.column_stack([first[places[:, 0]], number[places[:, 1:]]]))
        depths.append(np.frombuffer(share["depth"], np.int8))
        counts.append(np.frombuffer(share["f"], np.int64))
    suffixes, prefix, f = np.concatenate(keys), np.concatenate(depths), np.concatenate(counts)

    if max(len(firsts), len(others)) < 1 << 21:
        order = np.argsort((suffixes[:, 0] << 42) | (suffixes[:, 1] << 21) | suffixes[:, 2], kind="stable")
    else:
        order = np.lexsort(suffixes.T[::-1])
    suffixes, prefix, f = suffixes[order], prefix[order], f[order]
    new = np.zeros(len(f), bool)
    new[0] = True
    totals, leaf_of, found = [], [], []
    for d in range(WORDS):
        new[1:] |= suffixes[1:, d] != suffixes[:-1, d]
        starts = np.flatnonzero(new)
        totals.append(np.add.reduceat(f, starts))
        leaf_of.append(np.cumsum(new) - 1)  # node of every leaf
        kept = (totals[-1] >= least) & (prefix[starts] <= d + 1)
        found.append(starts[kept & (suffixes[starts, d] > 0)] if d else starts[kept])

    at = np.concatenate(found)
    size = np.repeat(np.arange(1, WORDS + 1), [len(x) for x in found])
    count = [totals[d][leaf_of[d][at]] for d in range(WORDS)]
    heads, words = list(firsts), list(others)
    named = pa.array(words, pa.binary()).cast(pa.string())
    one = pa.array([w for _, w in heads], pa.binary()).cast(pa.string())
    later = [named.take(pa.array(suffixes[at, d], mask=size <= d)) for d in (1, 2)]
    return pa.table(
        {
            "lang": pa.array([x for x, _ in heads], pa.string()).take(pa.array(suffixes[at, 0])),
            "size": pa.array(size, pa.int32()),
            "one": one.take(pa.array(suffixes[at, 0])),
            "two": later[0],
            "three": later[1],
            "f": pa.array(np.choose(size - 1, count), pa.int64()),
            "f1": pa.array(count[0], pa.int64(), mask=(prefix[at] > 1)),
            "f2": pa.array(count[1], pa.int64(), mask=(prefix[at] > 2)),
        }
    )


def _numbers(df: DataFrame) -> np.ndarray:
    """The hashes ``h`` of a frame of bounded length, sorted."""
    return np.sort(np.array([r.h for r in df.select("h").distinct().collect()], np.int64).view(np.uint64))


def _slot(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - SLOTS.bit_length() + 1)


def _per_slot(df: DataFrame) -> np.ndarray:
    totals = np.zeros(SLOTS, np.int64)
    sums = df.groupBy(_slot(F.col("h")).alias("slot")).agg(F.sum("f").alias("f")).toArrow()  # at most SLOTS rows
    totals[sums["slot"].to_numpy()] = sums["f"].to_numpy()
    return totals


def frequent_map(words: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of ``words``."""
    # bits are numbered from 1 on; a power of two divides the step from signed to unsigned hashes
    place = F.pmod(F.col("h"), F.lit(MAP_BITS)) + 1
    rows = words.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for b, bits in rows.collect():  # MAP_BITS bits
        out[(b - 1) * 4096 : b * 4096] = np.frombuffer(bits, np.uint8)
    return out


def pack(totals: np.ndarray, budget: int) -> np.ndarray:
    """The group of every slot: slots in order, a new group whenever a budget is full."""
    before = np.cumsum(totals) - totals
    return np.unique(before // budget, return_inverse=True)[1].astype(np.int32)


def collocations(
    df: DataFrame,
    *,
    text_column: str = "text",
    group_column: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """The best phrases of two and three words of every language: lang, rank, phrase, a, l, r, n, score.

    a, l and r are the occurrences of the phrase, of its first and of its last part at the cut with the lowest score
    floor(1000000 * a * a / (l * r)), n the occurrences of all words of the language. A null language is ``und``, a null text empty. Phrases
    do not reach over ``[.,;:!?]`` and line breaks. A phrase is dropped if a longer candidate holds it and occurs half as
    often. Ties go to the more frequent phrase, then to the smaller in UTF-8 order. ``budget`` changes the groups, not the
    result. Repeated rows count again; an empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(
        F.coalesce(F.col(group_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    words = stored(word_counts(docs))
    total = words.agg(F.sum("f")).first()[0] or 0
    budget = max(budget, -(-total // GROUPS))
    frequent = words.where(F.col("f") >= least)

    # words above the budget, and whatever shares a hash with them: at most GROUPS and a few
    heavy_words = _numbers(words.where(F.col("f") > budget))
    suffixes = Suffixes(frequent_map(frequent), heavy_words, np.zeros(0, np.uint64))
    is_heavy = lambda counts, h: counts.join(F.broadcast(spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")), "h")
    totals = _per_slot(frequent.where(F.col("f") <= budget))
    extended, heavy = spark.createDataFrame([], "lang string, phrase string, f long"), spark.createDataFrame([], _NODES)
    if len(heavy_words):
        pairs = stored(heavy_pair_counts(docs, spark.sparkContext.broadcast(suffixes)))
        totals += _per_slot(pairs.where(F.col("f") <= budget))
        suffixes.heavy_pairs = _numbers(pairs.where(F.col("f") > budget))
        of_pairs = stored(is_heavy(pairs, suffixes.heavy_pairs))
        named = of_pairs.select("lang", F.concat_ws(" ", "one", "two").alias("phrase"), "f")
        extended = stored(is_heavy(words, heavy_words).select("lang", F.col("word").alias("phrase"), "f").union(named))
        # phrases themselves, but in no subtree
        heavy = of_pairs.where(F.col("f") >= least).selectExpr(
            "lang", "2 as size", "one", "two", "null as three", "f", "null as f1", "null as f2"
        )
    shared = spark.sparkContext.broadcast(suffixes), spark.sparkContext.broadcast(pack(totals, budget))

    def build(table: pa.Table) -> pa.Table:
        return subtree(table, least)

    nodes = stored(grouped_suffixes(docs, *shared).groupBy("group").applyInArrow(_hinted(build), _NODES))
    return ranked(nodes.unionByName(heavy.select(*[F.col(f.name).cast(f.dataType) for f in nodes.schema])), extended, words, top)


def _hinted(build: Callable) -> Callable:
    build.__annotations__ = {"table": pa.Table, "return": pa.Table}
    return build


def ranked(nodes: DataFrame, extended: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """Cuts, scores and ranks of the phrases among the nodes; ``extended`` has the counts of extended prefixes."""
    phrase = F.concat_ws(" ", "one", "two", "three")
    # first parts: ancestors in the subtree, or extended prefixes
    known = F.broadcast(extended)
    first = nodes.where("size > 1").withColumn("phrase", phrase)
    for name, part in (("f1", F.col("one")), ("f2", F.concat_ws(" ", "one", "two"))):
        counts = known.select("lang", F.col("phrase").alias("_part"), F.col("f").alias("_f"))
        first = first.withColumn("_part", part).join(counts, ["lang", "_part"], "left")
        first = first.withColumn(name, F.coalesce(name, "_f")).drop("_part", "_f")

    def cut(k: int, l: str, rest: Column) -> Column:  # noqa: E741
        return F.struct(F.lit(k).alias("k"), F.col(l).alias("l"), rest.alias("rest"))

    two, three = F.array(cut(1, "f1", F.col("two"))), F.array(cut(1, "f1", F.concat_ws(" ", "two", "three")), cut(2, "f2", F.col("three")))
    cuts = first.select(
        "lang", "size", "phrase", F.col("f").alias("a"), F.inline(F.when(F.col("size") == 2, two).otherwise(three))
    )
    # last parts: extended prefixes from the broadcast, others by a join in which none of them is hot
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"], "left")
    counts = nodes.where("size < 3").select("lang", phrase.alias("rest"), F.col("f").alias("r"))
    columns = ("lang", "size", "phrase", "a", "k", "l", "r")
    looked_up = cuts.where("r is null").drop("r").join(counts, ["lang", "rest"]).select(*columns)
    cuts = cuts.where("r is not null").select(*columns).unionByName(looked_up)

    a, l, r = (F.col(c).cast("decimal(20,0)") for c in "alr")  # noqa: E741
    cuts = cuts.withColumn("_a", a * a * F.lit(SCALE).cast("decimal(7,0)")).withColumn("_b", l * r)
    best = cuts.withColumn("score", F.expr("_a div _b")).groupBy("lang", "size", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    # only a phrase of three words can hold another one
    parts = F.array(F.concat_ws(" ", "one", "two"), F.concat_ws(" ", "two", "three"))
    inside = nodes.where("size = 3").select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = best.join(inside, ["lang", "phrase"], "left").where(f"size = 3 or longer is null or 100 * longer < {INSIDE} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    leading = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return leading.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
