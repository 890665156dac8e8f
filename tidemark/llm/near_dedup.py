"""Near duplicates by MinHash, banding, signature verification and connected components.

1. One pass over the texts gives each document its set of word shingles, reduced to a key of the whole set, the minima
   of ``BANDS * ROWS`` universal hash functions as one key for each band, and one bit of each minimum.
   Documents with equal sets are one class, represented by the smallest id.
2. Representatives that share a band key are in one bucket. Two sets with a similarity of 0.75 miss each other in all 64
   bands of 6 rows with a chance of 4 in a million, more similar ones far more seldom.
3. Candidate pairs are compared by size, then by their signatures, then confirmed on the full sets.
4. Buckets are not expanded into pairs. First each document is compared with one centre (the smallest id it shares a
   bucket with), and links are joined to components. Buckets whose members all lie in one component are done. In the
   others, members are compared with a centre drawn at random for each bucket (``CENTRES`` times), and at last, where a
   bucket still holds several components, with the members of the *other* components. So every pair of a
   bucket is either compared or known to be connected, and a group of near copies costs a few comparisons a document.
5. Before that last step a document is held against large groups as wholes: the members of a component of about one size. What it shares with
   any of them it shares with the union of their sets, which bounds the similarity to all of them at once. Only where the
   bound reaches the limit are the members compared one by one. So a document just outside of a large group costs one look at the
   group's union, not one at each member, and no link is lost.
6. Components by alternating large-star and small-star steps, on links between component ids from the second round on.

Whatever is read again is written to the shared folder. Groups are handled by joins and partial
aggregates, which adaptive execution can split; no group meets in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows
from tidemark.llm.hashing import window_hashes, word_hashes
from tidemark.sources.storage import release, stored

SHINGLE = 5
PERCENT = 75
BANDS = 64
ROWS = 6
#: Standard deviations by which the agreement of signatures may fall short of what the similarity lets expect. Sets that
#: are exactly as similar as the limit fail by chance less often than they miss each other in all bands.
SLACK = 5
#: Members of a group in a bucket from which on it is met as a whole first.
LARGE = 8
#: Ratio of the sizes of the sets in one band of sizes.
SIZE_BAND = 1.04
#: Rounds of comparison with random centres.
CENTRES = 2
#: Size of the bitmap of wanted ids, in bits (4 MB). It only saves work: rows that it lets through by chance do no harm.
WANTED_BITS = 1 << 25

_MIX = np.uint32(0x9E3779B1)


def shingle_set(text: str | None, width: int = SHINGLE, table: bytes | None = None) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, A-Z in lower case; of all words if there are fewer.

    ``table`` (256 bytes) says which byte each one is read as.
    """
    data = (text or "").encode()
    words = (data.translate(table) if table else data).lower().split()  # bytes: lower() changes A-Z, split() cuts at ASCII blanks
    if len(words) >= width:
        return np.unique(window_hashes(word_hashes(words), width))
    if not words:
        return np.zeros(0, np.uint64)
    # fewer than ``width`` words: the number of words is part of the hash
    return window_hashes(word_hashes(words), len(words))


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of x -> a * x + b modulo 2 ** 32."""
    rng = np.random.default_rng(75)
    return rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(
        0, 1 << 32, count, dtype=np.uint32
    )


def minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = functions
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):  # memory does not follow the size of the set
        values = x[i : i + 1024, None] * a
        values += b
        np.minimum(low, values.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    """One number for each band, made of its place and its minima."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in low.reshape(bands, -1).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def signature(low: np.ndarray) -> np.ndarray:
    """One byte of each minimum, eight in a number."""
    some = ((low * _MIX) >> np.uint32(24)).astype(np.uint8)
    return np.pad(some, (0, -len(some) % 8)).view(np.uint64)


def describe(df: DataFrame, id_column: str, text_column: str, table: bytes | None, bands: int, rows: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", df.schema[id_column].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.ArrayType(T.LongType())),
        ]
    )

    def start():
        functions = hash_functions(bands * rows)

        def call(key, text):
            shingles = shingle_set(text, table=table)
            if len(shingles) and key is not None:
                low = minima(shingles, functions)
                lists = band_keys(low, bands).view(np.int64).tolist(), signature(low).view(np.int64).tolist()
                yield key, len(shingles), hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), *lists
            else:
                yield key, len(shingles), None, None, None

        return call

    return map_rows(df.select(id_column, text_column), schema, start)


def _bit_place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WANTED_BITS))


def rows_with(df: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is in ``ids``, and a few others.

    ``ids`` becomes a bitmap of fixed size, which is broadcast, so the texts are not shuffled.
    """
    place = _bit_place(F.col("id"))
    bitmap = (
        ids.groupBy(F.bitmap_bucket_number(place).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    )
    mine = _bit_place(F.col(id_column))
    bit = F.bitmap_bit_position(mine)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(mine)).join(F.broadcast(bitmap), "_bucket")
    return joined.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1).select(*df.columns)


def full_sets(df: DataFrame, id_column: str, text_column: str, table: bytes | None, ids: DataFrame, once: bool) -> DataFrame:
    """The sets of the rows with these ids; with ``once``, one for each id."""
    schema = T.StructType(
        [T.StructField("id", df.schema[id_column].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))]
    )

    def start():
        def call(key, text):
            yield key, shingle_set(text, table=table).view(np.int64).tolist()

        return call

    sets = map_rows(rows_with(df.select(id_column, text_column), id_column, ids), schema, start)
    return stored(sets.dropDuplicates(["id"]) if once else sets)


def least_equal(minima: int, percent: int) -> int:
    """Bytes of a signature that two sets of that similarity share, with ``SLACK`` standard deviations to spare."""
    p = percent / 100
    p += (1 - p) / 256
    return int(minima * p - SLACK * (minima * p * (1 - p)) ** 0.5)


def differing_bytes(x: Column, y: Column) -> Column:
    """In how many of their eight bytes two numbers differ: the lowest bit of a byte gathers its other bits."""
    z = x.bitwiseXOR(y)
    for places in (4, 2, 1):
        z = z.bitwiseOR(F.shiftrightunsigned(z, places))
    return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))


def may_be_linked(a: str, b: str, percent: int, minima: int) -> Column:
    """Whether sizes and signatures (columns of structs ``a`` and ``b``) leave a link possible."""
    small, large = F.least(f"{a}.n_shingles", f"{b}.n_shingles"), F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    differing = F.aggregate(
        F.zip_with(f"{a}.signature", f"{b}.signature", differing_bytes), F.lit(0), lambda s, x: s + x
    )
    return (100 * small >= percent * large) & (differing <= minima - least_equal(minima, percent))


def confirmed(
    pairs: DataFrame, classes: DataFrame, df: DataFrame, names: tuple, percent: int, minima: int, once: bool
) -> DataFrame:
    """Those of the pairs (a < b) that are links, checked by size and signature, then on the full sets."""
    facts = classes.select("id", F.struct("n_shingles", "signature").alias("f"))
    for side in "ab":
        pairs = pairs.join(facts.select(F.col("id").alias(side), F.col("f").alias(f"f{side}")), side)
    likely = stored(pairs.where(may_be_linked("fa", "fb", percent, minima)).select("a", "b"))
    ids = likely.select(F.col("a").alias("id")).distinct().union(likely.select(F.col("b").alias("id")).distinct())
    sets = full_sets(df, *names, ids, once)
    both = likely.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    links = stored(both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"))
    release(likely, sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), the component being the smallest id reachable.

    Large-star: each vertex links its larger neighbours to the smallest vertex it knows. Small-star: each vertex links
    its smaller neighbours and itself to the smallest. Ends when a round changes no link.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    # u > v everywhere
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before, now = None, state(edges)
    while now != before:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        release(last)
        before, now = now, state(edges)
    tops = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    found = stored(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops))
    release(edges)
    return found


def in_components(rows: DataFrame, parts: DataFrame, column: str = "id") -> DataFrame:
    """``rows`` with the component of ``column``, itself where it has no link."""
    found = parts.select(F.col("id").alias(column), "component")
    return rows.join(found, column, "left").withColumn("component", F.coalesce("component", column))


def joined_parts(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links: links between components are joined, then names are replaced."""
    between = in_components(links, parts, "a").withColumnRenamed("component", "ca")
    between = in_components(between, parts, "b").select(F.col("ca").alias("a"), F.col("component").alias("b"))
    higher = components(between)
    moved = parts.withColumnRenamed("component", "c").join(
        higher.select(F.col("id").alias("c"), F.col("component").alias("n")), "c", "left"
    )
    known = moved.select("id", F.coalesce("n", "c").alias("component"))
    new = higher.join(parts.select("id"), "id", "left_anti")  # ids without a link so far
    joined = stored(known.unionByName(new.select("id", "component")))
    release(higher, parts, links)
    return joined


def mixed_buckets(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The members (key, id) of buckets that hold more than one component, with it."""
    placed = in_components(members.select("key", "id"), parts)
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    return stored(placed.join(mixed.select("key"), "key"))


def _band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(SIZE_BAND))).cast("int")


def _band_least(band: Column) -> Column:
    """No set of the band is smaller."""
    return F.ceil(F.pow(F.lit(SIZE_BAND), band) - 1e-6)


def open_pairs(open_: DataFrame, placed: DataFrame, percent: int, minima: int) -> DataFrame:
    """Pairs (a, b) of the documents in ``open_`` (id, of, band) and the members of their groups, where signatures leave a link possible.

    ``placed`` has (key, id, component, n_shingles, signature, band), one row for each bucket of a document. Two documents that share
    many buckets meet in each of them, and become a pair in the first only.
    """
    keys = placed.groupBy("id").agg(F.collect_set("key").alias("keys"))
    facts = F.struct("id", "n_shingles", "signature", "keys")
    known = placed.join(keys, "id")
    mine = open_.join(known.select("id", "key", facts.alias("x")), "id").drop("id")
    others = known.select("key", F.col("component").alias("of"), "band", facts.alias("y"))
    first = F.array_min(F.array_intersect("x.keys", "y.keys"))
    pairs = mine.join(others, ["key", "of", "band"]).where(may_be_linked("x", "y", percent, minima) & (F.col("key") == first))
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def possible_pairs(members: DataFrame, sets_of, percent: int, minima: int) -> DataFrame:
    """Pairs (a, b) of members of different components in one bucket, without those that unions of sets or signatures rule out.

    ``members`` has (key, id, component, n_shingles, signature), ``sets_of`` gives the sets (id, shingles) of some ids. In each bucket the
    members of the component with fewer members there are held against the groups (component, band of sizes) of the others:
    against the union of a large group, against each member of a small one.
    """
    placed = stored(members.withColumn("band", _band(F.col("n_shingles"))))
    there = placed.groupBy("key", "component").agg(F.count("*").alias("there"))
    sizes = placed.groupBy("key", "component", "band").agg(F.count("*").alias("size"))

    few = sizes.where(F.col("size") < LARGE).join(there, ["key", "component"])
    one = placed.join(there, ["key", "component"]).select("key", F.struct("id", "component", "n_shingles", "signature", "there").alias("x"))
    two = placed.join(few, ["key", "component", "band"]).select("key", F.struct("id", "component", "n_shingles", "signature", "there").alias("y"))
    order = F.struct("x.there", "x.component") < F.struct("y.there", "y.component")
    direct = one.join(two, "key").where(order & (F.col("x.component") != F.col("y.component")) & may_be_linked("x", "y", percent, minima))
    direct = direct.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    groups = sizes.where(F.col("size") >= LARGE).select("key", F.col("component").alias("of"), "band")
    groups = groups.join(there.select("key", F.col("component").alias("of"), F.col("there").alias("of_there")), ["key", "of"])
    least, most = _band_least(F.col("g.band")), _band_least(F.col("g.band") + 1)
    fewer = F.struct("m.there", "m.component") < F.struct(F.col("g.of_there").alias("there"), F.col("g.of").alias("component"))
    own = placed.select("key", "id", "component", "n_shingles").join(there, ["key", "component"])
    near = own.alias("m").join(groups.alias("g"), "key").where(
        (F.col("m.component") != F.col("g.of")) & fewer & (100 * most >= percent * F.col("m.n_shingles")) & (100 * F.col("m.n_shingles") >= percent * least)
    )
    near = stored(near.select(F.col("m.id").alias("id"), F.col("g.of").alias("of"), F.col("g.band").alias("band"), F.col("m.n_shingles").alias("n")).distinct())

    # the members of large groups, and those that are held against them
    met = placed.join(sizes.where(F.col("size") >= LARGE), ["key", "component", "band"]).select("id", F.col("component").alias("of"), "band").distinct()
    sets = sets_of(met.select("id").union(near.select("id")).distinct())
    joint = met.join(sets, "id")
    joint = joint.select("of", "band", F.explode("shingles").alias("shingle")).distinct()
    held = near.join(sets, "id").select("id", "of", "band", "n", F.explode("shingles").alias("shingle"))
    shared = held.join(joint, ["of", "band", "shingle"]).groupBy("id", "of", "band", "n").agg(F.count("*").alias("h"))
    # at most h are shared with a set of the group, which has at least as many and at least the band's least
    open_ = shared.where(100 * F.col("h") >= percent * (F.col("n") + F.greatest("h", _band_least(F.col("band"))) - F.col("h")))
    pairs = stored(open_pairs(open_.select("id", "of", "band"), placed, percent, minima).union(direct).distinct())
    release(near, sets, placed)
    return pairs


def near_duplicates(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    ids: DataFrame | None = None,
    table: bytes | None = None,
) -> DataFrame:
    """n_shingles, component_id and kept for every row.

    Sets are linked if 100 * intersection >= ``percent`` * union; a component is what links connect, named after its
    smallest id; kept is true for that document. ``table`` says which byte each byte of a text is read as. With ``ids`` (one column, named like the id) only rows with one of
    these ids take part, and one row stands for all that share its id: their texts must have the same shingles. Null, empty and blank texts have no shingles and are
    linked with nothing. Rows that repeat an id share its component; if their texts differ, it is the smallest
    of any of them. Rows with a null id are linked with nothing, have no component and are kept. Other columns are ignored. An empty table gives no rows.
    """
    names, minima = (id_column, text_column, table), bands * rows
    if ids is None:
        every = stored(describe(df, *names, bands, rows))
    else:
        # the bitmap leaves most texts unread, the join is exact
        ids = ids.select(F.col(id_column).alias("id")).distinct()
        near = describe(rows_with(df.select(id_column, text_column), id_column, ids), *names, bands, rows)
        every = stored(near.join(ids, "id", "left_semi").dropDuplicates(["id"]))
    sets = every.where("set_key is not null")
    copies = sets.groupBy("set_key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stored(sets.select("id", "set_key").join(copies, "set_key").select("id", "first").distinct())
    classes = sets.join(copies, "set_key", "left").where("first is null or first = id").drop("first")

    members = classes.select("id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("c"), F.max("id").alias("last")).where("c < last")
    members = stored(members.join(buckets.select("key", "c"), "key"))

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, classes, df, names, percent, minima, ids is not None)

    links = confirm(members.where("id > c").groupBy(F.col("id").alias("b")).agg(F.min("c").alias("a")))
    parts = components(links)
    release(links)

    def only_mixed(held: DataFrame) -> DataFrame:
        left = mixed_buckets(held, parts)
        release(held)
        return left

    mixed = members
    for turn in range(CENTRES):
        mixed = only_mixed(mixed)
        by_chance = F.xxhash64("key", "id", F.lit(turn))
        centres = mixed.groupBy("key").agg(F.min_by(F.struct("id", "component"), by_chance).alias("c"))
        star = mixed.join(centres, "key").where("component != c.component")
        star = star.select(F.least("c.id", "id").alias("a"), F.greatest("c.id", "id").alias("b"))
        parts = joined_parts(parts, confirm(star.distinct()))

    held = only_mixed(mixed)
    mixed = held.join(classes.select("id", "n_shingles", "signature"), "id")
    pairs = possible_pairs(mixed, lambda wanted: full_sets(df, *names, wanted, ids is not None), percent, minima)
    parts = joined_parts(parts, confirm(pairs))
    release(held, pairs)

    # copies get the component of their representative
    copied = first.withColumnRenamed("id", "copy").withColumnRenamed("first", "id")
    placed = in_components(copied, parts).select(F.col("copy").alias("id"), "component")
    alone = parts.join(first.select("id"), "id", "left_anti").select("id", "component")
    final = placed.unionByName(alone).groupBy("id").agg(F.min("component").alias("component"))
    found = stored(
        in_components(every.select("id", "n_shingles"), final).select(
            F.col("id").alias(id_column),
            "n_shingles",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )
    release(every, first, parts)
    return found
