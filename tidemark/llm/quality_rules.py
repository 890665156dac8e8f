"""Quality rules with a cross-document line frequency.

Lines are normalised (lower case, digits to 0, single blanks) and hashed. For each host and line the distinct
documents are counted; a line found in more of them than both limits allow is boilerplate and removed. A document
that is left with too few words is depleted and rejected.

*Distinct* documents: the distinct whole normalised texts. Copies and near copies of one text must not make its own
lines look like boilerplate, so near copies count once too. Documents are near copies if

* their whole texts are linked by the comparison of full sets in ``near_dedup``, and
* so are their own texts: what is left without the lines that too many distinct texts of the host have, and without
  edited versions of such lines. Two texts without anything of their own are near copies.

Documents that share a long license and little else are linked as wholes, but each has a text of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BLANKS, map_rows
from tidemark.llm.hashing import hash64, window_hashes, word_hashes
from tidemark.llm.near_dedup import near_duplicates, rows_with
from tidemark.sources.storage import release, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A line is boilerplate if more distinct documents of its host have it than both of these.
MAX_DOCUMENTS = 20
MAX_SHARE = 0.01
#: A document is depleted if fewer words, or a smaller share of its words, are left.
MIN_WORDS_LEFT = 10
MIN_SHARE_LEFT = 0.3
#: A line is an edited version of others if this share of its two-word windows is found in them.
MIN_SHARE_EDITED = 0.5
#: Stands for a missing host.
NO_HOST = "\x00null"

_NORMAL = bytes.maketrans(bytes(range(65, 91)) + b"123456789", bytes(range(97, 123)) + b"0" * 9)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words which the text holds at least twice."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows) + 1, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def normal_lines(data: bytes) -> list[list[bytes]]:
    """The words of each normalised line that has any."""
    return [parts for parts in (line.split() for line in data.translate(_NORMAL).split(b"\n")) if parts]


def line_key(parts: list[bytes]) -> int:
    return hash64(b" ".join(parts))


def raw_key(text: Column) -> Column:
    """A hash (128 bits) of the text as it is, to find the rows that are to be read again."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def text_facts(text: str) -> tuple:
    """(hash (128 bits) of the whole normalised text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, line words)."""
    data = text.encode()
    words = data.split()
    hashes = word_hashes(words)
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    word_chars = len(text) - (len(data) - len(data.translate(None, BLANKS)))
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    counts: dict[int, int] = {}
    whole = []
    for parts in normal_lines(data):
        line = b" ".join(parts)
        whole.append(line)
        key = hash64(line)
        counts[key] = counts.get(key, 0) + len(parts)
    return (
        hashlib.md5(b" ".join(whole)).digest(),
        len(words),
        word_chars,
        n_symbols,
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        list(counts),
        list(counts.values()),
    )


def document_facts(df: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """Facts of every text and its distinct lines, with a number for the row."""
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType(
        [
            T.StructField("_row", T.LongType()),
            T.StructField(id_column, df.schema[id_column].dataType),
            T.StructField("_host", T.StringType()),
            T.StructField("_raw", T.BinaryType()),
            T.StructField("_doc", T.BinaryType()),
            *(T.StructField(c, T.LongType()) for c in longs),
            T.StructField("line_hash", T.ArrayType(T.LongType())),
            T.StructField("line_words", T.ArrayType(T.IntegerType())),
        ]
    )

    def start():
        def call(row, key, host, raw, text):
            yield row, key, NO_HOST if host is None else host, raw, *text_facts(text or "")

        return call

    text = F.col(text_column)
    rows = df.select(F.monotonically_increasing_id(), id_column, F.col(host_column).cast("string"), raw_key(text), text)
    return map_rows(rows, schema, start)


def own_texts(holders: DataFrame, texts: DataFrame, read: DataFrame) -> DataFrame:
    """(_host, _doc, component, text), stored: the lines of each document that are neither among those it has in ``holders``
    (_host, _doc, line_hash, component) nor edited versions of any that its component has there.

    ``read`` says which of ``texts`` (_raw, text) is read for a _doc.
    Documents without such lines have no row.
    """
    schema = T.StructType(
        [
            T.StructField("_host", T.StringType()),
            T.StructField("_doc", T.BinaryType()),
            T.StructField("component", T.BinaryType()),
            T.StructField("place", T.LongType()),
            T.StructField("held", T.BooleanType()),
            T.StructField("line", T.StringType()),
            T.StructField("windows", T.ArrayType(T.LongType())),
        ]
    )

    def start():
        def call(host, doc, component, held, text):
            held = set(held.tolist())
            for place, parts in enumerate(normal_lines(text.encode())):
                windows = np.unique(window_hashes(word_hashes(parts), min(2, len(parts)))).view(np.int64)
                yield host, doc, component, place, line_key(parts) in held, b" ".join(parts).decode(), windows.tolist()

        return call

    of_doc = holders.groupBy("_host", "_doc", "component").agg(F.collect_set("line_hash").alias("held"))
    of_doc = of_doc.join(read, "_doc")
    texts = rows_with(texts, "_raw", of_doc.select(F.col("_raw").alias("id"))).dropDuplicates(["_raw"])
    lines = stored(map_rows(of_doc.join(texts, "_raw").select("_host", "_doc", "component", "held", "text"), schema, start))
    window, line = F.explode("windows").alias("window"), ("_host", "_doc", "place")
    known = lines.where("held").select("_host", "component", window).distinct()
    found = lines.where("not held").select(*line, "component", window).join(known, ["_host", "component", "window"])
    found = found.groupBy(*line).agg(F.count("*").alias("found"))
    edited = F.coalesce("found", F.lit(0)) >= F.size("windows") * F.lit(MIN_SHARE_EDITED)
    own = lines.where("not held").join(found, [*line], "left").where(~edited)
    parts = F.array_sort(F.collect_list(F.struct("place", "line")))
    own = own.groupBy("_host", "_doc", "component").agg(F.concat_ws("\n", F.transform(parts, lambda p: p["line"])).alias("text"))
    own = stored(own)
    release(lines)
    return own


def document_classes(pairs: DataFrame, holders: DataFrame, texts: DataFrame, read: DataFrame) -> DataFrame:
    """``pairs`` (_host, _doc) with ``class``, the same for near copies.

    ``holders`` has the lines (_host, _doc, line_hash) that too many texts have, ``texts`` the text of every row
    as it is, with its _raw, and ``read`` one _raw for each _doc. Texts are read where they are, and normalised behind the filter for the wanted ones.
    """

    linked = near_duplicates(texts, id_column="_raw", text_column="text", ids=read.select("_raw"), table=_NORMAL)
    parts = stored(linked.select("_raw", F.col("component_id").alias("component")).join(read, "_raw").drop("_raw"))
    release(linked)
    groups = parts.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    shared = stored(holders.join(parts.join(groups, "component", "left_semi"), "_doc"))
    key = F.unhex(F.md5(F.concat(F.col("_host").cast("binary"), F.col("_doc"))))
    own = own_texts(shared, texts, read)
    named = own.withColumn("_key", key)
    linked = near_duplicates(named, id_column="_key", text_column="text")
    found = named.select("_host", "_doc", "_key").join(linked.select("_key", F.col("component_id").alias("own")), "_key").drop("_key")
    placed = pairs.join(parts, "_doc").join(found, ["_host", "_doc"], "left")
    classes = stored(placed.select("_host", "_doc", F.struct("component", "own").alias("class")))
    release(shared, own, parts, linked)
    return classes


def boilerplate_lines(
    facts: DataFrame, df: DataFrame, text_column: str, max_documents: int, max_share: float
) -> DataFrame:
    """(host, line hash) of the lines above both limits.

    Near copies make counts smaller only, so they are looked for among the documents that a line above the first limit has.
    The share is one of the host's distinct documents. A copy group of any size adds one to a
    count, and repeated rows of a key meet in partial aggregates first, so no line or host is a hot key of the exchange.
    """
    lines = facts.select("_host", "_doc", F.explode("line_hash").alias("line_hash")).distinct()
    many = lines.groupBy("_host", "line_hash").agg(F.count("*").alias("_docs")).where(F.col("_docs") > max_documents)
    many = stored(many.select("_host", "line_hash"))
    if many.isEmpty():
        return many
    held = stored(lines.join(many, ["_host", "line_hash"], "left_semi"))
    hosts = facts.join(many.select("_host").distinct(), "_host", "left_semi").select("_host", "_doc").distinct()
    hosts = hosts.groupBy("_host").agg(F.count("*").alias("_all"))
    # lines that the share alone lets stay need no comparison
    totals = stored(held.groupBy("_host", "line_hash").agg(F.count("*").alias("_docs")).join(hosts, "_host"))
    above = totals.where(F.col("_docs") > F.col("_all") * max_share).select("_host", "line_hash", "_all")
    holders = held.join(above, ["_host", "line_hash"])
    wanted = stored(holders.select("_host", "_doc").distinct())
    # one text stands for all that are equal once normalised
    read = facts.join(wanted.select("_doc").distinct(), "_doc", "left_semi").groupBy("_doc").agg(F.min("_raw").alias("_raw"))
    texts = df.select(raw_key(F.col(text_column)).alias("_raw"), F.coalesce(text_column, F.lit("")).alias("text"))
    read = stored(read)
    classes = document_classes(wanted, holders.drop("_all"), texts, read)
    per_line = holders.join(classes, ["_host", "_doc"]).select("_host", "line_hash", "_all", "class").distinct()
    per_line = per_line.groupBy("_host", "line_hash", "_all").agg(F.count("*").alias("_docs"))
    found = per_line.where((F.col("_docs") > max_documents) & (F.col("_docs") > F.col("_all") * max_share))
    found = stored(found.select("_host", "line_hash"))
    release(many, held, totals, wanted, read, classes)
    return found


def quality_rules(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_words_left: int = MIN_WORDS_LEFT,
    min_share_left: float = MIN_SHARE_LEFT,
) -> DataFrame:
    """Facts and verdict of every row.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and
    ``n_words_left`` after removal of boilerplate lines. A null or empty text has no words and fails. A null host is a
    host of its own. Repeated rows share their verdict; each keeps its row. Other columns are
    ignored. An empty table gives no rows.

    The facts (no text) are written once to the shared folder and read for the count and the verdict; so are the
    distinct texts among which near copies are looked for.
    """
    facts = stored(document_facts(df, id_column, text_column, host_column))
    lines = facts.select("_row", "_host", F.inline(F.arrays_zip("line_hash", "line_words")))
    removed = (
        lines.join(boilerplate_lines(facts, df, text_column, max_documents, max_share), ["_host", "line_hash"])
        .groupBy("_row")
        .agg(F.sum("line_words").alias("_removed"))
    )
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_words_left") < min_words_left) | (
        F.col("n_words_left") < F.col("n_words") * F.lit(float(min_share_left))
    )
    return (
        facts.drop("line_hash", "line_words", "_host", "_doc", "_raw")
        .join(removed, "_row", "left")
        .withColumn("n_words_left", left.cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .select(
            id_column, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "n_words_left",
        )
    )
