"""A Merkle manifest of a dataset, with a proof for every row, grown by appends.

1. Each row becomes a leaf at the scan, so texts never move; only ids and digests do. Leaves get their place in the tree
   of their group from a range sort and the row counts of its parts.
2. *Appending.* A ``Frontier`` takes the leaves of one aligned block (``arity ** levels`` places) in order. A node that joins an open
   run takes the nodes before it as its partial witness, and each of them is extended by the newcomer. A full run
   closes: its digest is appended one level higher, and the witnesses of its nodes pass to the leaves below them.
3. The root of a block is one append to the tree of block roots, which is cut into blocks again, until a group fits into one
   block. Subroots of the groups are appended in the same way to the tree that gives the root.
4. Going down again, a block is replayed beside the finished witness of its root, which extends that of each leaf. Only the
   proofs' digests leave the task, so nothing stored grows with rows times depth.

A task holds one block. A group of any size is many blocks, and blocks are dealt out by group and number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import ship_package, stored

ARITY = 8
#: Levels of a block: 4096 leaves.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, position long, count long, digest string"
_WITNESS = "array<struct<place: int, siblings: string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Frontier:
    """The open runs of one block, and the witness of every leaf appended so far, as far as it is known.

    A witness is a list of (place, siblings), one for each level, siblings joined from left to right.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[tuple[str, range, list[str]]]] = []
        self.witnesses: list[list[tuple[int, str]]] = []

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._join(0, digest, range(len(self.witnesses) - 1, len(self.witnesses)))

    def _join(self, level: int, digest: str, leaves: range) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        partial = [d for d, _, _ in run]
        for _, _, siblings in run:
            siblings.append(digest)
        run.append((digest, leaves, partial))
        if len(run) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for place, (_, leaves, siblings) in enumerate(run):
            step = (place, "".join(siblings))
            for leaf in leaves:
                self.witnesses[leaf].append(step)
        parent = sha("".join(d for d, _, _ in run))
        self._join(level + 1, parent, range(run[0][1].start, run[-1][1].stop))

    def finish(self, levels: int | None) -> str:
        """Closes what is open and gives the root: of exactly ``levels`` levels, or of as many as leave one node."""
        level = 0
        while True:
            run = self.open[level]
            last = level == len(self.open) - 1
            if last and len(run) == 1 and (levels is None or level == levels):
                return run[0][0]
            if run:
                self._close(level)
            level += 1


def replay(digests: Sequence[str], count: int, arity: int, levels: int) -> tuple[str, list[list[tuple[int, str]]]]:
    """Root and witnesses of one block; ``count`` is the size of the whole tree at its level."""
    frontier = Frontier(arity)
    for digest in digests:
        frontier.append(digest)
    root = frontier.finish(levels if count > arity**levels else None)
    return root, frontier.witnesses


def fold(digest: str, witness: Sequence[tuple[int, str]]) -> str:
    """The root that a leaf and its witness give."""
    for place, siblings in witness:
        digest = sha(siblings[: 64 * place] + digest + siblings[64 * place :])
    return digest


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with a column tree) with ``position`` in the tree by ``order`` and ``count`` of the tree.

    Rows that are equal in all of ``order`` are dealt out by an arbitrary number, so that they too spread over
    the parts of the sort; which of them comes first makes no difference to the digests.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "_tie"]
    parted = stored(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()))
    sizes = parted.groupBy("tree", "_part").agg(F.count("*").alias("n"))
    by_part = Window.partitionBy("tree").orderBy("_part")
    # one row for each part that a tree reaches into
    offsets = sizes.select(
        "tree",
        "_part",
        (F.sum("n").over(by_part) - F.col("n")).alias("_before"),
        F.sum("n").over(Window.partitionBy("tree")).alias("count"),
    )
    within = F.row_number().over(Window.partitionBy("tree", "_part").orderBy(*order, "_tie"))
    numbered = parted.withColumn("_within", within).join(offsets, ["tree", "_part"])
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_within") - 1).alias("position"), "count")


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("position")


def block_roots(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """The nodes of the next tree: one for each block."""
    size = arity**levels

    def root(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = _in_order(table)
        count = table["count"][0].as_py()
        digest, _ = replay(table["digest"].to_pylist(), count, arity, levels)
        return pa.table(
            {"tree": [key[0].as_py()], "position": [key[1].as_py()], "count": [-(-count // size)], "digest": [digest]},
            schema=pa.schema([("tree", pa.string()), ("position", pa.int64()), ("count", pa.int64()), ("digest", pa.string())]),
        )

    return blocks(nodes.select("tree", "position", "count", "digest"), size).groupBy("tree", "block").applyInArrow(root, _NODES)


def blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("position") / F.lit(size)).cast("long"))


def climb(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The nodes, their block roots, the block roots of these and so on; the last frame has one node for each tree."""
    out = [nodes]
    while True:
        out.append(stored(block_roots(out[-1], arity, levels)))
        (most,) = out[-1].agg(F.max("count")).first()
        if most is None or most <= 1:
            return out


def extend(nodes: DataFrame, known: DataFrame, arity: int, levels: int, finish) -> DataFrame:
    """Each node with its witness up to the root.

    ``known`` has the witness of every block root (tree, position, witness, subroot, root). ``finish`` is a pair: a function that
    turns a table of nodes, their witnesses and the row of ``known`` into a table, and the schema of that.
    """
    make, schema = finish
    size = arity**levels

    def call(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
        table, top = _in_order(table), above.to_pylist()[0]
        _, witnesses = replay(table["digest"].to_pylist(), table["count"][0].as_py(), arity, levels)
        rest = [(w["place"], w["siblings"]) for w in top["witness"]]
        return make(table, [w + rest for w in witnesses], top)

    right = known.withColumnRenamed("position", "block").groupBy("tree", "block")
    return blocks(nodes, size).groupBy("tree", "block").cogroup(right).applyInArrow(call, schema)


_KNOWN = f"tree string, position long, witness {_WITNESS}, subroot string, root string"
_WITNESS_ARROW = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))


def _as_known(table: pa.Table, witnesses: list, top: dict) -> pa.Table:
    n = table.num_rows
    steps = [[{"place": p, "siblings": s} for p, s in w] for w in witnesses]
    return pa.table(
        {
            "tree": table["tree"],
            "position": table["position"],
            "witness": pa.array(steps, _WITNESS_ARROW),
            "subroot": pa.array([top["subroot"]] * n, pa.string()),
            "root": pa.array([top["root"]] * n, pa.string()),
        }
    )


def descend(climbed: list[DataFrame], known: DataFrame, arity: int, levels: int, last) -> DataFrame:
    """From the witnesses of the subroots down to the nodes at the bottom, for which ``last`` finishes the rows."""
    for nodes in reversed(climbed[1:-1]):
        known = stored(extend(nodes, known, arity, levels, (_as_known, _KNOWN)))
    return extend(climbed[0], known, arity, levels, last)


def leaf_digest(values: dict[str, Column]) -> Column:
    """H of the values: ``-`` for null, otherwise the number of UTF-8 bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values.values()]
    return F.sha2(F.concat(*parts), 256)


def manifest(
    df: DataFrame,
    *,
    fields: Sequence[str] = FIELDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_column: str = "lang",
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Leaf, subroot, root and proof digest of every row, and a check of each proof against a tampered copy.

    ``fields``, in that order, make the leaf. Rows of one value of ``group_column`` (null is a group of its own and comes first)
    are a tree, ordered by ``id_column``; null ids come first and rows that share an id are ordered by their leaves. Where 3 divides the
    CRC-32 of the id as text, the tampered copy has A-Z of the text in lower case; a null id is never tampered with. Null and
    empty texts are different leaves. Rows that are the same in all fields have equal leaves and proofs of their own. An
    empty table gives no rows. Other columns are ignored.
    """
    ship_package(df.sparkSession)
    values = {f: F.col(f).cast("string") for f in fields}
    forged = values | {text_column: F.translate(values[text_column], _UPPER, _LOWER)}
    hit = F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 0
    leaves = df.select(
        F.col(id_column).alias("id"),
        F.when(F.col(group_column).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group_column).cast("string"))).alias("tree"),
        leaf_digest(values).alias("digest"),
        F.when(hit, leaf_digest(forged)).alias("forged"),
    )
    climbed = climb(stored(positions(leaves, ["id", "digest"])), arity, levels)

    # the subroots, in the order of their groups, are the leaves of the last tree
    groups = climbed[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("digest"))
    over = climb(stored(positions(groups, ["group"])), arity, levels)
    top = over[-1].select(
        "tree",
        "position",
        F.array().cast(_WITNESS).alias("witness"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )

    def as_groups(table: pa.Table, witnesses: list, above: dict) -> pa.Table:
        known = _as_known(table, witnesses, above)
        zero = pa.array([0] * table.num_rows, pa.int64())
        return pa.table([table["group"], zero, known["witness"], table["digest"], known["root"]], names=known.column_names)

    known = stored(descend(over, top, arity, levels, (as_groups, _KNOWN)))

    def as_rows(table: pa.Table, witnesses: list, above: dict) -> pa.Table:
        digests, copies = table["digest"].to_pylist(), table["forged"].to_pylist()
        folded = [fold(c or d, w) for d, c, w in zip(digests, copies, witnesses, strict=True)]
        n = table.num_rows
        return pa.table(
            {
                id_column: table["id"],
                "leaf": table["digest"],
                "subroot": pa.array([above["subroot"]] * n, pa.string()),
                "root": pa.array([above["root"]] * n, pa.string()),
                "proof_sha256": pa.array([sha("".join(s for _, s in w)) for w in witnesses], pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([f == above["root"] for f in folded], pa.bool_()),
            }
        )

    schema = (
        f"`{id_column}` {df.schema[id_column].dataType.simpleString()}, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean"
    )
    return descend(climbed, known, arity, levels, (as_rows, schema))
