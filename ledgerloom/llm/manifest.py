"""A Merkle manifest of a dataset: a tree of digests per group of rows and one over the groups, in blocks of van Emde Boas order.

The leaves of a tree are cut into aligned blocks of 2**LEVELS. A block is one row with the digests of its whole subtree, laid
out recursively: the upper half of its levels first, then each subtree of the lower half. The roots of a tree's blocks
are the leaves of the next tier, until one is left. Sibling paths are read from the blocks by the same arithmetic, from the
top down, so that a block's path is found once for all its leaves.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage

LEVELS = 10  # of hashing in a block, which so has 2**LEVELS leaves and 64 KB of digests
WIDTH = 32  # bytes of a digest
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCKS = "tree string, block long, size long, height int, n int, nodes binary, root binary"
PATH = ("siblings", "sides", "subroot")


def field(value: Column) -> Column:
    """A value as part of a leaf: ``-`` if null, else its length in UTF-8, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row, as hexadecimal text."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(*parts: bytes) -> bytes:
    """Of digests: the SHA-256 of their hexadecimal texts, one after the other."""
    return hashlib.sha256(hexlify(b"".join(parts))).digest()


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of one depth (0: the root) in a complete tree of that many levels.

    A tree is stored as the tree of the upper half of its levels, followed by the trees that hang on it.
    """
    place = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        levels -= top
        place = place + (1 << top) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


def height_of(size: int) -> int:
    """Levels of hashing above that many nodes."""
    return max(size - 1, 0).bit_length()


def subtree(leaves: Sequence[bytes], height: int) -> np.ndarray:
    """The nodes of a block in their places, a row each; nodes that there are not are zero."""
    nodes = np.zeros(((2 << height) - 1, WIDTH), np.uint8)
    row = list(leaves)
    for depth in range(height, -1, -1):
        nodes[address(height + 1, depth, np.arange(len(row)))] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, WIDTH)
        row = [digest(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return nodes


def siblings(nodes: np.ndarray, height: int, n: int, slots: np.ndarray) -> tuple[list[bytes], list[str]]:
    """For leaves of a block the siblings on the way up, and the side of each: ``L``, ``R``, or ``-`` for a node that has none."""
    own = [slots >> up for up in range(height)]
    there = np.array([(x ^ 1) < -(-n >> up) for up, x in enumerate(own)]).reshape(height, -1).T
    found = np.array([nodes[address(height + 1, height - up, x ^ 1)] for up, x in enumerate(own)]).reshape(height, -1, WIDTH).transpose(1, 0, 2)
    letters = np.where(there, np.where(np.array([x & 1 for x in own]).reshape(height, -1).T == 1, "L", "R"), "-")
    return [f[t].tobytes() for f, t in zip(found, there)], ["".join(row) for row in letters]


def numbered(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Adds ``pos`` from 0 in that order within each ``tree``, and ``size``, the rows of the tree.

    Rows are sorted by range, so that a tree that holds most of them is many tasks, and each run of a tree in a partition
    is shifted by the runs before it. ``rows`` must be stored, so that equal rows can be told apart by where they lie.
    """
    turn = F.col("tree"), *order, F.monotonically_increasing_id()
    sorted_ = rows.repartitionByRange(*turn).sortWithinPartitions(*turn[:-1])
    placed = stage(sorted_.withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_place", 33)), "placed")
    runs = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("own"), F.min("_place").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("own").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stage(runs.select("tree", "_part", (before - F.col("first")).alias("_shift"), F.sum("own").over(whole).alias("size")), "runs")
    return placed.join(runs, ["tree", "_part"]).select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("pos"), "size")


def block_rows(rows: DataFrame, levels: int) -> DataFrame:
    return rows.filter("size > 1").withColumn("block", F.shiftright("pos", levels))


def tier_of(rows: DataFrame, levels: int) -> DataFrame:
    """Blocks (the columns of BLOCKS) over the rows ``tree, pos, size, digest`` of trees of more than one node."""

    def build(own: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        height = min(levels, height_of(own["size"][0].as_py()))
        nodes = subtree(own["digest"].to_pylist(), height)
        row = own["tree"][0].as_py(), own["block"][0].as_py(), own["size"][0].as_py(), height, own.num_rows, nodes.tobytes(), nodes[0].tobytes()
        types = pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
        return pa.table({n.split()[0]: pa.array([v], t) for n, v, t in zip(BLOCKS.split(", "), row, types)})

    return block_rows(rows, levels).select("tree", "block", "pos", "size", "digest").groupBy("tree", "block").applyInArrow(build, BLOCKS)


def above(blocks: DataFrame, levels: int) -> DataFrame:
    """The roots of a tier's blocks as rows of the next one."""
    size = F.shiftright(F.col("size") + ((1 << levels) - 1), levels)
    return blocks.select("tree", F.col("block").alias("pos"), size.alias("size"), F.col("root").alias("digest"))


def with_paths(rows: DataFrame, blocks: DataFrame, tails: DataFrame, levels: int) -> DataFrame:
    """Rows of trees of more than one node with PATH: siblings inside their block, then those of the block.

    ``tails`` has ``tree, block`` and PATH of the blocks. A group is a block with its leaves.
    """
    kept, schema = list(rows.columns), rows.schema
    for name in PATH:
        schema = schema.add(name, "string" if name == "sides" else "binary")
    arrow = {"siblings": pa.binary(), "sides": pa.string(), "subroot": pa.binary()}

    def look_up(own: pa.Table, block: pa.Table) -> pa.Table:
        height, n = block["height"][0].as_py(), block["n"][0].as_py()
        nodes = np.frombuffer(block["nodes"][0].as_py(), np.uint8).reshape(-1, WIDTH)
        slots = own["pos"].to_numpy() & ((1 << levels) - 1)
        inner, sides = siblings(nodes, height, n, slots)
        rest = {name: block[name][0].as_py() for name in PATH}
        made = [[i + rest["siblings"] for i in inner], [s + rest["sides"] for s in sides], [rest["subroot"]] * own.num_rows]
        out = own.select(kept)
        for name, values in zip(PATH, made):
            out = out.append_column(name, pa.array(values, arrow[name]))
        return out

    key = ["tree", "block"]
    held = blocks.select("tree", "block", "height", "n", "nodes").join(tails, key)
    return block_rows(rows, levels).groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(look_up, schema)


@dataclass
class Trees:
    """``rows`` are the leaves (``tree, pos, size, digest`` and more), ``tiers`` the blocks above, ``roots`` one digest per tree."""

    rows: DataFrame
    tiers: list[DataFrame]
    roots: DataFrame
    levels: int

    def paths(self, ends: DataFrame) -> DataFrame:
        """The rows with PATH; ``ends`` has ``tree`` and PATH of each tree's root."""
        columns = self.rows.columns
        layers = [self.rows, *(above(t, self.levels) for t in self.tiers)]
        found: DataFrame | None = None
        for rows, blocks in reversed(list(zip(layers, [*self.tiers, None]))):
            # a tree that has come to one node goes on with the path of its root
            ended = rows.filter("size = 1").join(ends, "tree").select(*rows.columns, *PATH)
            if blocks is not None and found is not None:
                tails = found.select("tree", F.col("pos").alias("block"), *PATH)
                ended = with_paths(rows, blocks, tails, self.levels).unionByName(ended)
            found = ended if rows is self.rows else stage(ended, "paths")
        return found.select(*columns, *PATH)


def trees(rows: DataFrame, levels: int = LEVELS) -> Trees:
    """Trees over stored rows ``tree, pos, size, digest``: one job per tier of ``levels`` levels."""
    largest = rows.agg(F.max("size")).first()[0] or 0
    tiers, layer = [], rows
    for _ in range(-(-height_of(largest) // levels)):
        tiers.append(stage(tier_of(layer, levels), "tier"))
        layer = above(tiers[-1], levels)
    layers = [rows, *(above(t, levels) for t in tiers)]
    roots = reduce(DataFrame.unionByName, [layer.filter("size = 1").select("tree", "digest") for layer in layers])
    return Trees(rows, tiers, roots, levels)


@dataclass
class Manifest:
    """``documents`` are the trees of the groups, ``groups`` the tree of their roots; ``root`` is null for an empty table."""

    documents: Trees
    groups: Trees
    root: bytes | None


def build(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS, levels: int = LEVELS, **carried: Column) -> Manifest:
    """The manifest of a table: a leaf per row, in a tree per value of ``group`` (null: one of its own), ordered by id.

    Rows of a tree ascend by ``doc_id``, null ids last, equal ones by leaf: repeated rows each have a leaf. Of a run of two
    nodes the parent is the digest of both, of a last one alone that of one, until one node is left. ``carried`` are more
    columns for the leaves, from the columns of ``docs``. Null, empty and very long values are fields like others.
    """
    made = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n")).alias("tree"),
        F.col(doc_id).alias("id"),
        F.unhex(leaf([F.col(c) for c in columns])).alias("digest"),
        *(value.alias(name) for name, value in carried.items()),
    )
    made = stage(made, "leaves")
    leaves = stage(numbered(made, [F.col("id").isNull(), F.col("id"), F.col("digest")]), "numbered")
    documents = trees(leaves, levels)
    # "n" sorts before "s": the group of null comes first, the others follow by their bytes
    subroots = stage(documents.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "subroots")
    groups = trees(stage(numbered(subroots, [F.col("name")]), "groups"), levels)
    root = groups.roots.first()
    return Manifest(documents, groups, bytes(root["digest"]) if root else None)


def proofs(manifest: Manifest) -> DataFrame:
    """The leaves with ``siblings`` (digests of 32 bytes one after the other, from the leaf up to the root), ``sides`` and ``subroot``.

    ``sides`` has a letter per level: where the sibling stands, or ``-`` where a node has none.
    """
    empty = lambda rows: rows.select("tree", F.lit(b"").alias("siblings"), F.lit("").alias("sides"), F.lit(b"").alias("subroot"))
    upper = manifest.groups.paths(empty(manifest.groups.roots))
    ends = upper.select(F.col("name").alias("tree"), "siblings", "sides", F.col("digest").alias("subroot"))
    return manifest.documents.paths(stage(ends, "ends"))


def folded(digest: Column, siblings: Column, sides: Column) -> Column:
    """The root, as hexadecimal text, that a leaf's digest (hexadecimal) and its siblings lead to."""
    sibling = lambda at: F.lower(F.hex(F.substring(siblings, at * WIDTH + 1, F.lit(WIDTH))))

    def step(held: Column, side: Column) -> Column:
        other = sibling(held["at"])
        parts = F.when(side == "L", F.concat(other, held["own"])).when(side == "R", F.concat(held["own"], other)).otherwise(held["own"])
        return F.struct(F.sha2(parts, 256).alias("own"), (held["at"] + (side != "-").cast("int")).alias("at"))

    start = F.struct(digest.alias("own"), F.lit(0).alias("at"))
    return F.aggregate(F.filter(F.split(sides, ""), lambda s: s != ""), start, step, lambda held: held["own"])
