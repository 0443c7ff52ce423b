"""Merkle manifests of a dataset: hash trees per language and one over their roots, kept in blocks whose
nodes lie in van Emde Boas order.

A tree is cut into aligned subtrees of `height` levels. Each is one stored row: a block of 32-byte digests in
an order that puts the upper half of the levels first and then every subtree below it, recursively, so that a
way from a leaf to the root touches few neighbouring stretches whatever the size of a cache line. The
roots of the blocks are the leaves of the next level of blocks, until one block is left per language;
the subroots of the languages form one more tree of the same kind.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.documents import tables
from temporal_tree.operators.numbering import number_in_place
from temporal_tree.sources.scratch import Scratch

_DIGEST = 32


@functools.cache
def _layout(levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per depth of a tree with `levels` levels: the depth of the root of its top tree, the nodes of that
    top tree, the nodes of one tree below it (Brodal, Fagerberg and Jacob, 2002)."""
    above, top, bottom = (np.zeros(levels, np.int64) for _ in range(3))

    def cut(first: int, n: int) -> None:
        if n < 2:
            return
        upper = n // 2
        middle = first + upper
        above[middle], top[middle], bottom[middle] = first, (1 << upper) - 1, (1 << (n - upper)) - 1
        cut(first, upper)
        cut(middle, n - upper)

    cut(0, levels)
    return above, top, bottom


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes `index` (from 0, left to right) of a depth in a complete tree in van Emde Boas
    order. Only the roots of top trees on the way down are looked at, no pointers."""
    above, top, bottom = _layout(levels)
    if depth == 0:
        return np.zeros(len(index), np.int64)
    a = int(above[depth])
    # bits below the top tree's root say which of its bottom trees is meant
    below = index & int(top[depth])
    return addresses(levels, a, index >> (depth - a)) + int(top[depth]) + below * int(bottom[depth])


def node_hash(*digests: bytes) -> bytes:
    """SHA-256 of digests as lowercase hexadecimal text, one after another."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def build(leaves: list[bytes], height: int) -> bytes:
    """The stored form of a subtree of `height` levels above its leaves, of which there are 1 to 2^height.
    Nodes over no leaf are zeros; a node without a right neighbour is hashed alone."""
    space = np.zeros(((2 << height) - 1, _DIGEST), np.uint8)
    row = leaves
    for depth in range(height, -1, -1):
        at = addresses(height + 1, depth, np.arange(len(row)))
        space[at] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, _DIGEST)
        row = [node_hash(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return space.tobytes()


def leaves_of(block: bytes, height: int, count: int) -> list[bytes]:
    at = addresses(height + 1, height, np.arange(count)) * _DIGEST
    return [block[i : i + _DIGEST] for i in at.tolist()]


def siblings(block: bytes, height: int, count: int) -> list[list[bytes]]:
    """Per leaf its way up to below the root: the other node of each run, b"" where it stands alone."""
    index, nodes, levels = np.arange(count), count, []
    for depth in range(height, 0, -1):
        other = index ^ 1
        at = np.where(other < nodes, addresses(height + 1, depth, np.minimum(other, nodes - 1)) * _DIGEST, -1)
        levels.append([block[i : i + _DIGEST] if i >= 0 else b"" for i in at.tolist()])
        index, nodes = index >> 1, (nodes + 1) >> 1
    return [list(way) for way in zip(*levels, strict=True)] if levels else [[] for _ in range(count)]


def fold(digest: bytes, path: list[bytes], index: int) -> bytes:
    """The root that a leaf at `index` and its siblings, level by level, lead to."""
    for other in path:
        pair = (digest,) if not other else (other, digest) if index & 1 else (digest, other)
        digest, index = node_hash(*pair), index >> 1
    return digest


@dataclass
class Tree:
    """Trees of the same kind: `levels` of stored blocks, leaves first, and `roots` (`tree`, `root`)."""

    levels: list[DataFrame]
    roots: DataFrame


_BLOCK = "tree long, block long, height int, count int, nodes binary, root binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], columns: str) -> pa.RecordBatch:
    """Rows as one batch of columns with these names and types."""
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, columns.split(","))])
    arrays = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a row is a whole block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _stored(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        leaves = [leaf["digest"] for leaf in row["leaves"]]
        # the one block of a small tree is only as high as the tree
        levels = height if row["total"] > 1 << height else (row["total"] - 1).bit_length()
        nodes = build(leaves, levels)
        yield _batch([(row["tree"], row["block"], levels, len(leaves), nodes, nodes[:_DIGEST])], _BLOCK)


def grow(leaves: DataFrame, height: int, scratch: Scratch) -> Tree:
    """Hash trees over `leaves` (`tree`, `index` from 0, `total` leaves of the tree, `digest`). A task holds
    2^height leaves; each further level has that many times fewer rows."""
    levels: list[DataFrame] = []
    rows = leaves
    while True:
        blocks = rows.groupBy("tree", F.shiftright("index", height).alias("block"), "total").agg(
            F.array_sort(F.collect_list(F.struct("index", "digest"))).alias("leaves")
        )
        stored = scratch.save(
            blocks.mapInArrow(functools.partial(_stored, height=height), _BLOCK), f"blocks-{len(levels)}"
        )
        levels.append(stored)
        # a tree is complete when it has one block
        rows = stored.select("tree", F.col("block").alias("index"), F.col("root").alias("digest"))
        counted = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
        open_ = scratch.save(counted.where("total > 1"), f"open-{len(levels)}")
        if open_.isEmpty():
            break
        rows = rows.join(open_, "tree")
    ends = [level.where("block = 0").select("tree", "root", F.lit(i).alias("level")) for i, level in enumerate(levels)]
    roots = functools.reduce(DataFrame.unionByName, ends).groupBy("tree").agg(F.max_by("root", "level").alias("root"))
    return Tree(levels, scratch.save(roots, "roots"))


_PATHS = "tree long, index long, digest binary, path array<binary>, turns array<byte>"


def _ways(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("tree", pa.int64()),
            ("index", pa.int64()),
            ("digest", pa.binary()),
            ("path", pa.list_(pa.binary())),
            ("turns", pa.list_(pa.int8())),
        ]
    )
    for row in _rows(batches):
        block, levels, count = row["nodes"], row["height"], row["count"]
        upper, turns = row["path"] or [], row["turns"] or []
        ways = zip(leaves_of(block, levels, count), siblings(block, levels, count), strict=True)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "tree": row["tree"],
                    "index": (row["block"] << height) + i,
                    "digest": leaf,
                    "path": way + upper,
                    "turns": [i >> k & 1 for k in range(levels)] + turns,
                }
                for i, (leaf, way) in enumerate(ways)
            ],
            schema,
        )


def _ways_on(tree: Tree, height: int, above: DataFrame | None, scratch: Scratch) -> DataFrame:
    """The lowest blocks of `tree`, each with the `path` and `turns` from its root on.

    Goes down from the highest blocks; each gives its leaves, the blocks below, the rest of their way. `above`
    (`tree`, `path`, `turns`) is how it goes on beyond the root.
    """
    way = ["path", "turns"]
    nowhere = [f"cast(null as {kind}) AS {name}" for name, kind in zip(way, ("array<binary>", "array<byte>"), strict=True)]
    upper = None
    for i in reversed(range(len(tree.levels))):
        blocks = tree.levels[i]
        # a tree that ends at this level has one block there, its root
        last = blocks if upper is None else blocks.join(upper.select("tree").distinct(), "tree", "left_anti")
        last = last.selectExpr("*", *nowhere) if above is None else last.join(above.select("tree", *way), "tree")
        found = last if upper is None else last.unionByName(blocks.join(upper, ["tree", "block"]))
        if i == 0:
            return found
        upper = scratch.save(
            found.mapInArrow(functools.partial(_ways, height=height), _PATHS).select(
                "tree", F.col("index").alias("block"), *way
            ),
            f"ways-{i}",
        )
    raise ValueError("a tree without levels")


def proofs(tree: Tree, height: int, above: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Per leaf (`tree`, `index`, `digest`) its `path` of siblings up to the root, with an empty one where a
    node stands alone, and `turns`: 1 where it comes after its sibling."""
    return _ways_on(tree, height, above, scratch).mapInArrow(functools.partial(_ways, height=height), _PATHS)


def field(value: Column) -> Column:
    """A value as `-` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


_VERIFIED = "doc_id long, leaf string, tree long, proof_sha256 string, folded_root string"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block, levels, count = row["nodes"], row["height"], row["count"]
        upper = row["path"] or []
        above = sum(turn << k for k, turn in enumerate(row["turns"] or []))
        ways = zip(row["members"], leaves_of(block, levels, count), siblings(block, levels, count), strict=True)
        out = []
        for i, (member, leaf, way) in enumerate(ways):
            path, given = way + upper, member["given"]
            end = fold(leaf if given is None else given, path, i | above << levels)
            out.append((member["doc_id"], leaf.hex(), row["tree"], node_hash(*path).hex(), end.hex()))
        yield _batch(out, _VERIFIED)


@dataclass
class Manifest:
    """`leaves` (`doc_id`, `tree`, `index`, `digest`, `given`), the hash `trees` of the languages and the `top`
    tree over their subroots, as stored blocks."""

    leaves: DataFrame
    trees: Tree
    top: Tree
    height: int
    scratch: Scratch

    def verify(self) -> DataFrame:
        """Per row `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root` from the digest that was
        `given`, and `verified`."""
        ways = proofs(self.top, self.height, None, self.scratch)
        above = self.scratch.save(
            ways.select(F.col("index").alias("tree"), "path", "turns", F.lower(F.hex("digest")).alias("subroot")), "above"
        )
        members = self.leaves.groupBy("tree", F.shiftright("index", self.height).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("index", "doc_id", "given"))).alias("members")
        )
        blocks = _ways_on(self.trees, self.height, above, self.scratch).join(members, ["tree", "block"])
        root = self.top.roots.select(F.lower(F.hex("root")).alias("root"))
        return (
            blocks.mapInArrow(_folded, _VERIFIED)
            .join(above.select("tree", "subroot"), "tree")
            .crossJoin(F.broadcast(root))  # one row
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
            .withColumn("verified", F.col("folded_root") == F.col("root"))
        )


def manifest(rows: DataFrame, height: int = 10, scratch: Scratch | None = None) -> Manifest:
    """The hash trees of `rows`: `doc_id` (long), `lang`, `leaf` (hexadecimal) and `given`, a digest to verify
    instead of `leaf`, or null.

    Every row is a leaf, rows that repeat included. Leaves of a language ascend by `doc_id`, null first, then by
    `leaf`; languages ascend by their UTF-8 bytes, null first. A row that repeats in all columns takes a leaf
    of its own beside its twin. Rows are sorted over the whole table, so that a language may be of any
    size. An empty table has no root and verifies to an empty table.
    """
    scratch = scratch or tables(rows.sparkSession)
    # texts are hashed once; equal rows can be told apart, so that sorting can divide them
    narrow = scratch.save(rows.select("doc_id", "lang", "leaf", "given"), "leaves")
    narrow = narrow.withColumn("_copy", F.monotonically_increasing_id())
    order = ["lang", "doc_id", "leaf", "_copy"]
    placed = number_in_place(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy"), "place", scratch
    )
    langs = placed.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("total"))
    ranked = langs.repartitionByRange("lang").sortWithinPartitions("lang")
    langs = scratch.save(number_in_place(ranked, "tree", scratch).selectExpr("lang AS key", "tree - 1 AS tree", "first", "total"), "langs")
    leaves = placed.join(langs, placed["lang"].eqNullSafe(langs["key"]))
    leaves = scratch.save(
        leaves.select(
            "doc_id",
            "tree",
            (F.col("place") - F.col("first")).alias("index"),
            "total",
            F.unhex("leaf").alias("digest"),
            F.unhex("given").alias("given"),
        ),
        "placed",
    )
    trees = grow(leaves.drop("doc_id", "given"), height, scratch)
    tops = trees.roots.crossJoin(F.broadcast(langs.agg(F.count(F.lit(1)).alias("total"))))  # one row
    top = grow(
        tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), "total", F.col("root").alias("digest")),
        height,
        scratch,
    )
    return Manifest(leaves, trees, top, height, scratch)


def document_leaves(docs: DataFrame) -> DataFrame:
    """`doc_id`, `lang`, `leaf` and `given` of documents. Where 7 divides the CRC-32 of the decimal id, `given` is
    the digest of a row that was tampered with by adding 1 to `n_chars`; a null stays null there."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    own = {c: docs[c] for c in columns}
    changed = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = own | {"n_chars": docs["n_chars"].cast("decimal(20)") + 1}
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["lang"].alias("lang"),
        record_hash(list(own.values())).alias("leaf"),
        F.when(changed, record_hash(list(more.values()))).alias("given"),
    )
