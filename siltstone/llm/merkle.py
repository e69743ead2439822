"""Merkle manifest of a dataset, its trees stored block by block in van Emde Boas order.

The leaves of a source ascend by doc_id; every ARITY consecutive nodes of a level become one
of the next. A block is an aligned subtree of HEIGHT levels above its 3**HEIGHT leaves, kept
as one array of digests: the upper half of its levels first, then the subtrees of the lower
half one after another, each laid out the same way. `address` finds a node's place by
arithmetic alone; it serves to write a block and to read the siblings of a path. The roots
of the blocks are the leaves of the next round, until a source has one root; the roots of
the sources are the leaves of one more tree. A source of any size is so shared out by blocks,
and a proof reads one block a round.

A digest is the SHA-256 of what is hashed, put together as text: fields as byte count, colon
and value, `-` for null; digests as lowercase hex.

Defined cases: a null in any column is the field `-`; a null source is a source of its own
and the first; rows without doc_id come first in their source and are never tampered with;
rows of one doc_id go by their leaf, so that equal rows are neighbours with equal leaves; an
empty text differs from none; a text of any length is hashed whole, in the JVM; columns other
than the five are not read, so their names cannot clash; an empty table has no root and gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import ready_python, table
from siltstone.operators.ordering import in_order
from siltstone.sources.staging import stage

ARITY = 3
HEIGHT = 6
SIZE = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Level = tuple[str, str]  # hex digests of the siblings on the left and on the right


def nodes_in(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index):
    """Place of a node (or an array of nodes) of a depth in a tree of so many levels."""
    place = 0 * index
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        subtree = index // ARITY**depth
        index = index - subtree * ARITY**depth
        place = place + nodes_in(top) + subtree * nodes_in(levels - top)
        levels -= top
    return place


def height_of(leaves: int) -> int:
    """Levels above so many leaves until one node remains."""
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("ascii")).digest()


def build(leaves: list[bytes], height: int) -> bytes:
    """The block over some leaves: digests in van Emde Boas order, zeros where no node is."""
    cells = np.zeros((nodes_in(height + 1), SIZE), dtype=np.uint8)
    row = leaves
    for depth in range(height, -1, -1):
        cells[address(height + 1, depth, np.arange(len(row)))] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, SIZE)
        if depth:
            row = [digest(b"".join(row[i : i + ARITY]).hex()) for i in range(0, len(row), ARITY)]
    return cells.tobytes()


def paths(cells: bytes, height: int, leaves: int) -> list[list[Level]]:
    """For every leaf of a block its siblings by level, from the leaf up to the block's root."""
    stored = np.frombuffer(cells, np.uint8).reshape(-1, SIZE)
    counts = [leaves]
    for _ in range(height):
        counts.append(-(-counts[-1] // ARITY))
    above: list[list[Level]] = [[]]
    for depth in range(1, height + 1):
        n = counts[height - depth]
        row = [d.tobytes().hex() for d in stored[address(height + 1, depth, np.arange(n))]]
        found = []
        for i in range(n):
            first = i - i % ARITY
            sides = "".join(row[first:i]), "".join(row[i + 1 : first + ARITY])
            found.append([sides, *above[i // ARITY]])
        above = found
    return above


def fold(leaf: bytes, path: list[Level]) -> bytes:
    for left, right in path:
        leaf = digest(left + leaf.hex() + right)
    return leaf


def _written(path: list[Level]) -> str:
    return ";".join(f"{left}|{right}" for left, right in path)


def _read(path: str) -> list[Level]:
    return [tuple(level.split("|")) for level in path.split(";")] if path else []


def field(value: Column) -> Column:
    """Byte count, colon and value of a field as text; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


class Tree(NamedTuple):
    """Blocks of a forest, a frame a round.

    _key names the tree, _block the place among the round's blocks, _n the leaves that the tree
    has in the round, _count those of the block, _height its levels, _cells its nodes and _root
    its root.
    """

    rounds: list[DataFrame]
    leaves: int  # of a full block

    def roots(self) -> DataFrame:
        """_key and _root of every tree."""
        tops = [blocks.where(F.col("_n") <= self.leaves).select("_key", "_root") for blocks in self.rounds]
        out = tops[0]
        for more in tops[1:]:
            out = out.union(more)
        return out


_BLOCK = "_key string, _block long, _n long, _count long, _height long, _cells binary, _root binary"


def _block_of(position: str, leaves: int) -> Column:
    return F.expr(f"{position} DIV {leaves}").alias("_block")


def grow(row: DataFrame, most: int, height: int = HEIGHT) -> Tree:
    """The trees over leaves: _key, _pos (0-based place in the tree), _digest and _n (the tree's leaves).

    most is the size of the largest tree, and gives the number of rounds; height is that of a block.
    """
    full = ARITY**height

    def build_block(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_pos")
        n = rows["_n"][0].as_py()
        own = height if n > full else height_of(n)
        cells = build(rows["_digest"].to_pylist(), own)
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        values = [key[0].as_py(), key[1].as_py(), n, rows.num_rows, own, cells, cells[:SIZE]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    rounds = []
    while True:
        blocks = row.select("_key", _block_of("_pos", full), "_pos", "_digest", "_n").groupBy("_key", "_block")
        blocks = stage(blocks.applyInArrow(build_block, _BLOCK), "blocks").df
        rounds.append(blocks)
        if most <= full:
            return Tree(rounds, full)
        most = -(-most // full)
        row = blocks.where(F.col("_n") > full).select(
            "_key",
            F.col("_block").alias("_pos"),
            F.col("_root").alias("_digest"),
            F.expr(f"(_n + {full - 1}) DIV {full}").alias("_n"),
        )


def _child_paths(blocks: DataFrame, full: int) -> DataFrame:
    """_key, _pos, _above and _top of every leaf of some blocks that have the path above them."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                above = _read(row["_above"])
                found = paths(row["_cells"], row["_height"], row["_count"])
                n, first = len(found), row["_block"] * full
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["_key"]] * n, pa.string()),
                        pa.array(range(first, first + n), pa.int64()),
                        pa.array([_written(p + above) for p in found], pa.string()),
                        pa.array([row["_top"]] * n, pa.binary()),
                    ],
                    names=["_key", "_pos", "_above", "_top"],
                )

    return blocks.mapInArrow(walk, "_key string, _pos long, _above string, _top binary")


def with_paths(tree: Tree, above: DataFrame) -> DataFrame:
    """The blocks of the first round with _above, the path of their root, and _top, their tree's root.

    above: _key and _above, the path that goes on above each tree's root. Blocks are read
    from the last round down; each gives the paths of the blocks below it.
    """
    upper = None
    for blocks in reversed(tree.rounds):
        found = blocks.where(F.col("_n") <= tree.leaves).join(above, "_key").withColumn("_top", F.col("_root"))
        if upper is not None:
            inner = _child_paths(upper, tree.leaves).withColumnRenamed("_pos", "_block")
            found = found.unionByName(blocks.where(F.col("_n") > tree.leaves).join(inner, ["_key", "_block"]))
        upper = found
    return upper


class Manifest(NamedTuple):
    """leaves: doc_id, _key (the source), _pos, _n, _digest, _claim; the trees; the root as hex, None without rows."""

    leaves: DataFrame
    sources: Tree
    places: DataFrame
    top: Tree
    root: str | None


def source_key() -> Column:
    """The source as a text that null comes first of."""
    return F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))


def manifest(docs: DataFrame, claim: Column | None = None, height: int = HEIGHT) -> Manifest | None:
    """The manifest of documents; None of an empty table.

    claim replaces the text in the leaf that a later check is given (_claim); without it, the
    leaf itself is claimed. Texts are read once; only narrow rows are sorted.
    """
    rows = docs.select(*(F.col(c) for c in FIELDS))
    own = leaf_digest([F.col(c) for c in FIELDS])
    rows = rows.select(
        "doc_id",
        source_key().alias("_key"),
        own.alias("_digest"),
        (leaf_digest([*(F.col(c) for c in FIELDS[:-1]), claim]) if claim is not None else own).alias("_claim"),
    )
    rows = stage(rows, "leaves")
    if not rows.rows:
        return None
    order = [F.col("_key"), F.col("doc_id").asc_nulls_first(), F.col("_digest")]
    ranked = in_order(rows.df, order, "ranked").drop("total")
    trees = ranked.groupBy("_key").agg(F.min("rank").alias("_first"), F.count("*").alias("_n"))
    trees = stage(trees, "trees").df
    placed = ranked.join(trees, "_key").withColumn("_pos", F.col("rank") - F.col("_first")).drop("rank", "_first")
    leaves = stage(placed, "placed").df
    most, n = trees.agg(F.max("_n"), F.count("*")).first()
    sources = grow(leaves, most, height)
    tops = in_order(sources.roots(), [F.col("_key")], "roots")
    places = tops.select(F.col("_key").alias("_source"), F.col("rank").alias("_pos"))
    row = tops.select(F.lit("").alias("_key"), F.col("rank").alias("_pos"), F.col("_root").alias("_digest"), F.col("total").alias("_n"))
    top = grow(row, n, height)
    return Manifest(leaves, sources, places, top, bytes(top.roots().first()["_root"]).hex())


_CHECKED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _check_block(leaves: pa.Table, block: pa.Table) -> pa.Table:
    leaves = leaves.sort_by("_pos")
    row = block.to_pylist()[0]
    above = _read(row["_above"])
    out = []
    found = paths(row["_cells"], row["_height"], row["_count"])
    columns = (leaves[c].to_pylist() for c in ("doc_id", "_digest", "_claim"))
    for doc_id, own, claim, path in zip(*columns, found, strict=True):
        path = path + above
        proof = digest("".join(left + right for left, right in path))
        out.append((doc_id, own.hex(), row["_top"].hex(), proof.hex(), fold(claim, path).hex()))
    names = [c.split()[0] for c in _CHECKED.split(", ")]
    types = [pa.int64()] + [pa.string()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def check(made: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf.

    folded_root is made of the claimed leaf and the stored siblings.
    """
    start = made.top.rounds[0].sparkSession.createDataFrame([("", "")], "_key string, _above string")
    upper = _child_paths(with_paths(made.top, start), made.top.leaves)
    above = upper.join(made.places, "_pos").select(F.col("_source").alias("_key"), "_above")
    blocks = stage(with_paths(made.sources, above), "paths").df
    leaves = made.leaves.select("*", _block_of("_pos", made.sources.leaves))
    key = ["_key", "_block"]
    rows = leaves.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(_check_block, _CHECKED)
    root = F.lit(made.root)
    return rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their proofs checked after new lines were taken out of half of the texts."""
    docs = table(spark, sf_dir, "documents")
    ready_python(spark)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.col("text")
    made = manifest(docs, F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))
    if made is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return check(made)
