"""Merkle dataset manifest in van Emde Boas layout: hash trees over ordered rows, stored in blocks, with proofs.

*Trees.*  Rows of one key (``tree``) are its leaves, in order.  While several nodes remain, every
``2`` consecutive ones (the last run may have one) become the SHA-256 of their joined hex digests.  The roots
of all trees, ordered by key, are the leaves of one more tree, built in the same way; its root stands for the table.

*Layout.*  A tree is cut into aligned subtrees of ``height`` levels of edges; the roots of one tier of
blocks are the leaves of the next, until one block is left.  A block is one row: its digests (32 bytes each) stand in van
Emde Boas order, that is the upper half of the levels first, then each subtree hanging
below it, both laid out in the same way again.  ``addresses`` computes where a node lies; construction writes
parents and proofs read siblings through it, and a walk from leaf to root touches few stretches of the row.

*Positions.*  Rows are sorted by range (so a key with a third of all rows spreads over many tasks), numbered within their
task and shifted by the counts of the tasks before; these counts are one row for each task and key.
A task then holds one block's rows; a proof joins a leaf's block with the proof of
that block's root, so proofs are composed downwards, tier by tier.

A *proof* lists, from leaf to root, what stands left and right of the node: a digest on
one side, or on none if the node was alone in its run.  ``fold`` recomputes the root from a leaf
digest and a proof.

Defined cases: a NULL key is a tree of its own and comes first; NULLs come first in the order inside a
tree; rows that tie are ordered by their digest, and equal rows are leaves each; very long texts only enter as digests; an
empty table gives no rows (and no root); other columns are kept, their names must not clash with ``tree``, ``pos``,
``block``, ``proof``, ``subroot``, ``root``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import store
from gridmix.operators.joins import checked_broadcast, freeze

HEIGHT = 12
DIGEST = 32
PROOF = "array<struct<left: string, right: string>>"


def field_digest(*columns: str | Column) -> Column:
    """The lowercase hex SHA-256 of the joined fields: ``-`` if NULL, else byte count, ``:``, value."""

    def field(c: str | Column) -> Column:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


@functools.lru_cache(maxsize=256)
def addresses(height: int, depth: int) -> np.ndarray:
    """Where the nodes of one depth of a complete tree (``height`` levels of edges) lie in its row, left to right."""
    return _address(height + 1, depth, np.arange(1 << depth))


def _address(levels: int, depth: int, at: np.ndarray) -> np.ndarray:
    if levels == 1:
        return np.zeros_like(at)
    top = levels // 2
    if depth < top:
        return _address(top, depth, at)
    below, tree = levels - top, at >> depth - top
    return (1 << top) - 1 + tree * ((1 << below) - 1) + _address(below, depth - top, at & (1 << depth - top) - 1)


def _levels(n: int, height: int, alone: bool) -> int:
    """How many levels of edges a block of ``n`` leaves has: all ``height``, or up to its one node if it is its tree's only block."""
    return min(height, (n - 1).bit_length()) if alone else height


def build_block(leaves: list[str], height: int, alone: bool) -> tuple[bytes, str]:
    """A block's row in van Emde Boas order (only the levels in use; missing nodes are zeros), and its root."""
    levels = _levels(len(leaves), height, alone)
    row, nodes = np.zeros(((2 << levels) - 1, DIGEST), np.uint8), leaves
    for depth in range(levels, -1, -1):
        row[addresses(levels, depth)[:len(nodes)]] = np.frombuffer(bytes.fromhex("".join(nodes)), np.uint8).reshape(-1, DIGEST)
        if depth:
            joined = [a + b for a, b in zip(nodes[::2], [*nodes[1::2], ""] if len(nodes) % 2 else nodes[1::2], strict=True)]
            nodes = [sha256(x.encode()).hexdigest() for x in joined]
    return row.tobytes(), nodes[0]


def block_siblings(row: bytes, n: int) -> list[tuple[list[str | None], list[str | None]]]:
    """For each level of a block from the leaves up: what stands left and right of the path of each of its ``n`` leaves."""
    nodes = np.frombuffer(row, np.uint8).reshape(-1, DIGEST)
    levels, out = (len(nodes) + 1).bit_length() - 2, []
    leaf = np.arange(n)
    for depth in range(levels, 0, -1):
        size = -(-n // (1 << levels - depth))  # nodes that exist at this depth
        raw = nodes[addresses(levels, depth)[:size]].tobytes().hex()
        node = (leaf >> levels - depth).tolist()
        sibling = [raw[64 * (i ^ 1):64 * (i ^ 1) + 64] or None for i in node]
        out.append(([s if i & 1 else None for s, i in zip(sibling, node, strict=True)],
                    [None if i & 1 else s for s, i in zip(sibling, node, strict=True)]))
    return out


@dataclass
class Manifest:
    """A forest's tables.  ``leaves``: the given rows with ``tree, pos``; ``tiers``: ``tree, block, n, row, root`` of each tier of blocks."""

    leaves: DataFrame
    tiers: list[DataFrame]
    height: int

    def roots(self) -> DataFrame:
        """``tree, n_leaves, root`` of each tree."""
        sizes = self.leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n_leaves"))
        return self.tiers[-1].select("tree", "root").join(sizes, "tree")


def positions(rows: DataFrame, tree: Column, order: list[str | Column], partitions: int | None = None) -> DataFrame:
    """``rows`` with ``tree`` (text, never NULL, in the keys' order) and ``pos``, the place in its tree from 0; stored."""
    key = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))
    partitions = partitions or max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = ["tree", *order]
    placed = store(
        store(rows.withColumn("tree", key)).repartitionByRange(partitions, *by).sortWithinPartitions(*by)
        .withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    )
    counts = placed.groupBy("tree", "_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = freeze(counts.select("tree", "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return placed.join(checked_broadcast(counts), ["tree", "_task"]).withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before")).drop("_task", "_row", "_first", "_before")


def _build(height: int, alone: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ordered = rows.sort_by("pos")
        row, root = build_block(ordered["digest"].to_pylist(), height, alone)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([rows.num_rows], pa.int32()),
                         "row": pa.array([row], pa.binary()), "root": pa.array([root], pa.string())})

    return run


def build(leaves: DataFrame, digest: str, height: int = HEIGHT) -> Manifest:
    """The blocks of all trees; ``leaves`` are rows of ``positions`` with their hex ``digest``."""
    tier, tiers = leaves.select("tree", "pos", F.col(digest).alias("digest")), []
    most = leaves.agg(F.max("pos")).first()[0]  # one number: the largest tree decides how many tiers there are
    while True:
        last = most is None or most >> height == 0
        small = F.lit(True) if last else F.col("blocks") == 1
        blocks = tier.withColumn("block", F.shiftright("pos", height))
        if not last:  # of smaller trees, the only block ends at its own root
            sizes = tier.groupBy("tree").agg((F.shiftright(F.max("pos"), height) + 1).alias("blocks"))
            blocks = blocks.join(sizes, "tree")
        kind = "tree string, block long, n int, row binary, root string"
        built = blocks.filter(small).groupBy("tree", "block").applyInArrow(_build(height, True), kind)
        if not last:
            built = built.unionByName(blocks.filter(~small).groupBy("tree", "block").applyInArrow(_build(height, False), kind))
        tiers.append(store(built))
        if last:
            return Manifest(leaves, tiers, height)
        tier = tiers[-1].select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"))
        most >>= height


def _steps(levels: list, at: int) -> list[dict]:
    return [{"left": left[at], "right": right[at]} for left, right in levels]


def _block_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``tree, block, n, row, above, height`` to the proofs of the block's leaves."""
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for batch in batches:
        for r in range(batch.num_rows):
            tree, block, n, row, above, height = (batch[c][r].as_py() for c in ("tree", "block", "n", "row", "above", "height"))
            levels = block_siblings(row, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * n, pa.string()), pa.array(range(block << height, (block << height) + n), pa.int64()),
                 pa.array([_steps(levels, k) + above for k in range(n)], kind)], names=["tree", "pos", "proof"])


def _leaf_proofs(rows: pa.Table, blocks: pa.Table) -> pa.Table:
    """A first-tier block's leaf rows with their proofs."""
    levels, above = block_siblings(blocks["row"][0].as_py(), blocks["n"][0].as_py()), blocks["above"][0].as_py()
    first = int(blocks["block"][0].as_py()) << int(blocks["height"][0].as_py())
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    proofs = [_steps(levels, p - first) + above for p in rows["pos"].to_pylist()]
    return rows.drop_columns(["block"]).append_column("proof", pa.array(proofs, kind))


def with_proofs(manifest: Manifest, above: DataFrame | None = None) -> DataFrame:
    """The manifest's leaf rows with ``proof``; ``above``: ``tree, above``, what each tree's root needs further up."""
    if above is None:
        above = manifest.tiers[-1].select("tree", F.array().cast(PROOF).alias("above"))
    upper = manifest.tiers[-1].join(above, "tree")
    height = F.lit(manifest.height).alias("height")
    for tier in reversed(manifest.tiers[:-1]):
        roots = upper.select("tree", "block", "n", "row", "above", height).mapInArrow(_block_proofs, f"tree string, pos long, proof {PROOF}")
        upper = tier.join(store(roots).select("tree", F.col("pos").alias("block"), F.col("proof").alias("above")), ["tree", "block"])
    leaves = manifest.leaves.withColumn("block", F.shiftright("pos", manifest.height))
    blocks = upper.select("tree", "block", "n", "row", "above", height)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.leaves.schema.fields] + [f"proof {PROOF}"])
    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(_leaf_proofs, schema)


@dataclass
class Proved:
    """``rows``: the leaf rows with ``tree, pos, proof`` (up to the table's root), ``subroot`` and ``root``; and both manifests."""

    rows: DataFrame
    forest: Manifest
    top: Manifest


def manifest(rows: DataFrame, tree: Column, order: list[str | Column], digest: str, height: int = HEIGHT) -> Proved:
    """Trees over ``rows`` by key, a tree over their roots, and every row's proof through both."""
    forest = build(positions(rows, tree, [*order, digest]), digest, height)
    roots = forest.roots().select(F.col("tree").alias("of"), F.col("root").alias("subroot"))
    top = build(positions(roots, F.lit(None), ["of"]), "subroot", height)
    root = top.tiers[-1].select("root").first()  # one digest
    subroots = store(with_proofs(top).select(F.col("of").alias("tree"), "subroot", F.lit(root and root[0]).cast("string").alias("root"), "proof"))
    rows = with_proofs(forest, subroots.select("tree", F.col("proof").alias("above")))
    return Proved(rows.join(checked_broadcast(subroots.drop("proof")), "tree"), forest, top)


def fold(digest: str | Column, proof: str | Column) -> Column:
    """The root that a leaf digest and a proof give."""
    digest = F.col(digest) if isinstance(digest, str) else digest
    none = F.lit("")
    return F.aggregate(proof, digest, lambda node, step: F.sha2(F.concat(F.coalesce(step["left"], none), node, F.coalesce(step["right"], none)), 256))


def siblings(proof: str | Column) -> Column:
    """The digests of a proof, from leaf to root."""
    return F.flatten(F.transform(proof, lambda step: F.array_compact(F.array(step["left"], step["right"]))))
