"""Merkle manifest of a dataset: a tree of fan 8 for each part, one above the parts' roots, in van Emde Boas layout.

A tree's nodes are kept in aligned subtrees of ``HEIGHT`` levels above their leaves, one row each (*block*).  The
roots of a level's blocks are the leaves of the next level's blocks, until one block is left.  Inside a block the
nodes lie in van Emde Boas order: a tree of n levels is cut at half its height, first comes the upper tree and behind
it the lower trees in order, each laid out the same way.  ``address`` is that recursion as arithmetic; construction
writes through it and siblings are fetched through it, so that a leaf's path stays within few stretches of memory
whatever the size of a cache line or page.

Leaves get their positions without a window over all rows: they are sorted by ranges into a written table, and counts
per part and range (a row each) give the offsets.  A block is built by one task from at most 8 ** HEIGHT rows, whatever
part they belong to, so a part that holds most rows is spread like any other.  Paths go down from the upper blocks:
each block hands its leaves the siblings above them, and the lowest blocks meet their documents.

Tables below the folder: ``documents/level=k`` and ``parts/level=k`` (part, block, n, height, nodes), the blocks of the
two kinds of trees; ``leaves`` (part, pos, n, doc_id, leaf, presented) and ``roots`` (part, root).

Defined results: columns are hashed whole at any length, null as ``-``; a null part comes before all others, within
a part null ids come first and equal ids follow their leaves' digests, so repeated rows are leaves of their own beside
each other (which of two equal rows is which makes no difference).  A part with one leaf has that leaf as its root.
Columns that aren't named are not read; an empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.llm.common import importable, map_arrow, small_batches, written

#: Children of a node, and levels of a block above its leaves.
FAN, HEIGHT = 8, 4
BLOCKS = "part string, block long, n long, height int, nodes binary"
PATHS = "part string, block long, subroot string, siblings string, shape binary"


def nodes_in(levels: int) -> int:
    """Nodes of a complete tree."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a depth (the root's is 0) lie in a complete tree of that many levels."""
    if levels == 1:
        return index
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    tree, inside = np.divmod(index, FAN ** (depth - top))
    return nodes_in(top) + tree * nodes_in(levels - top) + address(levels - top, depth - top, inside)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Subtree:
    """A block: the nodes of an aligned subtree with ``leaves`` leaves."""

    def __init__(self, nodes: np.ndarray, leaves: int, height: int):
        self.nodes, self.leaves, self.height = nodes, leaves, height

    @classmethod
    def build(cls, leaves: list[str], height: int) -> Subtree:
        tree, level = cls(np.zeros((nodes_in(height + 1), 32), np.uint8), len(leaves), height), leaves
        for depth in range(height, -1, -1):
            tree.nodes[address(height + 1, depth, np.arange(len(level)))] = np.frombuffer(
                bytes.fromhex("".join(level)), np.uint8).reshape(-1, 32)
            level = [digest(level[k:k + FAN]) for k in range(0, len(level), FAN)]
        return tree

    def level(self, depth: int) -> list[str]:
        count = -(-self.leaves // FAN ** (self.height - depth))
        text = self.nodes[address(self.height + 1, depth, np.arange(count))].tobytes().hex()
        return [text[k:k + 64] for k in range(0, len(text), 64)]

    def root(self) -> str:
        return self.level(0)[0]

    def paths(self, siblings: str = "", shape: bytes = b"") -> list[tuple[str, bytes]]:
        """For each leaf the siblings up to the root and beyond it, from the lowest level on, and of each level the
        place in its run and the run's length."""
        above = [(siblings, shape)]
        for depth in range(1, self.height + 1):
            names, below = self.level(depth), []
            for start in range(0, len(names), FAN):
                run, (up, places) = names[start:start + FAN], above[start // FAN]
                for k in range(len(run)):
                    below.append(("".join(run[:k] + run[k + 1:]) + up, bytes((k, len(run))) + places))
            above = below
        return above


def fold(leaf: str, siblings: str, shape: bytes) -> str:
    """The root that a leaf and its siblings give."""
    at = 0
    for place, run in zip(shape[::2], shape[1::2]):
        end = at + 64 * (run - 1)
        own = at + 64 * place
        leaf = digest([siblings[at:own], leaf, siblings[own:end]])
        at = end
    return leaf


# ---------------------------------------------------------------------------
# Positions
# ---------------------------------------------------------------------------
def ranked(rows: DataFrame, part: str, order: list[str], name: str) -> DataFrame:
    """``rows`` (a written table) with their position in the part (``pos``, by ``order``) and its size (``n``)."""
    by = [F.col(c).asc_nulls_first() for c in (part, *order)]
    ranges = written(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                     .withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), name)
    stretches = ranges.groupBy(part, "_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = stretches.select(part, "_range", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
                               F.sum("_size").over(Window.partitionBy(part)).alias("n"))
    return (ranges.join(offsets, [part, "_range"])
            .select(*rows.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias("pos"), "n"))


# ---------------------------------------------------------------------------
# Construction
# ---------------------------------------------------------------------------
def _build(height: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        n = rows.column("n")[0].as_py()
        # the only block of a part is as high as its leaves need
        own = next((h for h in range(height) if FAN ** h >= n), height)
        tree = Subtree.build(rows.column("digest").to_pylist(), own)
        return pa.table({"part": rows.column("part")[:1], "block": rows.column("block")[:1], "n": pa.array([n], pa.int64()),
                         "height": pa.array([own], pa.int32()), "nodes": pa.array([tree.nodes.tobytes()], pa.binary())})

    return run


def _root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        roots = [Subtree(np.frombuffer(x, np.uint8).reshape(-1, 32), 1, h).root()
                 for x, h in zip(b.column(3).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(roots, pa.string()), b.column(4)],
                                         ["part", "pos", "digest", "n"])


def build_trees(leaves: DataFrame, folder: str, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Write the blocks of a tree per part (``leaves``: part, pos, digest, n); the levels, and part, root."""
    spark, block, levels, roots = leaves.sparkSession, FAN ** height, [], None
    small_batches(spark)
    importable(spark)
    while True:
        path = f"{folder}/level={len(levels)}"
        rows = leaves.select("part", "pos", "digest", "n", F.expr(f"pos div {block}").alias("block"))
        rows.groupBy("part", "block").applyInArrow(_build(height), BLOCKS).write.parquet(path)
        blocks = spark.read.schema(BLOCKS).parquet(path)
        levels.append(blocks)
        tops = map_arrow(blocks.select("part", F.col("block").alias("pos"), "height", "nodes", "n"), _root,
                         "part string, pos long, digest string, n long")
        done = tops.where(F.col("n") <= block).select("part", F.col("digest").alias("root"))
        roots = done if roots is None else roots.union(done)
        if blocks.where(F.col("n") > block).isEmpty():
            return levels, roots
        leaves = tops.where(F.col("n") > block).withColumn("n", F.expr(f"(n + {block - 1}) div {block}"))


# ---------------------------------------------------------------------------
# Paths
# ---------------------------------------------------------------------------
def _hand_down(height: int):
    """Each block's leaves with the siblings above them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FAN ** height
        for b in batches:
            for row in b.to_pylist():
                first = row["block"] * size
                leaves = min(row["n"] - first, size)
                tree = Subtree(np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32), leaves, row["height"])
                siblings, shape = zip(*tree.paths(row["siblings"], row["shape"]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * leaves, pa.string()), pa.array(np.arange(leaves) + first),
                    pa.array([row["subroot"]] * leaves, pa.string()), pa.array(siblings, pa.string()), pa.array(shape, pa.binary())],
                    ["part", "block", "subroot", "siblings", "shape"])

    return run


def hand_down(levels: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The lowest blocks with the siblings above their roots; ``above`` (PATHS, block 0) holds those of each part's
    root."""
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        # a part's root is the root of its only block on its highest level
        handed = above.withColumn("whole", F.lit(True))
        if paths is not None:
            handed = handed.union(paths.withColumn("whole", F.lit(False)))
        at = levels[k].withColumn("whole", F.col("n") <= FAN ** height).join(handed, ["part", "block", "whole"]).drop("whole")
        if k:
            paths = written(map_arrow(at, _hand_down(height), PATHS), "paths")
    return at


def _proofs(root: str):
    def run(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        if not rows.num_rows or not blocks.num_rows:
            rows = rows.slice(0, 0)
        rows = rows.sort_by("pos")
        block = blocks.to_pylist()[:1]
        paths = Subtree(np.frombuffer(block[0]["nodes"], np.uint8).reshape(-1, 32), rows.num_rows, block[0]["height"]).paths(
            block[0]["siblings"], block[0]["shape"]) if rows.num_rows else []
        folded = [fold(leaf, *path) for leaf, path in zip(rows.column("presented").to_pylist(), paths)]
        n = rows.num_rows
        return pa.table({
            "doc_id": rows.column("doc_id"), "leaf": rows.column("leaf"),
            "subroot": pa.array([block[0]["subroot"]] * n if n else [], pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array([digest([siblings]) for siblings, _ in paths], pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([x == root for x in folded], pa.bool_())})

    return run


# ---------------------------------------------------------------------------
# The manifest
# ---------------------------------------------------------------------------
def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the columns, each as its length in bytes, a colon and its text, or ``-``."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def write_manifest(rows: DataFrame, folder: str, height: int = HEIGHT) -> None:
    """``rows``: part (null: a part of its own), doc_id, leaf, presented (the digest to be verified later)."""
    spark = rows.sparkSession
    # no part is null from here on, and the order of parts is kept
    named = rows.select(F.coalesce(F.concat(F.lit("="), "part"), F.lit("")).alias("part"), "doc_id", "leaf", "presented",
                        F.monotonically_increasing_id().alias("_tie"))
    ordered = ranked(written(named, "digests"), "part", ["doc_id", "leaf", "_tie"], "ordered")
    ordered.drop("_tie").write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    _, roots = build_trees(leaves.withColumnRenamed("leaf", "digest"), f"{folder}/documents", height)
    roots.write.parquet(f"{folder}/roots")
    tops = ranked(spark.read.parquet(f"{folder}/roots").withColumn("whole", F.lit("")), "whole", ["part"], "parts")
    build_trees(tops.select(F.col("whole").alias("part"), "pos", F.col("root").alias("digest"), "n"), f"{folder}/parts", height)
    tops.select("part", "root", "pos").write.parquet(f"{folder}/order")


def _levels(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The blocks by level; a level holds an 8 ** HEIGHT-th of the one below."""
    blocks = spark.read.schema(f"{BLOCKS}, level int").parquet(folder)
    top = blocks.agg(F.max("level")).first()[0] or 0
    return [blocks.where(F.col("level") == k).drop("level") for k in range(top + 1)]


def read_root(spark: SparkSession, folder: str) -> str | None:
    """The root of all; None of an empty table."""
    top = _levels(spark, f"{folder}/parts")[-1].first()
    return top and Subtree(np.frombuffer(top["nodes"], np.uint8).reshape(-1, 32), 1, top["height"]).root()


def verify(spark: SparkSession, folder: str, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the presented leaf), verified of every row of a manifest of
    that height."""
    small_batches(spark)
    importable(spark)
    start = spark.createDataFrame([("", 0, "", "", b"")], PATHS)
    tops = map_arrow(hand_down(_levels(spark, f"{folder}/parts"), start, height), _hand_down(height), PATHS)
    order = spark.read.parquet(f"{folder}/order").select("part", F.col("root").alias("subroot"), F.col("pos").alias("block"))
    above = written(tops.drop("part", "subroot").join(order, "block").select(
        "part", F.lit(0).cast("long").alias("block"), "subroot", "siblings", "shape"), "above")
    blocks = hand_down(_levels(spark, f"{folder}/documents"), above, height)
    rows = spark.read.parquet(f"{folder}/leaves").withColumn("block", F.expr(f"pos div {FAN ** height}"))
    return rows.groupBy("part", "block").cogroup(blocks.groupBy("part", "block")).applyInArrow(
        _proofs(read_root(spark, folder)), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean")
