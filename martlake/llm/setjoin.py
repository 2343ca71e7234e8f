"""Exact Jaccard join of word n-gram sets by a size-aware heavy-light join.

Two documents are linked when 100 * intersection >= share * union of their sets of distinct word shingles.  A pair of
sizes a <= b is linked when the sets share c(a, b) = ceil(share * (a + b) / (100 + share)) shingles.

* **Light.**  A small set of size s enumerates, for every size it can be linked with, all its subsets of the c(a, b)
  shingles that such a pair shares.  Sets that meet in a subset of the pair (a, b) share it, so they are linked
  with the smallest member of size a by construction: one link a member, no pair is compared.
* **Heavy.**  A large set scans the inverted lists of its rarest shingles.  All shingles have one order: those with a
  hash in the lowest quarter by the number of texts that hold them, the others behind by their hash.  Linked sets share
  one of the first s - ceil(share * s / 100) + 1 shingles of either; lists of a shingle that one set holds
  are empty, so a set with that many shingles of its own is done.  Lists are split by size classes of the ratio
  100 / share, of which linked sets share one.  In a list every set is verified against the smallest one; members of
  lists that still hold several classes are compared in blocks (``links.links_in_groups``).
* **Boundary.**  Light costs a set its subsets, heavy the lengths of the lists it scans.  Both are summed by size over
  the whole table, and sizes up to the one with the least total are light.  Pairs of a light and a
  heavy set are found by the heavy side, which also scans for the light sets near the boundary.

Links are exact at every boundary; nothing is capped.  Equal sets are one node, so copies cost one row each.

Defined results: a text without words (null, empty) has an empty set and is linked with nothing.  A row without doc_id
is not linked: its component_id is null.  Rows with equal doc_id are one vertex, linked through any of their texts;
each keeps its own row.  A very long text is one set, read whole.  Columns other than doc_id and text are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, written
from martlake.llm.components import components
from martlake.llm.links import linked_pairs, links_in_groups, parts, sets_of
from martlake.llm.shingles import mix, shingle_sets

#: Shingles below this hash are counted: a quarter of all, more than the prefix of a set from 60 % similarity on.
COUNTED = np.uint64(1 << 62)
#: The largest size for which the light side is considered.
MOST_LIGHT = 16


def shared(a: int, b: int, share: int) -> int:
    """The least number of common shingles that links sets of these sizes."""
    return -(-share * (a + b) // (100 + share))


def prefix(n, share: int):
    """How many of its first shingles a set must look up."""
    return n - -(-share * n // 100) + 1


def partners(s: int, share: int, most: int) -> list[tuple[int, int]]:
    """Size pairs (a, b), a <= b <= most, that a set of size s can be linked in."""
    return [(min(s, t), max(s, t)) for t in range(1, most + 1) if 100 * min(s, t) >= share * max(s, t)]


def subsets(s: int, share: int, most: int) -> int:
    return sum(comb(s, shared(a, b, share)) for a, b in partners(s, share, most))


def boundary(cost: dict[int, tuple[int, int]], share: int, most: int = MOST_LIGHT) -> int:
    """The size up to which sets are light; ``cost``: size -> (sets, lengths of the lists they scan)."""
    def total(x: int) -> int:
        return sum(n * subsets(s, share, x) if s <= x else scanned for s, (n, scanned) in cost.items())

    return min(range(most + 1), key=total)


def size_classes(n: np.ndarray, share: int) -> np.ndarray:
    """The class of each size; linked sizes are in one class or in neighbouring ones."""
    edges = [1]
    while len(n) and edges[-1] <= n.max():
        edges.append(edges[-1] * 100 // share + 1)
    return np.searchsorted(edges, n, "right")


def _sketch(k: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, rows, texts in parts(b):
                sets, at = shingle_sets(texts, k)
                n = np.diff(at)
                sums = np.zeros((2, len(n)), np.uint64)
                if (n > 0).any():
                    sums[0, n > 0] = np.add.reduceat(sets, at[:-1][n > 0])
                    sums[1, n > 0] = np.add.reduceat(mix(sets ^ np.uint64(k)), at[:-1][n > 0])
                low = at[:-1] + np.diff(np.concatenate([[0], np.cumsum(sets < COUNTED)])[at])
                more = np.where(n <= MOST_LIGHT, at[1:], np.maximum(low, at[:-1] + prefix(n, share) * (n > 0)))
                cut = list(zip(at[:-1].tolist(), low.tolist(), more.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                     pa.array([sets[a:z].tobytes() for a, z, _ in cut], pa.binary()),
                     pa.array([sets[a:z].tobytes() for _, a, z in cut], pa.binary())],
                    ["doc_id", "row_id", "n_shingles", "set_a", "set_b", "low", "more"])

    return run, "doc_id long, row_id long, n_shingles long, set_a long, set_b long, low binary, more binary"


def _each_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each counted shingle of a set."""
    for b in batches:
        low = b.column(1).to_pylist()
        n = np.array([len(x) // 8 for x in low], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), n)),
                                          pa.array(np.frombuffer(b"".join(low), np.int64))], [b.schema.names[0], "shingle"])


def _scans(share: int):
    """The lists that a set scans: shingles of its prefix that may be held by others, and the sum of their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, n, counted, texts, found, more = (b.column(c).to_pylist() for c in (
                "node", "n_shingles", "counted", "texts", "found", "more"))
            scans, scanned = [], []
            for k in range(b.num_rows):
                rest = prefix(n[k], share) - counted[k] + len(found[k] or [])
                if rest <= 0:
                    scans.append([])
                    scanned.append(0)
                    continue
                order = np.lexsort((np.array(found[k] or [], np.int64), np.array(texts[k] or [], np.int64)))[:rest]
                first = np.array(found[k] or [], np.int64)[order]
                behind = np.frombuffer(more[k], np.int64)[:rest - len(first)]
                scans.append(np.concatenate([first, behind]).tolist())
                scanned.append(int(np.array(texts[k] or [], np.int64)[order].sum()) + len(behind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(scans, pa.list_(pa.int64())),
                 pa.array(scanned, pa.int64())], ["node", "n", "scans", "scanned"])

    return run


def _subsets(share: int, most: int):
    """A row for each subset that a light set enumerates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, smaller, pair, keys = [], [], [], [[], []]
            for name, n, low, more in zip(*(batch.column(c).to_pylist() for c in range(4))):
                items = np.frombuffer(low + more, np.uint64)
                for a, b in partners(n, share, most):
                    at = np.array(list(combinations(range(n), shared(a, b, share))), np.int64)
                    node += [name] * len(at)
                    smaller += [n == a] * len(at)
                    pair += [a << 8 | b] * len(at)
                    keys[0].append(items[at].sum(axis=1, dtype=np.uint64))
                    keys[1].append(mix(items ^ np.uint64(share))[at].sum(axis=1, dtype=np.uint64))
            x, y = (np.concatenate(c or [np.zeros(0, np.uint64)]).view(np.int64) for c in keys)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(smaller, pa.bool_()),
                                              pa.array(pair, pa.int64()), pa.array(x), pa.array(y)],
                                             ["node", "smaller", "pair", "x", "y"])

    return run


def _light_links(nodes: DataFrame, share: int, most: int) -> DataFrame:
    """Every set that meets a subset's sets of the smaller size is linked with the smallest of them."""
    small = nodes.where(F.col("n_shingles") <= most).select("node", "n_shingles", "low", "more")
    key = ["pair", "x", "y"]
    each = written(map_arrow(small, _subsets(share, most), "node long, smaller boolean, pair long, x long, y long"), "subsets")
    met = (each.groupBy(*key).agg(F.min(F.when(F.col("smaller"), F.col("node"))).alias("a"), F.min("node").alias("first"),
                                  F.max("node").alias("last")).where("a IS NOT NULL AND first != last").select(*key, "a"))
    return each.join(met, key).where("a != node").select("a", F.col("node").alias("b"))


def _lists(scans: DataFrame, share: int) -> DataFrame:
    """key, node, n of the inverted lists, split by size class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.array([len(x) for x in b.column(2).to_pylist()], np.int64)
            values = b.column(2).flatten().to_numpy().view(np.uint64)
            n = b.column(1).to_numpy()
            of = np.repeat(np.arange(len(size)), size)
            level = size_classes(n, share).astype(np.uint64)[of]
            keys = np.concatenate([mix(values + mix(level + np.uint64(i))) for i in (0, 1)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.tile(b.column(c).to_numpy()[of], 2))
                                                                for c in (0, 1))], ["key", "node", "n"])

    return map_arrow(scans.select("node", "n", "scans"), run, "key long, node long, n long")


def _heavy_links(docs: DataFrame, scans: DataFrame, k: int, share: int, known: DataFrame) -> DataFrame:
    """Links found in the inverted lists; ``known``: links that need not be found again."""
    lists = written(_lists(scans, share), "lists")
    shared_lists = written(lists.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"),
                                                    F.min_by("n", "node").alias("first_n"))
                           .where("first != last").drop("last"), "shared-lists")
    members = written(lists.join(shared_lists, "key"), "members")
    sets = sets_of(docs, members.select(F.col("node").alias("doc_id")).distinct(), k)
    near = F.least("n", "first_n") * 100 >= F.greatest("n", "first_n") * share
    pairs = members.where(F.col("node") != F.col("first")).where(near).select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = written(linked_pairs(pairs, sets, share).union(known), "links")
    return links.union(links_in_groups(members.select("key", "node"), components(links), sets, share))


def jaccard_join(docs: DataFrame, k: int = 5, share: int = 80, light: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.  ``light`` sets the boundary instead of the costs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch, schema = _sketch(k, share)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), "text")
    sketches = written(map_arrow(rows, sketch, schema), "sketches")
    linkable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")

    counted = map_arrow(linkable.select("set_a", "low"), _each_counted, "set_a long, shingle long")
    texts = written(counted.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("set_a").alias("a"),
                                                   F.max("set_a").alias("z")).where("a != z").drop("a", "z"), "texts")
    same = ["set_a", "set_b", "n_shingles"]
    chosen = linkable.groupBy(*same).agg(F.min("doc_id").alias("node"), F.min("row_id").alias("row_id"))
    nodes = written(chosen.join(sketches.select("row_id", "low", "more"), "row_id"), "nodes")

    held = map_arrow(nodes.select("row_id", "low"), _each_counted, "row_id long, shingle long").join(texts, "shingle")
    found = held.groupBy("row_id").agg(F.collect_list("shingle").alias("found"), F.collect_list("texts").alias("texts"))
    looked = nodes.withColumn("counted", (F.length("low") / 8).cast("long")).join(found, "row_id", "left")
    scans = written(map_arrow(looked.select("node", "n_shingles", "counted", "texts", "found", "more"), _scans(share),
                              "node long, n long, scans array<long>, scanned long"), "scans")
    if light is None:
        cost = scans.where(F.col("n") <= MOST_LIGHT).groupBy("n").agg(F.count("*").alias("sets"), F.sum("scanned").alias("s"))
        light = boundary({r["n"]: (r["sets"], r["s"]) for r in cost.collect()}, share)  # MOST_LIGHT rows at most
    light = min(light, MOST_LIGHT)

    small = written(_light_links(nodes, share, light), "light")
    heavy = scans.where((F.col("n") * 100 >= share * (light + 1)) & (F.size("scans") > 0))
    classes = components(written(_heavy_links(docs, heavy, k, share, small), "all-links"))
    by_set = nodes.join(classes, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    out = sketches.select("doc_id", *same).join(by_set, same, "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                      .alias("component_id"))
