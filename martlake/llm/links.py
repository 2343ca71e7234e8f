"""Exact links between shingle sets: of given pairs, and of all members of groups that are in different classes.

Sets are columns of sorted 64-bit hashes (``shingles.shingle_sets``) in binary form.  Two sets are linked when
100 * intersection >= share * union.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, written
from martlake.llm.shingles import overlap, shingle_sets

#: Shingles of the queries and of the nodes that one block compares, and of the blocks that share a task's group.
QUERY_BLOCK, NODE_BLOCK, POOL = 100_000, 500_000, 250_000


def parts(batch: pa.RecordBatch, chars: int = 2_000_000) -> Iterator[tuple[list, ...]]:
    """Columns of a batch whose last one holds texts, in parts of about that many characters."""
    texts = batch.column(batch.num_columns - 1).to_pylist()
    start = n = 0
    for k, text in enumerate(texts):
        n += len(text or "")
        if n >= chars or k + 1 == len(texts):
            part = batch.slice(start, k + 1 - start)
            yield *(part.column(c).to_pylist() for c in range(batch.num_columns - 1)), texts[start:k + 1]
            start, n = k + 1, 0


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in parts(b):
                sets, at = shingle_sets(texts, k)
                rows = [sets[a:z].tobytes() for a, z in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(at), pa.int64()),
                                                  pa.array(rows, pa.binary())], ["node", "n", "shingles"])

    return run


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, n, shingles of the texts whose id is in ``wanted``; wanted ids grow with the corpus, so it is a shuffle
    join at every size."""
    found = docs.join(wanted.hint("merge"), "doc_id", "left_semi")
    return written(map_arrow(found, _sets(k), "node long, n long, shingles binary"), "sets")


def linked(both: int, a: int, b: int, share: int) -> bool:
    return 100 * both >= share * (a + b - both)


def _verify(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c) for c in ("a", "b", "set_a", "set_b"))
            keep = []
            for k in range(batch.num_rows):
                p, q = np.frombuffer(x[k].as_py(), np.uint64), np.frombuffer(y[k].as_py(), np.uint64)
                keep.append(linked(min(len(p), len(q)), len(p), len(q), share)
                            and linked(overlap(p, q), len(p), len(q), share))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def linked_pairs(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return map_arrow(pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b"), _verify(share),
                     "a long, b long")


class Joined:
    """Classes that links have joined so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, c: int) -> int:
        while (above := self.up.get(c, c)) != c:
            self.up[c] = self.up.get(above, above)
            c = above
        return c

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.top(a), self.top(b)
        self.up[a] = b
        return a != b


def _compare(node: np.ndarray, comp: np.ndarray, query: np.ndarray, sets: list[np.ndarray], share: int, joined: Joined) -> list:
    """Queries of one block against its nodes of other classes: the links that join classes still apart."""
    data, out = np.flatnonzero(~query), []
    if not len(data) or not query.any():
        return out
    size = np.array([len(sets[d]) for d in data], np.int64)
    values = np.concatenate([sets[d] for d in data])
    by = np.argsort(values, kind="stable")
    values, owner = values[by], np.repeat(np.arange(len(data)), size)[by]
    for q in np.flatnonzero(query):
        low, high = np.searchsorted(values, sets[q], "left"), np.searchsorted(values, sets[q], "right")
        n = high - low
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
        both = np.bincount(owner[at], minlength=len(data))
        hit = (100 * both >= share * (len(sets[q]) + size - both)) & (comp[data] != comp[q])
        found = {int(comp[d]): int(node[d]) for d in data[hit]}
        out += [(int(node[q]), d) for c, d in found.items() if joined.join(int(comp[q]), c)]
    return out


def _compare_blocks(share: int):
    """The blocks of a pool, one after the other; rows of different blocks are never compared.  A pool gives fewer
    links than it holds classes."""

    def run(rows: pa.Table) -> pa.Table:
        label, q, d, node, comp = (rows.column(c).to_numpy() for c in ("label", "q", "d", "node", "component"))
        query = rows.column("query").to_numpy(zero_copy_only=False).astype(bool)
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        order = np.lexsort((d, q, label))
        new = np.ones(len(order), bool)
        for c in (label, q, d):
            new[1:] &= c[order][1:] == c[order][:-1]
        new[1:] = ~new[1:]
        pairs, joined = [], Joined()
        for at in np.split(order, np.flatnonzero(new)[1:]):
            pairs += _compare(node[at], comp[at], query[at], [sets[k] for k in at], share, joined)
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def links_in_groups(members: DataFrame, classes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Links between classes that meet in a group (``members``: key, node; ``classes``: node, component).

    Groups with one class need nothing more.  The others are gathered by their smallest class, and there every node
    outside that class is compared with all nodes of other classes, in blocks of queries against blocks of nodes:
    a group of any size is cut the same way, and no task holds more than its blocks."""
    m = written(members.join(classes, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")), "classes")
    opened = written(m.groupBy("key").agg(F.min("component").alias("label"), F.max("component").alias("last"))
                     .where("label != last").select("key", "label"), "open")
    sized = sets.groupBy("node").agg(F.sum("n").alias("n"))
    groups = written(m.join(opened, "key").select("label", "node", "component").distinct().join(sized, "node"), "groups")
    outside = F.col("component") != F.col("label")
    blocks = written(groups.groupBy("label").agg(
        F.ceil(F.sum("n") / NODE_BLOCK).cast("long").alias("nd"),
        F.ceil(F.sum(F.when(outside, F.col("n")).otherwise(0)) / QUERY_BLOCK).cast("long").alias("nq")), "blocks")
    g = groups.join(blocks, "label")
    one = F.lit(1).cast("long")
    own_q, own_d = F.pmod(F.xxhash64("node"), "nq") + 1, F.pmod(F.xxhash64("node", F.lit(1)), "nd") + 1
    cols = ["label", "node", "component", "n"]
    queries = g.where(outside).select(*cols, F.lit(True).alias("query"), own_q.alias("q"),
                                      F.explode(F.sequence(one, "nd")).alias("d"))
    data = g.select(*cols, F.lit(False).alias("query"), own_d.alias("d"),
                    F.explode(F.sequence(one, "nq")).alias("q")).select(*queries.columns)
    rows = written(queries.union(data), "compared")
    pools = max(1, -(-(rows.agg(F.sum("n")).first()[0] or 0) // POOL))
    pool = F.pmod(F.xxhash64("label", "q", "d", F.lit(2)), F.lit(pools))
    return (rows.drop("n").join(sets.select("node", "shingles"), "node").withColumn("pool", pool)
            .groupBy("pool").applyInArrow(_compare_blocks(share), "a long, b long"))
