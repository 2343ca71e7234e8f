"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct word shingles.  Two small collections of ``halves`` keys, each key made of
``rows`` minhashes, are computed a set; a table's key is a pair with one key of either collection, so that
``halves`` ** 2 tables cost 2 * ``halves`` * ``rows`` minhashes.  Sets of similarity s meet in a table with the
probability (1 - (1 - s ** rows) ** halves) ** 2; ``halves`` is the least number for which that is ``recall`` at the
threshold.

Equal sets are one node.  In each table's bucket every node is compared with the smallest one on the full sets; the
links found join nodes to classes.  Buckets that still hold more than one class are gathered by their smallest class,
and there every node outside that class is compared on full sets with all nodes of other classes, in blocks
(``links.links_in_groups``).  So every pair that meets in a table is either compared or in one class already, whatever
the size of its bucket; nothing is capped, and a bucket is never gathered in one task.

Defined results: a text without words has an empty set and is linked with nothing.  A row without doc_id is not
linked: its component_id is null and it is kept.  Rows with equal doc_id are one vertex, linked through any of their
texts.  Columns other than doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, written
from martlake.llm.components import components
from martlake.llm.links import linked_pairs, links_in_groups, parts, sets_of
from martlake.llm.shingles import minhashes, mix, shingle_sets
from martlake.session import scratch_path

RECALL = 0.9998


def halves_for(threshold: float, rows: int, recall: float) -> int:
    m = 1
    while (1 - (1 - threshold ** rows) ** m) ** 2 < recall:
        m += 1
    return m


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.uint64)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out


def _sketch(k: int, rows: int, halves: int):
    names = ["doc_id", "n_shingles", "set_a", "set_b", *(f"{h}{i}" for h in "xy" for i in range(halves))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in parts(b):
                sets, at = shingle_sets(texts, k)
                mins = minhashes(sets, at, 2 * halves * rows)
                cols = [np.diff(at), _sums(sets, at).view(np.int64), _sums(mix(sets ^ np.uint64(k)), at).view(np.int64)]
                for j in range(2 * halves):
                    key = np.zeros(len(ids), np.uint64)
                    for r in range(rows):
                        key = mix(key + mins[:, j * rows + r])
                    cols.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols)],
                                                 names)

    return run, ", ".join(f"{n} long" for n in names)


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 80, rows: int = 3, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; linked: 100 * intersection >= share * union."""
    halves = halves_for(share / 100, rows, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch, schema = _sketch(k, rows, halves)
    sketches = written(map_arrow(docs, sketch, schema), "sketches")

    key_cols = [f"{h}{i}" for h in "xy" for i in range(halves)]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = written(sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b", "n_shingles")
                    .agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in key_cols])
                    .repartition(tasks, "node"), "nodes")  # a node becomes a row a table: spread before that
    keys = [F.xxhash64(F.lit(i * halves + j), f"x{i}", f"y{j}") for i in range(halves) for j in range(halves)]
    buckets = nodes.select("node", F.explode(F.array(*keys)).alias("key"))
    shared = written(buckets.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                     .where("first != last").select("key", "first"), "buckets")
    members = written(buckets.join(shared, "key"), "members")

    sets = sets_of(docs, members.select(F.col("node").alias("doc_id")).distinct(), k)
    pairs = members.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = written(linked_pairs(pairs, sets, share), "links")
    more = links_in_groups(members.select("key", "node"), components(links), sets, share)
    classes = components(links.union(more))
    # rows with equal doc_id and different texts are nodes of one name: they meet here by that name
    by_set = nodes.join(classes, "node", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component"))
    found = sketches.join(by_set, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, k: int = 5, share: int = 80, rows: int = 3, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the smallest doc_id stays, one without
    doc_id only if none has one, and of rows equal in that the first.  Every row is a vertex of its own (a written
    number), so rows that share a doc_id or have none are compared by their texts like any others; a row without words
    always stays."""
    path = scratch_path(docs.sparkSession, "numbered")
    docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")).write.parquet(path)
    numbered = docs.sparkSession.read.parquet(path)
    found = near_duplicates(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), k, share, rows, recall)
    classes = written(found.select(F.col("doc_id").alias("number"), "component_id"), "found")
    named = numbered.select("number", F.col("row.doc_id").alias("doc_id")).join(classes.hint("merge"), "number")
    kept = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "number"))
                                             .alias("least")).select("least.number")
    # kept numbers grow with the corpus: a shuffle join at every size
    return numbered.join(kept.hint("merge"), "number", "left_semi").select("row.*")
