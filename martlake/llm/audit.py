"""Interaction audit of document filters by sorted posting lists.

Each filter keeps, per part and range of row numbers, the sorted list of the rows that fail it; rows with a good or a
toxic label are lists of their own.  A range's lists are merged by galloping: a k-way union copies whole runs up to
the next list's head, which is found by doubling steps and a binary search, and differences and intersections leap
over what the other list doesn't hold.  Ranges are disjoint, so the sizes of their unions and differences are summed over
the ranges and give, for every set of filters and every filter applied after it, the rows removed; the orders of
filters are looked up in these sums.

A range belongs to one task and holds ``RANGE`` rows at most; a part of any size is many ranges, and what is
shuffled is at most 112 sums a part and task.

The five filters (words are maximal runs of other characters than spaces and the characters 9 to 13; code points): A, under
50 words; B, 100 * distinct words < 65 * words; C, 100 * letters A to Z > 5 * length; D, any of ``#$%&*|``; E, the same
text as a row with a smaller doc_id, anywhere in the table.

Defined results: a null text is empty (it fails A; it fails E if a smaller doc_id is null or empty too); a null part is
the empty string; a null doc_id fails E never and has no label; rows with equal doc_id are rows of their own, each with the
labels of that doc_id (a label given once counts, however often it is repeated), and don't fail E for each other.  Texts
are read whole at any length.  Columns other than doc_id, text and the part are not read; an empty table has no parts and
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, whole_text, written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
RANGE = 1 << 16
#: A text with many copies meets its first one in so many parts of the join.
SALTS = 16
#: Parts whose sums a task holds at a time.
PARTS = 1000
LISTS = [*FILTERS, "good", "toxic"]
POSTINGS = "part string, first long, n long, " + ", ".join(f"`{c}` array<long>" for c in LISTS)


# ---------------------------------------------------------------------------
# Merges of sorted lists
# ---------------------------------------------------------------------------
def gallop(ids: list[int], target: int, at: int) -> int:
    """The first place from ``at`` on whose id is at least ``target``: doubling steps, then a binary search."""
    step, end = 1, len(ids)
    while at + step < end and ids[at + step] < target:
        at += step
        step *= 2
    return bisect_left(ids, target, at, min(at + step + 1, end))


def union(lists: list[list[int]]) -> list[int]:
    out, at = [], [0] * len(lists)
    heads = [(ids[0], k) for k, ids in enumerate(lists) if ids]
    heapify(heads)
    while len(heads) > 1:
        _, k = heappop(heads)
        ids, other = lists[k], heads[0][0]
        end = gallop(ids, other, at[k])
        out += ids[at[k]:end]
        end += end < len(ids) and ids[end] == other  # the other list brings it
        at[k] = end
        if end < len(ids):
            heappush(heads, (ids[end], k))
    for _, k in heads:
        out += lists[k][at[k]:]
    return out


def difference(a: list[int], b: list[int]) -> list[int]:
    out, i, j = [], 0, 0
    while i < len(a):
        j = gallop(b, a[i], j)
        if j == len(b):
            return out + a[i:]
        if a[i] == b[j]:
            i += 1
        else:
            end = gallop(a, b[j], i)
            out += a[i:end]
            i = end
    return out


def common(a: list[int], b: list[int]) -> int:
    """The size of the intersection."""
    n = i = j = 0
    while i < len(a):
        j = gallop(b, a[i], j)
        if j == len(b):
            break
        if a[i] == b[j]:
            n, i = n + 1, i + 1
        else:
            i = gallop(a, b[j], i)
    return n


def sizes(fails: list[list[int]], good: list[int], toxic: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(key, rows, good, toxic) of a range: for each set of filters (a mask) the size of its union, with key 8 * mask
    + 7; for each filter k outside it what the filter removes after them, with key 8 * mask + k."""
    for mask in range(SUBSETS):
        before = union([ids for k, ids in enumerate(fails) if mask >> k & 1])
        yield 8 * mask + 7, len(before), 0, 0
        for k, ids in enumerate(fails):
            if not mask >> k & 1:
                removed = difference(ids, before)
                yield 8 * mask + k, len(removed), common(good, removed), common(toxic, removed)


# ---------------------------------------------------------------------------
# Posting lists
# ---------------------------------------------------------------------------
def failures(docs: DataFrame, part: str) -> DataFrame:
    """part, doc_id, mask (of the filters A to D), digest of each row's text."""
    text = whole_text()
    words = F.split(text, r"[\x20\x09-\x0D]+")
    n, distinct = F.size(F.array_remove(words, "")), F.size(F.array_except(words, F.array(F.lit(""))))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return docs.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col("doc_id").cast("long").alias("doc_id"), mask.alias("mask"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def flagged(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """part, mask of all five filters, good, toxic of every row."""
    rows = written(failures(docs, part), "failures")
    named = rows.where("doc_id IS NOT NULL")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    firsts = (named.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first < last").select("digest", "first", salts.alias("salt")))
    given = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    again = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    judged = (named.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
              .join(firsts, ["digest", "salt"], "left").join(given, "doc_id", "left")
              .select("part", (F.col("mask") + again).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"),
                      F.coalesce("toxic", F.lit(False)).alias("toxic")))
    nameless = rows.where("doc_id IS NULL").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return written(judged.union(nameless), "flagged")


def _posted(range_rows: int):
    """The lists of each part, a range of row numbers at a time."""
    schema = pa.schema([("part", pa.string()), ("first", pa.int64()), ("n", pa.int64()),
                        *((c, pa.list_(pa.int64())) for c in LISTS)])

    def lists(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by("number")
        number, mask, good, toxic = (rows.column(c).to_numpy() for c in ("number", "mask", "good", "toxic"))
        flags = [*((mask >> k & 1).astype(bool) for k in range(len(FILTERS))), good.astype(bool), toxic.astype(bool)]
        parts = rows.column("part").combine_chunks().dictionary_encode()
        own = parts.indices.to_numpy()
        out = []
        for p, name in enumerate(parts.dictionary.to_pylist()):
            here = own == p
            ids = number[here]
            out.append({"part": name, "first": int(ids[0]), "n": len(ids),
                        **{c: ids[f[here]].tolist() for c, f in zip(LISTS, flags)}})
        return pa.RecordBatch.from_pylist(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if n and n + b.num_rows > range_rows:
                yield lists(held)
                held, n = [], 0
            if b.num_rows:
                held.append(b)
                n += b.num_rows
        if held:
            yield lists(held)

    return run


def post(rows: DataFrame, range_rows: int = RANGE) -> DataFrame:
    """The posting lists: one row a part and range (POSTINGS), written."""
    numbered = rows.select("part", F.monotonically_increasing_id().alias("number"), "mask", "good", "toxic")
    return written(map_arrow(numbered, _posted(range_rows), POSTINGS), "postings")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's ranges, by part; of ``PARTS`` parts at a time."""
    total: dict[str, np.ndarray] = {}

    def sums() -> pa.RecordBatch:
        each = [(part, np.flatnonzero(x.any(axis=1)), x) for part, x in total.items()]
        names = [part for part, keys, _ in each for _ in keys]
        keys = np.concatenate([keys for _, keys, _ in each])
        n = np.concatenate([x[keys] for _, keys, x in each])
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(keys, pa.int64()),
                                           *(pa.array(np.ascontiguousarray(n[:, c])) for c in range(3))],
                                          ["part", "key", "n", "good", "toxic"])

    for b in batches:
        for row in b.to_pylist():
            own = total.setdefault(row["part"], np.zeros((8 * SUBSETS, 3), np.int64))
            for key, *n in sizes([row[f] for f in FILTERS], row["good"], row["toxic"]):
                own[key] += n
            if len(total) >= PARTS:
                yield sums()
                total.clear()
    if total:
        yield sums()


# ---------------------------------------------------------------------------
# The audit
# ---------------------------------------------------------------------------
def step_orders() -> list[tuple]:
    """number, filter_order, step, k (the filter), before (the mask of the filters before it) of all steps of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        for step, k in enumerate(order):
            out.append((len(out), "".join(FILTERS[f] for f in order), step + 1, k, sum(1 << f for f in order[:step])))
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", range_rows: int = RANGE) -> DataFrame:
    """A row for each part, order of the filters and step, zeros included."""
    spark = docs.sparkSession
    postings = post(flagged(docs, labels, part), range_rows)
    sums = written(map_arrow(postings.drop("first", "n"), _merged, "part string, key long, n long, good long, toxic long")
                   .groupBy("part", "key").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]), "sums")
    looked = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(  # 112 entries at most
        F.struct("key", F.struct("n", "good", "toxic")))).alias("sums"))
    orders = step_orders()
    steps = spark.createDataFrame(orders, "number int, filter_order string, step int, k int, before int")  # 600 rows
    rows = (postings.groupBy("part").agg(F.sum("n").alias("rows")).join(looked, "part", "left")
            .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1)))).join(F.broadcast(steps), "number"))

    def of(key, field: str = "n"):
        return F.coalesce(F.col("sums")[key.cast("long")][field], F.lit(0).cast("long"))

    k, before = F.col("k"), F.col("before")
    removed = before * 8 + k
    bit = F.expr("shiftleft(1, k)")
    others = len(FILTERS) - 1
    # a set of filters stands before this one in as many orders as it and the rest can be ordered
    shapley = sum((of(F.lit(8 * m) + k) * (factorial(m.bit_count()) * factorial(others - m.bit_count()))
                   for m in range(SUBSETS - 1) if m.bit_count() <= others), F.lit(0).cast("long"))
    return rows.select(
        "part", "filter_order", "step", (F.col("rows") - of((before + bit) * 8 + 7)).alias("kept"), of(removed).alias("removed"),
        (of(k) - of(removed)).alias("redundant"), of((F.lit(SUBSETS - 1) - bit) * 8 + k).alias("unique_fails"),
        of(removed, "good").alias("good_lost"), of(removed, "toxic").alias("toxic_lost"), shapley.alias("shapley"))
