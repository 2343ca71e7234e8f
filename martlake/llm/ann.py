"""Nearest neighbours by cosine: an inverted file of lists, scanned with adaptive numbers of dimensions.

Vectors are scaled to length 1, rotated by a random orthogonal matrix, and dealt to the list of their nearest
centroid (k-means on a sample of at most about ``FIT_ROWS`` rows; every row is indexed).  A query looks into the
``probes`` lists with the nearest centroids; by default as many as ``TRIALS`` rows of that sample need to find the share
``RECALL`` of their nearest neighbours within it (few for clustered vectors, most for even ones).  There a candidate's squared distance grows block of columns by block:
after t of D columns, D / t times the partial distance estimates the whole one, and a candidate is abandoned as soon
as a test at ``EPSILON`` / sqrt(t) finds it farther than the query's k-th nearest so far.  The rest get their exact
cosine, in double precision, on the original vectors.

Lists are cut into cells of about ``CELL_ROWS`` candidates and ``CELL_QUERIES`` queries by a hash of the ids, so that
a list with a third of all rows is many tasks' work.  The k best of each cell are merged.

Defined results: vectors that are null, zero, or hold null or non-finite components, rows without id, and vectors
whose length isn't the commonest one (of equally common ones the smallest) take no part.  Repeated rows count once;
different vectors with one id are candidates of their own, and as queries one query with the nearest to any of them.
Equal scores are ordered by id.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import importable, map_arrow, written

FIT_ROWS = 20_000
MOST_LISTS = 1024
CELL_ROWS, CELL_QUERIES = 4096, 512
TRIALS, RECALL = 256, 0.97
COLUMN_BLOCK, SCAN_ROWS, EPSILON = 16, 1024, 2.1


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of unit vectors."""
    centres = x[np.random.default_rng(7).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(n > 0, sums / np.maximum(n, 1e-12), centres)
    return centres


def probes_for(x: np.ndarray, centres: np.ndarray, k: int) -> int:
    """How many lists the first rows of a sample need to find their neighbours in it."""
    trial = x[np.random.default_rng(8).permutation(len(x))[:TRIALS]]
    near = trial @ x.T
    top = np.argsort(-near, 1, kind="stable")[:, 1:k + 1]  # the first is the row itself
    if not top.size:
        return len(centres)
    own = np.argmax(x @ centres.T, 1)
    order = np.argsort(-(trial @ centres.T), 1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(len(centres)), order.shape), 1)
    return int(np.quantile(np.take_along_axis(rank, own[top], 1), RECALL, method="higher")) + 1


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def scan(ids: np.ndarray, x: np.ndarray, rotated: np.ndarray, query_id: int, q: np.ndarray, turned: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a cell (ids, scores), nearest first."""
    dim = x.shape[1]
    best_id, best = np.zeros(0, np.int64), np.zeros(0)
    for s in range(0, len(ids), SCAN_ROWS):
        alive = np.arange(s, min(s + SCAN_ROWS, len(ids)))
        alive = alive[ids[alive] != query_id]
        if len(best) == k:  # its squared distance, with room for rounding so that ties are never lost
            limit, part = 2 - 2 * best[-1] + 1e-9, np.zeros(len(alive))
            for t in range(0, dim, COLUMN_BLOCK):
                d = rotated[alive, t:t + COLUMN_BLOCK] - turned[t:t + COLUMN_BLOCK]
                part = part + (d * d).sum(1)
                seen = min(dim, t + COLUMN_BLOCK)
                slack = 1 + (EPSILON / np.sqrt(seen) if seen < dim else 0)
                near = part * (dim / seen) <= limit * slack * slack
                alive, part = alive[near], part[near]
                if not len(alive):
                    break
        if len(alive):
            found = np.concatenate([best, cosines(x[alive], q)])
            found_id = np.concatenate([best_id, ids[alive]])
            top = np.lexsort((found_id, -found))[:k]
            best, best_id = found[top], found_id[top]
    return best_id, best


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _assign(centres: np.ndarray, probes: int):
    """vec_id, embedding in; vec_id, vector, list out, a row for each of the nearest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.asarray(b.column(1).flatten(), np.float64).reshape(b.num_rows, -1)
            near = unit(x) @ centres.T
            n = min(probes, len(centres))
            lists = np.argpartition(-near, n - 1, 1)[:, :n] if n > 1 else np.argmax(near, 1)[:, None]
            vectors = [row.tobytes() for row in x for _ in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), n)), pa.array(vectors, pa.binary()),
                 pa.array(lists.ravel().astype(np.int32))], ["vec_id", "vector", "list"])

    return run


def _search(dim: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and queries.num_rows:
            turn = rotation(dim)
            ids, x, q = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector")), _matrix(queries.column("vector"))
            rotated, turned = unit(x) @ turn, unit(q) @ turn
            for j, query in enumerate(queries.column("vec_id").to_pylist()):
                found, score = scan(ids, x, rotated, query, q[j], turned[j], k)
                out[0].extend([query] * len(found))
                out[1].extend(found.tolist())
                out[2].extend(score.tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, lists: int | None = None,
            probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score; ``vectors``: vec_id, embedding.  By default there are as many lists as the
    square root of the rows, ``MOST_LISTS`` at most."""
    spark = vectors.sparkSession
    importable(spark)
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
            .where(F.col("vec_id").isNotNull() & good & F.exists("embedding", lambda v: v != 0)))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim, n = (sizes["dim"], sizes["count"]) if sizes else (1, 0)
    rows = rows.where(F.size("embedding") == dim).dropDuplicates(["vec_id", "embedding"])
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 53)) / float(1 << 53)
    sample = rows.where(spread < min(1.0, FIT_ROWS / max(n, 1) / 1.2 if n > FIT_ROWS else 1.0)).orderBy(
        "vec_id", "embedding").collect()  # about FIT_ROWS rows at most
    x = unit(np.array([r["embedding"] for r in sample], np.float64)) if sample else np.ones((1, dim))
    lists = lists or min(MOST_LISTS, max(1, int(n ** 0.5)))
    centres = kmeans(x, lists)
    probes = min(len(centres), probes or probes_for(x, centres, k))

    schema = "vec_id long, vector binary, list int"
    index = written(map_arrow(rows.select("vec_id", "embedding"), _assign(centres, 1), schema), "index")
    queries = written(map_arrow(rows.where(is_query).select("vec_id", "embedding"), _assign(centres, probes), schema),
                      "queries")
    cells = {"rows": {}, "queries": {}}  # a number for each list
    for name, of, size in (("rows", index, CELL_ROWS), ("queries", queries, CELL_QUERIES)):
        cells[name] = {r["list"]: -(-r["count"] // size) for r in of.groupBy("list").count().collect()}

    def blocks(name: str) -> Column:
        found = [F.lit(v) for pair in cells[name].items() for v in pair]
        return F.coalesce(F.create_map(*found)[F.col("list")] if found else F.lit(None).cast("int"), F.lit(1))

    def others(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(name) - 1))

    def own(name: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), blocks(name)).cast("int")

    left = index.select("vec_id", "vector", "list", own("rows").alias("r"), others("queries").alias("q"))
    right = queries.select("vec_id", "vector", "list", own("queries").alias("q"), others("rows").alias("r"))
    found = left.groupBy("list", "r", "q").cogroup(right.groupBy("list", "r", "q")).applyInArrow(
        _search(dim, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
