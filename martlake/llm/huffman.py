"""Token-id files coded with a canonical length-limited Huffman code.

Ids are counted over the whole corpus, the code's lengths are limited to ``MAX_BITS``, and only the lengths are
stored (the canonical code follows from them).  A table of blocks holds the ids in ascending doc_id order: each
block is decoded on its own, by one table look-up an id, from several bit-offset checkpoints at a time.

The format is three Parquet tables below one folder, so that any store Spark reads can hold it:

* ``code``   - id, bits: the code's lengths (ids that occur);
* ``blocks`` - file_no, block_no, first (ids of that file before the block), doc_ids, doc_tokens, n_tokens,
  checkpoints (bit offset of every ``EVERY``-th id), payload (the bits, most significant first);
* ``files``  - file_no, start (ids of all files before it), n_tokens.

The number of blocks' tasks is ``spark.sql.shuffle.partitions``, to be set by the input's size.

Defined results: a very long text is one document of one block, which is as long as it needs; a null text is empty (the end
id alone); null doc_ids come first; repeated rows are documents of
their own, next to each other; other columns are not read; an empty table gives empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, whole_text, written
from martlake.llm.tokens import encoder, id_width

#: The longest code, where the vocabulary that occurs has that many ids or fewer; else as many bits as these need.
MAX_BITS = 16
EVERY = 512
BLOCK_TOKENS = 1 << 20


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (or as many as that number of ids needs) for positive counts
    (package-merge)."""
    n = len(counts)
    max_bits = max(max_bits, (n - 1).bit_length())
    if n <= 1:
        return np.ones(n, np.uint8)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    rounds, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        rounds.append(by < n)
        both = both[by]
        even = len(both) // 2 * 2
        packages = both[0:even:2] + both[1:even:2]
    lengths, active = np.zeros(n, np.uint8), 2 * n - 2
    for is_leaf in reversed(rounds):
        k = int(is_leaf[:active].sum())
        lengths[:k] += 1
        active = 2 * (active - k)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


class Code:
    """The canonical code of (id, length) pairs: shorter codes first, then smaller ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(lengths[-1]) if len(ids) else 1
        steps = 1 << (self.bits - lengths)
        first = np.cumsum(steps) - steps  # the code, shifted to the full width
        self.code = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint64)
        self.length = np.zeros(len(self.code), np.int64)
        self.code[ids], self.length[ids] = first >> (self.bits - lengths), lengths
        self.symbol_at = np.zeros(1 << self.bits, np.uint32)
        self.length_at = np.zeros(1 << self.bits, np.int64)
        used = int(steps.sum())
        self.symbol_at[:used], self.length_at[:used] = np.repeat(ids, steps), np.repeat(lengths, steps)

    def encode(self, ids: np.ndarray, every: int = EVERY) -> tuple[bytes, np.ndarray]:
        """Bits (padded to 32) and the bit offset of every ``every``-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        n = self.length[ids]
        end = np.cumsum(n)
        at = end - n
        value = self.code[ids] << (64 - (at & 31) - n).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words = np.zeros(int(end[-1] >> 5) + 2, np.uint64)
        words[word[first]] = np.add.reduceat(value >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        size = int(end[-1] + 31) >> 5
        return words[:size].astype(">u4").tobytes(), at[::every]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, every: int = EVERY) -> np.ndarray:
        """All checkpoints' ids advance together, one look-up an id."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(payload + b"\0" * 4, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, lanes = checkpoints.astype(np.int64), len(checkpoints)
        out = np.zeros((every, lanes), np.uint32)
        down, low = 32 - self.bits, (1 << self.bits) - 1
        last = n - (lanes - 1) * every
        for k in range(min(every, n)):
            if k == last:  # the last checkpoint's ids end here
                at = at[:-1]
            peek = (window[at >> 3] >> (down - (at & 7))) & low
            out[k, :len(at)] = self.symbol_at[peek]
            at = at + self.length_at[peek]
        return out.T.reshape(-1)[:n]


def _encode_texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            ids = [x + enc.end for x in enc.ids(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())],
                                             ["doc_id", "row_id", "ids"])

    return run


def _count(width: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            c = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), width))
            if len(c) > len(total):
                total = np.pad(total, (0, len(c) - len(total)))
            total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return run


BLOCKS = ("file_no int, block_no int, first long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, "
          "checkpoints array<long>, payload binary")


def _write_blocks(width: np.dtype, ids: np.ndarray, lengths: np.ndarray, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, file_no = Code(ids, lengths), TaskContext.get().partitionId()
        docs, raw, held, block_no, first = [], [], 0, 0, 0
        schema = pa.schema([("file_no", pa.int32()), ("block_no", pa.int32()), ("first", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                            ("n_tokens", pa.int64()), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])

        def block() -> pa.RecordBatch:
            payload, at = code.encode(np.frombuffer(b"".join(raw), width).astype(np.int64))
            tokens = [len(r) // width.itemsize for r in raw]
            return pa.RecordBatch.from_pylist([{
                "file_no": file_no, "block_no": block_no, "first": first, "doc_ids": docs, "doc_tokens": tokens,
                "n_tokens": held, "checkpoints": at.tolist(), "payload": payload}], schema)

        for b in batches:
            for doc, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                docs.append(doc)
                raw.append(r)
                held += len(r) // width.itemsize
                if held >= block_tokens:
                    yield block()
                    block_no, first = block_no + 1, first + held
                    docs, raw, held = [], [], 0
        if docs:
            yield block()

    return run


def _read_blocks(ids: np.ndarray, lengths: np.ndarray, emit, names: list[str], kinds: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        for b in batches:
            for row in b.to_pylist():
                tokens = code.decode(row["payload"], np.array(row["checkpoints"], np.int64), row["n_tokens"])
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                out = []
                for doc, n, end in zip(row["doc_ids"], row["doc_tokens"], ends.tolist()):
                    out.append((doc, row["start"] + end - n, *emit(tokens[end - n:end])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def _code(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """At most one row per id of the vocabulary."""
    rows = spark.read.parquet(f"{folder}/code").collect()
    return np.array([r["id"] for r in rows], np.int64), np.array([r["bits"] for r in rows], np.int64)


def write_files(docs: DataFrame, path: str, folder: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every document and write the three tables below ``folder``."""
    spark, width = docs.sparkSession, id_width(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_id"),
                       whole_text().alias("text"))
    staged = written(map_arrow(rows, _encode_texts(path), "doc_id long, row_id long, ids binary"), "ids")

    counts = (map_arrow(staged.select("ids"), _count(width), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())  # bounded by the vocabulary
    ids = np.array([r["id"] for r in counts], np.int64)
    lengths = code_lengths(np.array([r["n"] for r in counts], np.int64))
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths)], "id long, bits int") \
        .coalesce(1).write.parquet(f"{folder}/code")

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (staged.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "row_id")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row_id").select("doc_id", "ids"))
    map_arrow(ordered, _write_blocks(width, ids, lengths, block_tokens), BLOCKS).write.parquet(f"{folder}/blocks")

    sizes = (spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("file_no")
             .agg(F.sum("n_tokens").alias("n")).orderBy("file_no").collect())  # one row a file
    start, table = 0, []
    for r in sizes:
        table.append((r["file_no"], start, r["n"]))
        start += r["n"]
    spark.createDataFrame(table, "file_no int, start long, n_tokens long").coalesce(1).write.parquet(f"{folder}/files")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.parquet(f"{folder}/files").select("file_no", F.col("start").alias("file_start"))
    return (spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").join(F.broadcast(files), "file_no")  # a row a file
            .select("doc_ids", "doc_tokens", "n_tokens", "checkpoints", "payload",
                    (F.col("file_start") + F.col("first")).alias("start")))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids of every document in the files."""
    fn = _read_blocks(*_code(spark, folder), lambda t: (t.astype(np.int64),), ["doc_id", "start", "ids"],
                      [pa.int64(), pa.int64(), pa.list_(pa.int64())])
    return map_arrow(_blocks(spark, folder), fn, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded ids."""
    fn = _read_blocks(*_code(spark, folder), lambda t: (len(t), zlib.crc32(t.astype("<u4"))),
                      ["doc_id", "start", "n_tokens", "ids_crc32"], [pa.int64()] * 4)
    return map_arrow(_blocks(spark, folder), fn, "doc_id long, start long, n_tokens long, ids_crc32 long")
