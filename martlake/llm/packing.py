"""Hierarchical multi-length packing of documents into training sequences.

Documents are encoded, an end id is appended, and each is routed to a context tier: whole windows of the longest
tier are cut off its front, and the rest goes to the smallest tier that holds it.  Tiers are packed from the
longest to the shortest: a window starts with a piece of its own tier, its gap is filled with the longest pieces of
shorter tiers that fit, and what is left of the gap with the front of a cut piece.  So every window is full to its
tier's size (a power of two) and nothing is padded; the last tokens of a block are cut into powers of two.
Sequences are then dealt to step groups of about equal numbers of tokens.

It is one pass over the documents without a shuffle: each task packs blocks of about ``block_tokens`` ids, so memory
is bounded by that and the longest text.  Sequence and group numbers hold the task's number and a running number;
they are the same when a lost task runs again, as long as the input's splits are the same.

Defined results: pieces of equal length are taken in the order of the documents from the last one on, and
sequences of equal length are dealt to groups in their order; a very long text is cut into whole windows of the longest tier;
a null text is empty (one piece, the end id); a null doc_id stays null; repeated rows are
documents of their own; columns other than doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, whole_text
from martlake.llm.tokens import encoder

TIERS = (128, 256, 512, 1024)
BLOCK_TOKENS = 1 << 22
STEP_TOKENS = 1 << 16

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "context int, step_group long")


class Pool:
    """Unplaced pieces by length, below the longest tier: (document, start, length)."""

    def __init__(self, longest: int):
        self.at: list[list[tuple[int, int]]] = [[] for _ in range(longest)]
        self.mask = 0

    def put(self, doc: int, start: int, length: int) -> None:
        self.at[length].append((doc, start))
        self.mask |= 1 << length

    def take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.at[length].pop()
        if not self.at[length]:
            self.mask &= ~(1 << length)
        return doc, start, length

    def longest(self, most: int) -> int:
        """The longest length of at most ``most``; 0 if none."""
        return max(0, (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def shortest(self, least: int) -> int:
        above = self.mask >> least << least
        return (above & -above).bit_length() - 1 if above else 0


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences of one block: (tokens, [(document, start, length), ...])."""
    longest, pool, out = tiers[-1], Pool(tiers[-1]), []
    for doc, n in enumerate(lengths):
        whole = n // longest * longest
        out.extend((longest, [(doc, s, longest)]) for s in range(0, whole, longest))
        if n > whole:
            pool.put(doc, whole, n - whole)
    for size in reversed(tiers):
        floor = size // 2 if size > tiers[0] else 0
        while (first := pool.longest(size if size < longest else size - 1)) > floor:
            window = [pool.take(first)]
            gap = size - first
            while gap and pool.mask:
                if fit := pool.longest(gap):
                    window.append(pool.take(fit))
                    gap -= fit
                else:
                    doc, start, length = pool.take(pool.shortest(gap))
                    window.append((doc, start, gap))
                    pool.put(doc, start + gap, length - gap)
                    gap = 0
            if not gap:
                out.append((size, window))
            else:
                out.extend(powers_of_two(window))
    return out


def powers_of_two(window: list[tuple[int, int, int]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """The block's last window, not full: cut into sequences of exact powers of two."""
    left = sum(length for _, _, length in window)
    rest = window[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left, need, part = left - size, size, []
        while need:
            doc, start, length = rest.pop()
            if length > need:
                rest.append((doc, start + need, length - need))
                length = need
            part.append((doc, start, length))
            need -= length
        yield size, part


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each sequence: the longest first, each to the group with the fewest tokens so far."""
    groups = max(1, -(-sum(sizes) // step_tokens))
    heap, out = [(0, g) for g in range(groups)], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heap[0]
        out[i] = g
        heapq.heapreplace(heap, (load + sizes[i], g))
    return out


def _pack_blocks(path: str, tiers: tuple[int, ...], block_tokens: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(path)
        base = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        docs: list[np.ndarray] = []
        held = sequences = groups = 0

        def block() -> pa.RecordBatch:
            nonlocal sequences, groups
            packed = pack([len(d) for d in docs], tiers)
            group = step_groups([n for n, _ in packed], step_tokens)
            cols: list[list] = [[] for _ in range(9)]
            for k, (size, pieces) in enumerate(packed):
                offset = 0
                for doc, start, length in pieces:
                    row = (ids[doc], start, length, zlib.crc32(docs[doc][start:start + length]), len(docs[doc]),
                           base + sequences + k, offset, size, base + groups + group[k])
                    for c, v in zip(cols, row):
                        c.append(v)
                    offset += length
            sequences += len(packed)
            groups += max(group, default=0) + 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, raw in zip(batch.column(0).to_pylist(), enc.ids(texts)):
                ids.append(doc_id)
                docs.append(np.frombuffer(raw + enc.end, enc.dtype).astype("<u4"))
                held += len(docs[-1])
                if held >= block_tokens:
                    yield block()
                    ids, docs, held = [], [], 0
        if docs:
            yield block()

    return run


def pack_documents(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece (SCHEMA); ``context`` is the sequence's length, a power of two."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(rows, _pack_blocks(path, tuple(sorted(tiers)), block_tokens, step_tokens), SCHEMA)
