"""Passages of a benchmark in documents, by an FM-index over each shard of documents.

Texts are cut into words (ASCII letters in lower case, digits, and all characters beyond ASCII).  A phrase is a
window of ``window`` consecutive words of an item; an item of fewer words, but not none, is one phrase.  Each task
gathers its documents into shards.  A shard's words are numbered by the phrases' vocabulary; a word outside it ends
a run (no phrase can cross it), and runs shorter than the shortest phrase hold no phrase, so they are left out.  Over
the rest the task builds a suffix array, the Burrows-Wheeler transform with a wavelet matrix for ranks, and sampled
suffix positions; all phrases are searched backwards at once, occurrences are located by steps back to a sampled
position, and overlapping or touching occurrences are merged into spans.

The benchmark is a stated query set: it goes to the tasks in blocks of about ``BLOCK_BYTES`` of text, dealt by a hash of
item and text without repeats, and every block meets every document.  One block is on the driver and in the tasks at a
time: where there are several, the documents are numbered in a written table, each block's finds are written before the
next block is taken, and a join by the number puts them together.

Defined results: a null or empty text has no words and no spans; a null or empty item has no phrase; items with a
null id are searched and reported under the empty string; repeated items count once; repeated documents are
documents of their own; other columns pass through; empty tables give no spans or no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import map_arrow, written

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
SAMPLE = 8

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_LOWER).split() if text else []


class WaveletMatrix:
    """Ranks of symbols in a sequence, a level for each bit."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.before, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.before.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        start = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            ones_at, ones_start = self.before[k][at], self.before[k][start]
            at = np.where(one, self.zeros[k] + ones_at, at - ones_at)
            start = np.where(one, self.zeros[k] + ones_start, start - ones_start)
        return at - start


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; symbol 0 ends a run, and each 0 counts as a symbol of its own."""
    n = len(seq)
    ends = seq == 0
    key = np.where(ends, np.cumsum(ends) - 1, seq.astype(np.int64) + n)
    rank, step = np.empty(n, np.int64), 1
    while True:
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        behind[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        step *= 2


class FMIndex:
    """Counts and places of phrases in a sequence of symbols 1..; 0 separates runs and ends the sequence."""

    def __init__(self, seq: np.ndarray, symbols: int, sample: int = SAMPLE):
        self.order = suffix_array(seq)
        before = self.order - 1
        bwt = np.where(before >= 0, seq[before], 0).astype(np.int32)
        self.bwt, self.bits = bwt, max(1, int(symbols).bit_length())
        self.ranks = WaveletMatrix(bwt, self.bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols + 1))]).astype(np.int64)
        # sampled: every ``sample``-th place, and the places behind a separator, which no step goes back over
        self.sampled = (self.order % sample == 0) | (bwt == 0)
        self.place = self.order[self.sampled]
        self.sample_no = np.cumsum(self.sampled) - 1
        self.size = len(seq)
        del self.order

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.ranks.rank(symbol, at)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase (a row of symbols, filled with 0 behind its length)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for k in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= k) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - k]
            low[live], high[live] = self.back(symbol, low[live]), self.back(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[rows[open_]]
            hit = open_[done]
            out[hit] = self.place[self.sample_no[rows[hit]]] + steps[hit]
            open_ = open_[~done]
            rows[open_] = self.back(self.bwt[rows[open_]].astype(np.int64), rows[open_])
            steps[open_] += 1
        return out


class Phrases:
    """The distinct phrases of a block of items, numbered words, and which items hold each phrase."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocab: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[int]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        for name, text in items:
            w = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in words(text)]
            for s in range(max(1, len(w) - window + 1) if w else 0):
                rows.setdefault(tuple(w[s:s + window]), set()).add(number[name])
        self.lengths = np.array([len(p) for p in rows], np.int64)
        self.symbols = np.zeros((len(rows), window), np.int64)
        for k, p in enumerate(rows):
            self.symbols[k, :len(p)] = p
        self.items = [sorted(x) for x in rows.values()]
        self.shortest = int(self.lengths.min(initial=window))

    def find(self, texts: list[list[bytes]]) -> tuple[list[list[int]], list[list[str]]]:
        """Of each text: merged spans [start, end, start, end, ...] in words, and the items found."""
        spans: list[list[int]] = [[] for _ in texts]
        found: list[list[str]] = [[] for _ in texts]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])  # a separator behind each text
        get = self.vocab.get
        seq = np.zeros(int(starts[-1]), np.int64)
        for t, s in zip(texts, starts.tolist()):
            seq[s:s + len(t)] = [get(w, 0) for w in t]
        known = np.concatenate([[0], (seq > 0).astype(np.int8), [0]])
        run, end = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
        long = end - run >= self.shortest
        run, end = run[long], end[long]
        if not len(run) or not len(self.lengths):
            return spans, found
        size = end - run + 1  # each run with the separator behind it
        offset = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(offset - run, size)
        index = FMIndex(seq[place], len(self.vocab))
        low, high = index.search(self.symbols, self.lengths)
        n = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(n)), n)
        rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
        at = place[index.locate(rows)]
        mark = np.zeros(len(seq) + 1, np.int32)
        np.add.at(mark, at, 1)
        np.add.at(mark, at + self.lengths[phrase], -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(mark) > 0).astype(np.int8), [0]]))
        for a, z in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist()):
            doc = int(np.searchsorted(starts, a, "right")) - 1
            base = int(starts[doc])
            spans[doc] += [a - base, z - base]
        doc = np.searchsorted(starts, at, "right") - 1
        for d, p in zip(*np.divmod(np.unique(doc * len(n) + phrase), max(1, len(n)))):
            found[d] += self.items[p]
        return spans, [sorted({self.names[k] for k in x}) for x in found]


def merged(spans: list[int], more: list[int]) -> list[int]:
    """Spans of words, as the union of two lists; touching spans become one."""
    out: list[int] = []
    for a, z in sorted(zip(spans[::2] + more[::2], spans[1::2] + more[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], z)
        else:
            out += [a, z]
    return out


def _search(items: list[tuple[str, str]], window: int, shard_words: int):
    """text, ..., n_words, spans, items in and out; the block's finds are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(items, window)
        held: list[tuple[pa.RecordBatch, list[list[bytes]]]] = []
        n = 0

        def shard() -> Iterator[pa.RecordBatch]:
            spans, found = phrases.find([t for _, texts in held for t in texts])
            done = 0
            for b, texts in held:
                k = len(texts)
                old_spans, old_items = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
                cols = [*b.columns[:-3], pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([merged(o, x) for o, x in zip(old_spans, spans[done:done + k])], pa.list_(pa.int64())),
                        pa.array([sorted({*o, *x}) for o, x in zip(old_items, found[done:done + k])],
                                 pa.list_(pa.string()))]
                done += k
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                b = batch.slice(s, 500)
                texts = [words(t) for t in b.column(0).to_pylist()]
                held.append((b, texts))
                n += sum(map(len, texts))
                if n >= shard_words:
                    yield from shard()
                    held, n = [], 0
        if held:
            yield from shard()

    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.coalesce("text", F.lit("")).alias("text")).distinct()


def _block(items: DataFrame, k: int, blocks: int) -> list[tuple[str, str]]:
    """The items of one block."""
    return [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row's finds of all blocks as one."""
    for b in batches:
        spans, items = [], []
        for each, names in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            out: list[int] = []
            for more in each:
                out = merged(out, more)
            spans.append(out)
            items.append(sorted({x for found in names for x in found}))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                                         ["number", "spans", "items"])


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """text, row (the document's other columns), n_words, spans (word numbers: start, end, ...), items."""
    nothing = [F.lit(0).cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("spans"),
               F.array().cast("array<string>").alias("items")]

    def search(rows: DataFrame, k: int) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
        return map_arrow(rows, _search(_block(items, k, blocks), window, shard_words), schema)

    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    items = _items(benchmark)
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    if blocks == 1:
        return search(docs.select("text", rest, *nothing), 0)
    numbered = written(docs.select("text", rest, F.monotonically_increasing_id().alias("number")), "numbered")
    rows = numbered.select("text", F.col("number").alias("row"), *nothing)
    first = written(search(rows, 0).select(F.col("row").alias("number"), "n_words", "spans", "items"), "finds")
    finds = first.select("number", "spans", "items").where(F.size("spans") > 0)
    for k in range(1, blocks):
        finds = finds.union(written(search(rows, k).where(F.size("spans") > 0).select(
            F.col("row").alias("number"), "spans", "items"), "finds"))
    each = finds.groupBy("number").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))  # an entry a block
    found = written(map_arrow(each, _together, "number long, spans array<long>, items array<string>"), "together")
    return (numbered.join(first.select("number", "n_words").hint("merge"), "number").join(found.hint("merge"), "number", "left")
            .select("text", "row", "n_words", *[F.coalesce(c, n).alias(c) for c, n in zip(("spans", "items"), nothing[1:])]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for text, spans in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if spans:
                at = [m.span() for m in WORD.finditer(text)]
                kept, last = [], 0
                for a, z in zip(spans[::2], spans[1::2]):
                    kept.append(text[last:at[a][0]])
                    last = at[z - 1][1]
                text = "".join([*kept, text[last:]])
            texts.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(1)], ["text", "row"])


def remove_passages(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, their columns as they were, without the words of benchmark passages."""
    found = find_passages(docs, benchmark, **options).select("text", "row", "spans")
    cut = map_arrow(found, _cut, T.StructType(found.schema.fields[:2]))
    return cut.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
