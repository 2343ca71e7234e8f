"""Token counts without token ids.

Pieces are counted by the tokenizers library once per distinct pre-token of the corpus; the counts are joined to
every document's pre-token frequencies and summed.

1. Each task cuts its texts into pre-tokens, and for shards of about ``shard_chars`` characters keeps a numbered
   list of the shard's distinct pre-tokens, and per document (pre-token number, frequency) pairs.
2. The shards' lists are dealt by pre-token and sorted, so that each distinct pre-token meets the library once.
3. The counts go back to their shards, where they are joined to the documents' frequencies.

A frequent pre-token costs one row a shard, not one a document, so no key is hot.

Defined results: a null text is empty (no bytes, no tokens); null doc_ids stay; repeated rows are counted each;
special strings inside a text count as the library's default has them (one token); other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, whole_text, written
from martlake.llm.tokens import SAFE, WORD_LEVEL, load

SHARD_CHARS = 24_000_000

SHARDS = ("shard long, doc_id long, n_bytes long, special long, freqs binary, local int, pretoken string")
_SHARDS = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("special", pa.int64()),
                     ("freqs", pa.binary()), ("local", pa.int32()), ("pretoken", pa.string())])


class PreTokens:
    """Pre-tokens of a text in the model's normal form, and how many special tokens stand between them."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(sorted(specials, key=len, reverse=True)) or r"(?!)")

    def __call__(self, text: str) -> tuple[list[str], int]:
        parts = self.special.split(text)
        if len(parts) == 1 and SAFE.fullmatch(text):
            return WORD_LEVEL.findall(text.lower()), 0
        out = []
        for part in parts:
            norm = self.tokenizer.normalizer.normalize_str(part)
            out += [norm[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm)]
        return out, len(parts) - 1


def _frequencies(path: str, shard_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut, shard = PreTokens(path), TaskContext.get().partitionId() << 24
        vocab: dict[str, int] = defaultdict()
        vocab.default_factory = vocab.__len__
        chars = 0

        def listed() -> pa.RecordBatch:
            n = len(vocab)
            none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, shard)), *none, pa.array(np.arange(n, dtype=np.int32)),
                                               pa.array(list(vocab), pa.string())], schema=_SHARDS)

        for b in batches:
            special, freqs = [], []
            for text in b.column(2).to_pylist():
                pieces, extra = cut(text)
                idx, n = np.unique(np.array(list(map(vocab.__getitem__, pieces)), np.uint32), return_counts=True)
                both = np.concatenate([np.diff(idx, prepend=np.uint32(0)).astype("<u4"), n.astype("<u4")])
                freqs.append(zlib.compress(both.tobytes(), 1))
                special.append(extra)
                chars += len(text)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard)), b.column(0), b.column(1), pa.array(special, pa.int64()),
                 pa.array(freqs, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], schema=_SHARDS)
            if chars >= shard_chars:
                yield listed()
                vocab.clear()
                shard, chars = shard + 1, 0
        if vocab:
            yield listed()

    return run


def _count_pieces(path: str, hold: int = 200_000):
    """Sorted pre-tokens in, packed (number, pieces) pairs a shard out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        last: tuple[str, int] = ("", 0)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            shard, local, n = (np.concatenate(x) for x in zip(*parts))
            by = np.argsort(shard, kind="stable")
            shard, both = shard[by], np.stack([local[by], n[by]], 1).astype("<u4")
            cut = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
            rows = [both[a:z].tobytes() for a, z in zip(cut, [*cut[1:], len(shard)])]
            return pa.RecordBatch.from_arrays([pa.array(shard[cut]), pa.array(rows, pa.binary())], ["shard", "counts"])

        for b in batches:
            d = b.column(2).dictionary_encode()
            words = d.dictionary.to_pylist()
            sizes = [len(e.ids) for e in tokenizer.encode_batch_fast([w for w in words if w != last[0]],
                                                                     add_special_tokens=False)]
            if words and words[0] == last[0] and len(sizes) < len(words):
                sizes.insert(0, last[1])
            if words:
                last = (words[-1], sizes[-1])
            parts.append((b.column(0).to_numpy(), b.column(1).to_numpy(),
                          np.array(sizes, np.int64)[d.indices.to_numpy()]))
            if sum(len(p[0]) for p in parts) >= hold:
                yield packed()
                parts = []
        if parts and sum(len(p[0]) for p in parts):
            yield packed()

    return run


def _sum_shard(docs: pa.Table, counts: pa.Table) -> pa.Table:
    pairs = np.frombuffer(b"".join(counts.column("counts").to_pylist()), "<u4").reshape(-1, 2)
    pieces = np.zeros(int(pairs[:, 0].max()) + 1 if len(pairs) else 0, np.int64)
    pieces[pairs[:, 0]] = pairs[:, 1]
    total = []
    for freqs, special in zip(docs.column("freqs").to_pylist(), docs.column("special").to_pylist()):
        idx, n = np.frombuffer(zlib.decompress(freqs), "<u4").reshape(2, -1)
        total.append(int((pieces[np.cumsum(idx)] * n).sum()) + special)
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": docs.column("n_bytes"),
                     "n_tokens": pa.array(total, pa.int64())})


def count_tokens(docs: DataFrame, path: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(whole_text()).cast("long").alias("n_bytes"), whole_text().alias("text"))
    staged = written(map_arrow(rows, _frequencies(path, shard_chars), SHARDS), "pretokens")
    listed = staged.where("pretoken IS NOT NULL").select("shard", "local", "pretoken")
    dealt = listed.repartition("pretoken").sortWithinPartitions("pretoken")
    counts = map_arrow(dealt, _count_pieces(path), "shard long, counts binary")
    freqs = staged.where("pretoken IS NULL").select("shard", "doc_id", "n_bytes", "special", "freqs")
    return freqs.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(
        _sum_shard, "doc_id long, n_bytes long, n_tokens long")
