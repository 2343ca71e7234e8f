import zlib

import numpy as np
import pytest
from conftest import pairs

from martlake.llm import huffman, packing, tokencount
from martlake.llm.tokens import encoder, load, vocabulary_path
from martlake.session import scratch_path

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")


def expected(docs, path):
    tokenizer = load(path)
    return [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
            for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("text", ["", "a", "it's  DON'T\n\n x_y \t__ 12,345.67…“q”", "é ñ ß Ñ ÀÉ", "½ İ ſ \x85 　 ﬁ",
                                  "<|endoftext|>a", "'S 'll ''t", "a\nb\n\n c \n"])
def test_encoder_is_the_library(text):
    enc = encoder(BYTES)
    assert np.frombuffer(enc.ids([text])[0], enc.dtype).tolist() == load(BYTES).encode(text, add_special_tokens=False).ids


def test_packing_covers_every_id_without_padding(docs, none):
    rows = packing.pack_documents(docs, BYTES, block_tokens=20_000, step_tokens=4096).collect()
    ids = {}
    for doc, t in expected(docs, BYTES):
        ids.setdefault(doc, []).append(np.array(t + [0], "<u4"))
    by_doc, by_seq, groups = {}, {}, {}
    for r in rows:
        assert any(zlib.crc32(x[r.start:r.start + r.length]) == r.ids_crc32 and len(x) == r.doc_tokens for x in ids[r.doc_id])
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc == {d: sum(map(len, x)) for d, x in ids.items()}
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == np.concatenate([[0], np.cumsum([r.length for r in seq])[:-1]]).tolist()
        size = sum(r.length for r in seq)
        assert size == seq[0].context <= 1024 and size & (size - 1) == 0
        groups[seq[0].step_group] = groups.get(seq[0].step_group, 0) + size
    assert packing.pack_documents(none, BYTES).count() == 0


def test_tiers_are_filled_from_shorter_ones():
    packed = packing.pack([900, 100, 60, 300, 700, 2050, 5], packing.TIERS)
    assert sum(n for n, _ in packed) == 4115 and [n for n, _ in packed[:2]] == [1024, 1024]
    assert all(sum(length for _, _, length in w) == n for n, w in packed)
    loads = packing.step_groups([1024] * 7 + [512] * 3, 2048)
    assert max(loads) == 4


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    counts = (rng.pareto(0.6, 3000) * 10 + 1).astype(np.int64)
    lengths = huffman.code_lengths(counts, 14)
    assert lengths.max() <= 14 and abs(sum(2.0 ** -lengths.astype(int)) - 1) < 1e-9
    free = huffman.code_lengths(np.array([5, 9, 12, 13, 16, 45]), 16)
    assert (free * [5, 9, 12, 13, 16, 45]).sum() == 224
    code, ids = huffman.Code(np.arange(3000), lengths), rng.integers(0, 3000, 5000)
    for n in (0, 1, 511, 512, 513, 5000):
        payload, at = code.encode(ids[:n])
        assert (code.decode(payload, at, n) == ids[:n]).all()


def test_token_files_round_trip(spark, docs, none):
    folder = scratch_path(spark, "files")
    huffman.write_files(docs, BYTES, folder, block_tokens=5000)
    want = sorted(((d, t + [0]) for d, t in expected(docs, BYTES)), key=str)
    assert sorted(((r.doc_id, r.ids) for r in huffman.read_documents(spark, folder).collect()), key=str) == want
    rows = sorted(huffman.read_digests(spark, folder).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: -1 if d is None else d)
    assert pairs(huffman.read_digests(spark, folder), "doc_id", "n_tokens", "ids_crc32") == sorted(
        ((d, len(t), zlib.crc32(np.array(t, "<u4"))) for d, t in want), key=str)
    folder = scratch_path(spark, "files")
    huffman.write_files(none, BYTES, folder)
    assert huffman.read_digests(spark, folder).count() == 0


def test_token_counts_are_the_library(docs, none):
    want = sorted(((d, len(t)) for d, t in expected(docs, WORDS)), key=str)
    assert pairs(tokencount.count_tokens(docs, WORDS, shard_chars=2000), "doc_id", "n_tokens") == want
    assert tokencount.count_tokens(none, WORDS).count() == 0
