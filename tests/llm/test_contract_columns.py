"""The columns that the registered queries derive from their operators, against plain versions."""

import hashlib
import zlib

import brute
import numpy as np
from pyspark.sql import functions as F

from martlake.llm import huffman, langid, packing, pii, queries
from martlake.llm.tokens import load, vocabulary_path


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_op2_columns_and_nearest_centroid(spark, sf_dir):
    """Every prediction is the largest cosine of plainly computed vectors; held_out is the checksum's."""
    texts = texts_of(spark, sf_dir)
    rows = queries.op2_language_id(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    assert len(rows) == len(texts)
    centroids = model.centroids.astype(np.float64)
    assert np.allclose((centroids ** 2).sum(1), 1, atol=1e-5)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        n = langid.counts(langid.letters(texts[r.doc_id] or ""), langid.DIMENSIONS)
        if not (texts[r.doc_id] or "").strip():
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        v = np.where(n > 0, (1 + np.log(np.maximum(n, 1))) * model.idf, 0)
        cosines = centroids @ (v / np.linalg.norm(v))
        assert abs(cosines.max() - r.score) < 1e-4
        assert cosines[[k for k, lang in enumerate(model.langs) if lang == r.lang_pred]].max() > cosines.max() - 1e-4


def test_op5_columns(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    for r in queries.op5_personal_data(spark, sf_dir).collect():
        want = brute.personal_data(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.PATTERNS]
        base = ",".join(f"{k}:{a}:{z}" for k in pii.PATTERNS for a, z in want[k])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans.startswith(base)
        rest = [x.split(":") for x in r.spans[len(base):].split(",") if x]
        assert all(k == "term" and texts[r.doc_id][int(a):int(z)].isalpha() for k, a, z in rest)


def test_op10_columns(spark, sf_dir):
    texts, tokenizer = texts_of(spark, sf_dir), load(vocabulary_path("word_bpe_49k.json"))
    rows = queries.op10_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_step_groups_are_balanced(spark, sf_dir):
    """At the registered block size; the groups of a block differ by a sequence at most."""
    rows = packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path("byte_bpe_50k.json"),
                                  step_tokens=8192).groupBy("step_group").agg(F.sum("length").alias("n")).collect()
    loads = sorted(r.n for r in rows)
    assert len(loads) > 10 and loads[-1] - loads[0] <= packing.TIERS[-1]


def test_a_long_text_is_packed_over_many_sequences(spark):
    words = "alpha beta gamma delta epsilon " * 60_000
    df = spark.createDataFrame([(1, words), (2, "short")], "doc_id long, text string")
    rows = packing.pack_documents(df, vocabulary_path("byte_bpe_50k.json")).collect()
    ids = load(vocabulary_path("byte_bpe_50k.json")).encode(words, add_special_tokens=False).ids
    assert sum(r.length for r in rows if r.doc_id == 1) == len(ids) + 1
    assert all(r.ids_crc32 == zlib.crc32(np.array([*ids, 0], "<u4")[r.start:r.start + r.length]) for r in rows if r.doc_id == 1)


def test_a_vocabulary_of_more_than_16_bits():
    counts = np.random.default_rng(1).integers(1, 50, 70_000)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= 17 and abs((2.0 ** -lengths.astype(int)).sum() - 1) < 1e-9
    code, ids = huffman.Code(np.arange(70_000), lengths), np.random.default_rng(2).integers(0, 70_000, 3000)
    payload, at = code.encode(ids)
    assert (code.decode(payload, at, len(ids)) == ids).all()
