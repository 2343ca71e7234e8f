"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import langid, licenses, merkle, pii, warc
from martlake.llm.ann import nearest
from martlake.llm.audit import audit
from martlake.llm.common import table
from martlake.llm.fmindex import find_passages
from martlake.llm.huffman import read_digests, write_files
from martlake.llm.neardup import near_duplicates
from martlake.llm.packing import pack_documents
from martlake.llm.setjoin import jaccard_join
from martlake.llm.tokencount import count_tokens
from martlake.llm.tokens import vocabulary_path
from martlake.session import scratch_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archive(pages.select(F.col("page_id").alias("id"), F.col("url").alias("uri"),
                                    F.encode("html", "UTF-8").alias("payload")), folder)
    return warc.read_digests(spark, folder).withColumnRenamed("id", "page_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("text", "doc_id"), model, F.col("doc_id"))
    return found.select(F.col("row").alias("doc_id"), langid.held_out(F.col("row")).alias("held_out"), "lang_pred",
                        "score", "rejected")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = list(pii.PATTERNS)
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
                        F.sha2(pii.joined(*kinds), 256).alias("base_sha256"), pii.joined(*kinds, "term").alias("spans"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, share=85)


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_files")
    write_files(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), folder)
    return read_digests(spark, folder)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.sequence(F.lit(1), F.size("spans"), F.lit(1)), F.lit(0).cast("long"),
                      lambda n, k: n + F.element_at("spans", k) * F.when(k % 2 == 0, 1).otherwise(-1))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.when(F.size("spans") > 0, hit).otherwise(0).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "manifest")
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = merkle.leaf_digest([F.col(c) for c in fields])
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf_digest([*(F.col(c) for c in fields[:-1]), lowered])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    merkle.write_manifest(docs.select(F.col("lang").alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
                                      leaf.alias("leaf"), F.when(chosen, tampered).otherwise(leaf).alias("presented")), folder)
    return merkle.verify(spark, folder)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, share=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_licenses": op3_licenses,
    "op4_packing": op4_packing,
    "op5_personal_data": op5_personal_data,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_nearest": op7_nearest,
    "op8_token_files": op8_token_files,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_ngram_join": op13_ngram_join,
}
