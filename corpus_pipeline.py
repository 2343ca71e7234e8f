"""The corpus pipeline over ``documents``: language, near duplicates, benchmark passages, personal data, packing.

Every stage but the last returns the columns of ``documents``; where a text changes, ``n_chars`` is its new length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import langid, pii
from martlake.llm.common import table, written
from martlake.llm.fmindex import remove_passages
from martlake.llm.neardup import one_of_each
from martlake.llm.packing import pack_documents
from martlake.llm.tokens import vocabulary_path
from martlake.session import scratch_path

#: Near duplicates of the pipeline: five words, a Jaccard similarity of 0.8.
SHINGLE_WORDS, SIMILARITY, MINHASHES_A_KEY, RECALL = 5, 80, 2, 0.999


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; a text without letters (null and empty ones too) or far from every centroid
    goes.  Rows are judged one by one, so repeated rows and ids share their fate; an empty table stays empty."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    kept = langid.predict(docs, model).where("NOT rejected")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id (a document without one only if the group has no
    other).  Rows that share a doc_id or have none are told apart by their texts alone; texts without words (null and
    empty ones too) all stay; an empty table stays empty; other columns are kept whatever their names."""
    return one_of_each(docs, SHINGLE_WORDS, SIMILARITY, MINHASHES_A_KEY, RECALL)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the words of benchmark passages.  All rows stay, null texts as null, and each is searched
    whole; an empty table or benchmark changes nothing."""
    return _sized(remove_passages(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data and disclosing terms replaced.  All rows stay, null texts as null, repeated
    rows alike; an empty table stays empty."""
    return _sized(pii.sanitise(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece of the kept documents: a null or empty text is its end id alone, repeated rows are
    documents of their own, a very long text is cut over several sequences, an empty table gives no rows."""
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicate), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]

#: Token ids of a public vocabulary can't be had in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
