"""A corpus pipeline over the documents table: five stages, each written and read again.

Every stage works on all documents that the one before kept, and all but the last return the
columns of documents. Toxic documents go, lines that an earlier document holds go, one document
of each group of near copies stays, documents with benchmark passages go, and what is left is
encoded and decoded. Documents are told apart by doc_id; rows with the same doc_id stay or go
together, except that toxicity is judged row by row. Null text passes every filter.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.llm import bpe, decontaminate, line_dedup, near_dedup, toxicity
from shopstat.llm.common import stored
from shopstat.llm.queries import table, tokenizer


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score one half or more."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines of earlier documents; n_chars counts the text that is left."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids and the digests of ids and decoded text."""
    out = bpe.encode_decode(docs.select("doc_id", "text"), tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
          ("decontaminate", decontaminate_stage), ("bpe", bpe_stage)]

#: The first stage learns a classifier, which SQL cannot express; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
