"""A corpus from raw documents to token ids: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir), `docs` having the columns of the table `documents`, and give a DataFrame that is
written as Parquet and read again as the next stage's `docs`. All but the last keep these columns; other columns of
`docs` pass through as far as the last stage. Defined results for nulls, empty texts, ties, repeated rows and empty
tables are those of the operators; a row without id is never a duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio.llm import bpe, decontam, line_dedup, minhash, quality
from tablefolio.llm.common import fresh_folder
from tablefolio.llm.queries import tokenizer_path
from tablefolio.plans.catalogue import table

NEAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within the limit of their language."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks they share with earlier ones; a document that has nothing else goes."""
    out = line_dedup.dedup_lines(docs)
    left = F.col("deleted_lines").isNull() | (F.length("text") > 0)
    size = F.when(F.col("deleted_lines").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long")
    return out.where(left).withColumn("n_chars", size).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    gone = minhash.near_duplicates(docs, percent=NEAR_PERCENT).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of each document, and of the text decoded from them."""
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_shared_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", token_ids),
]
ORACLE_SQL = None  # perplexity, patience diff and BPE have no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        folder = fresh_folder(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
