"""The training-data pipeline: each stage calls one operator over all its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents.  `run` writes each result as Parquet in the cluster's shared folder and rereads it, so a lost
executor costs at most the stage it was working on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from vaultmart.llm.common import new_run_dir, read_documents
from vaultmart.llm.queries import BPE_RANKS, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that are rejected go."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that repeat an earlier one, within one word, go; documents stay."""
    return line_dedup.dedup_lines(docs, chars_col="n_chars").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that contain a test item go."""
    return decontaminate.drop_contaminated(docs, read_documents(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the ids of every text, checked by decoding them."""
    path = tokenizer_path(BPE_RANKS)
    encoded = docs.select("doc_id", "lang", "source", "text", bpe.encode(F.col("text"), path).alias("e"))
    back = bpe.decode(F.col("e.ids"), path)
    return encoded.select("doc_id", "lang", "source", F.col("e.ids").alias("ids"),
                          F.size("e.ids").cast("long").alias("n_tokens"),
                          (back == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]
# SQL cannot express fingerprints, retrieval and merging; tests/llm/test_pipeline.py holds every stage
# against its brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    root = new_run_dir(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
