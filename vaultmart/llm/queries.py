"""The registered queries of the operators: whole tables in, contract columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm import bpe, decontaminate, language_model, license_scan, line_dedup, prefix_trie, quality_rules, repair, sharding, simhash, token_counts, token_file, url_filter
from vaultmart.llm.common import read_documents


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


PIECES = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    path = model_path or tokenizer_path(PIECES)
    return docs.select("doc_id", token_counts.token_counts(F.col("text"), path).alias("n_tokens"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per licence paragraph of every text."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    found = license_scan.scan(F.col("text"), license_scan.train(docs))
    return docs.select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return quality_rules.quality_verdicts(docs, keep=["doc_id", "lang", "source"])


BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op4_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Ids and decoded bytes of every text, as digests."""
    path = ranks_path or tokenizer_path(BPE_RANKS)
    docs = read_documents(spark, sf_dir).select("doc_id", bpe.encode(F.col("text"), path).alias("e"))
    back = docs.select("doc_id", "e.ids", bpe.decode(F.col("e.ids"), path).alias("bytes"))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read_documents(spark, sf_dir))


WORD_BPE = "word_bpe_49k.json"


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op7_token_file(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Ids written in directly addressable codes, read back, as start, count and checksum."""
    path = model_path or tokenizer_path(WORD_BPE)
    back = token_file.round_trip(read_documents(spark, sf_dir), path, end_id=1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir), shingle=3, radius=3)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_documents(spark, sf_dir), shards=8)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the conversations' prefix trie, each conversation with its borrowed head."""
    convs, steps = prefix_trie.number_turns(read_documents(spark, sf_dir, "conversations"))
    return prefix_trie.build(convs, prefix_trie.borrow_heads(convs, steps))


# The rules of the contract (host, path, action).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(read_documents(spark, sf_dir, "pages"), url_filter.write_rules(spark, rules))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation once damaged."""
    turns = read_documents(spark, sf_dir, "conversations")
    return repair.repair_reports(turns, repair.damage(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_model": op6_language_model,
    "op7_token_file": op7_token_file,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_url_filter": op12_url_filter,
    "op13_conversation_repair": op13_conversation_repair,
}
