"""Operators over tables whose other columns carry the names they use themselves, and over very long texts."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from vaultmart.llm import language_model, sharding, simhash, token_file

NAMES = ("n", "key", "part", "size", "row", "seg", "fingerprint", "component_id", "shard", "slot", "symbols", "held_out", "start",
         "payload", "word", "c", "marked", "fp", "doc")


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(k, f"text number {k % 7} of some words here") for k in range(40)] + [(50, None), (51, ""), (52, "w " * 200_000), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def odd(plain):
    for name in NAMES:
        plain = plain.withColumn(name, F.lit("other"))
    return plain


def same(a, b, digits=6):
    key = lambda r: tuple(round(x, digits) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, a.collect()), key=repr) == sorted(map(key, b.collect()), key=repr)


def test_columns_of_the_same_names(spark, plain, odd):
    same(simhash.near_duplicates(plain), simhash.near_duplicates(odd))
    same(sharding.assign_shards(plain), sharding.assign_shards(odd))
    path = P.path("word_bpe_49k.json")
    same(token_file.round_trip(plain, path, end_id=1), token_file.round_trip(odd, path, end_id=1))
    same(language_model.score_documents(plain), language_model.score_documents(odd), 3)
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    same(kept.select("doc_id", "text"), simhash.drop_near_duplicates(plain))
