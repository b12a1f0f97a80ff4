"""Byte-level BPE against the tokenizer library, and decoding as an exact round trip."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from vaultmart.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def blob():
    return open(PATH, "rb").read()


@pytest.fixture(scope="module")
def library(blob):
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(blob), special_tokens={})


@pytest.fixture(scope="module")
def encoder(blob):
    return bpe.Encoder(blob, bpe.class_runs())


CASES = ["", " ", "  ", "a", "don't they're we've I'll 'tis ''s 's's !'s x's'll 've", "a  b   c\n\n d \t e  ", " x 　　y",
         "naïve ñ 你好 世界 Ⅷ ½ 12,345", "😀😀 á", "a" * 3000, " " * 2000 + "x", "'" * 50 + "s", "<|endoftext|>",
         "\x00\x1c \x1dx", "x   y ", "'re'", "'l", "'", " 're 'r"]


def random_texts(n):
    rng = random.Random(7)
    pool = list("stmdrvel'' \t\n aZé你9½!_#😀") + ["  ", "'ll", "'re", " '"]
    return ["".join(rng.choices(pool, k=rng.randint(0, 700))) for _ in range(n)]


def test_ids_and_offsets_equal_the_library(encoder, library):
    texts = CASES + random_texts(300)
    ids, n_ids, id_ends, char_ends, n_tokens = encoder.encode_texts(texts)
    i = k = 0
    for text, n, m in zip(texts, n_ids, n_tokens):
        assert ids[i:i + n].tolist() == library.encode_ordinary(text)
        a = b = 0
        for e, c in zip(id_ends[k:k + m].tolist(), char_ends[k:k + m].tolist()):
            assert library.decode_bytes(ids[i + a:i + e].tolist()).decode() == text[b:c]
            a, b = e, c
        i, k = i + n, k + m


def test_pieces_carry_the_state(encoder):
    text = "".join(random_texts(40))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    whole = bpe.boundaries(points, encoder.table)
    for piece in (1, 7, 300, 4097):
        assert bpe.boundaries(points, encoder.table, piece).tolist() == whole.tolist()


def test_long_pre_token_is_merged_like_the_library(encoder, library):
    text = "".join(random.Random(1).choices("abcdefg", k=60_000))
    assert encoder.encode_texts([text])[0].tolist() == library.encode_ordinary(text)


def test_dataframe_round_trip(spark, library):
    rows = [(i, t, i * 10) for i, t in enumerate([None, *CASES, *random_texts(50)])]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, ids long")
    out = docs.withColumn("e", bpe.encode(F.col("text"), PATH)).withColumn("back", bpe.decode(F.col("e.ids"), PATH))
    assert out.columns == ["doc_id", "text", "ids", "e", "back"]
    got = out.collect()
    assert len(got) == len(rows) + 5
    for r in got:
        assert r.e.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.back).decode() == (r.text or "")
        assert r.ids == r.doc_id * 10
    assert out.limit(0).count() == 0 and docs.filter("doc_id < 0").select(bpe.encode(F.col("text"), PATH)).count() == 0
