"""Token counts against a plain search over all segmentations."""

import functools
import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from vaultmart.llm import token_counts as tc

MODEL = P.path("piece_bpe_32k.model")


def brute(scores, word, byte_cost):
    text = tc.MARK + word

    @functools.cache
    def best(end):  # (score, -tokens) of the best segmentation of text[:end]
        if end == 0:
            return 0.0, 0
        found = []
        for begin in range(end):
            s, n = best(begin)
            piece = text[begin:end]
            if piece in scores:
                found.append((s + scores[piece], n - 1))
            if len(piece) == 1 and piece not in scores:
                size = len(piece.encode())
                found.append((s + size * byte_cost, n - size))
        return max(found)
    return -best(len(text))[1]


def test_small_vocabulary():
    scores = {tc.MARK: -3.0, tc.MARK + "a": -4.0, "a": -2.0, "b": -2.5, "ab": -4.5, "aba": -5.0, "ba": -4.0, "bb": -9.0}
    rng = random.Random(2)
    words = list({"".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(400)})
    counter = tc.Counter(scores)
    got = counter.count_many(words)
    assert got == {w: brute(scores, w, counter.byte_cost) for w in words}
    assert all(counter.count_many([w]) == {w: n} for w, n in got.items())  # alone, no node is shared
    long = ["ab" * 400, "ab" * 400 + "é", "ab" * 399 + "b", "ab" * 400 + "b", "a"]
    assert counter.count_many(long) == {w: counter.count_many([w])[w] for w in long}
    assert counter.count_many([]) == {} and counter.count_many(["ab" * 40])["ab" * 40] == brute(scores, "ab" * 40, counter.byte_cost)


@pytest.fixture(scope="module")
def scores():
    return tc.piece_scores(open(MODEL, "rb").read())


def test_tables(spark, scores):
    texts = [None, "", " \n", "one", "One one\tone", "你好 x y", "w" * 300, "naïve Straße 😀 " * 300]
    rows = [(k, t, 5) for k, t in enumerate(texts)] + [(3, "one", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    byte_cost = min(scores.values()) - 1
    count = functools.cache(lambda w: brute(scores, w, byte_cost))
    got = docs.select("doc_id", "text", tc.token_counts(F.col("text"), MODEL).alias("n")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = [w.decode() for w in (r.text or "").encode().split()]
        assert r.n == sum(count(w) for w in words)
    assert docs.limit(0).select(tc.token_counts(F.col("text"), MODEL)).count() == 0


def test_whole_table(spark, scores):
    from vaultmart.llm.queries import op1_token_counts
    sf = "/root/testdata/sf0.001"
    byte_cost = min(scores.values()) - 1
    count = functools.cache(lambda w: brute(scores, w, byte_cost))
    got = {r.doc_id: r.n_tokens for r in op1_token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs[:60]:
        assert got[d.doc_id] == sum(count(w.decode()) for w in (d.text or "").encode().split())
