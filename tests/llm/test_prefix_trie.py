"""Conversation prefix trie against a dictionary of all prefixes."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vaultmart.llm import ordered, prefix_trie
from vaultmart.llm.common import SPACE_BYTES
from vaultmart.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def n_words(text):
    return len([w for w in text.encode().translate(bytes.maketrans(SPACE_BYTES, b" " * len(SPACE_BYTES))).split(b" ") if w])


def sequences(rows):
    """Turns by conversation in the operator's order."""
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by.setdefault(conv, []).append(((turn is not None, turn or 0), role, tie, text))
    return {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in by.items()}


def borrowed(by):
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = by.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    return out


def brute(by):
    members = {}
    for c, turns in by.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = sorted(c for c in convs if len(by[c]) == len(node))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(m) == len(node) + 1 for m in below),
            sum(all(len(by[c]) == len(m) for c in members[m]) for m in below),
            sum((len(members[m]) - 1) * n_words(m[-1][1]) for m in below if m),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def rows_of(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def make(seed):
    rng = random.Random(seed)
    texts = ["a b", "a  b\n c", "", None, "x", "long " * 3000, "ä ö"]
    rows = []
    for c in rng.sample(range(-30, 90), 60):
        for _ in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(7, k, "user", "tail %d" % k) for k in range(40)] + [(7, 3, "user", "tail 3")] * 5
    rows += [(c, 0, "user", "copy") for c in range(200, 230)] + [(None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("seed,bits,segment", [(1, 14, 12), (2, 16, 2), (3, 14, 1)])
def test_against_all_prefixes(spark, monkeypatch, seed, bits, segment):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", segment)  # short segments split most conversations
    rows = make(seed)
    convs, steps = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert rows_of(prefix_trie.build(convs, prefix_trie.borrow_heads(convs, steps), bits)) == brute(borrowed(sequences(rows)))


def test_full_sketch_lets_all_through(spark, monkeypatch):
    """Every cell hit twice: all prefixes are grouped exactly, and the result is the same."""
    rows = make(4)
    monkeypatch.setattr(prefix_trie, "possibly_shared", lambda df, bits: b"\xff" * ((prefix_trie.ROWS << bits) // 8))
    convs, steps = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(prefix_trie.build(convs, steps, 14)) == brute(sequences(rows))


def test_estimates_are_never_too_small(spark):
    rows = [(c, d, f"{c}", None) for c in range(300) for d in range(3)] + [(1000 + c, 0, "same", None) for c in range(50)]
    convs, steps = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA))
    screened = prefix_trie.screen(prefix_trie.prefixes(steps), 14)
    assert screened.where("single and conv_id >= 1000").count() == 0
    assert screened.where("single and conv_id < 1000").count() > 800  # and most singletons are proven


def test_one_conversation_holds_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", 4)
    turns = spark.range(0, 3000, 1, 6).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t "), F.col("id") % 3).alias("text"))
    convs, steps = prefix_trie.number_turns(turns)
    got = prefix_trie.build(convs, steps).collect()
    assert sorted(r.depth for r in got) == list(range(3001))
    assert all(r.n_convs == 1 and r.n_leaves == 1 and r.saved_tokens == 0 and r.n_children == (r.depth < 3000) for r in got)


def test_empty_and_clashing_columns(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.build(*prefix_trie.number_turns(empty)).count() == 0
    only_null = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert prefix_trie.build(*prefix_trie.number_turns(only_null)).count() == 0
    rows = make(5)
    clash = spark.createDataFrame(rows, SCHEMA)
    for name in ("d", "x1", "seg", "at", "n_convs", "digest", "words", "TURN_", "h", "base"):
        clash = clash.withColumn(name, F.lit("other"))
    clash.write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows_of(op11_prefix_trie(spark, str(tmp_path))) == brute(borrowed(sequences(rows)))
