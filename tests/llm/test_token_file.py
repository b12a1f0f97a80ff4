"""The token file against the tokenizers library, and its codes as an exact round trip."""

import os
import struct
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultmart.llm import token_file as tf

MODEL = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 0, 65535, 65536, 2**32 - 1], list(range(0, 70_000, 7))])
def test_shard_round_trip_and_random_access(ids):
    ids = np.array(ids, np.uint32)
    ends = np.array([len(ids) // 3, len(ids) // 3, len(ids)], np.int64)
    shard = tf.Shard(tf.encode_shard(ids, ends))
    assert shard.ids().tolist() == ids.tolist()
    assert [shard.access(i) for i in range(0, len(ids), max(1, len(ids) // 300))] == \
        ids[::max(1, len(ids) // 300)].tolist()
    assert shard.document(1).size == 0
    with pytest.raises(IndexError):
        shard.access(len(ids))


def test_files_give_back_the_library_ids(spark):
    texts = [None, "", "  ", "Don't STOP\n\nnow  é é Straße ÑANDÚ", "你好 世界 123", "a\tb c d\x0be <|x|>", "ΑΣ ΑΣ.",
             "word " * 5000, "x" * 3000, "Same", "Same"]
    rows = [(i * 3 % 11, t, "n") for i, t in enumerate(texts)] + [(None, "null id", "n"), (4, "again", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    library = Tokenizer.from_file(MODEL)
    got = tf.round_trip(docs, MODEL, end_id=1).collect()
    assert len(got) == len(rows)
    want = sorted((d is not None, d or 0, struct.pack(f"<{len(x) + 1}I", *x, 1)) for d, t, _ in rows
                  for x in [library.encode(t or "", add_special_tokens=False).ids])
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    assert tf.round_trip(docs.limit(0), MODEL, end_id=1).count() == 0


def test_query_equals_library_over_a_whole_table(spark):
    from vaultmart.llm.queries import op7_token_file
    library = Tokenizer.from_file(MODEL)
    start = 0
    got = {r.doc_id: r for r in op7_token_file(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_many_shards_per_partition(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("one two "), 10).alias("text"))
    path = tf.new_run_dir(spark, "token-file-test")
    tf.write_token_file(docs, MODEL, 1, path, shard_ids=100)
    assert spark.read.parquet(path).count() > 50
    starts = [r.start for r in tf.read_token_file(spark, path).orderBy("doc_id").collect()]
    assert starts == [21 * k for k in range(400)]


def test_stretches_that_differ_in_case_and_stops_share_a_word():
    path = MODEL
    encoder, library = tf.WordEncoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    assert encoder.encode_texts(pa.array(["Straße straße, STRAßE. straße?! foo Foo; FOO"]), 1)
    assert set(encoder.stretches.young) == {"straße", "foo"}
    odd = ["Été été. ÉTÉ, été. é.", "İstanbul istanbul. ªº µm, µm ×a a÷, Ωmega Ωmega.", "don't Don't. a1 A1, .a a. ... ,", "ÿ Ÿ, ﬁn K, Å. ǅ", None, "",
           "x̧, Ç ç. Ȩ́! a\tb.\r\nC, d.", "क़. क़", "ß ẞ. ﬀ,"]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_texts(pa.array(odd), 1)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids + [1] for t in odd]


def test_a_worker_has_one_thread_and_gives_memory_back():
    code = """
import types, pyarrow as pa
from vaultmart.llm import token_file as tf
threads = lambda: int(open("/proc/self/status").read().split("Threads:")[1].split()[0])
before = threads()
encoder = tf.worker_encoder(1, types.SimpleNamespace(value=open({model!r}, encoding="utf-8").read()))
assert tf.worker_encoder(1, None) is encoder
for k in range(4):
    encoder.encode_texts(pa.array([f"a{{k}}.{{i}} x{{i}}y 你{{i}}" for i in range(5000)]), 1)
print(threads() - before, pa.default_memory_pool().backend_name)
""".format(model=MODEL)
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "ARROW_DEFAULT_MEMORY_POOL")}
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], env=env | {"PYTHONPATH": root}, capture_output=True, text=True, check=True).stdout
    assert out.split() == ["0", "system"]
