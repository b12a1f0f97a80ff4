"""The pipeline: each stage against a brute-force version on its own input, and the whole on odd rows."""

import os
import re
import sys

import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as cp  # noqa: E402
from test_decontaminate import dc  # noqa: E402
from test_line_dedup import brute as brute_lines  # noqa: E402
from test_simhash import brute_fingerprint, brute_roots  # noqa: E402

from vaultmart.llm import bpe  # noqa: E402
from vaultmart.llm.oracle import quality_sql  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the whole table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in cp.STAGES:
        rows = docs.collect()
        docs = stage(spark, docs, SF).cache()
        out.append((rows, docs.collect(), docs.columns))
    return out


def test_columns(stages):
    assert [c for _, _, c in stages[:-1]] == [COLUMNS] * 4 and "doc_id" in stages[-1][2]


def test_quality(stages):
    import duckdb
    before, after, _ = stages[0]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    kept = {r[0] for r in con.execute(f"select doc_id from ({quality_sql()}) where kept").fetchall()}
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if r.doc_id in kept) and 0 < len(kept) < len(before)


def test_lines(stages):
    before, after, _ = stages[1]
    want = {d: t for d, t, _, _ in brute_lines([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == want and len(after) == len(before)
    assert all(r.n_chars == len(r.text) for r in after)
    assert sum(r.n_chars for r in after) < sum(len(r.text) for r in before)


def test_near_duplicates(stages):
    before, after, _ = stages[2]
    roots = brute_roots({brute_fingerprint(r.text) for r in before})
    least = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        least.setdefault(roots[brute_fingerprint(r.text)], tuple(r))
    assert sorted(map(tuple, after)) == sorted(least.values()) and len(after) < len(before)


def test_benchmark(spark, stages):
    before, after, _ = stages[3]
    tests = [t for _, t in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = lambda t: " ".join(w for w in map(dc.normal, t.split()) if w)
    leaked = {r.doc_id for r in before if any(f" {flat(t)} " in f" {flat(r.text)} " for t in tests)}
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if r.doc_id not in leaked) and leaked


def test_tokens(stages):
    before, after, _ = stages[4]
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=bpe.parse_ranks(
        open(P.path(cp.BPE_RANKS), "rb").read()))
    assert {r.doc_id: (r.ids, r.n_tokens, r.round_trip) for r in after} == {
        r.doc_id: (i, len(i), True) for r in before for i in [library.encode_ordinary(r.text or "")]}


def test_run_on_odd_rows(spark, tmp_path):
    clean = " ".join(f"word{k}" for k in range(60))
    rows = [(1, clean, "en", "a", 1), (1, clean, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
            (None, clean.replace("word", "other"), "en", "a", 5), (4, clean + "\n" + clean.replace("word", "more"), "en", "a", 9),
            (5, " ".join(f"long{k}" for k in range(40_000)), "en", "a", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 4, 5] and all(r.round_trip for r in got)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_stage_list():
    assert 4 <= len(cp.STAGES) <= 5 and all(re.match(r"\S", n) and callable(f) for n, f in cp.STAGES)
