"""Quality counts, sketches and verdicts."""

import pytest
from pyspark.sql import functions as F

from vaultmart.llm import quality_rules as q


def brute_counts(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    lines = [x for x in t.split("\n") if x.encode().split()]
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    cover = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(cover))


TEXTS = [None, "", " \n\t ", "a", "a b", "a b c a b c", "x x x x x", "x x x", "é ñ# $%\n&|\n&|\n \n", "a b c d a b c e b c d",
         "long " * 4000, "one two three\none two three\n", "  y z"]


def test_counts(spark):
    rows = [(k, t, "n", 5) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows + rows[:4], "doc_id long, text string, w string, n_words long")
    got = q.document_counts(docs).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        if r.doc_id != 10:
            assert tuple(r[c] for c in q.COUNTS) == brute_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert [r.n_repeat_words for r in got if r.doc_id == 10] == [4000]


def test_cells_bound_the_error(spark):
    got = spark.range(0, 200_000, 7).select("id", F.expr(q.cell("id")).alias("c")).collect()
    assert all(r.id <= r.c <= r.id * (1 + 1 / 32) for r in got)


def test_sketches_merge(spark):
    def counts(low, high):
        return spark.range(low, high).select(
            F.lit("en").alias("lang"), (F.col("id") % 3).cast("string").alias("source"), F.lit(False).alias("base_failed"),
            F.lit(100).alias("n_words"), (F.col("id") + 100).alias("word_chars"), F.lit(0).alias("n_symbols"),
            F.lit(4).alias("n_lines"), F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words"))
    parts = q.sketches(counts(0, 1700)).unionByName(q.sketches(counts(1700, 3000)))
    merged = q._quartiles(parts, ["lang"]).filter("ratio = 'word_len'").first()
    assert merged == q._quartiles(q.sketches(counts(0, 3000)), ["lang"]).filter("ratio = 'word_len'").first()
    assert merged.docs == 3000
    assert 849 <= merged.q1 <= 849 * 33 / 32 and 2349 <= merged.q3 <= 2349 * 33 / 32


@pytest.fixture(scope="module")
def corpus(spark):
    clean = " ".join(f"word{k}" for k in range(80))
    rows = [(k, clean.replace("word7 ", f"w{k} "), "en", "hot" if k % 3 else "small") for k in range(90)]
    rows += [(100, clean.replace(" ", "$$$ "), "en", "hot"), (101, clean.replace(" ", "$$$ "), "xx", "alone"),
             (102, None, None, None), (103, clean, None, None), (104, "too short", "en", "hot")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_verdicts(corpus):
    kept = {r.doc_id: r.kept for r in q.quality_verdicts(corpus).collect()}
    assert len(kept) == 95 and all(kept[k] for k in range(90))
    assert not kept[100] and not kept[102] and not kept[104] and kept[103]
    assert not kept[101]  # a group of one takes the fences of all documents


def test_filter_keeps_columns_and_repeats(corpus):
    frame = corpus.withColumns({"kept": F.lit("mine"), "_row": F.lit(1), "n_words": F.lit("x")})
    out = q.filter_documents(frame.unionByName(frame.filter("doc_id = 5")))
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([*range(90), 103, 5])
    assert q.filter_documents(frame.limit(0)).count() == 0 and q.quality_verdicts(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(corpus):
    plan = q.quality_verdicts(corpus)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
