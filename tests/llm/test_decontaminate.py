"""Decontamination: search against full scoring, and planted leaks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultmart.llm import decontaminate as dc


def items(seed, n, vocabulary=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    return [(k, " ".join(rng.choices(words, k=rng.randint(3, 30))) + "? " + " ".join(rng.choices(words, k=4)) + ".")
            for k in range(n)]


@pytest.mark.parametrize("block", [1, 4, 16])
def test_wand_retrieves_all_above_threshold(monkeypatch, block):
    monkeypatch.setattr(dc, "ITEM_BLOCK", block)
    index = dc.Index(items(4, 90))
    rng = random.Random(block)
    hits = 0
    for trial in range(300):
        base = rng.choice(items(4, 90))[1] if trial % 2 else ""
        words = base.split() + [f"w{k}" for k in rng.choices(range(150), k=rng.randint(0, 60))]
        rng.shuffle(words)
        words = words[:rng.randint(len(words) * 3 // 4, len(words))]
        terms = sorted({index.terms[dc.normal(w)] for w in words if dc.normal(w) in index.terms})
        scores = {}
        for t in terms:
            for k, w in (x for p in index.postings[t].values() for x in p):
                scores[k] = scores.get(k, 0) + w
        want = {k: s for k, s in scores.items() if s >= 1 - 1e-9}
        bounds = index.block_bounds(np.array(terms, np.int32), 1 << 20) if terms else np.zeros((1, 0))
        got = dict(x for b in np.flatnonzero(bounds[0] >= 1 - 1e-9).tolist() for x in index.search(terms, b))
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
        hits += len(want)
    assert hits > 60


def test_threshold_loses_no_verified_leak():
    rows = items(8, 60)
    index = dc.Index(rows)
    rng = random.Random(2)
    verified = 0
    for _ in range(600):
        k = rng.randrange(60)
        words = rows[k][1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        sequence = [index.terms.get(dc.normal(w), -1) for w in words]
        if index.verify(index.ids.index(k), sequence):
            verified += 1
            place = index.ids.index(k)
            assert place in dict(index.search(sorted({t for t in sequence if t >= 0}), place // dc.ITEM_BLOCK))
    assert 100 < verified < 600


def test_question_and_answer():
    assert dc.parts_of_item("What is it? A cat.") == ("What is it?", " A cat.")
    assert dc.parts_of_item("First one. Second one.") == ("First one.", " Second one.")
    assert dc.parts_of_item("Only one") == ("Only one", "Only one")
    assert dc.parts_of_item("Really? ") == ("Really? ", "Really? ")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(k, t) for k, t in items(8, 40, 4000)] + [(100, None), (101, ""), (102, "too short here"), (103, items(8, 40, 4000)[0][1])]
    return spark.createDataFrame(rows, "item_id long, text string")


def planted():
    rng = random.Random(6)
    filler = lambda n: " ".join(f"f{rng.randrange(9999)}" for _ in range(n))
    long = max(items(8, 40, 4000), key=lambda r: len(r[1]))
    words = long[1].split()
    edited = [*words]
    edited[2] = "edited"
    question = long[1][:long[1].rfind("?")]
    docs = [(0, filler(300) + " " + long[1] + " " + filler(300), [long[0]]),
            (1, long[1].upper().replace(" ", "\n"), [long[0]]),
            (2, filler(70) + " " + " ".join(edited), [long[0]]),
            (3, filler(100) + " " + question, []),
            (4, " ".join(reversed(words)), []),
            (5, filler(5000) + " " + items(8, 40, 4000)[0][1], [0, 103]),
            (6, None, []), (7, "", []), (8, " \n", []), (9, filler(800), []),
            (10, items(8, 40, 4000)[3][1] + " x " + items(8, 40, 4000)[4][1], [3, 4])]
    return docs + [docs[0]]


@pytest.mark.parametrize("part_bytes", [1 << 24, 700])
def test_planted_leaks(spark, benchmark, part_bytes):
    docs = planted()
    frame = spark.createDataFrame([(d, t, "n", 1) for d, t, _ in docs], "doc_id long, text string, item_id string, _leaks int")
    got = frame.select("doc_id", F.explode(dc.leaks(F.col("text"), benchmark, part_bytes=part_bytes)).alias("x"))
    assert sorted((r.doc_id, r.x.item_id) for r in got.collect()) == sorted((d, i) for d, _, w in docs for i in w)
    kept = dc.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, w in docs if not w]


def test_empty_tables(spark, benchmark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert dc.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert dc.find_leaks(docs.limit(0), benchmark).count() == 0
    assert dc.drop_contaminated(docs, benchmark.limit(0)).count() == 1


def test_long_text_is_split_alike(benchmark, monkeypatch):
    index = dc.Index([(r.item_id, r.text) for r in benchmark.collect() if r.text])
    text = planted()[0][1]
    whole = dc.Searcher(index).leaks(text)
    monkeypatch.setattr(dc, "LONG_TEXT", 1)
    monkeypatch.setattr(dc, "SLAB", 2)
    assert dc.Searcher(index).leaks(text) == whole and len(whole) == 1


def test_whole_table_against_brute_force(spark):
    """Every item against every text: five-word shingles, question and answer words."""
    from vaultmart.llm.queries import op10_decontamination
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id) for r in op10_decontamination(spark, sf).collect()}
    tests = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    words = lambda t: [w for w in map(dc.normal, t.split()) if w]
    longest = max(len(words(t)) for _, t in tests)
    stride = -(-longest * 5 // 4)
    want = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = words(d.text or "")
        for a in range(0, max(1, len(w)), stride):
            p = w[a:a + 2 * stride]
            have, single = set(dc.shingles(p)), set(p)
            for i, t in tests:
                s = set(dc.shingles(words(t)))
                if s and len(s & have) >= 0.8 * len(s) and all(
                        len(set(words(x)) & single) >= 0.8 * len(set(words(x))) for x in dc.parts_of_item(t)):
                    want.add((d.doc_id, i))
    assert got == want and got


def whole_text_leaks(rows, text):
    """Item ids that verify in a window of the stated span at any offset of the text."""
    words = lambda t: [w for w in map(dc.normal, t.split()) if w]
    span = 2 * -(-max(len(words(t)) for _, t in rows) * 5 // 4) + dc.PUT_IN
    w, out = words(text), set()
    for i, t in rows:
        want, sides = set(dc.shingles(words(t))), [set(words(x)) for x in dc.parts_of_item(t)]
        for a in range(max(1, len(w))):
            part = w[a:a + span]
            if len(want) and len(want & set(dc.shingles(part))) >= 0.8 * len(want) - 1e-9 and all(
                    len(x & set(part)) >= 0.8 * len(x) - 1e-9 for x in sides):
                out.add(i)
                break
    return out


@pytest.mark.parametrize("put_in", [0, 30, 60, 100, 250])
def test_words_put_in_at_every_offset(put_in):
    """A gap between question and answer: found or not must not depend on what stands before."""
    rng = random.Random(put_in)
    words = [f"w{k}" for k in range(3000)]
    rows = [(k, " ".join(rng.choices(words, k=50 - k)) + "? " + " ".join(rng.choices(words, k=9)) + ".") for k in range(6)]
    searcher = dc.Searcher(dc.Index(rows))
    question, answer = dc.parts_of_item(rows[0][1])
    leak = f"{question} {'gap ' * put_in}{answer}"
    for before in range(searcher.span + 2):
        found = searcher.leaks("x " * before + leak + " y" * 500)
        assert [(f["item_id"], f["passage_start"]) for f in found] == [(0, before)]


def test_windows_against_whole_texts():
    rng = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(25, 40))) + "? " + " ".join(rng.choices(words, k=5)) + ".")
            for k in range(4)]
    searcher = dc.Searcher(dc.Index(rows))
    hits = misses = 0
    for trial in range(24):
        question, answer = dc.parts_of_item(rng.choice(rows)[1])
        gap = rng.choices(words + ["f"] * 400, k=rng.choice([0, 40, searcher.span - 20, searcher.span - 5, searcher.span + 40]))
        text = " ".join([*rng.choices(words, k=rng.randint(0, 300)), question, *gap, answer, *rng.choices(words, k=rng.randint(0, 99))])
        want = whole_text_leaks(rows, text)
        assert {f["item_id"] for f in searcher.leaks(text)} == want
        hits, misses = hits + bool(want), misses + (not want)
    assert hits > 10 and misses > 2


def test_parts_do_not_change_scores(spark, benchmark):
    frame = spark.createDataFrame([(d, t) for d, t, _ in planted()], "doc_id long, text string")
    got = [sorted(tuple(r) for r in frame.select("doc_id", F.explode(dc.leaks(F.col("text"), benchmark, part_bytes=b)).alias("x"))
                  .select("doc_id", "x.*").collect()) for b in (700, 1 << 24)]
    assert got[0] == got[1] and got[0]
