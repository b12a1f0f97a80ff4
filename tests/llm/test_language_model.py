"""Language model: gradients, windows, base scores by brute force, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vaultmart.llm import language_model as lm


SYMBOLS = lm.FIRST + 70


def tiny(n_words=70, seed=1):
    counts = list(range(n_words, 0, -1))
    net = lm.Network(lm.start(counts, list(range(30, 30 + lm.TAILS)), 9, seed).astype(np.float64), n_words)
    net.flat += np.random.default_rng(2).normal(0, 0.3, len(net.flat))
    return net


def test_gradients(monkeypatch):
    net, rng = tiny(), np.random.default_rng(3)
    symbols, targets = rng.integers(0, SYMBOLS, (5, 4)), rng.integers(0, SYMBOLS, (5, 4))
    keep = (rng.random((5, 4)) > 0.3).astype(np.float64)
    state = rng.normal(0, 1, (4, lm.HIDDEN))
    weights = rng.random(20)

    def loss():
        hidden, _ = net.forward(symbols, keep, state)
        return -(net.output(hidden.reshape(-1, lm.HIDDEN), targets.reshape(-1))[0] * weights).sum()

    monkeypatch.setattr(lm, "DTYPE", np.float64)
    hidden, saved = net.forward(symbols, keep, state)
    _, d_hidden, grads = net.output(hidden.reshape(-1, lm.HIDDEN), targets.reshape(-1), weights)
    grads |= net.backward(symbols, keep, saved, d_hidden.reshape(hidden.shape))
    for name, view in net.p.items():
        flat, g = view.reshape(-1), grads[name].reshape(-1)
        for i in np.unique(np.concatenate([rng.integers(0, len(flat), 12), np.argsort(-abs(g))[:6]])):
            keep_value, step = flat[i], 1e-5
            flat[i] = keep_value + step
            up = loss()
            flat[i] = keep_value - step
            down = loss()
            flat[i] = keep_value
            assert abs((up - down) / (2 * step) - g[i]) < 1e-5 * max(1, abs(g[i])), name


def test_probabilities_sum_to_one():
    net = tiny()
    hidden = np.random.default_rng(0).normal(0, 1, (3, lm.HIDDEN))
    for h in hidden:
        logs = net.output(np.repeat(h[None], SYMBOLS, 0), np.arange(SYMBOLS))[0]
        assert abs(np.exp(logs).sum() - 1) < 1e-6


@pytest.mark.parametrize("lanes", [1, 3, 256])
def test_windows_carry_the_state(monkeypatch, lanes):
    monkeypatch.setattr(lm, "LANES", lanes)
    rng = np.random.default_rng(4)
    net = lm.Network(tiny().flat.astype(np.float32), 70)
    docs = [np.append(rng.integers(0, SYMBOLS, n), lm.END).astype(np.int32) for n in (0, 1, 40, 200, 3, 17, 90)]
    got = lm.log10_scores(net, docs)
    for doc, score in zip(docs, got):
        inputs = np.concatenate([[lm.END], doc[:-1]])[:, None]
        hidden, _ = net.forward(inputs, np.ones(inputs.shape, np.float32), np.zeros((1, lm.HIDDEN), np.float32))
        want = net.output(hidden[:, 0], doc)[0].sum() / math.log(10)
        assert abs(score - want) < 1e-3 * abs(want)


def brute(rows):
    train = [(d, t) for d, t in rows if zlib.crc32(str(d if d is not None else "").encode()) % 7 != 2]
    toks = lambda t: [*(t or "").encode().lower().split(), "end"]
    c = Counter(w for _, t in train for w in toks(t))
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        w = toks(t)
        out.append((d, zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2, len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


def check(rows, got):
    assert len(got) == len(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    for want, r in zip(sorted(brute(rows), key=key), sorted(
            [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)):
        assert r[:5] == want[:5]
        assert abs(r[5] - want[5]) <= 1e-6 * max(1, abs(want[5]))
        assert math.isfinite(r[6]) and r[6] <= 0


def test_tables(spark, monkeypatch):
    rows = [(0, None), (1, ""), (2, " \n "), (3, "A a b"), (4, "É é É unseen"), (5, "w " * 30_000), (6, "b a"), (3, "A a b"),
            (None, "null id"), (40, "only here"), *[(k, f"the cat {k % 5} sat") for k in range(100, 160)]]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    check(rows, lm.score_documents(docs).collect())
    assert lm.score_documents(docs.limit(0)).count() == 0
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 2 and r[0] is not None]
    none = lm.score_documents(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert held and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)


def test_model_beats_counts_on_held_out_texts(spark):
    from vaultmart.llm.queries import op6_language_model
    got = op6_language_model(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    check([(d.doc_id, d.text) for d in docs], got)
    held = [r for r in got if r.held_out]
    model, base = sum(r.score for r in held), sum(r.base_score for r in held)
    print("log10 per token: model", model / sum(r.n_tokens for r in held), "base", base / sum(r.n_tokens for r in held))
    assert model > base


def test_scores_do_not_depend_on_files(spark, monkeypatch):
    """The same rows in one partition and in 48, in another order: the same training, the same scores."""
    monkeypatch.setattr(lm, "PART_TOKENS", 20_000)  # several parts a round
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {r.doc_id: r for r in lm.score_documents(docs.coalesce(1)).collect()}
    many = {r.doc_id: r for r in lm.score_documents(docs.orderBy("text").repartition(48)).collect()}
    assert one.keys() == many.keys()
    assert all(abs(one[k].score - many[k].score) <= 1e-6 * max(1, abs(one[k].score)) for k in one)
    assert any(r.score != r.base_score for r in one.values())


def test_cutoff():
    assert lm.cutoff([(5, 1), (3, 2), (1, 10)], 3) == 3
    assert lm.cutoff([(5, 1), (3, 2), (1, 10)], 12) == 3 and lm.cutoff([(5, 1), (3, 2), (1, 10)], 13) == 1
    assert lm.cutoff([(5, 4)], 3) == 6 and lm.cutoff([], 3) == 1


def test_tail_words_share_a_proper_probability():
    """Of one class: its words by count plus one, and one for all unseen."""
    assert lm.tail_class(b"nation") == lm.tail_class(b"on") == zlib.crc32(b"on") % lm.TAILS
    assert 0 <= lm.tail_class(b"x") < lm.TAILS


def test_arrow_numbers_the_words_that_python_splits():
    """Only distinct words become Python objects; spaces at the ends, odd spaces and other scripts are cut as before."""
    texts = [None, "", " ", "The the\tTHE \x0bthe\x0c\r\n end", "  É é x y ÀB ", "one", "\x1cone\x1f one\x85", "你好 World 你好"]
    distinct, at, ends = lm.numbered(pa.array(["cut away", *texts, "cut away"]).slice(1, len(texts)))
    names = distinct.to_pylist()
    assert len(set(names)) == len(names) and set(at.tolist()) == set(range(len(names)))
    assert [[names[k] for k in at[a:b]] for a, b in zip(ends, ends[1:])] == [(t or "").encode().lower().split() for t in texts]
    none = lm.numbered(pa.array(["", None], pa.string()))
    assert len(none[0]) == len(none[1]) == 0 and none[2].tolist() == [0, 0, 0]


def test_scoring_softmax_equals_the_training_one():
    """By column and by row, to the last bit; scoring's log probabilities are those training sees."""
    rng = np.random.default_rng(6)
    for classes in (32, 65, 97):
        logits, at = rng.normal(0, 9, (300, classes)).astype(np.float32), rng.integers(0, classes, 300)
        by_column = lm._log_softmax_by_column(np.ascontiguousarray(logits.T), at)
        assert (by_column == lm._log_softmax(logits.copy(), at)[0]).all()
    net = lm.Network(tiny().flat.astype(np.float32), 70)
    hidden, targets = rng.normal(0, 1, (5000, lm.HIDDEN)).astype(np.float32), rng.integers(0, SYMBOLS, 5000)
    learning = net.output(hidden, targets, np.ones(5000, np.float32))[0]
    assert np.allclose(net.output(hidden, targets)[0], learning, rtol=1e-6, atol=1e-6)


def test_states_follow_the_recurrence():
    """Gate by gate, with lanes cleared and buffers used again, as the plain formulas say."""
    net, rng = lm.Network(tiny().flat.astype(np.float32), 70), np.random.default_rng(7)
    symbols, keep = rng.integers(0, SYMBOLS, (9, 6)), (rng.random((9, 6)) > 0.3).astype(np.float32)
    begin, h = rng.normal(0, 1, (6, lm.HIDDEN)).astype(np.float32), lm.HIDDEN
    state = begin
    learned, scored = net.forward(symbols, keep, begin)[0], net.forward(symbols, keep, begin, learn=False)[0]
    for t in range(9):
        state = state * keep[t, :, None]
        x = net.p["embedding"][symbols[t]] @ net.p["input"] + net.p["gates"]
        a = state @ net.p["recurrent"]
        z, r = (1 / (1 + np.exp(-(x[:, g * h:(g + 1) * h] + a[:, g * h:(g + 1) * h]))) for g in (0, 1))
        c = np.tanh(x[:, 2 * h:] + r * a[:, 2 * h:])
        state = c + z * (state - c)
        assert np.allclose(learned[t], state, atol=1e-5) and (scored[t] == learned[t]).all()


def test_words_are_counted_and_classed_without_python_objects(spark, monkeypatch):
    """Stretches and sums of any size give the same counts; an ending is worked out once, however many words have it."""
    asked = []
    monkeypatch.setattr(lm, "tail_class", lambda w: asked.append(w) or zlib.crc32(w[-2:]) % lm.TAILS)
    words = [f"{k}{e}".encode() for k in range(3000) for e in ("on", "é", "x")] + [b"x", "é".encode()[:1]]
    assert lm.tail_classes(pa.array(words)).tolist() == [zlib.crc32(w[-2:]) % lm.TAILS for w in words]
    assert len(asked) == 1 + 1 + 10 + 2
    assert len(lm.tail_classes(pa.array([], pa.binary()))) == 0

    texts = [None, "", " ", *(f"the Cat w{k % 7} w{k}" for k in range(200))]
    want = Counter(w for t in texts for w in (t or "").encode().lower().split())
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:a + 7], pa.string())], names=["text"]) for a in range(0, len(texts), 7)]
    for size, rows, flush in ((1, 8192, 1), (1, 8192, 40), (4 << 20, 3, 300), (4 << 20, 8192, 1_000_000)):
        monkeypatch.setattr(lm, "COUNT_BYTES", size)
        monkeypatch.setattr(lm, "COUNT_ROWS", rows)
        monkeypatch.setattr(lm, "FLUSH_WORDS", flush)
        got = Counter()
        for b in lm.counted(batches):
            got.update(dict(zip(b["word"].to_pylist(), b["c"].to_pylist())))
        assert got == want
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    assert {bytes(r.word): r.c for r in lm.word_counts(docs).collect()} == want
    assert lm.word_counts(docs.limit(0)).count() == 0


def test_stretches_hold_few_rows(monkeypatch):
    monkeypatch.setattr(lm, "COUNT_ROWS", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array(["a"] * n, pa.string())], names=["text"]) for n in (0, 4, 4, 4, 0, 9, 9, 1)]
    assert [[b.num_rows for b in held] for held in lm._stretches(batches, lambda b: b.column(0))] == [[4, 4, 4], [9, 9], [1]]
