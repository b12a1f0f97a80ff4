"""Line deduplication against a brute-force edit distance over words."""

import random

import pytest

from vaultmart.llm import line_dedup


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[i + 1:] == short[i:]


def ascii_words(line):
    return [w.decode() for w in line.encode().split()]


def brute(docs):
    """docs: (id, text), distinct.  Returns (id, new text, n_lines, n_kept)."""
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for d, t in order:
        for no, line in enumerate((t or "").split("\n")):
            w = tuple(ascii_words(line))
            if w:
                first.setdefault(w, (d, t, no))
    rank = {p: k for k, p in enumerate(first.values())}
    gone = set()
    for w, p in first.items():
        if len(w) >= line_dedup.MIN_WORDS:
            for v, q in first.items():
                if len(v) >= line_dedup.MIN_WORDS and rank[q] < rank[p] and within_one(w, v):
                    gone.add(w)
    out = []
    for d, t in docs:
        lines = t.split("\n") if t is not None else []
        kept = [x for no, x in enumerate(lines)
                if not ascii_words(x) or (first[tuple(ascii_words(x))] == (d, t, no) and tuple(ascii_words(x)) not in gone)]
        out.append((d, None if t is None else "\n".join(kept), len(lines), len(kept)))
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)]
    bases = [rng.choices(vocabulary, k=rng.randint(5, 16)) for _ in range(6)]
    docs = []
    for d in range(n):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = list(rng.choice(bases))
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(w))
                w[i:i + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 1))
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        docs.append((d, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = random_docs(seed, 60)
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(docs))
    assert sum(r.n_lines - r.n_kept for r in got) > 50


def test_edge_cases(spark):
    base = "one two three four five six seven eight nine"
    docs = [(None, "null id line of no matter"), (1, None), (2, ""), (3, "\n \n"), (4, base), (5, base + " ten\n" + base),
            (6, "one two three four X six seven eight nine\n\nown"), (7, "short a b"), (8, "short a c"), (9, "w " * 9000),
            (10, "w " * 9001), (11, base.replace(" ", "   "))]
    rows = [(d, t, "en", 7, 1) for d, t in docs]
    frame = spark.createDataFrame(rows + rows[4:5], "doc_id long, text string, lang string, n_chars long, doc int")
    out = line_dedup.dedup_lines(frame, chars_col="n_chars")
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "doc", "n_lines", "n_kept"]
    got = out.collect()
    want = brute(docs)
    want.append(want[4])  # a repeated row is the same document
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "", r.text is None, r.n_lines, r.n_kept) for r in got) == \
        sorted(((d is not None, d or 0), t or "", t is None, n, k) for d, t, n, k in want)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)
    assert line_dedup.dedup_lines(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(random_docs(3, 5), "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
