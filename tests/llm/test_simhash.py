"""SimHash: fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vaultmart.llm import simhash
from vaultmart.llm.components import connected_components


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_roots(values, radius=3):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def near_values(rng, n, families):
    bases = [rng.getrandbits(64) for _ in range(families)]
    out = []
    for _ in range(n):
        v = rng.choice(bases)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        out.append(v)
    return out


def test_text_fingerprint():
    rng = random.Random(3)
    texts = ["", " \n", "A", "A b", "one Two THREE", "É É é", " x y z w"] + [
        " ".join(rng.choices(["a", "bb", "Ccc", "ñ", "\n", "d\te"], k=rng.randint(1, 90))) for _ in range(60)]
    for t in texts:
        assert simhash.text_fingerprint(t.encode()) == brute_fingerprint(t)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 300])
def test_bit_sliced_comparison(n):
    rng = random.Random(n)
    a = np.array(near_values(rng, n, 3), np.uint64)
    b = np.array(near_values(rng, n + 7, 3), np.uint64)
    i, j = simhash.links_in_unit(a, b, 3)
    want = {(x, y) for x in range(len(a)) for y in range(len(b)) if (int(a[x]) ^ int(b[y])).bit_count() <= 3}
    assert set(zip(i.tolist(), j.tolist())) == want
    m = min(len(a), len(b))
    flags = simhash.links_of_pairs(a[:m], b[:m], 3)
    assert flags.tolist() == [(k, k) in want for k in range(m)]


@pytest.mark.parametrize("block,small", [(1024, 24), (4, 2)])
def test_classes_and_components(spark, monkeypatch, block, small):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(block)
    values = near_values(rng, 250, 12) + [rng.getrandbits(64) for _ in range(200)] + [0, 1, 3, 2**64 - 1]
    classes = spark.createDataFrame([(f"{v:016x}",) for v in sorted(set(values))], "fp string")
    links = simhash.class_links(classes)
    got = {int(r.node, 16): int(r.root, 16) for r in connected_components(links).collect()}
    want = brute_roots(values)
    assert {v: got.get(v, v) for v in want} == want


def test_long_chain(spark):
    nodes = [f"{k:05d}" for k in range(300)]
    random.Random(5).shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a string, b string")
    got = connected_components(edges).collect()
    assert len(got) == 300 and {r.root for r in got} == {"00000"}


def rows_for_tables():
    base = " ".join(f"word{k}" for k in range(200))
    texts = [None, "", "  \n", "Alpha beta", "alpha BETA", base, base.upper(), base + " extra", "solo " * 50,
             base.replace("word7 ", "other "), "x" * 100_000]
    return [(k, t, "f", 1) for k, t in enumerate(texts)] + [(5, base, "f", 1), (None, base, "f", 1), (None, "null id", "f", 1)]


def test_documents(spark):
    rows = rows_for_tables()
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id int").repartition(4)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fp = {t: brute_fingerprint(t) for _, t, _, _ in rows}
    roots = brute_roots(fp.values())
    least = {}
    for d, t, _, _ in rows:
        r = roots[fp[t]]
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    want = sorted(((d is not None, d or 0), f"{fp[t]:016x}", least[roots[fp[t]]] if least[roots[fp[t]]] is not None else -1)
                  for d, t, _, _ in rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.fingerprint,
                   -1 if r.component_id is None else r.component_id) for r in got) == want
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len({roots[f] for f in fp.values()})
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(v for v in least.values() if v is not None)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_whole_table(spark):
    from vaultmart.llm.queries import op8_simhash
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    fp = {d: brute_fingerprint(t) for d, t in docs}
    roots, least = brute_roots(fp.values()), {}
    for d in sorted(fp):
        least.setdefault(roots[fp[d]], d)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in op8_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert got == {d: (f, least[roots[f]]) for d, f in fp.items()}


def test_hot_group_links_stay_linear(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    values = {base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)} | {rng.getrandbits(64) for _ in range(50)}
    classes = spark.createDataFrame([(f"{v:016x}",) for v in values], "fp string")
    links = simhash.class_links(classes)
    assert links.count() < 40 * len(values)
    roots = connected_components(links).groupBy("root").count().orderBy(F.desc("count")).first()
    assert roots["count"] >= 60 * 59 // 2
