"""Type-2 satellite loader against a plain-Python model of the reference's rules.

Per batch the model: (1) takes staged rows whose key has no open row or whose
hashdiff differs from the latest open row; (2) deletes rows with the same
(key, load_date) and inserts those rows open; (3) closes every open row that has
a later open row of the same key, at the nearest such load_date.  Random
batches mix new keys, changes, reverts, unchanged rows, late arrivals and
same-instant replacements.
"""

import datetime as dt
import random
from collections import Counter

from vaultmart.operators import vault

DAYS = [dt.datetime(2024, 1, d) for d in range(1, 8)]
SCHEMA = "k string, a string, hashdiff string, load_date timestamp_ntz, record_source string"


def model_batch(table, staged):
    open_rows = [r for r in table if r["end"] is None]
    latest = {}
    for r in sorted(open_rows, key=lambda r: r["ld"]):
        latest[r["k"]] = r
    changed = [s for s in staged if s["k"] not in latest or latest[s["k"]]["hd"] != s["hd"]]
    keys = {(s["k"], s["ld"]) for s in changed}
    table = [r for r in table if (r["k"], r["ld"]) not in keys]
    table += [dict(s, end=None) for s in changed]
    opened = [r for r in table if r["end"] is None]
    for r in opened:
        later = [o["ld"] for o in opened if o["k"] == r["k"] and o["ld"] > r["ld"]]
        if later:
            r["end"] = min(later)
    return table


def test_loader_matches_model_on_random_batches(spark):
    ck = lambda d: d.checkpoint()
    fulls = lates = 0
    for seed in range(4):
        rnd = random.Random(seed)
        table, open_df, closed_df = [], None, None
        for step in range(5):
            staged = []
            for k in rnd.sample([f"k{i}" for i in range(6)], rnd.randint(1, 6)):
                a = rnd.choice("xyz")
                ld = DAYS[min(6, step + 1)] if rnd.random() < 0.6 else rnd.choice(DAYS[:step + 2])
                staged.append({"k": k, "a": a, "hd": f"h{a}", "ld": ld})
            closed = [r for r in table if r["end"] is not None]
            if closed and rnd.random() < 0.5:
                # re-send the key and instant of a closed version (same-instant replacement)
                c = rnd.choice(closed)
                a = rnd.choice("xyz")
                staged = [s for s in staged if s["k"] != c["k"]]
                staged.append({"k": c["k"], "a": a, "hd": f"h{a}", "ld": c["ld"]})
            newest = max((r["ld"] for r in table), default=None)
            lates += sum(1 for s in staged if newest is not None and s["ld"] < newest)
            table = model_batch(table, staged)
            df = spark.createDataFrame([(s["k"], s["a"], s["hd"], s["ld"], "src") for s in staged],
                                       SCHEMA)
            out = vault.load_satellite(df, "k", ["a"], open_df, closed_df, materialize=ck)
            fulls += out.closed_is_full
            open_df = out.open.checkpoint()
            closed_df = out.closed.checkpoint() if out.closed_is_full or closed_df is None \
                else closed_df.unionByName(out.closed).checkpoint()
            got = Counter((r.k, r.a, r.load_date, r.load_end_date)
                          for r in open_df.unionByName(closed_df).collect())
            want = Counter((r["k"], r["a"], r["ld"], r["end"]) for r in table)
            assert got == want, (seed, step, got - want, want - got)
    assert lates > 0 and fulls > 0, (lates, fulls)
