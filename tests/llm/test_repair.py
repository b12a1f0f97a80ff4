"""Conversation repair against a search over all edits of each conversation."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from vaultmart.llm import ordered, repair
from vaultmart.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = "[\x20\x09-\x0D]"


def damaged(rows):
    """Rows by conversation after the contract's damage, in the operator's order."""
    by = {}
    for c, turn, role, text in rows:
        if c is None:
            continue
        by.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        order = ((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest())
        z = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        if z == 0:
            continue
        text = "" if z == 1 else re.sub("[.!?]", "", text) if z == 2 else text
        role = "user" if z == 4 else role
        by[c] += [(order, turn, role, text)] * (2 if z == 3 else 1)
    return {c: [r[1:] for r in sorted(v, key=lambda r: r[0])] for c, v in by.items()}


def cheapest(rows):
    """Least (cost, audit) by searching edit strings in that order; `rows` are (role, text, fault)."""
    roles = lambda turns: "".join((r or " ")[0] for r, _ in turns)
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, k, turns = heapq.heappop(heap)
        said = roles(turns)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, turns
        if not re.fullmatch("(s?(ua)*u?)?", said):
            continue
        key = (k, "" if not said else "s" if said == "s" else said[-1])
        if key in done:
            continue
        done.add(key)
        ways = [(5, "I", k, turns + ((role, ""),)) for role in ("user", "assistant")]
        if k < len(rows):
            role, text, fault = rows[k]
            late = 5 * (fault == "t")
            ways.append((2, "D", k + 1, turns))
            if fault not in ("b", "d"):
                ways.append((late, "K", k + 1, turns + ((role, text),)))
                ways += [(1 + late, "R", k + 1, turns + ((r, text),)) for r in ("user", "assistant")]
        for more, edit, at, after in ways:
            heapq.heappush(heap, (cost + more, audit + edit, at, after))


def brute(rows):
    out = []
    for c, turns in damaged(rows).items():
        seen, faults, n = set(), [], dict(b=0, d=0, t=0)
        for _, role, text in turns:
            fault = ("b" if not re.search(f"[^{SPACE[1:-1]}]", text) else "d" if (role, text) in seen
                     else "t" if re.sub(f"{SPACE}+$", "", text)[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append((role, text, fault))
            n[fault] = n.get(fault, 0) + 1
        initials = [(r or " ")[0] for r, _, _ in faults]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        at = [t for t, _, _ in turns if t is not None]
        cost, audit, kept = cheapest(faults)
        out.append((c, max(at) - min(at) + 1 - len(set(at)) if at else 0, n["b"], n["d"], n["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out)


def make(seed):
    rng = random.Random(seed)
    texts = ["Hi.", "Hi. ", "no end", "", None, " \n", "What?", "a! b", "Long one. " * 2000, "é.\x85", "ok!\x0b\x0c"]
    rows = []
    for c in range(-5, 60):
        turn = 0
        for _ in range(rng.choice([1, 2, 3, 4, 6, 11])):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((c, rng.choice([turn] * 9 + [None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "sys"]),
                         rng.choice(texts + ["Word %d." % turn] * 8)))
    return rows + rows[:20] + [(None, 1, "user", "Nobody.")]


def got_rows(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,segment", [(1, 12), (2, 1), (3, 2), (4, 0)])
def test_against_search(spark, monkeypatch, seed, segment):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", segment)  # short segments: folded over many
    rows = make(seed)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got_rows(repair.repair_reports(turns, repair.damage(turns))) == brute(rows)


def test_repaired_turns_are_what_the_digest_is_of(spark):
    rows = make(6)
    turns = spark.createDataFrame(rows, SCHEMA)
    whole = repair.repair_reports(turns, repair._rows(turns)).collect()
    texts = {}
    for r in sorted(repair.repaired_turns(turns).collect(), key=lambda r: (r.conv_id, r.turn)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in whole:
        mine = texts.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(mine).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in mine))


def test_nodes_are_shared(monkeypatch):
    """Signatures with a common ending: its nodes are solved once."""
    import pyarrow as pa

    calls = []
    inner = repair._step
    monkeypatch.setattr(repair, "_step", lambda symbol, costs: calls.append(symbol) or inner(symbol, costs))
    backs = sorted(["au" * 50, "au" * 50 + "s", "au" * 50 + "sx", "au" * 49 + "aa"])
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 4), pa.array(backs)], names=["end", "back"])
    solved = [r for b in repair.solve([batch]) for r in b.to_pylist()]
    assert len(calls) == 100 + 2 + 1 and len(solved) == 4
    assert solved[backs.index("au" * 50 + "s")]["audit"] == ["K" * 101]


def test_one_conversation_holds_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", 5)
    rows = [(5, k, "assistant" if k % 2 else "user", f"Text {k}." if k % 7 else "same") for k in range(1500)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got_rows(repair.repair_reports(turns, repair.damage(turns))) == brute(rows)


def test_empty_and_clashing_columns(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert got_rows(repair.repair_reports(empty, repair.damage(empty))) == []
    gone = [(c, t, "user", "x.") for c in range(40) for t in [next(t for t in range(500) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)]]
    df = spark.createDataFrame(gone, SCHEMA)
    assert got_rows(repair.repair_reports(df, repair.damage(df))) == [(c, 0, 0, 0, 0, 0, 0, "", repair.NO_TEXT) for c in range(40)]
    rows = make(5)
    clash = spark.createDataFrame(rows, SCHEMA)
    for name in ("hit", "copy", "at", "seg", "fault", "tie_role", "tie_text", "digest", "edits", "initial", "cost", "end", "back"):
        clash = clash.withColumn(name, F.lit("other"))
    clash.write.parquet(f"{tmp_path}/conversations.parquet")
    assert got_rows(op13_conversation_repair(spark, str(tmp_path))) == brute(rows)
