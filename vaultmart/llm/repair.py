"""Conversation structure repair: cheapest edits that give turns of the form (system)? (user assistant)+, or none.

A turn's signature is its role initial and its fault: blank and duplicate turns must be deleted, truncated
ones cost TRUNCATED unless deleted.  Edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty
user or assistant turn 5.  Among the cheapest, the audit (the edits' initials in order) that is least in ASCII.

* What follows a turn decides its cheapest edits, so signatures are minimised from the end: distinct signatures,
  sorted by their reverse, form an automaton in which conversations share their suffixes.  It is walked in that order;
  for every node and each of the four grammar states the cost-to-go and the first edit of the best
  audit suffix are worked out once, and only the current path is held.  A state leaves at most one target per
  edit, so the first edits of equal costs decide the order of audits.
* Conversations are cut into segments (ordered.py).  One that spans several is folded over them by (min, +) matrices from
  grammar state to state, from the last to the first; then each segment's signature is solved with the costs that follow it.
* Repaired texts are streamed: edits come as one record per segment, sorted in front of the turns they are for.  A digest
  of a whole conversation is sequential by definition; it is fed turn by turn in constant memory.

Defined results: null role or text is one space; turns go by turn (null first), then role, then the text's digest;
of repeated rows all but the first are duplicates; an initial other than s, u or a, also of an empty role, fits no
state, so such a turn is reroled or deleted; rows without conv_id belong to no conversation and take no part; an empty
table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.llm.common import NOT_SPACE, small_batches, write_table
from vaultmart.llm.ordered import in_order

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (2, 2, 3, 2)  # the state after a user or assistant turn, of which each state takes one
FAR = 1 << 40
LAST = "last"  # ends the last of several segments
NO_TEXT = hashlib.sha256(b"").hexdigest()


# -- the automaton ---------------------------------------------------------------------------------
def _insert(costs, edits):
    """Costs and first edits once an empty turn may be inserted first (two in a row, at most, can pay)."""
    for _ in range(2):
        for s in range(4):
            best = min((costs[s], edits[s]), (costs[TURN[s]] + INSERT, "I"))
            costs[s], edits[s] = best
    return tuple(costs), "".join(edits)


@lru_cache(maxsize=1 << 16)
def _before(symbol: str, costs: tuple) -> tuple[tuple, str]:
    """Costs by grammar state, and first edits, in front of a turn with costs `costs` after it."""
    out, edits = [], []
    role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    for s in range(4):
        ways = [(costs[s] + DELETE, "D")]
        if symbol != "d":
            ways.append((costs[TURN[s]] + REROLE + extra, "R"))
            if role in NEXT[s]:
                ways.append((costs[NEXT[s][role]] + extra, "K"))
        cost, edit = min(ways)
        out.append(cost)
        edits.append(edit)
    return _insert(out, edits)


# Where a conversation ends: states 0 and 3 stop ("."), the others insert.
END = _insert([0, FAR, FAR, 0], [".", ".", ".", "."])


@lru_cache(maxsize=1 << 16)
def _step(symbol: str, costs: tuple) -> tuple[tuple, str]:
    """As `_before`, for costs of any size: what it caches is relative to the least of them."""
    least = min(costs)
    out, edits = _before(symbol, tuple(c - least for c in costs))
    return tuple(c + least for c in out), edits


def _ending(end: str) -> tuple[tuple, str]:
    return END if end in ("", LAST) else (tuple(map(int, end.split(","))), "....")


def solve(batches):
    """(end, back) rows sorted by both -> cost, audit and last state for each grammar state at the start.

    `back` is a signature read from its end; `end` is empty for a whole conversation (solved from
    state 0 alone), LAST, or the costs that follow by state."""
    path, last, old = [], None, ""
    for batch in batches:
        rows = []
        for end, back in zip(*(c.to_pylist() for c in batch.columns)):
            if end != last:
                path, last, old = [_ending(end)], end, ""
            same = 0
            while same < len(old) and same < len(back) and old[same] == back[same]:
                same += 1
            del path[same + 1:]
            for symbol in back[same:]:  # nodes not met before
                path.append(_step(symbol, path[-1][0]))
            old = back
            cost, audit, stop = [], [], []
            for start in range(4 if end else 1):
                state, edits, at = start, [], len(back)
                while True:
                    edit = path[at][1][state]
                    if edit == ".":
                        break
                    edits.append(edit)
                    if edit != "I":
                        at -= 1
                    if edit in "IR":
                        state = TURN[state]
                    elif edit == "K":
                        state = NEXT[state][back[at].lower()]
                cost.append(path[-1][0][start])
                audit.append("".join(edits))
                stop.append(state)
            rows.append((end, back, cost, audit, stop))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())))],
            names=["end", "back", "cost", "audit", "stop"]) if rows else pa.RecordBatch.from_pylist([], schema=_SOLVED)


_SOLVED = pa.schema([("end", pa.string()), ("back", pa.string()), ("cost", pa.list_(pa.int64())),
                     ("audit", pa.list_(pa.string())), ("stop", pa.list_(pa.int32()))])


def _matrices(batches):
    """Costs from every state at the start of a signature to every state at its end (16 numbers)."""
    for batch in batches:
        backs = batch.column(0).to_pylist()
        out = []
        for back in backs:
            columns = []
            for stop in range(4):
                costs = tuple(0 if s == stop else FAR for s in range(4))
                for symbol in back:
                    costs, _ = _before(symbol, costs)
                    costs = tuple(min(c, FAR) for c in costs)
                columns.append(costs)
            out.append([columns[j][i] for i in range(4) for j in range(4)])
        yield pa.RecordBatch.from_arrays([pa.array(backs, pa.string()), pa.array(out, pa.list_(pa.int64()))], names=["back", "matrix"])


def _fold_back(group: pd.DataFrame) -> pd.DataFrame:
    """The costs that follow each segment of one conversation, less their least (`base`)."""
    group = group.sort_values("seg")
    after, ends, bases = None, [], []
    for m in reversed(group["matrix"].tolist()):
        if after is None:
            ends.append(LAST)
            bases.append(0)
            after = END[0]
        else:
            bases.append(min(after))
            ends.append(",".join(str(c - bases[-1]) for c in after))
        after = [min(int(m[4 * i + j]) + after[j] for j in range(4)) for i in range(4)]
    return pd.DataFrame({"conv_id": group["conv_id"], "seg": group["seg"], "end": ends[::-1], "base": bases[::-1]})


def _fold_on(group: pd.DataFrame) -> pd.DataFrame:
    """Each segment's audit, from the grammar state that the one before it leaves."""
    group = group.sort_values("seg")
    state, audits, costs = 0, [], []
    for k, (cost, audit, stop, base) in enumerate(zip(group["cost"], group["audit"], group["stop"], group["base"])):
        audits.append(audit[state])
        costs.append(int(cost[state]) + int(base) if k == 0 else 0)
        state = int(stop[state])
    return pd.DataFrame({"conv_id": group["conv_id"], "seg": group["seg"], "edits": audits, "cost": costs})


# -- turns -----------------------------------------------------------------------------------------
def damage(turns: DataFrame) -> DataFrame:
    """The damaged rows of the contract: crc32(conv_id:turn) % 20 drops, empties, strips, repeats or reroles a turn."""
    rows = _rows(turns)
    hit = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    return (rows.withColumn("hit", hit).where("hit <> 0")
            .withColumn("text", F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("hit", "copy"))



def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("tie_role"), F.col("tie_text")]


def _rows(turns: DataFrame) -> DataFrame:
    """Turns with a conversation: null texts as one space, and the columns that settle ties."""
    role, text = (F.coalesce(turns[c], F.lit(" ")) for c in ("role", "text"))
    return turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"), text.alias("text"),
        role.alias("tie_role"), F.md5(text.cast("binary")).alias("tie_text"))


def segments(rows: DataFrame) -> DataFrame:
    """Written table, a row per (conversation, segment): its signature backwards, counts of faults and of illegal
    neighbours, first and last initial, and the order of its first turn."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.when(F.col("role") == "", F.lit(" ")).otherwise(F.substring("role", 1, 1))
    light = rows.select(
        "conv_id", "turn", "tie_role", "tie_text", F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")).alias("digest"),
        F.when(~F.col("text").rlike(NOT_SPACE), F.lit("b")).when(~F.substring(end, -1, 1).isin(".", "!", "?"), F.lit("t"))
        .otherwise(F.lit("")).alias("fault"))
    placed = in_order(light, ["conv_id", *_order()], "repair-turns")
    seen = placed.groupBy("conv_id", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = F.when((F.col("fault") != "b") & (F.col("at") > F.col("first")), F.lit("d")).otherwise(F.col("fault"))
    faulty = placed.join(seen, ["conv_id", "digest"], "left").withColumn("fault", fault)
    symbol = (F.when(F.col("fault").isin("b", "d"), F.lit("d")).when(F.col("fault") == "t", F.upper("initial")).otherwise(F.col("initial")))
    count = lambda c: F.sum((F.col("fault") == c).cast("long"))
    first = F.struct("turn", "tie_role", "tie_text")
    grouped = faulty.withColumn("symbol", symbol).groupBy("conv_id", "seg").agg(  # SEGMENT rows at most
        F.sort_array(F.collect_list(F.struct("at", "symbol", "initial"))).alias("list"), F.min_by(first, "at").alias("start"),
        count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"))
    initials = F.array_join(F.transform("list", lambda x: x["initial"]), "")
    pairs = F.filter(F.sequence(F.lit(1), F.length("initials") - 1), lambda k: (
        F.length("initials") > 1) & ~F.col("initials").substr(k, F.lit(2)).isin("su", "ua", "au"))
    return write_table(grouped.withColumn("initials", initials).select(
        "conv_id", "seg", F.reverse(F.array_join(F.transform("list", lambda x: x["symbol"]), "")).alias("back"),
        F.when(F.length("initials") < 2, F.lit(0)).otherwise(F.size(pairs)).cast("long").alias("illegal"),
        F.substring("initials", 1, 1).alias("first"), F.substring("initials", -1, 1).alias("last"),
        "blank", "duplicate", "truncated", "start.*"), "repair-segments")


def plan_edits(segs: DataFrame) -> DataFrame:
    """Written table: the edits and the cost of each segment (a conversation's cost stands in its first)."""
    several = segs.select("conv_id", "seg", "back").join(segs.groupBy("conv_id").count().where("count > 1").select("conv_id"), "conv_id")
    matrices = several.select("back").distinct().mapInArrow(_matrices, "back string, matrix array<long>")
    follow = several.join(matrices, "back").groupBy("conv_id").applyInPandas(
        _fold_back, "conv_id long, seg long, end string, base long")
    ended = write_table(segs.join(follow, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "back", F.coalesce("end", F.lit("")).alias("end"), F.coalesce("base", F.lit(0)).alias("base"),
        F.col("end").isNotNull().alias("several")), "repair-ends")
    parts = int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = write_table(ended.select("end", "back").distinct().repartitionByRange(parts, "end", "back").sortWithinPartitions("end", "back")
                         .mapInArrow(solve, "end string, back string, cost array<long>, audit array<string>, stop array<int>"),
                         "repair-automaton")
    known = ended.join(solved, ["end", "back"])
    alone = known.where("not several").select("conv_id", "seg", F.col("audit")[0].alias("edits"), F.col("cost")[0].alias("cost"))
    folded = known.where("several").groupBy("conv_id").applyInPandas(_fold_on, "conv_id long, seg long, edits string, cost long")
    return write_table(alone.unionByName(folded), "repair-edits")


class _Replay:
    """One conversation's edits, applied to its turns as they come."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.state, self.edits, self.at, self.audit = conv_id, 0, "", 0, []

    def plan(self, edits: str) -> None:
        self.edits, self.at = self.edits[self.at:] + edits, 0
        self.audit.append(edits)

    def inserted(self):
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._turn(), ""

    def _turn(self) -> str:
        role = "assistant" if self.state == 2 else "user"
        self.state = TURN[self.state]
        return role

    def turn(self, role: str, text: str):
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "R":
            yield self._turn(), text
        elif edit == "K":
            self.state = NEXT[self.state][role[:1]]
            yield role, text


def _replayed(batches, emit, flush):
    now = None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "edits", "role", "text")]
        for conv_id, edits, role, text in zip(*columns):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    emit(now, now.inserted())
                    flush(now)
                now = _Replay(conv_id)
            if edits is not None:
                now.plan(edits)
            else:
                emit(now, now.turn(role, text))
        yield
    if now is not None:
        emit(now, now.inserted())
        flush(now)
    yield


def _digests(batches):
    state, done = {}, []

    def emit(now, turns):
        for role, text in turns:
            if state.get("of") is not now:
                state.update(of=now, sha=hashlib.sha256())
                state["sha"].update(f"{role}:{text}".encode())
            else:
                state["sha"].update(f"\n{role}:{text}".encode())

    def flush(now):
        done.append((now.conv_id, "".join(now.audit), state["sha"].hexdigest() if state.get("of") is now else NO_TEXT))
    for _ in _replayed(batches, emit, flush):
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))],
                                         names=["conv_id", "audit", "repaired_sha256"])
        done.clear()


def _texts(batches):
    out, place = [], {}

    def emit(now, turns):
        for role, text in turns:
            place[now.conv_id] = place.get(now.conv_id, -1) + 1
            out.append((now.conv_id, place[now.conv_id], role, text))
    for _ in _replayed(batches, emit, lambda now: place.pop(now.conv_id, None)):
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                         names=["conv_id", "turn", "role", "text"])
        out.clear()


def _stream(rows: DataFrame, segs: DataFrame, edits: DataFrame) -> DataFrame:
    """Turns of each conversation in order, the edits of a segment in front of its first turn."""
    small_batches(rows.sparkSession)
    plans = edits.join(segs.select("conv_id", "seg", "turn", "tie_role", "tie_text"), ["conv_id", "seg"]).select(
        "conv_id", "turn", "tie_role", "tie_text", "seg", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    both = plans.unionByName(rows.withColumns({"seg": F.lit(None).cast("long"), "edits": F.lit(None).cast("string")}))
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", *_order(), F.col("seg").asc_nulls_last())
            .select("conv_id", "edits", "role", "text"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn (renumbered from 0), role, text of every conversation once repaired."""
    rows = _rows(turns)
    segs = segments(rows)
    return _stream(rows, segs, plan_edits(segs)).mapInArrow(_texts, "conv_id long, turn long, role string, text string")


def repair_reports(original: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per conversation of `original`: faults of its `rows` (from `damage` or `_rows`), cost, audit and digest of the repair."""
    segs = segments(rows)
    edits = plan_edits(segs)
    before = Window.partitionBy("conv_id").orderBy("seg")
    seam = F.concat(F.lag("last").over(before), F.col("first"))
    faults = segs.select("conv_id", "blank", "duplicate", "truncated", (
        F.col("illegal") + F.when(seam.isNull() | seam.isin("su", "ua", "au"), 0).otherwise(1)).alias("illegal"))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    turn = (rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
            .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")))
    digests = _stream(rows, segs, edits).mapInArrow(_digests, "conv_id long, audit string, repaired_sha256 string")
    every = original.where(original["conv_id"].isNotNull()).select(original["conv_id"].cast("long").alias("conv_id")).distinct()
    joined = (every.join(turn, "conv_id", "left").join(faults.groupBy("conv_id").agg(*sums), "conv_id", "left")
              .join(edits.groupBy("conv_id").agg(F.sum("cost").alias("cost")), "conv_id", "left").join(digests, "conv_id", "left"))
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NO_TEXT)).alias("repaired_sha256"))
