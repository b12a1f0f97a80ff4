"""Conversation prefix trie: prefixes that several conversations share, screened by a count-min sketch.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.

* A prefix's digest is the exclusive or of two 64-bit hashes of its (depth, turn) pairs.  Running digests
  need no recurrence, so long conversations are split into segments (ordered.py).
* Every task counts the digests of its rows in a count-min sketch whose cells stop at two (two bitmaps:
  at least one, at least two).  Sketches are merged block by block; the merged bitmap of cells that
  reached two is broadcast: 2**MAX_BITS cells in each of ROWS rows at most, 8 MB.
* A digest with a cell below two has an estimate of one, and the estimate is never too small: the prefix is
  proven a singleton.  Such tails are emitted where they lie: one member, one leaf, nothing saved, the parent is
  the same conversation.  Only prefixes that may be shared are shuffled and grouped exactly; a false
  alarm is grouped too and comes out with one member.
* Sums over subtrees are sums over members.  Every node is owned by its smallest member; a conversation owns
  all its nodes from some depth on.  With q(c) the words before the first node that c owns, what the
  subtree of v saves is the sum of q over its members but the owner, minus (members - 1) times
  the words above v; its leaves are the members that own a leaf.

Above about 2**MAX_BITS prefixes the sketch fills up and lets more through to the exact grouping; the
result stays the same.

Defined results: null role or text counts as empty; turns go by turn (null first), then role, then the text's
digest; repeated rows are turns of their own; rows without conv_id belong to no conversation and take
no part; an empty table has no node; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.llm.common import NOT_SPACE, write_table
from vaultmart.llm.ordered import in_order

ROWS = 4
MIN_BITS, MAX_BITS = 14, 24
BLOCK = 1 << 13  # bytes of a bitmap block
SEEDS = (7919, 104729)
KEY = ["d", "x1", "x2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- turns ---------------------------------------------------------------------------------------
def number_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, n; steps: conv_id, seg, d, digest, words), d numbering the turns from 1."""
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(NOT_SPACE)).cast("long").alias("words"))
    placed = in_order(rows, ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"], "trie-turns").drop("role", "turn")
    counts = placed.groupBy("conv_id", "seg").agg(F.count("*").alias("n"))
    before = counts.select("conv_id", "seg", (
        F.sum("n").over(Window.partitionBy("conv_id").orderBy("seg")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("conv_id", "seg").orderBy("at"))
    steps = placed.withColumn("number", number).join(before, ["conv_id", "seg"]).select(
        "conv_id", "seg", (F.col("before") + F.col("number")).alias("d"), "digest", "words")
    return counts.groupBy("conv_id").agg(F.sum("n").alias("n")), steps


def borrow_heads(convs: DataFrame, steps: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Steps in which conversation c begins with the first h turns of c - c % every, h = crc32(c) % most,
    instead of its own first h (% as in SQL: of the sign of c)."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % most).alias("h")
    bases = convs.select(c.alias("base"), F.col("n").alias("n_base"))
    plan = convs.select(c, h, (c - c % every).alias("base")).join(bases, "base", "left").select(
        c, "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("take"))
    own = steps.join(plan.select("conv_id", "h", "take"), "conv_id").where(F.col("d") > F.col("h")).select(
        "conv_id", "seg", (F.col("d") - F.col("h") + F.col("take")).alias("d"), "digest", "words")
    heads = steps.where((c % every == 0) & (F.col("d") < most)).select(c.alias("base"), "d", "digest", "words")
    borrowed = plan.join(heads, "base").where(F.col("d") <= F.col("take")).select(
        "conv_id", F.lit(-1).cast("long").alias("seg"), "d", "digest", "words")
    return own.unionByName(borrowed)


# -- prefixes --------------------------------------------------------------------------------------
def prefixes(steps: DataFrame) -> DataFrame:
    """Written table, a row per conversation and depth: the digests of the prefix (x1, x2) and of the one above
    (p1, p2), its words and those of the last turn, the conversation's depth and words."""
    inside = Window.partitionBy("conv_id", "seg").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k, seed in enumerate(SEEDS, 1):
        steps = steps.withColumn(f"g{k}", F.xxhash64(F.lit(seed), "d", "digest"))
    local = write_table(steps.select(
        "conv_id", "seg", "d", "words", "g1", "g2", F.bit_xor("g1").over(inside).alias("x1"),
        F.bit_xor("g2").over(inside).alias("x2"), F.sum("words").over(inside).alias("upto")), "trie-local")
    totals = local.groupBy("conv_id", "seg").agg(
        F.bit_xor("g1").alias("t1"), F.bit_xor("g2").alias("t2"), F.sum("words").alias("t"), F.max("d").alias("last"))
    above = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    before = totals.select(
        "conv_id", "seg", *(F.coalesce(f(c).over(above), F.lit(0).cast("long")).alias(o) for f, c, o in (
            (F.bit_xor, "t1", "o1"), (F.bit_xor, "t2", "o2"), (F.sum, "t", "o"))),
        F.max("last").over(whole).alias("len"), F.sum("t").over(whole).alias("total"))
    x1, x2 = (F.col(f"x{k}").bitwiseXOR(F.col(f"o{k}")) for k in (1, 2))
    return write_table(local.join(before, ["conv_id", "seg"]).select(
        "conv_id", "d", "len", "total", "words", (F.col("upto") + F.col("o")).alias("upto"), x1.alias("x1"), x2.alias("x2"),
        x1.bitwiseXOR(F.col("g1")).alias("p1"), x2.bitwiseXOR(F.col("g2")).alias("p2")), "trie-prefixes")


# -- count-min screening ---------------------------------------------------------------------------
def _cells(x1: np.ndarray, x2: np.ndarray, row: int, bits: int) -> np.ndarray:
    mixed = (x1.view(np.uint64) + np.uint64(row) * (x2.view(np.uint64) | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64) + (row << bits)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _sketch(bits: int):
    def run(batches):
        once, twice = np.zeros(ROWS << bits, bool), np.zeros(ROWS << bits, bool)
        for batch in batches:
            x1, x2 = _columns(batch, "x1", "x2")
            for row in range(ROWS):
                cell, n = np.unique(_cells(x1, x2, row, bits), return_counts=True)
                twice[cell[(n > 1) | once[cell]]] = True
                once[cell] = True
        a, b = np.packbits(once), np.packbits(twice)
        for k in range(0, len(a), BLOCK):
            if a[k:k + BLOCK].any():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([k // BLOCK], pa.int32()), "once": pa.array([a[k:k + BLOCK].tobytes()], pa.binary()),
                    "twice": pa.array([b[k:k + BLOCK].tobytes()], pa.binary())})
    return run


def _merge(batches):
    """Sketch blocks in order of their number: one at a time in memory."""
    at, once, twice = None, None, None
    for batch in batches:
        for r in batch.to_pylist():
            a, b = (np.frombuffer(r[n], np.uint8) for n in ("once", "twice"))
            if r["block"] == at:
                twice = twice | b | (once & a)
                once = once | a
                continue
            if at is not None:
                yield _block(at, twice)
            at, once, twice = r["block"], a, b
    if at is not None:
        yield _block(at, twice)


def _block(at, twice):
    return pa.RecordBatch.from_pydict({"block": pa.array([at], pa.int32()), "twice": pa.array([twice.tobytes()], pa.binary())})


def possibly_shared(rows: DataFrame, bits: int) -> bytes:
    """Bitmap of the sketch's cells that two or more prefixes fell into."""
    sketches = rows.select("x1", "x2").mapInArrow(_sketch(bits), "block int, once binary, twice binary")
    merged = sketches.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, "block int, twice binary")
    bitmap = np.zeros((ROWS << bits) // 8, np.uint8)
    for r in merged.toLocalIterator():  # ROWS << MAX_BITS bits at most
        bitmap[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["twice"], np.uint8)
    return bitmap.tobytes()


def screen(rows: DataFrame, bits: int | None = None) -> DataFrame:
    """Written table: `rows` plus `single` and `parent_single`, true where the sketch proves one member."""
    if bits is None:
        bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(2 * rows.count() + 1))))
    shared = rows.sparkSession.sparkContext.broadcast(possibly_shared(rows, bits))  # 8 MB at most

    def test(batches):
        bitmap = np.frombuffer(shared.value, np.uint8)

        def single(x1, x2):
            out = np.zeros(len(x1), bool)
            for row in range(ROWS):
                cell = _cells(x1, x2, row, bits)
                out |= (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
            return out
        for batch in batches:
            d, x1, x2, p1, p2 = _columns(batch, "d", "x1", "x2", "p1", "p2")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(single(x1, x2)), pa.array(single(p1, p2) & (d > 1))],
                names=[*batch.schema.names, "single", "parent_single"])
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", single boolean, parent_single boolean"
    return write_table(rows.mapInArrow(test, schema), "trie-screened")


# -- nodes -----------------------------------------------------------------------------------------
def _hash_ends(batches):
    """Rows (key, conv_id) in order: a digest per key, fed as the ids come, so memory stays constant."""
    key, state, done = None, None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if r[:3] != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = r[:3], hashlib.sha256(str(r[3]).encode())
            else:
                state.update(f",{r[3]}".encode())
        if done:
            yield _ends(done)
            done = []
    if key is not None:
        yield _ends([(*key, state.hexdigest())])


def _ends(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                      names=[*KEY, "ends_sha256"])


def _hashed(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256).  A digest is sequential by definition: the ids of one node pass through one task, sorted and
    streamed, 32 bytes each and one per conversation."""
    rows = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return rows.mapInArrow(_hash_ends, "d long, x1 long, x2 long, ends_sha256 string")


def build(convs: DataFrame, steps: DataFrame, bits: int | None = None) -> DataFrame:
    """The trie of the conversations `convs` (conv_id), whose turns are `steps` (conv_id, seg, d, digest, words): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node."""
    rows = screen(prefixes(steps), bits)
    tails, alive = rows.where("single"), rows.where("not single")
    shared = alive.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("len").alias("longest"),
                                     F.max(F.col("upto") - F.col("words")).alias("above"))
    owned = (shared.groupBy("conv_id").agg(F.min("d").alias("s"), F.min_by("above", "d").alias("q"),
                                           F.bool_or(F.col("longest") == F.col("d")).alias("leaf"))
             .unionByName(tails.groupBy("conv_id").agg(
                 F.min("d").alias("s"), F.min_by(F.col("upto") - F.col("words"), "d").alias("q"),
                 F.bool_or(F.col("len") == F.col("d")).alias("leaf")))
             .groupBy("conv_id").agg(F.min("s").alias("s"), F.min_by("q", "s").alias("q"), F.bool_or("leaf").alias("leaf")))
    sums = rows.where("d = 1").select("conv_id", "len", "total")
    first = write_table(convs.select("conv_id").join(sums, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("len", F.lit(0)).cast("long").alias("len"), "s",
        F.coalesce("q", "total", F.lit(0)).cast("long").alias("q"), F.coalesce("leaf", F.lit(False)).alias("leaf")), "trie-owners")

    many = lambda c: F.sum(c.cast("long"))
    top = first.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.coalesce(many(F.col("s") == 1), F.lit(0)).alias("n_children"),
                    F.greatest(F.coalesce(many(F.col("leaf")), F.lit(0)), F.lit(1)).alias("n_leaves"), F.sum("q").alias("saved_tokens")).where("n_convs > 0")
    nodes = write_table(alive.join(first.select("conv_id", "s", "q", "leaf"), "conv_id").groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        (many(F.col("s") == F.col("d") + 1) + (F.min_by("len", "conv_id") > F.max("d")).cast("long")).alias("n_children"),
        many(F.col("leaf")).alias("n_leaves"),
        (F.sum("q") - F.min_by("q", "conv_id") - (F.count("*") - 1) * F.max(F.col("upto") - F.col("words"))).alias("saved_tokens"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.bool_or("parent_single").alias("parent_single")), "trie-nodes")
    zero = F.lit(0).cast("long")
    ends = _hashed(alive.where("d = len").unionByName(
        first.where("len = 0").select(zero.alias("d"), zero.alias("x1"), zero.alias("x2"), "conv_id"), allowMissingColumns=True))
    ends = write_table(ends, "trie-ends")

    out = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ended = F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    root = top.withColumn("d", zero).join(ends.where("d = 0").select("d", "ends_sha256"), "d", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), *out[1:-1], ended)
    lone = tails.select(
        *KEY, "p1", "p2", "parent_single", "conv_id", F.lit(1).cast("long").alias("n_convs"),
        (F.col("len") > F.col("d")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("len") == F.col("d"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))
    every = nodes.join(ends, KEY, "left").select(*KEY, "p1", "p2", "parent_single", *out[:-1], ended)
    least = top.select("conv_id").first()  # one row
    least = F.lit(least["conv_id"] if least else None).cast("long")

    def place(df, parent):
        return df.select("conv_id", F.col("d").alias("depth"), parent.alias("parent_conv_id"), *out[1:])
    # the parent of a tail's first node, or of a shared node, is found by its key; others lie at hand
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent"))
    both = every.unionByName(lone)
    looked = place(both.where("d > 1 and not parent_single").join(parents, ["d", "p1", "p2"]), F.col("parent"))
    near = place(both.where("d = 1 or parent_single"), F.when(F.col("d") == 1, least).otherwise(F.col("conv_id")))
    return root.unionByName(near).unionByName(looked)
