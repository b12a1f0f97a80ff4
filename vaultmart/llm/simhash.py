"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

Fingerprints.  A bit is set if it is set in more than half of the 64-bit hashes of the text's
word shingles (repeats count).  Documents of equal fingerprint are one class; only classes are compared.

Candidates.  Two fingerprints that differ in at most RADIUS = 3 bits agree on one of four 16-bit
bands, and then on one of four 12-bit parts of the other 48 bits.  So every class is listed under
16 keys of 28 bits, and all pairs within the radius share a key: the search is exact.  Keys with
one class are dropped; a key with more than BLOCK classes is dealt into blocks by a hash, and every
pair of blocks is a unit of work, so no task gathers more than two blocks.

Comparison.  A unit's fingerprints are stored as 64 bit planes.  For a run of queries, plane by
plane, the mismatch words (plane xor query bit) are added to vertical counters (ones, twos and a
sticky "over") by carry-save steps; a run is abandoned as soon as every candidate is over the
radius.  Small units are laid side by side and compared at each distance between rows instead, with
the same counters over packed planes of differences.

Links.  A unit passes on a spanning forest of its links, not all pairs: what is connected stays
connected and the rows do not grow with the square of a group.  Components are found by star steps
over classes; a component's id is its smallest document id.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; texts of fewer
words than a shingle hash their whole word sequence; repeated rows share a class; null ids get the
component of their class (null if no member has an id); an empty table gives an empty result; other columns
pass through `drop_near_duplicates` and are ignored elsewhere, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm.common import free_name, scratch, small_batches, write_table
from vaultmart.llm.components import connected_components
from vaultmart.llm.line_dedup import bitmap, with_mark

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCK = 1024
SMALL = 24           # units of at most this many rows are compared side by side
QUERIES_AT_ONCE = 128
PLANES_PER_TEST = 8  # planes added between two tests for abandoning


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text in UTF-8: A-Z lower-cased, words parted by ASCII white space."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())])  # big endian
    n = len(hashes) // 8
    counts = np.zeros(64, np.int64)
    step = 1 << 16
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for a in range(0, n, step):
        counts += np.unpackbits(rows[a:a + step], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text_col, shingle: int = SHINGLE):
    """String column of 16 lowercase hex digits."""
    small_batches(SparkSession.active())

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.binary()):
            out.append(f"{text_fingerprint(t.as_py() or b'', shingle):016x}")
        return pa.array(out, pa.string())
    return run(text_col)


def _planes(values: np.ndarray) -> np.ndarray:
    """[64, words] bit planes of 64-bit values: bit b of value i is bit i of plane b."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
    packed = np.packbits(bits, axis=1, bitorder="little")
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view("<u8")


def _within(mismatch, shape, n: int, radius: int) -> np.ndarray:
    """Words whose bits tell which of `n` candidates have at most `radius` mismatches over the 64 planes.

    `mismatch(b)` gives plane b's mismatch words.  Counters are vertical: bit i of counter j is
    bit j of candidate i's count; what is over the radius stays over (as do the bits past the last)."""
    n_counters = (radius + 1).bit_length()
    counters = [np.zeros(shape, np.uint64) for _ in range(n_counters)]
    over = np.zeros(shape, np.uint64)
    if n % 64:
        over[..., -1] = np.uint64((0xFFFFFFFFFFFFFFFF << n % 64) & 0xFFFFFFFFFFFFFFFF)
    for b in range(64):
        carry = mismatch(b)
        for j in range(n_counters):
            counters[j], carry = counters[j] ^ carry, counters[j] & carry
        over |= carry
        if b % PLANES_PER_TEST == PLANES_PER_TEST - 1:
            over |= _greater(counters, radius)
            if b < 63 and (over == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
                break
    return ~over


def _greater(counters, radius: int) -> np.ndarray:
    """Bits of the candidates whose count exceeds `radius`."""
    more = np.zeros_like(counters[0])
    equal = ~more
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal = equal & counters[j]
        else:
            more |= equal & counters[j]
            equal = equal & ~counters[j]
    return more


def links_in_unit(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i in a, j in b) within the radius, by queries against bit planes."""
    planes = _planes(b)
    flip = np.unpackbits(a.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(bool)  # [query, plane]
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    left, right = [], []
    for q in range(0, len(a), QUERIES_AT_ONCE):
        mask = np.where(flip[q:q + QUERIES_AT_ONCE], ones, np.uint64(0))
        near = _within(lambda p: planes[p][None, :] ^ mask[:, p, None], (len(mask), planes.shape[1]), len(b), radius)
        hit = np.unpackbits(np.ascontiguousarray(near).view(np.uint8), axis=1, bitorder="little",
                            count=len(b)).view(bool)
        i, j = np.nonzero(hit)
        left.append(i + q), right.append(j)
    return np.concatenate(left), np.concatenate(right)


def links_of_pairs(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """Flags of the row-wise pairs (x[i], y[i]) within the radius."""
    planes = _planes(x ^ y)
    near = _within(lambda p: planes[p], planes.shape[1:], len(x), radius)
    return np.unpackbits(near.view(np.uint8), bitorder="little", count=len(x)).view(bool)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a[i], b[i]): every node linked to the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low), np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[root[moved]], nodes[moved]


def _unit_links(values: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one large unit: block against itself (side 0 only) or block against block."""
    first, second = values[side == 0], values[side == 1]
    if not len(first):
        return first, first
    i, j = links_in_unit(first, second if len(second) else first, radius)
    other = second if len(second) else first
    return spanning(first[i], other[j])


def class_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) as hex strings that connect all fingerprints within the radius of each other.

    `classes` has one row per distinct fingerprint in column `fp` (16 hex digits).  The bands make the
    search exact for radius 3 or less."""
    if radius > 3:
        raise ValueError("the keys are exact up to 3 differing bits")
    keys = []
    for band in range(4):
        own = f"substr(fp, {4 * band + 1}, 4)"
        rest = f"concat(substr(fp, 1, {4 * band}), substr(fp, {4 * band + 5}))"
        keys += [f"conv(concat('{4 * band + part:x}', {own}, substr({rest}, {3 * part + 1}, 3)), 16, 10)"
                 for part in range(4)]
    listed = classes.select("fp", F.explode(F.expr(f"array({', '.join(keys)})")).alias("key")).select(
        "fp", F.col("key").cast("long").alias("key"))
    listed = write_table(listed, "simhash-keys")
    sizes = listed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.expr("key + 0L").alias("k"), F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("blocks"))
    # both inputs plain exchanges: a key that holds much of the table is split by AQE
    found = listed.join(sizes, listed["key"] == sizes["k"]).select(
        "key", "fp", "blocks", F.expr("cast(pmod(xxhash64(fp, key), blocks) as int)").alias("block"))
    units = found.select("key", "fp", F.explode(F.expr(
        "transform(sequence(0, blocks - 1), o -> struct(least(block, o) as i, greatest(block, o) as j, "
        "case when block > o then 1 else 0 end as side))")).alias("u")).select(
        "key", "fp", "u.i", "u.j", "u.side")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (units.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "side"))

    def search(batches):
        held = None
        for batch in batches:
            rows = [np.array([int(f, 16) for f in batch.column("fp").to_pylist()], np.uint64),
                    *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "side")]]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            n = len(rows[0])
            if not n:
                continue
            _, key, i, j, _ = rows
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begins = np.flatnonzero(new)
            held = [x[begins[-1]:] for x in rows]  # the last unit may go on in the next batch
            yield from compare([x[:begins[-1]] for x in rows], begins)
        if held is not None:
            yield from compare(held, np.array([0, len(held[0])]))

    def compare(rows, bounds):
        """`bounds`: where the units begin, and the end of the last."""
        values, _, i, j, side = rows
        if not len(values):
            return
        sizes = np.diff(bounds)
        one_block = (i == j)[bounds[:-1]]
        small = one_block & (sizes <= SMALL)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        left, right = [], []
        flat = small[unit]
        v, u = values[flat], unit[flat]
        for lag in range(1, int(sizes[small].max(initial=1))):
            near = np.flatnonzero(u[lag:] == u[:-lag])
            x, y = v[near], v[near + lag]
            hit = links_of_pairs(x, y, radius) if len(near) else np.zeros(0, bool)
            left.append(x[hit]), right.append(y[hit])
        for k in np.flatnonzero(~small).tolist():
            a, b = bounds[k], bounds[k + 1]
            x, y = _unit_links(values[a:b], side[a:b], radius)
            left.append(x), right.append(y)
        if left:
            x, y = spanning(np.concatenate(left), np.concatenate(right))
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{f:016x}" for f in z.tolist()], pa.string()) for z in (x, y)], names=["a", "b"])

    return dealt.mapInArrow(search, "a string, b string")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per document."""
    marked = write_table(docs.select(docs[id_col].alias("doc_id"), fingerprint(docs[text_col], shingle)
                                     .alias("fingerprint")), "simhash")
    return marked.join(class_components(marked, radius), marked["fingerprint"] == F.col("_fp")).select(
        "doc_id", "fingerprint", "component_id")


def class_components(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(_fp, _root, component_id) for every distinct fingerprint of `marked` (doc_id, fingerprint)."""
    with scratch(marked.sparkSession):
        classes = write_table(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
                              .withColumnRenamed("fingerprint", "fp"), "simhash-classes")
        roots = connected_components(class_links(classes.select("fp"), radius))
        rooted = write_table(classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
        least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).select(
            F.concat("root", F.lit("")).alias("r"), "component_id")
        # a table of its own: its size is known to the planner, and a class that holds a third of all
        # documents meets it in a join whose inputs are both plain exchanges
        return write_table(rooted.join(least, rooted["root"] == least["r"])
                           .select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), "component_id"),
                           "simhash-components", keep=True)


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest id (null ids last), of
    repeated rows one.  It is found by a grouped minimum, never by gathering a component."""
    fp, row = free_name(docs.columns, "_fingerprint"), free_name(docs.columns, "_row")
    # written, so that a row's number is fixed
    marked = write_table(docs.withColumns({fp: fingerprint(docs[text_col], shingle),
                                           row: F.monotonically_increasing_id()}), "simhash-docs", "zstd")
    ids = marked.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fingerprint"), F.col(row).alias("row"))
    component = class_components(ids, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("k")
    members = ids.join(component, ids["fingerprint"] == component["_fp"])
    chosen = members.groupBy("_root").agg(first).select(F.col("k.row").alias("r"))
    gone = write_table(ids.select("row").join(chosen, ids["row"] == chosen["r"], "left_anti").select("row"), "simhash-gone")
    # documents that cannot be among those gone are not shuffled to find out; in a struct their columns clash with none
    whole = marked.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(row).alias("row"),
                          F.xxhash64(row).alias("key"))
    found = with_mark(whole, ["key"], bitmap(gone.select(F.xxhash64("row").alias("key"))))
    stay = found.filter("not marked").unionByName(found.filter("marked").join(gone, "row", "left_anti").select(found.columns))
    return stay.select("doc.*")
