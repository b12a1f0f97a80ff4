"""Byte-level BPE: pre-token boundaries by a scan of transition functions, then cached merging.

Pre-tokenisation uses no regex.  Every code point has a class, looked up in an array; apostrophes
and white space get a finer class from the one or two code points after them.  A class is a
transition function on eight states.  The classes are laid out as blocks side by side: one sweep
down the blocks composes each block's function for all states at once, a scan over the blocks
gives every block its entry state (composition is associative), and a second sweep emits each
position's boundary flag.  Texts of a batch form one stream, parted by a class that resets the
state, and the stream is scanned in pieces of PIECE code points with the state carried over, so
memory does not grow with a text's length.

The slices between boundaries are pre-tokens.  Their ids come from a bounded cache; the misses of a
group of texts are merged together, lowest rank first and leftmost among equals, one pair per
pre-token and round in arrays.  Long ones go through a heap: a million bytes cost n log n.  Ids come with each pre-token's end in ids and in code points,
so text can be taken apart and decoded in any range.

Defined results: a null or empty text has no ids and decodes to no bytes; order, repeats and other
columns (whatever their names) do not matter, because the functions act on one column.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections import ChainMap

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import RecentCache, small_batches

PIECE = 1 << 20          # code points per scan
BLOCK = 256              # code points per block of a scan
GROUP_CHARS = 1 << 19    # code points of text handled together
CACHE_ENTRIES = 100_000  # pre-tokens cached per Python worker and generation
CACHED_CHARS = 64        # longer pre-tokens are not cached

# Classes.  0-3 come from the table; the others are made from them and the next code points.
OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3
SPACE_THEN, SPACE_WHITE, WHITE_THEN, WHITE_WHITE = 4, 5, 6, 7  # followed by text / by white space or the end
TWO, THREE, BREAK = 8, 9, 10                                   # 's 't 'm 'd / 're 've 'll / between texts
N_CLASSES = 11

# States: what the code point just read belongs to.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT, DONE = range(8)
N_STATES = 8


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, a pre-token starts here), both [class, state]."""
    nxt = np.zeros((N_CLASSES, N_STATES), np.uint8)
    cut = np.ones((N_CLASSES, N_STATES), bool)
    for cls, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        nxt[cls] = run
        cut[cls, [run, AFTER_SPACE]] = False  # goes on, or takes the one space before it
    for cls, state in ((TWO, ONE_LEFT), (THREE, TWO_LEFT)):
        nxt[cls] = state
        nxt[cls, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS  # here the apostrophe is ordinary
        cut[cls, [IN_OTHERS, AFTER_SPACE]] = False
    nxt[SPACE_THEN], nxt[WHITE_THEN] = AFTER_SPACE, DONE
    for cls in (SPACE_WHITE, WHITE_WHITE):
        nxt[cls] = IN_WHITE
        cut[cls, IN_WHITE] = False
    nxt[BREAK] = DONE
    for cls in range(N_CLASSES):
        if cls != BREAK:  # inside a contraction every code point is taken as it comes
            nxt[cls, ONE_LEFT], nxt[cls, TWO_LEFT] = DONE, ONE_LEFT
            cut[cls, [ONE_LEFT, TWO_LEFT]] = False
    return nxt, cut


NEXT, CUT = transitions()
NEXT_FLAT, CUT_FLAT = NEXT.reshape(-1), CUT.reshape(-1)


def class_runs() -> tuple[list[int], list[int]]:
    """(first code point of each run, its class), read off the tokenizer library's Unicode tables."""
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    table = np.zeros(0x110001, np.uint8)
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        matcher = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(matcher.encode_ordinary(text)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = cls
    starts = np.flatnonzero(np.diff(table, prepend=255))
    return starts.tolist(), table[starts].tolist()


def class_table(runs: tuple[list[int], list[int]]) -> np.ndarray:
    starts = np.array([*runs[0], 0x110001])
    return np.repeat(np.array(runs[1], np.uint8), np.diff(starts))


def classify(points: np.ndarray, after: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes of `points`; `after`: the two code points that follow (BREAK past the end of all)."""
    ext = np.concatenate([points, after])
    raw = table[np.minimum(ext, 0x110000)]
    is_break = ext > 0x10FFFF
    n = len(points)
    cls = raw[:n].copy()
    white = np.flatnonzero(raw[:n] == WHITE)
    ends = (raw[white + 1] == WHITE) | is_break[white + 1]
    cls[white] = np.where(points[white] == 32, SPACE_THEN, WHITE_THEN) + ends
    quote = np.flatnonzero(points == 39)
    if len(quote):
        a, b = ext[quote + 1], ext[quote + 2]
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)
        two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))
        cls[quote] = np.where(one, TWO, np.where(two, THREE, OTHER))
    cls[is_break[:n]] = BREAK
    return cls


def scan(cls: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Boundary flag of every position, and the state after the last, from the entry state."""
    n = len(cls)
    blocks = n // BLOCK
    flags = np.empty(n, bool)
    body = cls[:blocks * BLOCK].reshape(blocks, BLOCK).T.astype(np.uint8) * N_STATES  # [step, block]
    if blocks:
        body = np.ascontiguousarray(body)
        # compose: after each step, where every entry state of every block has got to
        at = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], blocks, 1)
        for row in body:
            at = NEXT_FLAT[row + at]
        entry = np.empty(blocks, np.uint8)
        for k, whole in enumerate(at.T.tolist()):  # the blocks' functions, applied in order
            entry[k] = state
            state = whole[state]
        out = np.empty((BLOCK, blocks), bool)
        for k, row in enumerate(body):
            index = row + entry
            out[k] = CUT_FLAT[index]
            entry = NEXT_FLAT[index]
        flags[:blocks * BLOCK] = out.T.reshape(-1)
    for k in range(blocks * BLOCK, n):
        flags[k] = CUT[cls[k], state]
        state = int(NEXT[cls[k], state])
    return flags, state


def boundaries(points: np.ndarray, table: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Positions in `points` (code points; values over 0x10FFFF part texts) where a pre-token or
    a part starts."""
    found, state = [], DONE
    end = np.array([0x110000, 0x110000], np.uint32)
    for a in range(0, len(points), piece):
        b = min(a + piece, len(points))
        after = np.concatenate([points[b:b + 2], end])[:2]
        flags, state = scan(classify(points[a:b], after, table), state)
        found.append(np.flatnonzero(flags) + a)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the neighbouring pair of lowest rank (leftmost first) until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))   # part starting at i is piece[i:end[i]]
    before = list(range(-1, n - 1))
    alive = bytearray(b"\x01" * n)
    heap = []

    def push(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}


def mergeable_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys `left id << 32 | right id` of all pairs of tokens that make a token, and its id."""
    found = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                found[a << 32 | b] = rank
    keys = np.array(sorted(found), np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], np.int64)


NO_PAIR = 1 << 40


def merge_many(pieces: list[bytes], byte_ids: np.ndarray, pairs) -> list[bytes]:
    """What `merge` gives for each piece (not empty), as 32-bit integers; one merge per piece and round."""
    keys, made = pairs

    def rank(a, b):
        key = a << 32 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, made[at], NO_PAIR)

    out: list[bytes] = [b""] * len(pieces)
    part = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
    score = np.full(len(part), NO_PAIR)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    score[inner] = rank(part[inner], part[inner + 1])
    while len(part):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        size = np.diff(np.append(first, len(part)))
        best = np.minimum.reduceat(score, first)
        over = best == NO_PAIR
        if over.any():
            blob = part.astype(np.int32).tobytes()
            for k, a, n in zip(owner[first[over]].tolist(), first[over].tolist(), size[over].tolist()):
                out[k] = blob[4 * a:4 * (a + n)]
            stay = np.repeat(~over, size)
            part, owner, score = part[stay], owner[stay], score[stay]
            best, size = best[~over], size[~over]
            if not len(part):
                break
        hits = np.flatnonzero(score == np.repeat(best, size))
        hits = hits[np.diff(owner[hits], prepend=-1) != 0]  # the leftmost of each piece
        part[hits] = best
        stay = np.ones(len(part), bool)
        stay[hits + 1] = False
        part, owner, score = part[stay], owner[stay], score[stay]
        hits -= np.arange(len(hits))
        score[hits] = NO_PAIR
        right = hits[hits + 1 < len(part)]
        right = right[owner[right] == owner[right + 1]]
        score[right] = rank(part[right], part[right + 1])
        left = hits[hits > 0] - 1
        left = left[owner[left] == owner[left + 1]]
        score[left] = rank(part[left], part[left + 1])
    return out


class Encoder:
    """One per Python worker: class table, ranks and the pre-token cache."""

    def __init__(self, blob: bytes, runs) -> None:
        self.table = class_table(runs)
        self.ranks = parse_ranks(blob)
        self.pairs = mergeable_pairs(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.cache = RecentCache(CACHE_ENTRIES)

    def learn(self, tokens: set[str]) -> dict[str, bytes]:
        """A mapping that holds every one of `tokens`: the cache, and the long ones beside it."""
        long, new, pieces = {}, [], []
        missing = self.cache.missing(tokens)
        cache = self.cache.young
        for token in missing:
            piece = token.encode()
            known = self.ranks.get(piece)
            if known is not None:
                cache[token] = known.to_bytes(4, "little")
            elif len(token) > CACHED_CHARS:
                long[token] = np.array(merge(piece, self.ranks), np.int32).tobytes()
            else:
                new.append(token), pieces.append(piece)
        if pieces:
            cache.update(zip(new, merge_many(pieces, self.byte_ids, self.pairs)))
        return ChainMap(long, cache) if long else cache

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, their count per text; then per pre-token its end in ids and in code points, both
        within its text, and the count of pre-tokens per text."""
        joined = "\0".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate([[0], np.cumsum(lengths + 1)])  # of each text; a break ends it
        points[first[1:-1] - 1] = 0x110000
        starts = boundaries(points, self.table)
        stops = np.append(starts[1:], len(points))
        real = points[starts] <= 0x10FFFF if len(starts) else np.zeros(0, bool)
        starts, stops = starts[real], stops[real]
        tokens = [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        known = self.learn(set(tokens))
        found = [known[t] for t in tokens]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        owner = np.searchsorted(first, starts, "right") - 1
        per_text = np.bincount(owner, minlength=len(texts))
        ends = np.cumsum(sizes)
        token_first = np.concatenate([[0], np.cumsum(per_text)])
        id_first = np.concatenate([[0], ends])[token_first]
        return (flat, np.diff(id_first), (ends - id_first[:-1][owner]).astype(np.int32),
                (stops - first[owner]).astype(np.int32), per_text)


_WORKER: dict = {}  # what this Python worker has built, by the vocabulary's checksum and purpose


def _share(ranks_path: str):
    """The vocabulary file (under a megabyte, read on the driver) for every executor, and its key."""
    with open(ranks_path, "rb") as f:
        blob = f.read()
    return SparkSession.active().sparkContext.broadcast(blob), zlib.crc32(blob)


ENCODED = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    T.StructField("id_ends", T.ArrayType(T.IntegerType(), False)),
    T.StructField("char_ends", T.ArrayType(T.IntegerType(), False))])


def _lists(counts: list[np.ndarray], values: list[np.ndarray]) -> pa.ListArray:
    counts, values = np.concatenate(counts), np.concatenate(values)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))


def encode(text_col, ranks_path: str):
    """Column struct(ids, id_ends, char_ends) of a text column: pre-token k has the ids up to
    id_ends[k] and the code points up to char_ends[k]."""
    runs, (vocabulary, key) = class_runs(), _share(ranks_path)
    small_batches(SparkSession.active())

    @F.arrow_udf(ENCODED)
    def run(texts: pa.Array) -> pa.Array:
        encoder = _WORKER.get(("encode", key))
        if encoder is None:
            encoder = _WORKER["encode", key] = Encoder(vocabulary.value, runs)
        empty = np.zeros(0, np.int32)
        ids, n_ids, id_ends, char_ends, n_tokens = [empty], [empty], [empty], [empty], [empty]
        group, size, parts = [], 0, []
        for t in texts:
            t = t.as_py() or ""
            if group and size + len(t) > GROUP_CHARS:
                parts.append(encoder.encode_texts(group))
                group, size = [], 0
            group.append(t)
            size += len(t)
        if group:
            parts.append(encoder.encode_texts(group))
        for flat, n, e, c, k in parts:
            ids.append(flat), n_ids.append(n), id_ends.append(e), char_ends.append(c), n_tokens.append(k)
        return pa.StructArray.from_arrays(
            [_lists(n_ids, ids), _lists(n_tokens, id_ends), _lists(n_tokens, char_ends)],
            names=["ids", "id_ends", "char_ends"])

    return run(text_col)


def token_bytes(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row; by id, where each begins and its length."""
    ranks = parse_ranks(blob)
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    tokens = sorted(ranks, key=ranks.get)
    size[[ranks[t] for t in tokens]] = [len(t) for t in tokens]
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def decode_ids(ids: np.ndarray, tokens) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids in a row, and the number of bytes of each."""
    data, first, size = tokens
    n = size[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) + np.repeat(first[ids] - (ends - n), n)
    return data[place], n


def decode(ids_col, ranks_path: str):
    """Binary column of the bytes that a column of ids stands for (null: no bytes)."""

    vocabulary, key = _share(ranks_path)
    small_batches(SparkSession.active())

    @F.arrow_udf(T.BinaryType())
    def run(ids: pa.Array) -> pa.Array:
        tokens = _WORKER.get(("decode", key))
        if tokens is None:
            tokens = _WORKER["decode", key] = token_bytes(vocabulary.value)
        out = []
        step = 512  # rows decoded together
        for a in range(0, len(ids), step):
            rows = ids.slice(a, step)
            counts = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, n = decode_ids(rows.flatten().to_numpy(zero_copy_only=False), tokens)
            ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
            blob = data.tobytes()
            out += [blob[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.array(out, pa.binary())

    return run(ids_col)
