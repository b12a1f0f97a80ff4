"""Token ids on disk in directly addressable codes, and reading them back, whole or by position.

A shard holds the ids of a run of documents.  An id is split into chunks of CHUNK_BITS bits, lowest
first.  Level 0 holds the lowest chunk of every id; a continuation bit per entry says whether the id
has more chunks, and level j + 1 holds the next chunk of just those entries of level j that go on.
The entry's place in the next level is the number of continuation bits before it: a rank
directory stores that count for every 512 bits, and the rest is one popcount of at most 64 bytes.
So any id is found in a few steps from its position, without decoding its neighbours.

Layout, little endian: magic, version, chunk bits, number of levels, documents, ids (all
unsigned 32 bit); the 64-bit end of every document in ids; then per level its length in entries (64
bit), the chunks (one byte each), the continuation bits (one per entry, padded to 64 bytes) and the
directory (64 bit per 512 entries).  The last level has neither bits nor directory.

Shards are rows of Parquet tables in a folder that every executor reaches, so any store Spark writes
to will do, and a rerun task replaces its own output (Spark's commit protocol), nothing else.

Documents are ordered by id (nulls first), equal ids by the hash of their text.  `start` is the
number of ids of all documents before: shards carry it within their range partition, and the
partitions' totals, one row each, are summed.  Defined results: a null or empty text has the end id
only; repeated rows are written each; an empty table gives no shards and an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultmart.llm.common import LOWER, UPPER, RecentCache, new_run_dir, small_batches

MAGIC, VERSION, CHUNK_BITS = 0x31434144, 1, 8
RANK_BITS = 512
SHARD_IDS = 1 << 18      # a shard is closed at the first document end past this many ids
CACHE_ENTRIES = 250_000  # words cached per Python worker and generation
GROUP_BYTES = 1 << 22
STOPS = ".,;:!?"
# letters that the text rules only lower-case: ASCII and Latin-1, which no normal form changes or joins
LETTERS = UPPER + LOWER + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
TAIL = 4
# the split pattern that the vocabulary file must state for the shortcuts of WordEncoder to hold
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def encode_shard(ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    """The file image of `ids` (unsigned 32 bit) with the documents' ends."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more != 0
        last = not goes_on.any()
        body = [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes()]
        if not last:
            bits = np.packbits(goes_on, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
            per = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(1, dtype=np.int64)
            body += [bits.tobytes(), (np.cumsum(per) - per).astype("<u8").tobytes()]
        levels.append(b"".join(body))
        if last:
            break
        rest = more[goes_on]
    head = struct.pack("<6I", MAGIC, VERSION, CHUNK_BITS, len(levels), len(doc_ends), len(ids))
    return b"".join([head, doc_ends.astype("<u8").tobytes(), *levels])


class Shard:
    """Reads a file image: `ids()` all, `access(i)` the id at any position, `document(k)` its ids."""

    def __init__(self, blob: bytes) -> None:
        magic, version, bits, n_levels, n_docs, self.n_ids = struct.unpack_from("<6I", blob)
        if (magic, version, bits) != (MAGIC, VERSION, CHUNK_BITS):
            raise ValueError("not a token file of this version")
        self.doc_ends = np.frombuffer(blob, "<u8", n_docs, 24).astype(np.int64)
        at = 24 + 8 * n_docs
        self.levels = []
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            chunks = np.frombuffer(blob, np.uint8, n, at + 8)
            at += 8 + n
            bits = ranks = None
            if k + 1 < n_levels:
                groups = -(-n // RANK_BITS)
                bits = np.frombuffer(blob, np.uint8, groups * RANK_BITS // 8, at)
                at += groups * RANK_BITS // 8
                ranks = np.frombuffer(blob, "<u8", groups, at)
                at += 8 * groups
            self.levels.append((chunks, bits, ranks))

    def access(self, i: int) -> int:
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (k * CHUNK_BITS)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            group = i // RANK_BITS
            before = bits[group * RANK_BITS // 8:i >> 3]
            inside = int(np.bitwise_count(before).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(ranks[group]) + inside
        return value

    def ids(self) -> np.ndarray:
        rest = None
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if bits is not None:
                goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
                value[goes_on] |= rest << CHUNK_BITS
            rest = value
        return rest

    def document(self, k: int) -> np.ndarray:
        a = int(self.doc_ends[k - 1]) if k else 0
        return np.array([self.access(i) for i in range(a, int(self.doc_ends[k]))], np.uint32)


class _Tails(dict):
    """Ids of the stops at a word's end.  Of more than TAIL of them, which no text has often, none are kept."""

    def __init__(self, library) -> None:
        super().__init__({"": b""})
        self.library = library

    def __missing__(self, stops: str) -> bytes:
        ids = _packed(self.library.encode(stops, add_special_tokens=False).ids)
        if len(stops) <= TAIL:
            self[stops] = ids
        return ids


class WordEncoder:
    """Ids by the tokenizers library.  The model's text rules never join across a space or a line
    end, so each stretch between them is encoded once and kept in a bounded cache.  Nor do they join letters
    and the punctuation after them, and they lower-case, so words go to its merge model as runs of lower-case letters,
    their stops apart: stretches of LETTERS that differ only in case and stops are one entry of the cache."""

    def __init__(self, model_json: str) -> None:
        from tokenizers import Tokenizer

        rules = json.loads(model_json)
        kinds = [n["type"] for n in rules["normalizer"]["normalizers"]]
        split = rules["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["pattern"]["Regex"] != WORD_RULE:
            raise ValueError("this vocabulary's text rules are not known to part at white space")
        self.library = Tokenizer.from_str(model_json)
        self.model, self.normalizer = self.library.model, self.library.normalizer
        self.byte_chars = {b: c for c, b in _byte_alphabet().items()}
        self.stretches, self.tails = RecentCache(CACHE_ENTRIES), _Tails(self.library)

    def learn(self, stretches: list[str]) -> dict[str, bytes]:
        """A mapping that holds the ids of every one of `stretches`, as little-endian 32-bit integers.

        A run of letters is one pre-token whatever stands around it: it goes straight to the library's
        merge model, lower-cased (after the library's normaliser if it is not ASCII); everything else goes
        through the whole library."""
        known, merge, tails, chars = self.stretches.young, self.model.tokenize, self.tails, self.byte_chars
        rest, foreign = [], []
        for s in self.stretches.missing(stretches):
            core = s.rstrip(STOPS)
            if not core.isalpha():
                rest.append(s)
            elif not core.isascii():
                foreign.append((s, core))
            else:
                ids = _packed([t.id for t in merge(core.lower())])
                known[s] = ids if core is s else ids + tails[s[len(core):]]
        if foreign:
            normal = self.normalizer.normalize_str(" ".join([core for _, core in foreign])).split(" ")
            for (s, core), n in zip(foreign, normal, strict=True):
                if n.isalpha():
                    n = n.encode().decode("latin-1").translate(chars)
                    known[s] = _packed([t.id for t in merge(n)]) + tails[s[len(core):]]
                else:
                    rest.append(s)
        known.update((s, _packed(e.ids)) for s, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False), strict=True))
        return known

    def encode_texts(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Per text its ids and `end_id`, as little-endian 32-bit integers.  Arrow splits the texts and numbers their
        distinct stretches; only these become Python strings, and the ids are gathered by number."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()
        whole, at = numbered.dictionary, numbered.indices.to_numpy()
        core = pc.ascii_rtrim(whole, STOPS)
        plain = pc.match_substring_regex(core, f"^[{LETTERS}]+$")
        keys = pc.if_else(plain, pc.utf8_lower(core), whole).dictionary_encode()
        stops = pc.if_else(plain, pc.utf8_ltrim(whole, LETTERS), "").dictionary_encode()
        distinct = keys.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.learn(distinct)
        packed = list(map(known.__getitem__, distinct))
        tails = [self.tails[t] for t in stops.dictionary.to_pylist()]
        # every stretch is a word and its stops, every text a row of stretches
        pairs = np.stack([keys.indices.to_numpy(), stops.indices.to_numpy() + len(packed)], 1).reshape(-1)
        values, ends = _gather(np.frombuffer(b"".join(packed + tails), "<u4"), _sizes(packed + tails), pairs)
        ids, ends = _gather(values, np.diff(ends[::2]), at)
        cuts, end = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist(), struct.pack("<I", end_id)
        return [ids[a:b].tobytes() + end for a, b in zip(cuts, cuts[1:])]


def _sizes(packed: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, packed), np.int64, len(packed)) // 4


def _gather(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs numbered `at` one after the other, and their ends after a zero; `values` holds all runs, of `sizes`."""
    begins, each = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat(begins[at] - ends[:-1], each)
    place += np.arange(ends[-1])
    return values[place], ends


_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


def _groups(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs [a, b) of texts of about GROUP_BYTES together; a longer text is alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // GROUP_BYTES
    edges = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def _byte_alphabet() -> dict[int, int]:
    """Byte-level pre-tokenisers write printable Latin-1 bytes as themselves and the others, in order,
    as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {256 + k: b for k, b in enumerate(rest)}


_WORKER: dict = {}


def worker_encoder(key: int, model) -> WordEncoder:
    """The Python worker's encoder of the broadcast `model`.  A worker has one core and stays between tasks: the library starts
    no threads, whose heaps would stay too, and Arrow's arrays come from the system's allocator, which gives memory back."""
    if key not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pa.set_memory_pool(pa.system_memory_pool())
        _WORKER[key] = WordEncoder(model.value)
    return _WORKER[key]

SHARD_SCHEMA = "part int, local_start long, n_ids long, doc_ids array<bigint>, payload binary"


def write_token_file(docs: DataFrame, model_path: str, end_id: int, path: str, text_col: str = "text",
                     id_col: str = "doc_id", shard_ids: int = SHARD_IDS) -> None:
    """Write the shards of all documents, in ascending order of the id, under `path`."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_path, encoding="utf-8") as f:
        blob = f.read()
    model, key = spark.sparkContext.broadcast(blob), zlib.crc32(blob.encode())

    def shards(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = worker_encoder(key, model)
        names, ids, n, start = [], [], 0, 0

        def close():
            nonlocal names, ids, n, start
            ends = np.cumsum([len(b) // 4 for b in ids])
            payload = encode_shard(np.frombuffer(b"".join(ids), "<u4"), ends)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                names=["part", "local_start", "n_ids", "doc_ids", "payload"])
            names, ids, n, start = [], [], 0, start + n
            pa.default_memory_pool().release_unused()
            return row

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in _groups(texts):
                for name, blob in zip(keys[a:b], encoder.encode_texts(texts.slice(a, b - a), end_id)):
                    names.append(name), ids.append(blob)
                    n += len(blob) // 4
                    if n >= shard_ids:
                        yield close()
        if names:
            yield close()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    tie = F.xxhash64("text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), tie)
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
     .mapInArrow(shards, SHARD_SCHEMA).write.parquet(path))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary): every document of the shards under `path`."""
    table = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("total"))  # one row per range partition
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("offset"))

    def documents(batches):
        for batch in batches:
            for names, payload, start in zip(batch.column("doc_ids"), batch.column("payload"),
                                             batch.column("start").to_pylist()):
                shard = Shard(payload.as_py())
                blob, ends = shard.ids().astype("<u4").tobytes(), shard.doc_ends
                begins = np.concatenate([[0], ends[:-1]])
                step = 4096  # documents per outgoing batch
                for a in range(0, len(ends), step):
                    lo, hi = begins[a:a + step], ends[a:a + step]
                    yield pa.RecordBatch.from_arrays(
                        [names.values.slice(a, step).cast(pa.int64()), pa.array(lo + start, pa.int64()),
                         pa.array(hi - lo, pa.int64()),
                         pa.array([blob[4 * i:4 * j] for i, j in zip(lo.tolist(), hi.tolist())], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    # broadcast: one row per range partition of the writer, whatever the data
    placed = table.join(F.broadcast(offsets), "part").select(
        "doc_ids", "payload", (F.col("offset") + F.col("local_start")).alias("start"))
    return placed.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def round_trip(docs: DataFrame, model_path: str, end_id: int, **columns) -> DataFrame:
    """Write the token file into the shared folder and read it back."""
    spark = docs.sparkSession
    path = new_run_dir(spark, "token-file")
    write_token_file(docs, model_path, end_id, path, **columns)
    return read_token_file(spark, path)
