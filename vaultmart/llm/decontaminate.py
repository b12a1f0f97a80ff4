"""Benchmark decontamination: a BM25 inverted index of the test items, searched with block-max WAND.

Words are lower-cased and stripped of punctuation at their ends.  A leak is a window of SPAN words, at any
offset of the text, that passes the verification below; SPAN is 2.5 times the longest item and PUT_IN
words, so an item with that many words more put in (an explanation, options) is one wherever it stands.
Passages of 2 SPAN words, SPAN words apart, hold every window; each passage with a shingle of any item
(without one nothing can verify) queries the index.

Scores.  An item's BM25 weights are divided by their sum, so a passage with all of its words scores 1.
The item's threshold is 1 less its heaviest words, as many as a leak that passes the verification can
lack: no verifiable leak scores below it.  Weights are then divided by the threshold, so that
retrieval is "all items that score 1 or more" for every item alike.

Search.  Items are in blocks of ITEM_BLOCK, sorted by length.  Each term keeps its largest weight in each
block; the sums of these block maxima over the distinct words of a passage are taken for all
passages of a text at once, and a block that cannot reach 1 is skipped.  In the blocks left, cursors over the
words' postings run WAND: in order of their item, pivot by the lists' maxima, skip to the
pivot's item, score it fully when all cursors before it stand there.

Verification.  For each item retrieved the windows that begin at its words in the passage's first half are
compared with it (any other window has no more of its words than one of these).  At least OVERLAP of the
item's distinct five-word shingles occur in the window, and at least OVERLAP of the distinct words of its question and of its answer.  The question ends at the last "?",
or else before the last sentence; an item of one sentence is its own question and answer.

The index is broadcast in parts of at most PART_BYTES of item text (measured), so a larger benchmark means
more passes over the texts, not a larger broadcast.  Number, mean and longest length of the items and the document
frequencies are those of the whole benchmark in every part, so scores and windows do not depend on the parts.

Defined results: null, empty or wordless texts have no leaks; items of fewer than MIN_ITEM_WORDS words
(null included) take no part, as they have no five-word shingle; equal items are all reported; repeated rows each have
their own; an empty table on either side gives no leaks.  One row per text and item: its best window
(the first of equals), which begins at passage_start.  Other columns are ignored (they pass through
`drop_contaminated`), whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import free_name, small_batches, write_table

K1, B = 1.2, 0.75
SHINGLE, OVERLAP = 5, 0.8
MIN_ITEM_WORDS = SHINGLE
PUT_IN = 256
MARK_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
ITEM_BLOCK = 4
SLAB = 1 << 12
PART_BYTES = 1 << 20
_PAST = 1 << 62
_item = itemgetter(0)
CACHE_ENTRIES = 300_000
LONG_TEXT = 1 << 22  # longer texts are split word by word, never held as a list of words
_ENDS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”‘’„…–—¿¡·•"
_WORD = re.compile(r"\S+")


def normal(word: str) -> str:
    return word.lower().strip(_ENDS)


def parts_of_item(text: str) -> tuple[str, str]:
    """(question, answer) of a test item."""
    at = text.rfind("?") + 1
    if not at or not text[at:].split():
        sentences = [m.end() for m in re.finditer(r"[.!?\n]+(?=\s)", text.rstrip())]
        at = sentences[-1] if sentences else 0
    question, answer = text[:at], text[at:]
    return (question, answer) if question.split() and answer.split() else (text, text)


class Statistics(NamedTuple):
    """Of all items of the benchmark that take part; `frequency` only of the words of one part."""

    n: int
    words: int
    longest: int
    frequency: dict[str, int]


class Index:
    """Inverted index of (item id, text) pairs."""

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None) -> None:
        self.terms: dict[str, int] = {}
        self.ids, self.shingles, self.words = [], [], []
        sequences = []
        # items of like length side by side: their weights are alike, which makes block maxima tight
        known = [(len(x), item is None, item, x, text) for item, text in items for x in [self._ids(text)]]
        for _, _, item, sequence, text in sorted(known, key=lambda x: (x[0], x[1], x[2] or 0)):
            if len(sequence) >= MIN_ITEM_WORDS:
                self.ids.append(item)
                sequences.append(sequence)
                self.shingles.append(frozenset(shingles(sequence)))
                self.words.append(tuple(frozenset(self._ids(p)) for p in parts_of_item(text)))
        self.longest = whole.longest if whole else max(map(len, sequences), default=0)
        self.marks = np.unique(_hashes(np.array(sorted(set().union(*self.shingles)), np.int64).reshape(-1, SHINGLE).T))
        self.mark_bits = np.zeros(1 << MARK_BITS, bool)
        self.mark_bits[self.marks >> np.uint64(64 - MARK_BITS)] = True
        self._weigh(sequences, whole)

    def _ids(self, text: str) -> list[int]:
        found = (normal(w) for w in text.split())
        return [self.terms.setdefault(w, len(self.terms)) for w in found if w]

    def _weigh(self, sequences: list[list[int]], whole: Statistics | None) -> None:
        n, lists = len(sequences), [[] for _ in self.terms]
        n_all = whole.n if whole else n
        mean = (whole.words if whole else sum(map(len, sequences))) / n_all if n_all else 1
        found = [np.unique(s, return_counts=True) for s in sequences]
        frequency = np.zeros(len(self.terms))
        for terms, _ in found:
            frequency[terms] += 1
        if whole:
            frequency = np.array([whole.frequency.get(w, 0) for w in self.terms], float)
        idf = np.log1p((n_all - frequency + 0.5) / (frequency + 0.5))
        self.threshold, self.weights = [], []
        for k, (terms, tf) in enumerate(found):
            weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(sequences[k]) / mean))
            weight /= math.fsum(weight)
            lacking = int((1 - OVERLAP) * len(self.shingles[k]) + 1e-9)
            threshold = max(1e-3, 1 - np.sort(weight)[::-1][:lacking].sum())
            self.threshold.append(threshold)
            self.weights.append(dict(zip(terms.tolist(), weight.tolist())))
            for t, w in zip(terms.tolist(), (weight / threshold).tolist()):
                lists[t].append((k, w))
        self.n_blocks = -(-n // ITEM_BLOCK)
        # per term its postings by block, and all terms' block maxima as compressed rows
        self.postings: list[dict[int, list[tuple[int, float]]]] = []
        rows, blocks, maxima = [0], [], []
        for x in lists:
            by_block: dict[int, list[tuple[int, float]]] = {}
            for k, w in x:
                by_block.setdefault(k // ITEM_BLOCK, []).append((k, w))
            self.postings.append(by_block)
            blocks += by_block
            maxima += [max(w for _, w in p) for p in by_block.values()]
            rows.append(len(blocks))
        self.rows, self.blocks = np.array(rows, np.int64), np.array(blocks, np.int64)
        self.maxima = np.array(maxima)

    def block_bounds(self, ids: np.ndarray, chunk: int) -> np.ndarray:
        """[chunk, block] sums of block maxima over the distinct terms of each chunk of `chunk` words."""
        at = np.flatnonzero(ids >= 0)
        n_chunks, n_terms = -(-len(ids) // chunk), max(1, len(self.terms))
        owner, term = np.divmod(np.unique(at // chunk * n_terms + ids[at]), n_terms)
        size = self.rows[term + 1] - self.rows[term]
        place = np.arange(size.sum()) + np.repeat(self.rows[term] - (np.cumsum(size) - size), size)
        cell = np.repeat(owner * self.n_blocks, size) + self.blocks[place]
        return np.bincount(cell, self.maxima[place], n_chunks * self.n_blocks).reshape(n_chunks, self.n_blocks)

    def search(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """(item, score) of the items of a block that score 1 or more for the distinct `terms`, by WAND."""
        limit, out = 1 - 1e-9, []
        lists = [p for p in (self.postings[t].get(block) for t in terms) if p]
        # a cursor: the item it stands at, the list's largest weight, the list, the position
        cursors = [[p[0][0], max(w for _, w in p), p, 0] for p in lists]
        if sum(c[1] for c in cursors) < limit:
            return out
        while cursors:
            cursors.sort(key=_item)
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[1]
                if bound >= limit:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            if cursors[0][0] == item:
                score = sum(c[2][c[3]][1] for c in cursors if c[0] == item)
                if score >= limit:
                    out.append((item, score))
                item += 1
            for c in cursors:  # the lists before the pivot skip to its item, or past it if it was scored
                while c[0] < item:
                    c[3] += 1
                    c[0] = c[2][c[3]][0] if c[3] < len(c[2]) else _PAST
            cursors = [c for c in cursors if c[0] != _PAST]
        return out

    def verify(self, item: int, sequence: list[int]) -> tuple[float, float, float] | None:
        """Overlaps (shingles, question, answer) of an item with a passage, if all reach OVERLAP."""
        share = lambda want, have: len(want & have) / len(want)
        words = set(sequence)
        found = (share(self.shingles[item], set(shingles(sequence))), *(share(p, words) for p in self.words[item]))
        return found if min(found) >= OVERLAP - 1e-9 else None


    def shingle_places(self, ids: np.ndarray) -> np.ndarray:
        """Where a shingle of some item begins (and, by a chance of equal hashes, others)."""
        if len(ids) < SHINGLE or not len(self.marks):
            return np.zeros(0, np.int64)
        n = len(ids) - SHINGLE + 1
        known = ids >= 0
        at = np.flatnonzero(np.logical_and.reduce([known[k:k + n] for k in range(SHINGLE)]))
        found = _hashes(np.array([ids[at + k] for k in range(SHINGLE)], np.int64))
        some = np.flatnonzero(self.mark_bits[found >> np.uint64(64 - MARK_BITS)])
        at, found = at[some], found[some]
        place = np.minimum(np.searchsorted(self.marks, found), len(self.marks) - 1)
        return at[self.marks[place] == found]

    def best_window(self, item: int, sequence: list[int], span: int, starts: int) -> tuple | None:
        """(score, start, overlaps) of the best verified window of `span` words that begins before `starts`."""
        weights, wanted = self.weights[item], self.shingles[item]
        question, answer = self.words[item]
        places = [k for k, t in enumerate(sequence) if t in weights]
        found = {k: s for k in places for s in [tuple(sequence[k:k + SHINGLE])] if s in wanted}
        words, seen, best = Counter(), Counter(), None
        n_question = n_answer = entered = shingled = 0
        for start in places:
            if start >= starts:
                break
            end = start + span
            while entered < len(places) and places[entered] < end:
                t = sequence[places[entered]]
                words[t] += 1
                if words[t] == 1:
                    n_question += t in question
                    n_answer += t in answer
                entered += 1
            while shingled < len(places) and places[shingled] + SHINGLE <= end:
                if places[shingled] in found:
                    seen[found[places[shingled]]] += 1
                shingled += 1
            overlap = len(seen) / len(wanted), n_question / len(question), n_answer / len(answer)
            if min(overlap) >= OVERLAP - 1e-9:
                score = math.fsum(w for t, w in weights.items() if t in words)
                if best is None or score > best[0] + 1e-12:
                    best = (score, start, overlap)
                    if len(words) == len(weights):
                        break  # the score of all words: no later window is better
            # the window's first word goes
            t = sequence[start]
            words[t] -= 1
            if not words[t]:
                del words[t]
                n_question -= t in question
                n_answer -= t in answer
            if start in found:
                seen[found[start]] -= 1
                if not seen[found[start]]:
                    del seen[found[start]]
        return best


def _hashes(columns: np.ndarray) -> np.ndarray:
    out = np.zeros(columns.shape[1], np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def shingles(sequence: list[int]) -> list[tuple[int, ...]]:
    return list(zip(*(sequence[k:] for k in range(SHINGLE))))


class Searcher:
    """One per Python worker and index: texts in, leaks out."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.span = 2 * max(1, -(-index.longest * 5 // 4)) + PUT_IN
        self.known: dict[str, int] = {}

    def _term(self, word: str) -> int:
        """Term id, -1 for a word in no item, -2 for no word at all."""
        w = normal(word)
        found = self.index.terms.get(w, -1) if w else -2
        if len(self.known) >= CACHE_ENTRIES:
            self.known.clear()
        self.known[word] = found
        return found

    def sequence(self, text: str) -> np.ndarray:
        known, term = self.known, self._term
        if len(text) < LONG_TEXT:
            words = text.split()
            found = list(map(known.get, words))
            if None in found:
                found = [term(w) if f is None else f for w, f in zip(words, found)]
            ids = np.array(found, np.int32)
        else:
            ids = np.fromiter((term(m[0]) for m in _WORD.finditer(text)), np.int32)
        return ids[ids != -2]

    def leaks(self, text: str) -> list[dict]:
        ids = self.sequence(text)
        best: dict[int, dict] = {}
        if not len(ids) or not self.index.ids:
            return []
        span, n_chunks = self.span, -(-len(ids) // self.span)
        for first in range(0, n_chunks, SLAB):  # chunks whose bounds are held at once
            part = ids[first * span:(first + SLAB + 1) * span]
            marked = np.zeros(-(-len(part) // span) + 2, bool)
            marked[self.index.shingle_places(part) // span + 1] = True
            live = (marked[1:] | np.append(marked[2:], False))[:-1]  # a passage is two chunks: its own or the next
            if not live.any():
                continue
            # only the chunks of those passages count
            used = np.repeat(live | np.append(False, live[:-1]), span)[:len(part)]
            parts = self.index.block_bounds(np.where(used, part, -1), span)
            bound = (parts + np.append(parts[1:], np.zeros_like(parts[:1]), 0))[:SLAB]
            bound[~live[:SLAB]] = 0
            last = -1
            for k, block in zip(*(x.tolist() for x in np.nonzero(bound >= 1 - 1e-9))):
                a = (first + k) * span
                if a != last:
                    last, passage = a, ids[a:a + 2 * span]
                    terms, sequence = np.unique(passage[passage >= 0]).tolist(), passage.tolist()
                for item, _ in self.index.search(terms, block):
                    if not self.index.verify(item, sequence):  # nor does any window of the passage
                        continue
                    found = self.index.best_window(item, sequence, span, span)
                    if found and (item not in best or found[0] > best[item]["score"] + 1e-12):
                        score, start, overlap = found
                        best[item] = {"item_id": self.index.ids[item], "score": score, "passage_start": a + start,
                                      "overlap": overlap[0], "question_overlap": overlap[1],
                                      "answer_overlap": overlap[2]}
        return [best[k] for k in sorted(best)]


LEAKS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("passage_start", T.LongType()), T.StructField("overlap", T.DoubleType()),
    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("passage_start", pa.int64()),
                             ("overlap", pa.float64()), ("question_overlap", pa.float64()),
                             ("answer_overlap", pa.float64())]))
_WORKER: dict = {}


def _parts(items: DataFrame, id_col: str, text_col: str, part_bytes: int):
    """(items, statistics) on the driver one part at a time; each part's size is measured before it is fetched."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    total = rows.agg(size.alias("n")).first()["n"]
    n = max(1, -(-total // part_bytes))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    fetch = lambda k: [(r["id"], r["text"]) for r in rows.filter(F.col("part") == k).collect()]
    if n == 1:  # its own statistics are those of the whole
        yield fetch(0), None
        return
    known = write_table(rows.select("part", "text").mapInArrow(_item_words, "part long, n long, words array<string>"), "leak-items")
    whole = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    words = known.select("part", F.explode("words").alias("word"))
    frequency = write_table(words.groupBy("word").agg(F.count("*").alias("c")), "leak-words")
    for k in range(n):
        own = words.filter(F.col("part") == k).select("word").distinct().join(frequency, "word")
        yield fetch(k), Statistics(*whole, {r["word"]: r["c"] for r in own.collect()})  # at most the part's words


def _item_words(batches):
    """(part, number of words, distinct words) of the items that take part."""
    for batch in batches:
        sequences = [[w for w in map(normal, t.as_py().split()) if w] for t in batch.column(1)]
        rows = [(p, len(x), sorted(set(x))) for p, x in zip(batch.column(0).to_pylist(), sequences) if len(x) >= MIN_ITEM_WORDS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["part", "n", "words"])


def leaks(text_col, items: DataFrame, id_col: str = "item_id", item_text_col: str = "text",
          part_bytes: int = PART_BYTES):
    """Array column of the test items that a text contains, with score and overlaps."""
    spark = SparkSession.active()
    small_batches(spark)
    found = []
    for rows, whole in _parts(items, id_col, item_text_col, part_bytes):
        shared = spark.sparkContext.broadcast(Index(rows, whole))
        found.append(_search(shared)(text_col))
    return reduce(F.concat, found)


def _search(shared):
    @F.arrow_udf(LEAKS)
    def run(texts: pa.Array) -> pa.Array:
        searcher = _WORKER.get(shared.value)
        if searcher is None:
            searcher = _WORKER[shared.value] = Searcher(shared.value)
        return pa.array([searcher.leaks(t.as_py() or "") for t in texts], _ARROW)
    return run


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document and test item that it contains."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.explode(leaks(docs[text_col], items)).alias("leak"))
    return rows.select("doc_id", "leak.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without the documents that contain a test item."""
    name = free_name(docs.columns, "_leaks")
    return docs.withColumn(name, leaks(docs[text_col], items)).filter(F.size(name) == 0).drop(name)
