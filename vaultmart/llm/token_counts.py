"""Token counts by trie-shared dynamic programming over a unigram vocabulary.

A text's pre-tokens are its words with the word-begin mark in front.  The count of a pre-token is the
number of pieces in its best segmentation, the one with the largest sum of piece scores (of
equal sums the one with fewer pieces; then the one whose last piece is longest).  The score of a
piece is minus the logarithm of its rank plus two, a Zipf law over the vocabulary's own order, so
nothing is trained.  A character that is no piece costs one token per UTF-8 byte (byte fallback).

The forward score of a position depends on the characters before it only, so all words that share a
prefix share it.  The distinct new words of a batch are put into a trie; going down the trie, the forward
scores are extended by one position per node, once for all words below, and the count of
a word is read off its terminal node.  A tail that only one word has is kept as that word, and walked
without nodes.  Counts go into a bounded cache; texts add them up.

Bounds: the batch's distinct words and the cache; no node per character of an unshared tail, so a word of a
million characters costs its length times the pieces open at a time.

Defined results: null, empty and blank texts have no words and no tokens; repeats, order and
other columns do not matter, because the function acts on one column.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import RecentCache, small_batches

MARK = "▁"          # the word-begin mark of the vocabulary's pieces
CACHE_ENTRIES = 150_000  # words cached per Python worker and generation
GROUP_BYTES = 1 << 19


def piece_scores(model: bytes) -> dict[str, float]:
    """Piece -> score of a SentencePiece vocabulary: control and byte pieces take no part."""
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_proto=model)
    scores, rank = {}, 0
    for i in range(lib.get_piece_size()):
        if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)):
            scores[lib.id_to_piece(i)] = -math.log(rank + 2)
            rank += 1
    return scores


class _Fallback(dict):
    """Character -> (score, tokens) of its bytes; None for one that is a piece."""

    def __init__(self, pieces: dict, byte_cost: float) -> None:
        super().__init__((c, None) for c, node in pieces.items() if "" in node)
        self.byte_cost = byte_cost

    def __missing__(self, c: str):
        size = len(c.encode())
        self[c] = size * self.byte_cost, size
        return self[c]


class Counter:
    """Token counts of words; one per Python worker.

    The pieces lie in a trie of their own.  Going down the words' trie, each position carries the pieces
    that are still open: (forward score and tokens where it begins, its node), earliest begin first.  A character
    moves every open piece one node on, or ends it, so only pieces that match are ever tried."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.byte_cost = min(scores.values()) - 1  # of one byte of a character that is no piece
        self.cache = RecentCache(CACHE_ENTRIES)
        self.pieces: dict = {}
        for piece, score in scores.items():
            node = self.pieces
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score  # no character is empty: the place of the piece that ends here
        self.fallback = _Fallback(self.pieces, self.byte_cost)
        self.begin = self._walk(MARK, 0.0, 0, [(0.0, 0, self.pieces)])

    def _walk(self, text: str, best: float, tokens: int, opened: list) -> tuple[float, int, list]:
        """Forward score, tokens and open pieces after `text`, from those before it."""
        pieces, fallback = self.pieces, self.fallback
        for c in text:
            step = fallback[c]
            if step is None:
                top = None
            else:
                top, count = best + step[0], tokens + step[1]
            after = []
            for s, n, node in opened:
                node = node.get(c)
                if node is not None:
                    after.append((s, n, node))
                    score = node.get("")
                    if score is not None:
                        s += score
                        if top is None or s > top or (s == top and n < count - 1):
                            top, count = s, n + 1
            best, tokens, opened = top, count, after
            opened.append((best, tokens, pieces))
        return best, tokens, opened

    def count_many(self, words: list[str]) -> dict[str, int]:
        """Counts of distinct words through one trie.  A node maps characters to nodes, or to the one word
        that goes on there; at "" stands the word that ends."""
        root: dict = {}
        for word in words:
            node, last = root, len(word) - 1
            for i, c in enumerate(word):
                child = node.get(c)
                if child is None:
                    node[c] = word
                    break
                if child.__class__ is str:  # a word alone so far: its tail moves down
                    child, other = {}, child
                    child[other[i + 1:i + 2]] = other
                    node[c] = child
                if i == last:
                    child[""] = word
                node = child
        out, walk = {}, self._walk
        stack = [(root, 0, *self.begin)]
        while stack:
            node, depth, best, tokens, opened = stack.pop()
            for c, child in node.items():
                if child.__class__ is str:
                    out[child] = walk(child[depth:], best, tokens, opened)[1] if c else tokens
                else:
                    stack.append((child, depth + 1, *walk(c, best, tokens, opened)))
        return out

    def count_texts(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        new = self.cache.missing(set().union(*texts)) if texts else []
        known = self.cache.young
        known.update(self.count_many(new))
        return [sum(map(known.__getitem__, words)) for words in texts]


_WORKER: dict = {}


def token_counts(text_col, model_path: str):
    """Column of the number of tokens of a text column, as long."""
    spark = SparkSession.active()
    small_batches(spark)
    with open(model_path, "rb") as f:
        scores = spark.sparkContext.broadcast(piece_scores(f.read()))  # a vocabulary: under a megabyte

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        counter = _WORKER.get(model_path)
        if counter is None:
            counter = _WORKER[model_path] = Counter(scores.value)
        out, group, size = [], [], 0
        for t in texts.cast(pa.binary()):
            group.append(t.as_py() or b"")
            size += len(group[-1])
            if size >= GROUP_BYTES:
                out += counter.count_texts([_words(x) for x in group])
                group, size = [], 0
        return pa.array(out + counter.count_texts([_words(x) for x in group]), pa.int64())

    return run(text_col)


def _words(text: bytes) -> list[str]:
    """The words of a text: split as bytes, where white space is ASCII only, decoded together."""
    words = text.split()
    return b" ".join(words).decode().split(" ") if words else []
