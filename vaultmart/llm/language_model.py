"""Language-model scoring: a gated recurrent network with a class-factored softmax, in numpy.

Tokens are the lower-cased words of a text and one end.  Counts are taken over all training documents
(those whose id's crc32 modulo FOLDS is not HELD_OUT), in Spark.  Every word of the corpus belongs to a class: the
VOCABULARY most frequent ones to classes of WORDS_PER_CLASS words of like frequency, all others, however many the
corpus has, to one of TAILS classes by their last two bytes (endings tell language and part of speech).

Network.  A GRU reads the previous token: a frequent word as itself, any other as its class.  A first softmax gives the
class of the next token, or the end; a second one the word within a class of frequent words.  Within a tail class words are
dealt by their counts (plus one, and one for all unseen words of the class), so every text gets a proper
probability.  Biases start at the counts' logarithms.

Training.  Texts are tokenised once, into a table of symbols.  Training documents are dealt by a hash of their
content into ROUNDS rounds, and each round into parts of about PART_TOKENS tokens (MOST_PARTS parts at most, of more
tokens then); the number follows from the counted tokens alone, and a part's documents are ordered, so the model does
not depend on files, partitions or row order.  In each round every part trains a copy of the model on all its documents,
by backpropagation truncated to WINDOW steps with the state carried from window to window (over PIECE tokens of a
document), and the next round starts from the copies' mean, weighted by tokens: a grouped aggregate, of which one model
reaches the driver.  Documents lie on LANES parallel lanes; the state is cleared where one begins.

Scoring.  The same windows run over every whole document with the state carried, adding up the log
probabilities.  Counts of the words above a cutoff, FREQUENT at most, are broadcast; all other words of a document meet
their counts in a join on the word.  The cutoff comes from the number of words per count.

Defined results: a null or empty text is one end; null ids count as the empty string (crc32 0, training);
repeated rows count and are scored each; without training documents all counts are zero; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import small_batches, write_table

FOLDS, HELD_OUT = 7, 2
VOCABULARY, WORDS_PER_CLASS, TAILS = 1024, 32, 64
HIDDEN, EMBEDDING = 16, 16
WINDOW, LANES = 16, 256
SCORE_STEPS, SOFTMAX_ROWS = 32, 2048  # a window of scoring; states whose logits are worked out at once, in the cache
GROUP_TOKENS = 1 << 21
STEP_TOKENS = 4096         # tokens behind one step of the optimiser, at least
FREQUENT = 100_000
RATE = 0.02
COUNT_BYTES, COUNT_ROWS = 4 << 20, 8192  # of text, or one batch, whose words are numbered together
FLUSH_WORDS = 1_000_000  # words, with repeats between stretches, a counting task holds before it adds up or passes them on
MODEL_BLOCK = 2048      # parameters in one row of the average
ROUNDS, PART_TOKENS, MOST_PARTS = 3, 1 << 20, 4096
PIECE = 2048            # tokens of a document over which training carries the state
DTYPE = np.float32
END, FIRST = TAILS, TAILS + 1  # symbols: the tail classes, the end, then words by falling count


def shapes(n_words: int) -> dict[str, tuple[int, ...]]:
    classes = FIRST + -(-n_words // WORDS_PER_CLASS)
    return {"embedding": (FIRST + n_words, EMBEDDING), "input": (EMBEDDING, 3 * HIDDEN), "gates": (3 * HIDDEN,),
            "recurrent": (HIDDEN, 3 * HIDDEN), "class_w": (HIDDEN, classes), "class_b": (classes,),
            "word_w": (max(1, classes - FIRST), HIDDEN, WORDS_PER_CLASS), "word_b": (max(1, classes - FIRST), WORDS_PER_CLASS)}


def unpack(flat: np.ndarray, n_words: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(n_words).items():
        size = math.prod(shape)
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def start(counts: list[int], tails: list[int], ends: int, seed: int = 5) -> np.ndarray:
    """The common start of all copies: small random weights, biases at the logarithm of the counts plus one."""
    n = len(counts)
    rng = np.random.default_rng(seed)
    flat = np.concatenate([rng.normal(0, 0.1, math.prod(s)).astype(np.float32) for s in shapes(n).values()])
    p = unpack(flat, n)
    padded = np.zeros(p["word_b"].size)
    padded[:n] = np.array(counts) + 1.0
    per_word = padded.reshape(p["word_b"].shape)
    sums = np.concatenate([np.array(tails) + 1.0, [ends + 1.0], per_word.sum(1)])[:len(p["class_b"])]
    p["class_b"][:] = np.log(sums / sums.sum())
    p["class_w"] *= 0.1
    p["word_w"] *= 0.1
    p["word_b"][:] = np.where(per_word > 0, np.log(np.maximum(per_word, 1)), -30.0)
    p["word_b"] -= p["word_b"].max(1, keepdims=True)
    p["gates"][:] = 0
    return flat


def _sigmoid(x, out):
    np.tanh(np.multiply(x, 0.5, out=out), out=out)
    out *= 0.5
    out += 0.5


def _by_value(x: np.ndarray) -> np.ndarray:
    """The stable order of symbols or classes; 16 bits are sorted by radix."""
    return np.argsort(x.astype(np.int16), kind="stable")


def _log_softmax(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the log probability of column `at`, and the sum of the exponentials that then stand in `logits`."""
    logits -= logits.max(1, keepdims=True)
    picked = logits[np.arange(len(at)), at]
    total = np.exp(logits, out=logits).sum(1)
    return picked - np.log(total), total


def _log_softmax_by_column(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """As `_log_softmax`, of logits [classes, rows]: every step runs along the rows; sums in numpy's order of a row."""
    logits -= logits.max(0)
    picked = logits[at, np.arange(len(at))]
    e, even = np.exp(logits, out=logits), len(logits) - len(logits) % 8
    r = e[:even].reshape(-1, 8, len(at)).sum(0)
    total = ((r[0] + r[1]) + (r[2] + r[3])) + ((r[4] + r[5]) + (r[6] + r[7]))
    for x in e[even:]:
        total += x
    return picked - np.log(total)


def _slope(e: np.ndarray, at: np.ndarray, weights: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gradient of the weighted loss by the logits, in place of their exponentials."""
    e *= (weights / total)[:, None]
    e[np.arange(len(at)), at] -= weights
    return e


def _by_gate(x: np.ndarray) -> np.ndarray:
    """[rows, 3 * HIDDEN] as [3, rows, HIDDEN]."""
    return np.ascontiguousarray(x.reshape(len(x), 3, HIDDEN).transpose(1, 0, 2))


def _cleared(keep: np.ndarray) -> list[np.ndarray]:
    """Per step the lanes whose state is cleared before it."""
    step, lane = np.divmod(np.flatnonzero(keep.reshape(-1) == 0), keep.shape[1])
    edges = np.searchsorted(step, np.arange(len(keep) + 1)).tolist()
    return [lane[a:b] for a, b in zip(edges, edges[1:])]


class Network:
    """Parameters as one flat array, with views by name."""

    def __init__(self, flat: np.ndarray, n_words: int) -> None:
        self.flat, self.n_words = flat, n_words
        self.p = unpack(flat, n_words)

    def forward(self, symbols: np.ndarray, keep: np.ndarray, state: np.ndarray, learn: bool = True):
        """States after each step of a window [steps, lanes], with what the backward pass needs if it is to `learn`."""
        p, h, n = self.p, HIDDEN, len(symbols)
        # gate by gate, so that the elementwise steps run over whole rows of lanes
        table = p["embedding"] @ _by_gate(p["input"]) + p["gates"].reshape(3, 1, h)
        recurrent = _by_gate(p["recurrent"])
        cleared = _cleared(keep)
        hidden, lanes, held = np.empty((*symbols.shape, h), DTYPE), symbols.shape[1], n if learn else 1
        before, cand, cand_h = np.empty((3, held, lanes, h), DTYPE)
        z_r = np.empty((held, 2, lanes, h), DTYPE)
        a, x = np.empty_like(z_r[0]), np.empty_like(z_r[0])
        for t in range(n):
            k = t if learn else 0
            before[k] = state
            state = before[k]
            if len(cleared[t]):
                state[cleared[t]] = 0
            np.matmul(state, recurrent[:2], out=a)
            table[0].take(symbols[t], axis=0, out=x[0], mode="clip")
            table[1].take(symbols[t], axis=0, out=x[1], mode="clip")
            _sigmoid(np.add(x, a, out=a), z_r[k])
            np.matmul(state, recurrent[2], out=cand_h[k])
            c = np.multiply(z_r[k, 1], cand_h[k], out=cand[k])
            c += table[2].take(symbols[t], axis=0, out=x[0], mode="clip")
            np.tanh(c, out=c)
            new = np.subtract(state, c, out=hidden[t])
            new *= z_r[k, 0]
            new += c
            state = new
        return hidden, (before, z_r, cand, cand_h)

    def output(self, hidden: np.ndarray, targets: np.ndarray, weights: np.ndarray | None = None):
        """Natural log probability of each target given its state; with `weights` (the loss is minus their
        weighted sum) also the gradients: (log p, d hidden, named gradients)."""
        p = self.p
        word = targets - FIRST
        cls = np.where(word < 0, targets, FIRST + word // WORDS_PER_CLASS)
        grads, d_hidden = {}, None
        if weights is None:
            log_p, lanes = np.empty(len(cls), hidden.dtype), range(0, len(cls), SOFTMAX_ROWS)
            for a, b in ((a, a + SOFTMAX_ROWS) for a in lanes):
                logits = p["class_w"].T @ hidden[a:b].T
                logits += p["class_b"][:, None]
                log_p[a:b] = _log_softmax_by_column(logits, cls[a:b])
        else:
            logits = hidden @ p["class_w"]
            logits += p["class_b"]
            log_p, total = _log_softmax(logits, cls)
            d = _slope(logits, cls, weights, total)
            grads["class_w"], grads["class_b"] = hidden.T @ d, d.sum(0)
            d_hidden = d @ p["class_w"].T
            grads["word_w"], grads["word_b"] = np.zeros_like(p["word_w"]), np.zeros_like(p["word_b"])
        # words in order of their class: a run of rows per class, with weights of its own
        order = _by_value(cls)
        edges = np.searchsorted(cls[order], np.arange(FIRST, len(p["class_b"]) + 1)).tolist()
        runs = [(c, a - edges[0], b - edges[0]) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
        if not runs:
            return log_p, d_hidden, grads
        at = order[edges[0]:edges[-1]]
        h, inner = np.take(hidden, at, axis=0), word[at] % WORDS_PER_CLASS
        if weights is None:
            logits = np.empty((WORDS_PER_CLASS, len(at)), DTYPE)
            for c, a, b in runs:
                own = np.matmul(p["word_w"][c].T, h[a:b].T, out=logits[:, a:b])
                own += p["word_b"][c][:, None]
            log_p[at] += _log_softmax_by_column(logits, inner)
            return log_p, d_hidden, grads
        logits = np.empty((len(at), WORDS_PER_CLASS), DTYPE)
        for c, a, b in runs:
            own = np.matmul(h[a:b], p["word_w"][c], out=logits[a:b])
            own += p["word_b"][c]
        log_q, total = _log_softmax(logits, inner)
        log_p[at] += log_q
        d = _slope(logits, inner, weights[at], total)
        back = np.empty_like(h)
        for c, a, b in runs:
            grads["word_w"][c], grads["word_b"][c] = h[a:b].T @ d[a:b], d[a:b].sum(0)
            np.matmul(d[a:b], p["word_w"][c].T, out=back[a:b])
        d_hidden[at] += back
        return log_p, d_hidden, grads

    def backward(self, symbols: np.ndarray, keep: np.ndarray, saved, d_hidden: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the recurrent part; nothing flows into the window before."""
        p, h = self.p, HIDDEN
        before, z_r, cand, cand_h = saved
        cleared = _cleared(keep)
        d_x = np.empty((3, *symbols.shape, h), DTYPE)
        d_a = np.empty((*symbols.shape, 3 * h), DTYPE)
        flow = np.zeros_like(before[0])
        back = np.ascontiguousarray(p["recurrent"].T)
        rest, moved = np.empty_like(z_r[0]), np.empty_like(flow)
        for t in reversed(range(len(symbols))):
            z, r = z_r[t]
            flow += d_hidden[t]
            np.subtract(1, z_r[t], out=rest)
            d_c = np.multiply(flow, rest[0], out=d_x[2, t])
            rest *= z_r[t]
            np.multiply(cand[t], cand[t], out=moved)
            d_c *= np.subtract(1, moved, out=moved)
            d_z = np.multiply(flow, np.subtract(before[t], cand[t], out=moved), out=d_x[0, t])
            d_z *= rest[0]
            d_r = np.multiply(d_c, cand_h[t], out=d_x[1, t])
            d_r *= rest[1]
            np.concatenate([d_z, d_r, np.multiply(d_c, r, out=moved)], axis=1, out=d_a[t])
            flow *= z
            flow += np.matmul(d_a[t], back, out=moved)
            if len(cleared[t]):
                flow[cleared[t]] = 0
        flat_s = symbols.reshape(-1)
        order = _by_value(flat_s)
        in_order = flat_s[order]
        firsts = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        per_symbol = np.concatenate([np.add.reduceat(x.reshape(-1, h).take(order, axis=0), firsts) for x in d_x], axis=1)
        seen = in_order[firsts]
        d_embedding = np.zeros_like(p["embedding"])
        d_embedding[seen] = per_symbol @ p["input"].T
        return {"embedding": d_embedding, "input": p["embedding"][seen].T @ per_symbol, "gates": per_symbol.sum(0),
                "recurrent": before.reshape(-1, h).T @ d_a.reshape(-1, 3 * h)}


class Adam:
    def __init__(self, network: Network, rate: float = RATE) -> None:
        self.network, self.rate, self.steps = network, rate, 0
        self.mean, self.square = np.zeros_like(network.flat), np.zeros_like(network.flat)

    def step(self, grads: dict[str, np.ndarray]) -> None:
        g = np.concatenate([grads[name].reshape(-1) for name in self.network.p])
        norm = float(np.sqrt(g @ g))
        if norm > 1:
            g *= 1 / norm
        self.steps += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        size = self.rate * math.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        self.network.flat -= size * self.mean / (np.sqrt(self.square) + 1e-8)


def windows(docs: list[np.ndarray], steps: int):
    """Lay documents on lanes and cut the lanes into windows.

    Yields (inputs, targets, keep, document, active) per window, arrays [steps, lanes]: `active` is the number of
    lanes still running (lanes are sorted by length), `document` is -1 where a lane has ended."""
    lanes = min(LANES, len(docs))
    lengths = np.array([len(d) for d in docs])
    load, at = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    for k in np.argsort(-lengths, kind="stable").tolist():  # longest first, onto the emptiest lane
        lane = int(load.argmin())
        at[lane].append(k)
        load[lane] += lengths[k]
    order = np.argsort(-load, kind="stable")
    sequence = [k for lane in order for k in at[lane]]
    target = np.concatenate([docs[k] for k in sequence])
    owner = np.repeat(sequence, lengths[sequence])
    begins = np.cumsum(lengths[sequence]) - lengths[sequence]
    inputs = np.concatenate([[END], target[:-1]])
    inputs[begins] = END
    keep = np.ones(len(target), np.float32)
    keep[begins] = 0
    size = load[order]
    first = np.cumsum(size) - size
    for a in range(0, int(size[0]), steps):
        active = int(np.searchsorted(-size, -a, "left"))  # lanes longer than a
        n = min(steps, int(size[0]) - a)
        place = first[:active] + a + np.arange(n)[:, None]
        if a + n <= size[active - 1]:  # no lane ends within the window
            yield inputs[place], target[place], keep[place], owner[place], active
            continue
        live = place < (first + size)[:active]
        place = np.minimum(place, (first + size - 1)[:active])
        yield inputs[place], target[place], keep[place], np.where(live, owner[place], -1), active


def train(network: Network, groups, rate: float = RATE) -> int:
    """One pass over groups of documents (symbol arrays); returns the number of tokens."""
    optimizer, tokens, held, gathered = Adam(network, rate), 0, 0, {}

    def step():  # windows of few lanes wait for others: a step on a handful of tokens is noise
        nonlocal held, gathered
        optimizer.step({name: g / held for name, g in gathered.items()})
        held, gathered = 0, {}

    for docs in groups:
        state = np.zeros((min(LANES, len(docs)), HIDDEN), np.float32)
        for inputs, target, keep, document, active in windows(docs, WINDOW):
            hidden, saved = network.forward(inputs, keep, state[:active])
            state = hidden[-1]
            live = (document >= 0).reshape(-1)
            _, d_hidden, grads = network.output(hidden.reshape(-1, HIDDEN), target.reshape(-1), live.astype(np.float32))
            grads |= network.backward(inputs, keep, saved, d_hidden.reshape(hidden.shape))
            gathered = {name: g + gathered[name] for name, g in grads.items()} if gathered else grads
            n = int(live.sum())
            held, tokens = held + n, tokens + n
            if held >= STEP_TOKENS:
                step()
    if held:
        step()
    return tokens


def log10_scores(network: Network, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole document (symbol arrays)."""
    out = np.zeros(len(docs) + 1)
    state = np.zeros((min(LANES, len(docs)), HIDDEN), np.float32)
    for inputs, target, keep, document, active in windows(docs, SCORE_STEPS):
        hidden, _ = network.forward(inputs, keep, state[:active], learn=False)
        state = hidden[-1]
        log_p, _, _ = network.output(hidden.reshape(-1, HIDDEN), target.reshape(-1))
        out += np.bincount(document.reshape(-1) + 1, log_p, len(out))
    return out[1:] / math.log(10)


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct lower-cased words of `texts` (binary), the number of every token's word, and where each text's tokens
    end, after a zero.  Arrow's ASCII functions know A-Z and ASCII white space only."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded, ends = split.flatten().dictionary_encode(), split.offsets.to_numpy()
    distinct, at = coded.dictionary, coded.indices.to_numpy()
    empty = pc.index(distinct, "").as_py()  # stands before or after white space at a text's ends
    if empty >= 0:
        live = at != empty
        ends = np.concatenate([[0], np.cumsum(live)])[ends]
        at = at[live] - (at[live] > empty)
        distinct = pa.concat_arrays([distinct[:empty], distinct[empty + 1:]])
    return distinct.cast(pa.binary()), at, ends


def is_training(id_col):
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS != HELD_OUT


def word_counts(docs: DataFrame) -> DataFrame:
    """Written table (word binary, c): counts over `docs` (text), added up in the tasks, then by word."""
    parts = docs.select("text").mapInArrow(counted, "word binary, c bigint")
    return write_table(parts.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


def counted(batches):
    """Batches (word, c) of batches of texts; a word may stand in several."""
    found = []  # words and their counts, a pair of arrays per stretch of text
    for held in _stretches(batches, lambda b: b.column(0)):
        distinct, at, _ = numbered(pa.concat_arrays([b.column(0) for b in held]))
        found.append((distinct, np.bincount(at, minlength=len(distinct))))
        if sum(len(w) for w, _ in found) > FLUSH_WORDS:
            found = [_added(found)]
            if len(found[0][0]) > FLUSH_WORDS // 2:
                yield _counts(*found[0])
                found = []
    if found:
        yield _counts(*_added(found))


def _stretches(batches, texts):
    """Lists of batches with rows whose `texts` hold COUNT_BYTES, or COUNT_ROWS rows, or a little more."""
    held, size, rows = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size, rows = size + texts(batch).nbytes, rows + batch.num_rows
        if size >= COUNT_BYTES or rows >= COUNT_ROWS:
            yield held
            held, size, rows = [], 0, 0
    if held:
        yield held


def _added(found: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """The sums of counts by word, by Arrow: no word becomes a Python object."""
    table = pa.table([pa.concat_arrays([w for w, _ in found]), np.concatenate([c for _, c in found])], names=["word", "c"])
    sums = table.group_by("word", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
    return pa.concat_arrays(sums["word"].chunks or [pa.array([], pa.binary())]), sums["c_sum"].to_numpy()


def _counts(words: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], names=["word", "c"])


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def tail_classes(words: pa.Array) -> np.ndarray:
    """`tail_class` of every word (binary), worked out once for each different ending."""
    endings = pc.binary_slice(words, -2).dictionary_encode()
    by_ending = np.array([tail_class(e) for e in endings.dictionary.to_pylist()], np.int16)
    return by_ending[endings.indices.to_numpy()]


def cutoff(sizes: list[tuple[int, int]], most: int) -> int:
    """The least count such that `most` words at most have it or more, from (count, number of words)."""
    total, least = 0, None
    for c, n in sorted(sizes, reverse=True):
        total += n
        if total > most:
            break
        least = c
    return least if least is not None else max((c for c, _ in sizes), default=0) + 1


def _pieces(symbols: np.ndarray) -> list[np.ndarray]:
    return [symbols[a:a + PIECE] for a in range(0, len(symbols), PIECE)]


def _parts(batches):
    """(part, groups of documents) of rows in order of their part; a group has GROUP_TOKENS tokens or a little more."""
    rows = ((k, np.frombuffer(x, "<i2").astype(np.int32)) for batch in batches
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

    def groups(mine):
        docs, size = [], 0
        for _, symbols in mine:
            docs += _pieces(symbols)
            size += len(symbols)
            if size >= GROUP_TOKENS:
                yield docs
                docs, size = [], 0
        if docs:
            yield docs
    for part, mine in groupby(rows, lambda r: r[0]):
        yield part, groups(mine)


def fit(table: DataFrame, n_words: int, flat: np.ndarray, tokens: int) -> np.ndarray:
    """The model after all rounds over the training documents `table` (doc_id, symbols), which hold `tokens` tokens."""
    parts = max(1, min(MOST_PARTS, -(-tokens // (ROUNDS * PART_TOKENS))))
    h = F.xxhash64("doc_id", "symbols")
    dealt = table.select("doc_id", "symbols", h.alias("h"), F.pmod(h, F.lit(ROUNDS * parts)).alias("deal"))
    for k in range(ROUNDS):
        flat = train_round(dealt.where(F.col("deal") % ROUNDS == k), parts, n_words, flat)
    return flat


def train_round(dealt: DataFrame, parts: int, n_words: int, flat: np.ndarray) -> np.ndarray:
    """The mean of the copies that the parts (`deal`) of one round train from `flat`."""
    shared = dealt.sparkSession.sparkContext.broadcast(flat)  # under 400 KB: the vocabulary is bounded

    def learn(batches):
        for part, groups in _parts(batches):
            network = Network(shared.value.copy(), n_words)
            n = train(network, groups)
            blocks = [network.flat[a:a + MODEL_BLOCK] for a in range(0, len(network.flat), MODEL_BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([n] * len(blocks), pa.int64()),
                 pa.array([b.tolist() for b in blocks], pa.list_(pa.float64()))], names=["block", "n", "w"])

    ordered = dealt.repartition(parts, "deal").sortWithinPartitions("deal", "h", "doc_id", "symbols").select("deal", "symbols")
    copies = write_table(ordered.mapInArrow(learn, "block int, n bigint, w array<double>"), "lm-copies")
    mean = (copies.select("block", "n", F.posexplode("w").alias("i", "x")).groupBy("block", "i")
            .agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x")))
    out = flat.copy()
    for r in mean.collect():  # one row per parameter of the model
        out[r["block"] * MODEL_BLOCK + r["i"]] = r["x"]
    return out


def symbols_of(rows: DataFrame, n_words: int, frequent: dict[bytes, int], log_norms: list[float]) -> DataFrame:
    """Written table, a row per document: its symbols, and what its words add to the scores.

    `frequent` holds words and counts, the first `n_words` of them as symbols of their own; words it lacks are listed."""
    shared = rows.sparkSession.sparkContext.broadcast((frequent, np.array(log_norms)))  # FREQUENT words at most

    def run(batches):
        known, norms = shared.value
        words = pa.array(list(known), pa.binary())
        symbol = np.append(np.arange(FIRST, FIRST + n_words, dtype=np.int16), tail_classes(words[n_words:]))
        log = np.log10(np.array(list(known.values())) + 1.0)
        for held in _stretches(batches, lambda b: b.column(2)):
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            distinct, at, ends = numbered(batch.column(2))
            found = pc.fill_null(pc.index_in(distinct, value_set=words), -1).to_numpy()
            rare = found < 0  # by word
            by_word, log_of = np.empty(len(distinct), np.int16), np.zeros(len(distinct))
            by_word[~rare], log_of[~rare] = symbol[found[~rare]], log[found[~rare]]
            by_word[rare] = tail_classes(distinct.filter(pa.array(rare)))
            symbols, logs, out = by_word[at], log_of[at], []
            for a, b in zip(ends.tolist(), ends[1:].tolist()):
                own, weight = symbols[a:b], logs[a:b]
                in_tail = own < TAILS
                tails = np.bincount(own[in_tail], minlength=TAILS)
                out.append((float(weight.sum()), float(weight[in_tail].sum() - tails @ norms),
                            np.append(own, np.int16(END)).astype("<i2").tobytes()))
            sizes = np.diff(ends)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            is_rare, width = rare[at], max(1, len(distinct))
            # of every text each rare word once, with its number
            pairs, tf = np.unique(owner[is_rare] * width + at[is_rare], return_counts=True)
            listed = pa.StructArray.from_arrays([distinct.take(pa.array(pairs % width)), pa.array(tf, pa.int64())], names=["word", "tf"])
            offsets = np.searchsorted(pairs, np.arange(len(sizes) + 1) * width)
            n_rare = np.bincount(owner[is_rare], minlength=len(sizes))
            types = (pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes + 1, pa.int64()), pa.array(sizes - n_rare, pa.int64()),
                 *(pa.array([r[k] for r in out], t) for k, t in enumerate(types)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), listed)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "tail_logs", "symbols", "rare"])
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, tail_logs double, "
              "symbols binary, rare array<struct<word: binary, tf: bigint>>")
    listed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), (~is_training(rows["doc_id"])).alias("held_out"), "text")
    return write_table(listed.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-symbols")


def model_scores(table: DataFrame, n_words: int, flat: np.ndarray) -> DataFrame:
    """`table` with model_score, the network's log10 probability of each document's symbols."""
    shared = table.sparkSession.sparkContext.broadcast(flat)

    def run(batches):
        network = Network(shared.value, n_words)
        held, size = [], 0

        def scored():
            docs = [np.frombuffer(x.as_py(), "<i2").astype(np.int32) for b in held for x in b.column("symbols")]
            scores, at = log10_scores(network, docs), 0
            for b in held:
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(scores[at:at + b.num_rows], pa.float64())],
                                                 names=[*columns, "model_score"])
                at += b.num_rows
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column("symbols").nbytes // 2
            if size >= GROUP_TOKENS:
                yield from scored()
                held, size = [], 0
        if held:
            yield from scored()
    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "tail_logs"]
    schema = ("row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, tail_logs double, model_score double")
    return table.select(*columns, "symbols").mapInArrow(run, schema)


def score_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    learn = rows.filter(is_training(rows["doc_id"]))
    counts = word_counts(learn)
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = learn.count()
    n, v = sums["n"] + ends, sums["v"] + (ends > 0)
    # different counts: fewer than the root of twice the tokens
    least = cutoff([tuple(r) for r in counts.groupBy("c").agg(F.count("*")).collect()], FREQUENT)
    above = [(bytes(r["word"]), r["c"]) for r in counts.where(F.col("c") >= least).collect()]  # FREQUENT at most
    frequent = dict(sorted(above, key=lambda x: (-x[1], x[0])))
    vocabulary = list(frequent)[:VOCABULARY]
    totals, kinds = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    tail = (F.crc32(F.substring("word", -2, 2)) % TAILS).alias("k")
    for r in counts.groupBy(tail).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # TAILS rows
        totals[r["k"]], kinds[r["k"]] = r["c"], r["n"]
    for w in vocabulary:
        totals[tail_class(w)] -= frequent[w]
        kinds[tail_class(w)] -= 1
    table = symbols_of(rows, len(vocabulary), frequent, np.log10(totals + kinds + 1).tolist())
    begin = start([frequent[w] for w in vocabulary], totals.tolist(), ends)
    model = fit(table.where("not held_out"), len(vocabulary), begin, n)
    scored = model_scores(table, len(vocabulary), model)

    each = table.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.tf")
    met = each.join(counts.filter(F.col("c") > 0), "word", "left").groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"))
    end_log, all_log = math.log10(ends + 1), math.log10(n + v + 1)
    rare = F.coalesce("rare_logs", F.lit(0.0))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + rare + F.lit(end_log) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("model_score") + F.col("tail_logs") + rare).alias("score"))
