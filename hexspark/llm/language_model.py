"""Language-model scores of whole documents: a gated recurrent network and add-one unigrams.

Tokens are the words of a text in small letters and one end.  Their counts over all training documents
are a distributed table; its head, a bounded number of the commonest, goes to every executor.  The
network (a GRU in numpy) predicts the class of the next token and then the token in its class.  Classes
are ranges of the common words by frequency, each with a softmax of its own; their number grows with the
square root of the vocabulary.  Less common words form classes by the size of their count, in which they
share by count; words beyond the head form the last class.  So every text has a proper probability, words
never seen included.

Training is by truncated backpropagation: state is carried from window to window of a document,
gradients are not.  All training documents are dealt by a hash into shards of a fixed number of tokens,
whatever the partitions of the input; a shard is trained in order of the hash, from the same start, with
one optimiser from its first token to its last, and the weights of all shards are averaged by tokens.
Scoring packs whole documents into lanes and carries state across windows to their ends.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common

HEAD = 1 << 18
#: Learned classes for each unit of the square root of the vocabulary, least and most; words of each class.
CLASSES_A_ROOT, CLASSES_LEAST, CLASSES_MOST, CLASS_WORDS = 0.05, 8, 40, 64
BINS = 16
HIDDEN = 24
TRAIN_LANES, TRAIN_STEPS, TRAIN_RATE = 256, 16, 0.02
#: Weights with adaptive steps (Adam).  The others, of the outputs, take plain ones: adaptive steps would
#: push down every word that a sample happens not to hold.
PLAIN_RATE = 2.0
#: Tokens of a shard, and tokens of it that are packed into lanes together.
SHARD_TOKENS, PACK_TOKENS = 4_000_000, 1_000_000
#: A document longer than a lane goes on in another one, which begins with so many tokens from before the
#: cut: they set the state and are not learned from again.
LEAD = 32
LANES, STEPS = 512, 32
#: Tokens counted or scored together.
CHUNK_TOKENS = 2_000_000
AVERAGE_FAN = 16
END = np.uint64(0x9D5C0FB2E1A64C37)


def token_ids(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the tokens of each text in a row, its end included, and the index of each text's first."""
    words, first = common.hashed_words(raw, at)
    n = len(at) - 1
    bounds = first + np.arange(n + 1)
    out = np.full(len(words) + n, END, np.uint64)
    spot = np.ones(len(out), bool)
    spot[bounds[1:] - 1] = False
    out[spot] = words
    return out, bounds


def _tokens(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, at = common.utf8_of(col)
    for lo, hi in common.pieces(at):
        yield lo, hi, *token_ids(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """id, c for every distinct token of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            ids, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n)], ["id", "c"])

        parts, held = [], 0
        for batch in batches:
            for _, _, ids, _ in _tokens(batch.column(0)):
                parts.append(ids)
                held += len(ids)
                if held > CHUNK_TOKENS:
                    yield counted(parts)
                    parts, held = [], 0
        if parts:
            yield counted(parts)

    return docs.select(text).mapInArrow(common.freed(run), "id long, c long").groupBy("id").agg(F.sum("c").alias("c"))


class Head:
    """The commonest tokens: their counts, classes and places, found by id."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, tokens: int, types: int) -> None:
        """ids by falling count; tokens and types: of the whole table."""
        self.tokens, self.types = tokens, types
        n = len(ids)
        self.classes = int(min(CLASSES_MOST, max(CLASSES_LEAST, CLASSES_A_ROOT * types**0.5)))
        top = min(n, self.classes * CLASS_WORDS)
        #: Rows of the input table: common words, bins, beyond the head, start of a text.
        self.rows = self.classes * CLASS_WORDS + BINS + 2
        rank = np.arange(n)
        level = np.clip(np.log2(np.maximum(counts, 1)).astype(int), 0, BINS - 1)
        self.n_classes = self.classes + BINS + 1
        cls = np.where(rank < top, rank // CLASS_WORDS, self.classes + level).astype(np.int32)
        mass = np.bincount(cls, counts + 1.0, self.n_classes)
        self.rest = float(tokens - counts.sum() + (types - n) + 1)  # of the last class
        mass[-1] = self.rest
        self.class_bias = np.where(mass > 0, np.log(np.maximum(mass, 1e-30) / mass.sum()), -30.0).astype(np.float32)
        self.word_bias = np.full((self.classes, CLASS_WORDS), -30.0, np.float32)
        self.word_bias[cls[:top], rank[:top] % CLASS_WORDS] = np.log(counts[:top] + 1.0)
        inside = np.log((counts + 1.0) / mass[cls])
        inside[:top] = 0.0
        # Arrays by place in order of id; one more for tokens beyond the head.
        order = np.argsort(ids)
        self.ids = ids[order]
        self.log_count = np.append(np.log10(counts[order] + 1.0), 0.0)
        self.cls = np.append(cls[order], self.n_classes - 1).astype(np.int32)
        self.inside = np.append(inside[order], 0.0).astype(np.float32)  # natural log within the class, where no softmax is
        self.row = np.append(np.where(rank < top, rank, self.classes * CLASS_WORDS + level)[order], self.classes * CLASS_WORDS + BINS).astype(np.int32)
        self.bits = max(1, min(20, n.bit_length()))
        self.start = np.searchsorted(self.ids >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.start).max()) if n else 0

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """The place of each token in order of id, or the number of places if it is not in the head."""
        n = len(self.ids)
        out = np.full(len(tokens), n, np.int32)
        cell = (tokens >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.start[cell], self.start[cell + 1]
        open_ = np.flatnonzero(at < stop)
        for k in range(self.deepest):
            spot = at[open_] + k
            same = self.ids[spot] == tokens[open_]
            out[open_[same]] = spot[same]
            open_ = open_[~same]
            open_ = open_[at[open_] + k + 1 < stop[open_]]
            if not len(open_):
                break
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)
    return x


def _softmax(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, their exponentials and the sums of these; moved by their maxima only if they would leave the range."""
    y = h @ w
    y += b
    e = np.exp(y)
    total = e.sum(1)
    if not (total.min() > 1e-30 and total.max() < 1e30):
        y -= y.max(1, keepdims=True)
        e = np.exp(y)
        total = e.sum(1)
    return y, e, total


@dataclass
class Network:
    wx: np.ndarray  # input rows x 3 hidden: update, reset, candidate
    u: np.ndarray  # hidden x 3 hidden
    wc: np.ndarray
    bc: np.ndarray
    ww: np.ndarray  # class x hidden x word
    bw: np.ndarray

    NAMES = ("wx", "u", "wc", "bc", "ww", "bw")

    @staticmethod
    def new(head: Head, seed: int = 8) -> Network:
        rng = np.random.default_rng(seed)

        def small(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        wx = small(head.rows, 3 * HIDDEN, scale=0.2)
        return Network(
            wx, small(HIDDEN, 3 * HIDDEN, scale=0.15), small(HIDDEN, head.n_classes, scale=0.05), head.class_bias.copy(),
            small(head.classes, HIDDEN, CLASS_WORDS, scale=0.05), head.word_bias.copy(),
        )

    def step(self, rows: np.ndarray, h: np.ndarray) -> np.ndarray:
        x = self.wx[rows]
        g = h @ self.u
        zr = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        c = np.tanh(x[:, 2 * HIDDEN :] + zr[:, HIDDEN:] * g[:, 2 * HIDDEN :])
        return c + zr[:, :HIDDEN] * (h - c)

    def outputs(self, h: np.ndarray, cls: np.ndarray, word: np.ndarray, inside: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target given its state; with grads, also the gradient of the mean loss on the states.

        Gradients of the words' outputs are kept by class, for the classes met.
        """
        n, classes = len(h), len(self.ww)
        every = np.arange(n)
        z, e, total = _softmax(h, self.wc, self.bc)
        out = z[every, cls].astype(np.float64) - np.log(total) + inside
        d_h = None
        if grads is not None:
            e *= (1 / n / total)[:, None]
            e[every, cls] -= 1 / n
            grads["wc"], grads["bc"], grads["words"] = h.T @ e, e.sum(0), {}
            d_h = e @ self.wc.T
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edges = np.searchsorted(cls[order], np.arange(classes + 1))
        ranked, words = h[order[: edges[-1]]], word[order[: edges[-1]]]
        found = np.empty(edges[-1])
        back = np.empty_like(ranked)
        for k in np.flatnonzero(np.diff(edges)).tolist():
            lo, hi = edges[k], edges[k + 1]
            own, w, rows = ranked[lo:hi], words[lo:hi], every[: hi - lo]
            y, e, total = _softmax(own, self.ww[k], self.bw[k])
            found[lo:hi] = y[rows, w] - np.log(total)
            if grads is not None:
                e *= (1 / n / total)[:, None]
                e[rows, w] -= 1 / n
                grads["words"][k] = own.T @ e, e.sum(0)
                np.matmul(e, self.ww[k].T, out=back[lo:hi])
        out[order[: edges[-1]]] += found
        if grads is not None:
            d_h[order[: edges[-1]]] += back
        return out, d_h


class Packed:
    """Whole documents end to end in lanes of like length, the longest lane first."""

    def __init__(self, head: Head, docs: list[np.ndarray], lanes: int, lead: list[int] | None = None) -> None:
        """docs: places of the tokens of each document; lead: first tokens of each that count for nothing."""
        length = np.array([len(d) for d in docs])
        heap = [(0, i, []) for i in range(min(lanes, len(docs)))]
        for d in np.argsort(-length, kind="stable").tolist():
            load, i, own = heapq.heappop(heap)
            own.append(d)
            heapq.heappush(heap, (load + int(length[d]), i, own))
        runs = sorted(heap, key=lambda x: (-x[0], x[1]))
        self.load = np.array([x[0] for x in runs])
        shape = (int(self.load[0]), len(runs))
        self.input = np.zeros(shape, np.int32)
        self.target = np.full(shape, len(head.ids), np.int32)
        self.doc = np.zeros(shape, np.int32)
        self.reset = np.zeros(shape, bool)
        self.counts = np.zeros(shape, bool)
        for lane, (load, _, own) in enumerate(runs):
            places = np.concatenate([docs[d] for d in own])
            starts = np.concatenate([[0], np.cumsum(length[own])])[:-1]
            self.target[:load, lane] = places
            self.input[1:load, lane] = head.row[places[:-1]]
            self.input[starts, lane] = head.rows - 1
            self.reset[starts, lane] = True
            self.doc[:load, lane] = np.repeat(own, length[own])
            self.counts[:load, lane] = True
            for d, s in zip(own, starts.tolist(), strict=True) if lead else ():
                self.counts[s : s + lead[d], lane] = False

    def open_at(self, t: int) -> int:
        """Lanes that go on at step t."""
        return int(np.searchsorted(-self.load, -t, "left"))


def score_documents(net: Network, head: Head, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document; tokens beyond the head count with their class alone."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    packed = Packed(head, docs, LANES)
    word_of = head.row % CLASS_WORDS
    h = np.zeros((packed.input.shape[1], HIDDEN), np.float32)
    for t0 in range(0, len(packed.input), STEPS):
        states, targets, owners = [], [], []
        for t in range(t0, min(t0 + STEPS, len(packed.input))):
            n = packed.open_at(t)
            h = h[:n]
            begin = packed.reset[t, :n]
            if begin.any():
                h = h.copy()  # the state before is still to predict the end of its document
                h[begin] = 0
            h = net.step(packed.input[t, :n], h)
            states.append(h)
            targets.append(packed.target[t, :n])
            owners.append(packed.doc[t, :n])
        target = np.concatenate(targets)
        found, _ = net.outputs(np.concatenate(states), head.cls[target], word_of[target], head.inside[target].astype(np.float64))
        total += np.bincount(np.concatenate(owners), found, len(docs))
    return total


class Trainer:
    """Gradient steps over windows of TRAIN_STEPS tokens in TRAIN_LANES lanes; state is carried, gradients are not.

    The optimiser goes on from one call to the next.
    """

    ADAPTIVE = ("wx", "u", "wc")

    def __init__(self, net: Network, head: Head) -> None:
        self.net, self.head, self.updates = net, head, 0
        self.mean = {k: np.zeros_like(getattr(net, k)) for k in self.ADAPTIVE}
        self.square = {k: np.zeros_like(getattr(net, k)) for k in self.ADAPTIVE}

    def fit(self, docs: list[np.ndarray]) -> None:
        """One pass over documents, given as places of their tokens."""
        if not docs:
            return
        head, net = self.head, self.net
        most = max(16 * TRAIN_STEPS, -(-sum(map(len, docs)) // TRAIN_LANES))
        cuts = [(d, i) for d in docs for i in range(0, len(d), most)]
        packed = Packed(head, [d[max(0, i - LEAD) : i + most] for d, i in cuts], TRAIN_LANES, [min(i, LEAD) for _, i in cuts])
        word_of = head.row % CLASS_WORDS
        h = np.zeros((packed.input.shape[1], HIDDEN), np.float32)
        for t0 in range(0, len(packed.input), TRAIN_STEPS):
            span = slice(t0, t0 + TRAIN_STEPS)
            n = packed.open_at(t0)
            rows, reset, counts = packed.input[span, :n], packed.reset[span, :n], packed.counts[span, :n]
            states, kept = self.forward(rows, reset, h[:n])
            h = states[-1]
            if not counts.any():
                continue
            target = packed.target[span, :n][counts]
            grads: dict = {}
            d_states = np.zeros_like(states)
            _, d_states[counts] = net.outputs(states[counts], head.cls[target], word_of[target], head.inside[target].astype(np.float64), grads)
            self.backward(rows, reset, kept, d_states, grads)
            self.apply(grads, float(counts.sum()) / (TRAIN_LANES * TRAIN_STEPS))

    def forward(self, rows: np.ndarray, reset: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States after each step of a window, and what the way back needs."""
        net, (steps, n) = self.net, rows.shape
        x = net.wx[rows]
        before, states = np.empty((steps, n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        gates, inner, cand = np.empty((steps, n, 2 * HIDDEN), np.float32), np.empty_like(states), np.empty_like(states)
        for t in range(steps):
            before[t] = h
            if reset[t].any():
                before[t][reset[t]] = 0
            h = before[t]
            g = h @ net.u
            gates[t] = _sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            inner[t] = g[:, 2 * HIDDEN :]
            c = gates[t, :, HIDDEN:] * inner[t]
            c += x[t, :, 2 * HIDDEN :]
            np.tanh(c, out=cand[t])
            c = cand[t]
            h = states[t] = c + gates[t, :, :HIDDEN] * (h - c)
        return states, (before, gates, inner, cand)

    def backward(self, rows: np.ndarray, reset: np.ndarray, kept: tuple, d_states: np.ndarray, grads: dict) -> None:
        """Gradients of u and of the input rows met, through the steps of one window."""
        before, gates, inner, cand = kept
        z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
        # All that does not hang on later steps is made for the whole window.
        by_cand = (1 - z) * (1 - cand * cand)
        by_update = (before - cand) * z * (1 - z)
        by_reset = inner * r * (1 - r)
        d_x = np.empty((*rows.shape, 3 * HIDDEN), np.float32)
        d_g = np.empty_like(d_x)
        carry = np.zeros_like(d_states[0])
        back = np.ascontiguousarray(self.net.u.T)
        for t in range(len(rows) - 1, -1, -1):
            d = d_states[t] + carry
            d_c = d * by_cand[t]
            np.multiply(d, by_update[t], out=d_g[t, :, :HIDDEN])
            np.multiply(d_c, by_reset[t], out=d_g[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(d_c, r[t], out=d_g[t, :, 2 * HIDDEN :])
            d_x[t, :, 2 * HIDDEN :] = d_c
            carry = d * z[t]
            carry += d_g[t] @ back
            if reset[t].any():
                carry[reset[t]] = 0
        d_x[:, :, : 2 * HIDDEN] = d_g[:, :, : 2 * HIDDEN]
        grads["u"] = before.reshape(-1, HIDDEN).T @ d_g.reshape(-1, 3 * HIDDEN)
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        edges = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        grads["rows"], grads["wx"] = flat[edges], np.add.reduceat(d_x.reshape(-1, 3 * HIDDEN)[order], edges)

    def apply(self, grads: dict, share: float) -> None:
        """One step against the gradients, clipped together; share: how full the window was."""
        net, words, met = self.net, grads["words"], grads["rows"]
        parts = [grads["wx"], grads["u"], grads["wc"], grads["bc"], *(g for pair in words.values() for g in pair)]
        norm = sum(float(np.vdot(g, g)) for g in parts) ** 0.5
        clip = min(1.0, 1.0 / (norm + 1e-9))
        self.updates += 1
        # Plain floats, so that the arrays stay in single precision.
        rate = share * TRAIN_RATE * (1 - 0.999**self.updates) ** 0.5 / (1 - 0.9**self.updates)
        for k in self.ADAPTIVE:
            g = grads[k]
            g *= clip
            m, v = self.mean[k], self.square[k]
            own = met if k == "wx" else slice(None)
            mean = m[own] * 0.9 + 0.1 * g
            square = v[own] * 0.999 + 0.001 * (g * g)
            m[own], v[own] = mean, square
            getattr(net, k)[own] -= rate * mean / (np.sqrt(square) + 1e-6)
        plain = share * PLAIN_RATE * clip
        net.bc -= plain * grads["bc"]
        for k, (g_w, g_b) in words.items():
            net.ww[k] -= plain * g_w
            net.bw[k] -= plain * g_b


def _average(rows: list[tuple[float, bytes]]) -> bytes:
    """Weights averaged by tokens, in the order given."""
    total = sum(n for n, _ in rows)
    out: dict[str, np.ndarray] = {}
    for n, blob in rows:
        for k, w in pickle.loads(blob).items():
            out[k] = out.get(k, 0.0) + w.astype(np.float64) * (n / total)
    return pickle.dumps({k: w.astype(np.float32) for k, w in out.items()})


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """rows (h, key, text) with shard and copies, how often the shard has the row."""
    alone = rows.withColumns({"shard": F.pmod("h", F.lit(shards)), "copies": F.lit(1).cast("long")})
    if shards == 1:
        return alone
    # Equal rows have one key, so the texts are read only if keys come more than once.
    again = common.stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("_again")), "again")
    if again.isEmpty():
        return alone
    sizes = rows.join(again, F.col("key").eqNullSafe(F.col("_again")), "left_semi").groupBy("h").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    # Two bytes a token at least, so these are all that hold a quarter of a shard; most have more.
    hot = common.stored(sizes.where((F.col("n") > 1) & (F.col("bytes") >= SHARD_TOKENS // 2)).select("h"), "hot")
    if hot.isEmpty():
        return alone
    many = rows.join(hot, "h", "left_semi").groupBy("h", "key", "text").agg(F.count("*").alias("n"))
    spread = many.select("h", "key", "text", "n", F.explode(F.sequence(F.lit(0), F.least("n", F.lit(shards)).cast("int") - 1)).alias("i"))
    copies = (F.col("n") - F.pmod("n", F.lit(shards))) / shards + F.when(F.col("i") < F.pmod("n", F.lit(shards)), 1).otherwise(0)
    spread = spread.select("h", "key", "text", F.pmod(F.pmod("h", F.lit(shards)) + F.col("i"), F.lit(shards)).alias("shard"), copies.cast("long").alias("copies"))
    return alone.join(hot, "h", "left_anti").unionByName(spread)


def train(docs: DataFrame, head: Head, key: str = "doc_id", text: str = "text") -> Network:
    """All rows are learned from once: dealt into shards by a hash of key and text, and trained in its order.

    Rows equal in both that together would fill a good part of a shard are divided evenly over the shards; they are
    shuffled once a shard, with their number.  The result hangs on the rows alone, not on their partitions.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(head)
    shards = max(1, -(-head.tokens // SHARD_TOKENS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        now, trainer, held, since, seen = None, None, [], 0, 0

        def finish() -> pa.RecordBatch:
            trainer.fit(held)
            blob = pickle.dumps({k: getattr(trainer.net, k) for k in Network.NAMES})
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([float(seen)]), pa.array([blob], pa.binary())], ["shard", "n", "net"])

        for batch in batches:
            of, copies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, ids, bounds in _tokens(batch.column(1)):
                places = head.places(ids)
                for i in range(hi - lo):
                    if of[lo + i] != now:
                        if now is not None:
                            yield finish()
                        now, trainer, held, since, seen = of[lo + i], Trainer(Network.new(head), head), [], 0, 0
                    for _ in range(copies[lo + i]):
                        held.append(places[bounds[i] : bounds[i + 1]])
                        since += len(held[-1])
                        seen += len(held[-1])
                        if since >= PACK_TOKENS:
                            trainer.fit(held)
                            held, since = [], 0
        if now is not None:
            yield finish()

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)]
        for group, own in itertools.groupby(rows, lambda r: r[0]):
            own = [(n, blob) for _, _, n, blob in own]
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([sum(n for n, _ in own)]), pa.array([_average(own)], pa.binary())], ["shard", "n", "net"])

    h = F.xxhash64(F.lit(21), F.col(text), F.col(key))
    dealt = _dealt(docs.select(h.alias("h"), F.col(key).alias("key"), F.col(text).alias("text")), shards)
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "h", "key", "text").select("shard", "text", "copies")
    nets = common.stored(dealt.mapInArrow(common.freed(run), "shard long, n double, net binary"), "nets")
    while (count := nets.count()) > AVERAGE_FAN:
        # The weights of AVERAGE_FAN shards meet in one task.
        groups = -(-count // AVERAGE_FAN)
        placed = nets.select(F.floor(F.col("shard") / AVERAGE_FAN).alias("group"), "shard", "n", "net")
        placed = placed.repartitionById(groups, F.pmod("group", F.lit(groups)).cast("int")).sortWithinPartitions("group", "shard")
        nets = common.stored(placed.mapInArrow(common.freed(merge), "shard long, n double, net binary"), "nets")
    rows = [(r[1], bytes(r[2])) for r in sorted(nets.collect())]
    net = Network.new(head)
    if rows:
        for k, value in pickle.loads(_average(rows)).items():
            setattr(net, k, value)
    return net


def _commonest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts, by falling count, of at most `most` of the commonest tokens.

    The bound comes from a histogram of counts by sixteenths of an octave, so no task ranks the tokens; of the
    bin in which the number ends a share by id is taken.
    """
    level = F.floor(F.log2("c") * 16).cast("int")
    held, least, share = 0, None, 0
    for at, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        least = at
        if held + n > most:
            share = 1000 * (most - held) // n
            break
        held, share = held + n, 1000
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = counts.where((level > least) | ((level == least) & (F.pmod(F.xxhash64("id"), F.lit(1000)) < share))).select("id", "c").toArrow()
    ids, c = top.column("id").to_numpy().astype(np.int64), top.column("c").to_numpy().astype(np.int64)
    order = np.lexsort((ids, -c))
    return ids[order].view(np.uint64), c[order]


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    held_out rows are never learned from.  base_score is the add-one unigram log10 probability, score
    the network's.  Null texts count as empty: one token, the end.  With no row to learn from, all tokens
    are unknown.  Tokens are told apart by 64-bit hashes; repeated rows count as often as they occur.  Texts of any length are
    scored whole; no rows give none.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    training = docs.where(~held_out)
    counts = common.stored(token_counts(training, text), "counts")
    n_tokens, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ids, c = _commonest(counts, HEAD)
    head = Head(ids, c, n_tokens, n_types)
    net = train(training, head, key, text)
    sent = spark.sparkContext.broadcast((head, net))
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("row", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_head", T.LongType()), T.StructField("s_head", T.DoubleType()),
        T.StructField("s_net", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("rare_n", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, net = sent.value
        beyond = len(head.ids)
        for batch in batches:
            held, start, since = [], 0, 0
            rare, rare_n, rare_len, n_all, n_head, s_head = [], [], [], [], [], []

            def flush(stop: int, batch=batch) -> pa.RecordBatch:
                nonlocal start, since
                s_net = score_documents(net, head, held)
                where = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(rare_len))]).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(start, stop - start) for i in range(3)), pa.array(np.concatenate(n_all)), pa.array(np.concatenate(n_head)),
                        pa.array(np.concatenate(s_head)), pa.array(s_net / np.log(10)),
                        pa.ListArray.from_arrays(where, pa.array(np.concatenate(rare))), pa.ListArray.from_arrays(where, pa.array(np.concatenate(rare_n))),
                    ],
                    schema.names,
                )
                start, since = stop, 0
                for x in (held, rare, rare_n, rare_len, n_all, n_head, s_head):
                    x.clear()
                return out

            for lo, hi, ids, bounds in _tokens(batch.column(3)):
                places = head.places(ids)
                held.extend(places[bounds[i] : bounds[i + 1]] for i in range(hi - lo))
                out_of = places == beyond
                n_all.append(np.diff(bounds))
                n_head.append(common.sums_by(~out_of, bounds))
                s_head.append(np.array([head.log_count[places[bounds[i] : bounds[i + 1]]].sum() for i in range(hi - lo)]))
                spot = np.flatnonzero(out_of)
                doc = np.searchsorted(bounds, spot, "right") - 1
                order = np.lexsort((ids[spot], doc))
                x, d = ids[spot][order], doc[order]
                edge = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (d[1:] != d[:-1])])) if len(x) else np.zeros(0, np.int64)
                rare.append(x[edge].view(np.int64))
                rare_n.append(np.diff(np.append(edge, len(x))))
                rare_len.append(np.bincount(d[edge], minlength=hi - lo))
                since += len(ids)
                if since > CHUNK_TOKENS:
                    yield flush(hi)
            if held:
                yield flush(batch.num_rows)

    rows = docs.select(key, held_out.alias("held_out"), F.monotonically_increasing_id().alias("row"), text)
    scored = common.stored(rows.mapInArrow(common.freed(run), schema), "scored")
    seen = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("rid"), F.col("x.rare_n").alias("n"))
    seen = seen.join(counts, F.col("rid") == F.col("id"), "left")
    tail = seen.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("s_tail"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_tail"),
        F.sum("n").alias("n_rare"),
    )
    out = scored.join(tail, F.col("row") == F.col("_row"), "left")
    s_tail, n_tail, n_rare = (F.coalesce(c, F.lit(0)) for c in ("s_tail", "n_tail", "n_rare"))
    return out.select(
        key, "held_out", "n_tokens", (F.col("n_head") + n_tail).alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("s_head") + s_tail - F.col("n_tokens") * float(np.log10(n_tokens + n_types + 1))).alias("base_score"),
        (F.col("s_net") + s_tail - n_rare * float(np.log10(head.rest))).alias("score"),
    )
