"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word, bare of punctuation and with small letters, has the sum of the hashed embeddings of itself and
of its beginnings, so an insult is known in any of its forms and two words rarely meet in all.  Filters over one, two and three words are max-pooled over the
whole text and weighed by a logistic output.  Thresholds are calibrated by language, which is told from
the common words and letters of the text, other languages having the common one; a score of 0.5 lies at the threshold of the text's language.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common, samples

BUCKETS, WIDTH, FILTERS, SPANS = 1 << 16, 8, 8, (1, 2, 3)
#: Bytes of the beginnings of a word that have embeddings beside the word itself.
BEGINNINGS = (4, 5, 6)
BATCH, RATE = 32, 0.15
#: Passes over the sample; a small one is passed more often, up to so many batches in all.
EPOCHS, MOST_EPOCHS, LEAST_BATCHES = 8, 40, 1500
#: The fitting sample: at most so many texts and bytes of each class.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 12 << 20
#: Every so many-th text of each class calibrates the thresholds and is not trained on.
CALIBRATION = 5
#: Where labelled texts are left over, all are trained on in shards of about so many bytes, at this rate, from the model of the sample.
SHARD_BYTES, SHARD_RATE = 16 << 20, 0.02
#: A clean text called toxic counts as so many toxic texts missed.
CLEAN_COUNTS = 4.0
#: A language's threshold is drawn towards that of all, and that of all towards the one the costs give, as by
#: so many texts of each class.
DRAWN = 25
#: Common words and accented letters of each language.
COMMON_WORDS = {
    "en": "the of and to in is that for with by",
    "de": "der die das und den ein ist mit für auf von nicht",
    "fr": "le les des et est une dans pour sur avec du",
    "es": "el los las y que del en por con se",
}
LETTERS = {"en": "", "de": "äöüßÄÖÜ", "fr": "éèêëçàâôûîïÉÈÊÇÀ", "es": "ñáíóúÑÁÍÓÚ"}
NAMES = tuple(COMMON_WORDS)
#: A text of which fewer words than this share are common words or letters of its likeliest language is in none of them.
EVIDENCE = 0.1
#: The number of languages, which stands for any other.
OTHER = len(NAMES)


def _language_tables() -> tuple[np.ndarray, np.ndarray]:
    """The language of a word's bucket (0: none), and which second bytes (after 0xC3) are letters of each."""
    words = np.zeros(BUCKETS, np.int8)
    letters = np.zeros((len(NAMES), 256), bool)
    for i, name in enumerate(NAMES):
        ids, _ = word_ids(*common.utf8_of(pa.array([COMMON_WORDS[name]])))
        words[ids[0]] = i + 1
        letters[i, [c.encode()[1] for c in LETTERS[name]]] = True
    return words, letters


def word_ids(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (one row per table) of the words of each text without the punctuation around them, and each text's first word."""
    starts, ends, first = common.bare_bounds(raw, at)
    # Words of punctuation alone are empty ranges and share one hash.
    stops = [ends, *(np.minimum(ends, starts + n) for n in BEGINNINGS)]
    if not len(starts):
        return np.zeros((len(stops), 0), np.int32), first
    hashes = [common.hashed(raw, starts, e) >> np.uint64(7 * i) for i, e in enumerate(stops)]
    return np.stack([(h & np.uint64(BUCKETS - 1)).astype(np.int32) for h in hashes]), first


_WORD_LANGUAGE, _LETTER = _language_tables()


def languages(raw: np.ndarray, at: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The language of each text: that with most common words and letters, the first of those as many; OTHER without enough of them.

    Italian and Russian texts, and those of a word or two, are OTHER and take the common cut.
    """
    spoken = _WORD_LANGUAGE[ids[0]]
    after = np.concatenate([[False], raw[:-1] == 0xC3]) if len(raw) else np.zeros(0, bool)
    counts = [common.sums_by(spoken == i + 1, first) + common.sums_by(after & _LETTER[i][raw], at) for i in range(len(NAMES))]
    counts = np.stack(counts)
    return np.where(counts.max(0) >= np.maximum(1, EVIDENCE * np.diff(first)), counts.argmax(0), OTHER)


@dataclass
class Model:
    tables: np.ndarray  # word and beginnings x BUCKETS x WIDTH
    conv: np.ndarray  # WIDTH x (filters of each place of each span)
    shift: np.ndarray  # one per filter
    out: np.ndarray
    bias: float
    cuts: np.ndarray  # by language

    @staticmethod
    def places(span: int, i: int) -> slice:
        at = sum(SPANS[: SPANS.index(span)]) + i
        return slice(at * FILTERS, (at + 1) * FILTERS)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        e = self.tables[0][ids[0]]
        for table, own in zip(self.tables[1:], ids[1:], strict=True):
            e += table[own]
        return e

    def filtered(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Filter values at every word; a window reaching over a text's end sees zeros there."""
        y = e @ self.conv
        doc_end = np.repeat(first[1:], np.diff(first))
        here = np.arange(len(e))
        cols = []
        for span in SPANS:
            z = y[:, self.places(span, 0)].copy()
            for i in range(1, span):
                ok = here + i < doc_end
                z[:-i][ok[:-i]] += y[i:, self.places(span, i)][ok[:-i]]
            cols.append(z)
        return np.hstack(cols)

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The output before calibration; a text without words has empty filters."""
        n = len(first) - 1
        pooled = np.zeros((n, len(self.out)), np.float32)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            pooled[full] = np.maximum.reduceat(self.filtered(self.embed(ids), first), first[full], axis=0)
            pooled[full] = np.maximum(pooled[full] + self.shift, 0)
        return (pooled @ self.out + self.bias).astype(np.float64)

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at) - 1)
        for lo, hi in common.pieces(at, 1 << 20):
            part, bounds = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            ids, first = word_ids(part, bounds)
            z = self.logits(ids, first) - self.cuts[languages(part, bounds, ids, first)]
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return out


def new_model(seed: int = 4) -> Model:
    rng = np.random.default_rng(seed)
    n = FILTERS * len(SPANS)
    return Model(
        rng.normal(0, 0.05, (1 + len(BEGINNINGS), BUCKETS, WIDTH)).astype(np.float32),
        rng.normal(0, 0.4, (WIDTH, FILTERS * sum(SPANS))).astype(np.float32),
        np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32), 0.0, np.zeros(OTHER + 1),
    )


def train(texts: list[bytes], labels: np.ndarray, epochs: int | None = None, seed: int = 4, start: Model | None = None) -> Model:
    """Fit by Adagrad; through max pooling only the best window of each filter gets a gradient.

    With start, all texts are trained on in one pass that goes on from it, and its cuts stay.
    """
    model = new_model(seed) if start is None else copy.deepcopy(start)
    if start is not None and not len(labels):
        return model
    if start is None and len(set(labels.tolist())) < 2:
        model.bias = -4.0 if not len(labels) or labels[0] == 0 else 4.0
        return model
    rng = np.random.default_rng(seed)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    parts, firsts, spoken, seen_words = [], [], [], 0
    for lo, hi in common.pieces(at):
        ids, own = word_ids(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        spoken.append(languages(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], ids, own))
        parts.append(ids)
        firsts.append(own[:-1] + seen_words)
        seen_words += ids.shape[1]
    ids, first = np.concatenate(parts, axis=1), np.append(np.concatenate(firsts), seen_words)
    del parts, firsts
    place = np.empty(len(texts), int)  # within the class
    for c in (0, 1):
        place[labels == c] = np.arange(np.sum(labels == c))
    held = np.flatnonzero(place % CALIBRATION == CALIBRATION - 1)
    rows = np.flatnonzero(place % CALIBRATION != CALIBRATION - 1)
    if start is not None:
        rows, epochs = np.arange(len(texts)), 1
    weight = np.where(labels == 1, 0.5 / max(1, np.sum(labels[rows] == 1)), 0.5 / max(1, np.sum(labels[rows] == 0))) * len(rows)
    seen = {k: np.full_like(v, 1e-3) for k, v in (("tables", model.tables), ("conv", model.conv), ("shift", model.shift), ("out", model.out))}
    seen_bias = 1e-3
    epochs = epochs or min(MOST_EPOCHS, max(EPOCHS, LEAST_BATCHES * BATCH // max(1, len(rows))))
    for epoch in range(epochs):
        rate = (RATE if start is None else SHARD_RATE) * (1 - epoch / (epochs + 1))
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // BATCH)):
            word = np.concatenate([np.arange(first[d], first[d + 1]) for d in batch])
            own = np.concatenate([[0], np.cumsum(first[batch + 1] - first[batch])])
            own_ids = ids[:, word]
            e = model.embed(own_ids)
            values = model.filtered(e, own)
            best = np.full((len(batch), len(model.out)), -1)
            pooled = np.zeros((len(batch), len(model.out)), np.float32)
            for i in range(len(batch)):
                if own[i + 1] > own[i]:
                    best[i] = values[own[i] : own[i + 1]].argmax(0) + own[i]
                    pooled[i] = values[best[i], np.arange(len(model.out))]
            active = np.maximum(pooled + model.shift, 0) * (best >= 0)
            p = 1 / (1 + np.exp(-(active @ model.out + model.bias)))
            err = ((p - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            g_out = active.T @ err
            g_pool = np.outer(err, model.out) * (active > 0)
            g_conv = np.zeros_like(model.conv)
            g_rows, g_vals = [], []
            for k, span in enumerate(SPANS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                d, f = np.nonzero(g_pool[:, cols])
                pos, g = best[:, cols][d, f], g_pool[:, cols][d, f]
                for i in range(span):
                    inside = pos + i < own[d + 1]
                    q, gi, fi = pos[inside] + i, g[inside], f[inside]
                    place = model.places(span, i).start + fi
                    np.add.at(g_conv.T, place, e[q] * gi[:, None])
                    g_rows.append(q)
                    g_vals.append(model.conv[:, place].T * gi[:, None])
            for name, grad in (("conv", g_conv), ("out", g_out), ("shift", g_pool.sum(0))):
                seen[name] += grad**2
                setattr(model, name, getattr(model, name) - rate * grad / np.sqrt(seen[name]))
            seen_bias += float(err.sum()) ** 2
            model.bias -= rate * float(err.sum()) / np.sqrt(seen_bias)
            q, v = np.concatenate(g_rows), np.concatenate(g_vals)
            for t, buckets in enumerate(own_ids):
                hit, where = np.unique(buckets[q], return_inverse=True)
                grad = np.zeros((len(hit), WIDTH), np.float32)
                np.add.at(grad, where, v)
                seen["tables"][t][hit] += grad**2
                model.tables[t][hit] -= rate * grad / np.sqrt(seen["tables"][t][hit])
    if start is not None:
        return model
    if len(held):
        z = model.logits(np.concatenate([ids[:, first[d] : first[d + 1]] for d in held], axis=1), np.concatenate([[0], np.cumsum(first[held + 1] - first[held])]))
        model.cuts = calibrated(z, labels[held], np.concatenate(spoken)[held])
    else:
        model.cuts[:] = np.log(CLEAN_COUNTS)
    return model


def calibrated(z: np.ndarray, y: np.ndarray, language: np.ndarray) -> np.ndarray:
    """The best cut of each language, drawn towards the common one the more the fewer texts it has; last the common one, for all others."""

    def cut_of(own: np.ndarray, towards: float) -> float:
        toxic, clean = np.sort(z[own & (y == 1)]), np.sort(z[own & (y == 0)])
        n = min(len(toxic), len(clean))
        if not n:
            return towards
        edges = np.unique(z[own])
        cuts = np.concatenate([[edges[0] - 1], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1]])
        cost = np.searchsorted(toxic, cuts) / len(toxic) + CLEAN_COUNTS * (1 - np.searchsorted(clean, cuts) / len(clean))
        # Among cuts as good, that in the widest gap.
        ok = np.flatnonzero(cost <= cost.min() + 1e-12)
        gaps = np.concatenate([[0], np.diff(edges), [0]])
        return (n * float(cuts[ok[gaps[ok].argmax()]]) + DRAWN * towards) / (n + DRAWN)

    every = cut_of(np.ones(len(z), bool), float(np.log(CLEAN_COUNTS)))
    return np.array([*(cut_of(language == i, every) for i in range(len(NAMES))), every])


def _flat(model: Model) -> np.ndarray:
    """The weights as rows of WIDTH numbers: those of the buckets, then all others."""
    rest = np.concatenate([model.conv.ravel(), model.shift, model.out, [model.bias]]).astype(np.float32)
    return np.concatenate([model.tables.reshape(-1, WIDTH), np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)])


def _moved(model: Model, at: np.ndarray, by: np.ndarray) -> Model:
    flat = _flat(model)
    flat[at] += by
    n = model.tables.size // WIDTH
    tables, rest = flat[:n].reshape(model.tables.shape), flat[n:].ravel()
    a, b = model.conv.size, model.conv.size + len(model.shift)
    return Model(tables, rest[:a].reshape(model.conv.shape), rest[a:b], rest[b : b + len(model.out)], float(rest[b + len(model.out)]), model.cuts)


def trained_on_all(model: Model, every: DataFrame) -> Model:
    """The model after a pass over all texts of every (_key, label, text) but a fifth by hash, whose scores give the cuts.

    Texts are dealt by hash into shards, which train apart from the same start; a weight moves by the mean over the
    shards that moved it.  The driver gets the weights and a histogram of scores.
    """
    every = common.stored(every, "labelled")
    fold = F.pmod(F.xxhash64(F.lit(9), "_key"), F.lit(CALIBRATION))
    size = every.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    sent = every.sparkSession.sparkContext.broadcast(model)

    def shard(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_key")
        texts, labels = [t.encode() for t in rows.column("text").to_pylist()], rows.column("label").to_numpy()
        by = _flat(train(texts, labels, start=sent.value)) - _flat(sent.value)
        at = np.flatnonzero(by.any(1))
        return pa.table({"at": pa.array(at.astype(np.int64)), **{f"d{i}": by[at, i].astype(np.float64) for i in range(WIDTH)}})

    dealt = every.where(fold != 0).withColumn("shard", F.pmod(F.xxhash64(F.lit(8), "_key"), F.lit(shards)))
    moved = dealt.groupBy("shard").applyInArrow(shard, ", ".join(["at long", *(f"d{i} double" for i in range(WIDTH))]))
    mean = moved.groupBy("at").agg(*(F.avg(f"d{i}").cast("float").alias(f"d{i}") for i in range(WIDTH))).toArrow()
    model = _moved(model, mean.column("at").to_numpy(), np.stack([mean.column(f"d{i}").to_numpy() for i in range(WIDTH)], 1))
    final = every.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = common.utf8_of(batch.column(1))
            for lo, hi in common.pieces(at):
                part, bounds = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                ids, first = word_ids(part, bounds)
                z = np.round(np.clip(final.value.logits(ids, first), -40, 40), 2)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(languages(part, bounds, ids, first).astype(np.int32)), pa.array(z)], ["y", "l", "z"])

    seen = every.where(fold == 0).select("label", "text").mapInArrow(common.freed(run), "y int, l int, z double").groupBy("y", "l", "z").count().toArrow()
    y, lang, z = (np.repeat(seen.column(c).to_numpy(), seen.column("count").to_numpy()) for c in ("y", "l", "z"))
    model.cuts = calibrated(z, y, lang) if len(z) else model.cuts
    return model


def classify(
    docs: DataFrame, labels: DataFrame, train_on: Column | None = None, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """key and score, 0 to 1, of every row of docs; 0.5 is the threshold of the text's language.

    Learns from all labels that train_on (a condition on the labels' key) admits: a first model from at most `rows`
    texts and `max_bytes` bytes of each class, then, where that is not all, from every text, which also gives the thresholds.  Null and empty texts get the score of a text without words, texts of any length
    are read whole, and equal texts get equal scores, each row its own; without labels all rows count as clean, no rows give
    none.  Other columns are not read, whatever their names.
    """
    sample, _ = samples.labelled(docs, labels, "toxic", rows, max_bytes, train_on, key, text)
    model = samples.fitted(sample, train)
    every = samples.every_labelled(docs, labels, "toxic", train_on, key, text)
    if every.select("_key").count() > sample.count():
        model = trained_on_all(model, every)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(*common.utf8_of(batch.column(1))))], schema.names)

    return docs.select(key, text).mapInArrow(common.freed(run), schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return common.fold(key, 5) == 0
