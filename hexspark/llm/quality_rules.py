"""Quality rules judged by an isolation forest.

Rule statistics are counted for every whole text with numpy and made rates.  An isolation forest fitted
on a bounded sample of the rates gives each document an anomaly score from the lengths of its paths
over random splits.  Labels set the threshold on that score and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common

# Fixed by the task.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

#: Rows of the fitting sample, trees, and rows of each tree.
SAMPLE_ROWS = 20_000
TREES, TREE_ROWS = 128, 64
#: Rates are drawn towards the corpus' rate as by so many units of it, so that a short text's chance
#: does not make it odd.
UNITS = {"n_words": 50, "n_lines": 10, "word_chars": 250}
#: Rates are scaled by the distance of these quantiles, and distances from the middle raised to a power:
#: uniform splits then fall far from the bulk more often.
SPREAD = (0.05, 0.5, 0.95)
POWER = 1.5
#: Of the good labelled rows, at most this share may be rejected.
MOST_LOST = 0.01
BINS = 1000
DEFAULT_THRESHOLD = 0.6

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits", "n_marks")


def _byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _byte_set(SYMBOLS)
_UPPER = _byte_set(bytes(range(65, 91)))
_DIGIT = _byte_set(b"0123456789")
_MARK = _byte_set(b"!\"'()+/;=?@[\\]^_`{}~")
_HEAD = np.ones(256, bool)  # bytes that begin a code point
_HEAD[0x80:0xC0] = False


def statistics(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The rule statistics of each text in a buffer."""
    n = len(at) - 1
    out = {k: np.zeros(n, np.int64) for k in COUNTS + EXTRA}
    for lo, hi in common.pieces(at):
        part, bounds = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        starts, ends, first = common.word_bounds(part, bounds)
        words = common.hashed(part, starts, ends, lower=False)
        rows = slice(lo, hi)
        out["n_words"][rows] = np.diff(first)
        out["word_chars"][rows] = common.sums_by(_HEAD[part] & ~common.SEP[part], bounds)
        for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_marks", _MARK)):
            out[name][rows] = common.sums_by(table[part], bounds)
        out["n_repeat_words"][rows] = _repeated(words, first)
        newlines = common.sums_by(part == 10, bounds)
        for i in np.flatnonzero(newlines):
            lines = [x for x in part[bounds[i] : bounds[i + 1]].tobytes().split(b"\n") if x.strip()]
            out["n_lines"][lo + i] = len(lines)
            out["n_dup_lines"][lo + i] = len(lines) - len(set(lines))
        out["n_lines"][rows] = np.maximum(out["n_lines"][rows], np.diff(first) > 0)
    return out


def _repeated(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words covered by 3-word windows that occur twice or more in it."""
    if len(words) < 3:
        return np.zeros(len(first) - 1, np.int64)
    base = np.uint64(0x9E3779B97F4A7C15)
    key = common.mix64((words[:-2] * base + words[1:-1]) * base + words[2:])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    valid = doc[:-2] == doc[2:]
    key = common.mix64(key + doc[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    spot = np.flatnonzero(valid)
    order = spot[np.argsort(key[spot])]
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(words), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return common.sums_by(covered, first)


def rule_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the rule statistics of every row; a null text counts as empty."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *(T.StructField(c, T.LongType()) for c in COUNTS + EXTRA)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(*common.utf8_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c]) for c in COUNTS + EXTRA)], schema.names)

    return docs.select(key, text).mapInArrow(common.freed(run), schema)


#: What each rate counts and what it is a share of.
RATES = (
    ("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"),
    ("n_upper", "word_chars"), ("n_digits", "word_chars"), ("n_marks", "n_words"),
)


def rates(totals: dict[str, int]) -> list[Column]:
    """The rates of a row, given the totals of the statistics over all rows."""
    return [(F.col(top) + UNITS[below] * totals[top] / max(1, totals[below])) / (F.col(below) + UNITS[below]) for top, below in RATES]


def scaled(rate: Column, low: float, middle: float, high: float) -> Column:
    """A rate's distance from the middle in spreads, with its sign, to the power."""
    z = (rate - F.lit(middle)) / F.lit(max(high - low, 1e-3 * abs(middle), 1e-9))
    return F.signum(z) * F.pow(F.abs(z), F.lit(POWER))


class Forest:
    """Isolation forest: each tree splits a random subset of rows at random values of random features."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.size = min(size, max(2, len(rows)))
        self.trees = []
        for _ in range(trees):
            sub = rows[rng.choice(len(rows), self.size, replace=False)] if len(rows) > self.size else rows
            self.trees.append(self._grow(sub, rng))

    @staticmethod
    def average(n: float) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        limit = int(np.ceil(np.log2(max(2, self.size))))
        feature, cut, left, depth = [], [], [], []
        queue = [(rows, 0)]
        at = 0
        while at < len(queue):
            sub, level = queue[at]
            at += 1
            spread = sub.max(0) - sub.min(0) if len(sub) else np.zeros(0)
            open_ = np.flatnonzero(spread > 0)
            if level >= limit or len(sub) < 2 or not len(open_):
                feature.append(-1)
                cut.append(0.0)
                left.append(0)
                depth.append(level + self.average(len(sub)))
                continue
            f = int(rng.choice(open_))
            c = rng.uniform(sub[:, f].min(), sub[:, f].max())
            below = sub[:, f] < c
            feature.append(f)
            cut.append(c)
            left.append(len(queue))  # the right child follows the left
            depth.append(0.0)
            queue += [(sub[below], level + 1), (sub[~below], level + 1)]
        return np.array(feature), np.array(cut), np.array(left), np.array(depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores, 0 to 1: 2 to the power of minus the mean path length over its expectation."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, depth in self.trees:
            node = np.zeros(len(rows), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, left[node] + right, node)
            total += depth[node]
        return 2 ** (-total / len(self.trees) / max(self.average(self.size), 1e-9))


def threshold_of(good: np.ndarray, bad: np.ndarray, most_lost: float = MOST_LOST) -> float:
    """The cut on scores that catches most bad rows net of good ones, losing at most a share of the good.

    good and bad are histograms over BINS bins of the score; rows at or above the cut are rejected.
    """
    if not good.sum() or not bad.sum():
        return DEFAULT_THRESHOLD
    lost = good[::-1].cumsum()[::-1] / good.sum()
    caught = bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(lost <= most_lost, caught - lost, -1.0)
    at = int(gain.argmax())
    return at / BINS if gain[at] > 0 else 1.01


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """key, the statistics, base_failed, anomaly score and kept for every row of docs.

    The statistics are made in one pass over the texts and kept as a table.  Totals and quantiles are those
    of all rows; the forest is fitted on at most sample_rows of those that pass the base rules, in hash
    order; all labelled rows set the threshold.  Null or empty texts have no words and fail the base rules;
    without labels of both kinds the threshold is a fixed default.  Repeated rows are each judged alike, scores at the
    threshold are rejected; a row of null key has no label.  Texts of any length count whole; no rows give none.  Other columns are
    not read, whatever their names.
    """
    stats = common.stored(rule_table(docs, key, text), "rules")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    marks = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_q"))
    totals = stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS + EXTRA]).first().asDict()
    per_row = rates(totals)
    spread = stats.where(~failed).agg(*[F.percentile_approx(r, list(SPREAD), 20000) for r in per_row]).first()
    over = [scaled(r, *(q or (0.0, 0.0, 0.0))).alias(f"x{i}") for i, (r, q) in enumerate(zip(per_row, spread, strict=True))]
    names = [f"x{i}" for i in range(len(over))]

    sample = stats.where(~failed).orderBy(F.xxhash64(F.lit(3), F.col(key)), *COUNTS).limit(sample_rows).select(*over).toArrow()
    forest = Forest(_matrix(sample, names)) if len(sample) else None
    schema = T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(_matrix(batch, names)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: -len(names)], pa.array(score)], schema.names)

    scored = common.stored(stats.select("*", *over).mapInArrow(common.freed(run), schema), "scored")
    level = F.floor(F.col("anomaly") * BINS).cast("int")
    bins = scored.where(~failed).join(marks, F.col(key) == F.col("_key")).groupBy(level.alias("bin"), "_q").count()
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for b, q, n in bins.collect():
        (good if q == 1 else bad)[min(max(b, 0), BINS)] += n
    cut = threshold_of(good, bad)
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (level < round(cut * BINS)))


def _matrix(rows: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([np.asarray(rows.column(n).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(n).to_numpy()) for n in names], axis=1)
