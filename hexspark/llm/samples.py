"""Bounded labelled samples for fitting, drawn by hash without shuffling texts."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common


def labelled(
    docs: DataFrame, labels: DataFrame, target: str, rows: int, max_bytes: int, where: Column | None = None, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, float]:
    """At most `rows` texts and `max_bytes` bytes of each class (text, label, h, _key); and the share of label 1.

    Only labels of keys that docs has count, for the sample and for the share, so labels of other documents change nothing.
    Keys are taken in the order of a hash, so a rerun takes the same ones; a text that does not fit into the bytes left is
    passed over, the ones after it are not.  Null labels are left out, null texts count as empty; a key labelled twice
    counts once, with its smaller label; of a key on several rows one text counts.
    """
    once = labels.where(F.col(target).isNotNull() & F.col(key).isNotNull())
    if where is not None:
        once = once.where(where)
    once = once.groupBy(F.col(key).alias("_key")).agg(F.min(target).cast("int").alias("_label"))
    # Keys alone are read here; the side of the labels may be broadcast, which a semi join of labels with docs could not do.
    once = common.stored(docs.select(F.col(key).alias("_key")).join(once, "_key").distinct(), "labels")
    order = F.xxhash64(F.lit(5), F.col("_key"))
    # Only a hash range some times as wide as needed is ranked, so the ranking does not grow with the labels.
    seen = dict(once.groupBy("_label").count().collect())
    width = max([rows / max(1, seen.get(c, 0)) for c in (0, 1)], default=1.0)
    ranked = once.where(F.pmod(order, F.lit(1 << 30)) < int(2 * width * (1 << 30))) if width < 0.25 else once
    parts = [ranked.where(F.col("_label") == c).orderBy(order, "_key").limit(rows) for c in (0, 1)]
    ids = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * rows rows at most
    said = F.coalesce(F.col(text), F.lit("")).alias("_text")
    found = docs.select(F.col(key).alias("_of"), said).join(ids, F.col("_of") == F.col("_key"))
    found = found.groupBy("_key", F.col("_label").alias("label")).agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("text"))
    found = common.stored(found.select("text", "label", order.alias("h"), "_key"), "sample")
    # Sizes of 2 * rows texts at most decide on the driver which ones fit.
    taken, held = [], {0: 0, 1: 0}
    sizes = found.select("label", "h", "_key", F.octet_length("text").alias("n")).collect()
    for label, _, k, n in sorted(sizes, key=lambda r: (r[0], r[1], r[2])):
        if held[label] + n <= max_bytes:
            held[label] += n
            taken.append((k,))
    if len(taken) < len(sizes):
        fits = docs.sparkSession.createDataFrame(taken, T.StructType([T.StructField("_fits", found.schema["_key"].dataType)]))
        found = found.join(F.broadcast(fits), F.col("_key") == F.col("_fits"), "left_semi")
    return found, seen.get(1, 0) / max(1, seen.get(0, 0) + seen.get(1, 0))


def every_labelled(docs: DataFrame, labels: DataFrame, target: str, where: Column | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All labelled texts (_key, label, text) under the rules of labelled, without its limits."""
    once = labels.where(F.col(target).isNotNull() & F.col(key).isNotNull())
    if where is not None:
        once = once.where(where)
    once = once.groupBy(F.col(key).alias("_key")).agg(F.min(target).cast("int").alias("label"))
    found = docs.select(F.col(key).alias("_of"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(once, F.col("_of") == F.col("_key"))
    return found.groupBy("_key", "label").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("text"))


def fitted(sample: DataFrame, fit: Callable[[list[bytes], np.ndarray], object]) -> object:
    """fit(texts, labels) over a sample, in one task: the driver holds the model alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += [t.encode() for t in batch.column(0).to_pylist()]
            labels += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, np.array(labels, np.int64)))], pa.binary())], ["model"])

    ordered = sample.repartition(1).sortWithinPartitions("label", "h", "_key").select("text", "label")
    row = ordered.mapInArrow(common.freed(run), "model binary").first()
    return fit([], np.zeros(0, np.int64)) if row is None else pickle.loads(row[0])  # no row: an empty plan runs no task


def auc(scores, labels) -> float:
    """Area under the curve; ties count half."""
    scores, labels = np.asarray(scores), np.asarray(labels)
    order = np.argsort(scores, kind="stable")
    _, inverse, counts = np.unique(scores[order], return_inverse=True, return_counts=True)
    mean_rank = np.cumsum(counts) - (counts - 1) / 2
    ranks = np.empty(len(scores))
    ranks[order] = mean_rank[inverse]
    pos = labels == 1
    n, m = pos.sum(), (~pos).sum()
    return float((ranks[pos].sum() - n * (n + 1) / 2) / max(1, n * m))


def logistic(x, y, l2: float = 1e-3, rounds: int = 50):
    """Weights (last: intercept) of a logistic fit by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = l2 * len(x) * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
