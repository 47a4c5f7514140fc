"""Quality by compression: dictionaries of good and bad text, and the difference they make.

Two zstandard dictionaries are trained on bounded samples of good and bad labelled texts.  Each whole
text is compressed with either, piece by piece, so that a dictionary counts to the end of a long text and
not only until the text has taught the compressor itself.  The difference of the two sizes, over the
length, is the quality of the text; a logistic curve of it, fitted on differences made by dictionaries
that had not seen the text, makes it the chance that the text is good.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common, samples

LEVEL = 3
DICTIONARY_BYTES = 32 << 10
#: Bytes of a text for the dictionary trainer, bytes of all texts it is given at most (a bound of the fit, evenly over the
#: sample: it needs fifty times what it reads), and bytes compressed at a time.
CHUNK, TRAINER_BYTES, PIECE = 4096, 4 << 20, 1024
#: Bytes added to a text's length, so that a few bytes make no extreme difference.
LEAST_BYTES = 256
#: The fitting sample: at most so many texts and bytes of each class.
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 24 << 20
#: The sample is cut into so many parts; the differences of each are made by dictionaries of the others.
PARTS = 2
#: A score from here on predicts label 1.
DECISION = 0.3


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES, trainer_bytes: int = TRAINER_BYTES) -> bytes:
    """A trained dictionary as bytes, from `trainer_bytes` of the texts, every nth piece of them; raw content where there is too little text to train on."""
    chunks = [t[i : i + CHUNK] for t in texts for i in range(0, len(t), CHUNK)]
    step = max(1, -(-sum(map(len, chunks)) // trainer_bytes))
    chunks = chunks[::step]
    total = sum(map(len, chunks))
    if len(chunks) >= 16 and total >= 16 * 1024:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 8)), chunks).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(chunks)[-size:]


class Difference:
    """The normalised compressed-size difference of a text under a good and a bad dictionary; positive is good."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL) -> None:
        bare = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by = []
        for d in (good, bad):
            made = zstandard.ZstdCompressionDict(d) if len(d) >= 8 else None
            if made is not None:
                made.precompute_compress(level=level)
            self.by.append(zstandard.ZstdCompressor(dict_data=made, **bare) if made is not None else zstandard.ZstdCompressor(**bare))

    def of(self, text: bytes) -> float:
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.by)
        return (bad - good) / (len(text) + LEAST_BYTES)

    def of_all(self, col: pa.Array) -> np.ndarray:
        """Of each text of a column; null counts as empty, which has none."""
        raw, at = common.utf8_of(col)
        return np.array([self.of(raw[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)])


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float

    def scores(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.shift, -40, 40)))


def _dictionaries(texts: list[bytes], labels: np.ndarray, use: np.ndarray) -> tuple[bytes, bytes]:
    good, bad = (dictionary([texts[i] for i in np.flatnonzero(use & (labels == c))]) for c in (1, 0))
    return good, bad


def fit(texts: list[bytes], labels: np.ndarray, prior: float | None = None) -> Model:
    """Dictionaries of all texts, and the curve from differences by dictionaries of the parts a text is not in.

    prior: the share of good texts outside the sample, if the classes were not drawn alike.
    """
    every = np.ones(len(texts), bool)
    if len(set(labels.tolist())) < 2:  # one class or none: predict it, or good
        return Model(*_dictionaries(texts, labels, every), 0.0, 8.0 if not len(labels) or labels[0] == 1 else -8.0)
    part = np.empty(len(texts), int)
    for c in (0, 1):  # each class is spread over the parts
        own = np.flatnonzero(labels == c)
        part[own] = np.arange(len(own)) % PARTS
    x = np.empty(len(texts))
    for k in range(PARTS):
        by = Difference(*_dictionaries(texts, labels, part != k))
        for i in np.flatnonzero(part == k):
            x[i] = by.of(texts[i])
    unit = float(x.std()) or 1.0
    slope, shift = samples.logistic(x[:, None] / unit, labels, 1e-4)
    slope = max(0.0, slope)  # a higher difference is never worse
    if prior is not None and 0 < prior < 1:
        own = labels.mean()
        shift += np.log(prior / (1 - prior)) - np.log(own / (1 - own))
    return Model(*_dictionaries(texts, labels, every), float(slope / unit), float(shift))


def trained(docs: DataFrame, labels: DataFrame, train: Column | None, key: str, text: str, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """The model of the labels that `train` admits."""
    sample, prior = samples.labelled(docs, labels, "quality", rows, max_bytes, train, key, text)
    return samples.fitted(sample, partial(fit, prior=prior))


def classify(
    docs: DataFrame, labels: DataFrame, train: Column | None = None, key: str = "doc_id", text: str = "text",
    rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES, keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Columns `keep` (the key, if None) and score, 0 to 1, of every row of docs; higher: label 1 likelier.

    Learns from the labels that `train` (a condition on the labels' key) admits, at most `rows` texts
    and `max_bytes` bytes of each class.  Null texts count as empty and get a score; without labels all
    rows count as good.  A column named score is replaced.
    """
    model = trained(docs, labels, train, key, text, rows, max_bytes)
    names = [c for c in (keep or (key,)) if c != "score"]
    chosen = docs.select(*names, F.col(text).alias("_text"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Difference(model.good, model.bad)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.scores(by.of_all(batch.column(batch.num_columns - 1))))], schema.names)

    return chosen.mapInArrow(common.freed(run), schema)


def kept(docs: DataFrame, labels: DataFrame, train: Column | None = None, key: str = "doc_id", text: str = "text", decision: float = DECISION) -> DataFrame:
    """docs without the rows that score under `decision`; columns are unchanged and no row moves."""
    model = trained(docs, labels, train, key, text)
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Difference(model.good, model.bad)
        for batch in batches:
            yield batch.filter(pa.array(model.scores(by.of_all(batch.column(place))) >= decision))

    return docs.mapInArrow(common.freed(run), docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return common.fold(key, 5) == 0
