"""Shared pieces of the text operators: scratch tables, folds and vectorised word hashing.

Words are maximal runs of bytes other than space and \\x09-\\x0D.  Inside Python workers a batch of
texts is handled as one UTF-8 buffer: word boundaries, 64-bit word hashes and per-text sums are numpy
operations over pieces of a few megabytes, so memory does not depend on the batch or the partition.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed by the task: what separates words, as a regular expression class.
WORD = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 1 << 20
#: Bytes hashed at a time, which stay in the cache.
HASH_BYTES = 1 << 18

_own_dir: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Where it is unset, a local session gets one of its own, which goes
    when the driver ends; a cluster has no such folder to guess, so that raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="hexspark-"))
            atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
        base = "file://" + _own_dir[0]
    return f"{base.rstrip('/')}/hexspark"


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, each with underscores before it until no taken one is like it."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, tag: str, *marks: Column) -> tuple[DataFrame, tuple]:
    """stored, and aggregates over the rows, observed while they are written."""
    seen, spark, path = Observation(), df.sparkSession, new_path(df.sparkSession, tag)
    df.observe(seen, *(m.alias(f"m{i}") for i, m in enumerate(marks))).write.parquet(path)
    got = seen.get
    return spark.read.schema(df.schema).parquet(path), tuple(got.get(f"m{i}") for i in range(len(marks)))


class Scratch:
    """Tables of an operator in the shared folder that go one by one, when nothing reads them any more.

    Shuffle files of a write go when it ends: else they stay until the driver happens to collect its garbage.
    """

    #: Of Spark 4.1 on; before, the files stay as they do by default.
    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    _lock, _writing, _before = threading.Lock(), 0, "false"

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, tuple[str, ...]]] = {}

    def _write(self, df: DataFrame, path: str, packed: bool) -> DataFrame:
        # The setting is the session's, so of writes at the same time the first sets it and the last puts it back.
        conf, kind = self.spark.conf, Scratch
        with kind._lock:
            if not kind._writing:
                kind._before = conf.get(self.CLEANUP, "false")
                conf.set(self.CLEANUP, "true")
            kind._writing += 1
        try:
            (df.write.option("compression", "zstd") if packed else df.write).parquet(path)
        finally:
            with kind._lock:
                kind._writing -= 1
                if not kind._writing:
                    conf.set(self.CLEANUP, kind._before)
        return self._read(df, path)

    def _read(self, df: DataFrame, *paths: str) -> DataFrame:
        out = self.spark.read.schema(df.schema).parquet(*paths)
        self.paths[id(out)] = (out, paths)
        return out

    def stored(self, df: DataFrame, tag: str, packed: bool = False) -> DataFrame:
        """Write df and read it back, as common.stored; packed: smaller files, for texts."""
        return self._write(df, new_path(self.spark, tag), packed)

    def joined(self, tables: list[DataFrame]) -> DataFrame:
        """One table of the files of several tables of one schema, in place of them."""
        return self._read(tables[0], *(p for t in tables for p in self.paths.pop(id(t))[1]))

    def observed(self, df: DataFrame, tag: str, *marks: Column, packed: bool = False) -> tuple[DataFrame, tuple]:
        """stored, and aggregates over the rows, observed while they are written."""
        seen = Observation()
        out = self.stored(df.observe(seen, *(m.alias(f"m{i}") for i, m in enumerate(marks))), tag, packed)
        got = seen.get
        return out, tuple(got.get(f"m{i}") for i in range(len(marks)))

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of tables written here, which nothing reads from now on."""
        for t in tables:
            for path in self.paths.pop(id(t))[1]:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def placed(scratch: Scratch, rows: DataFrame, group: str, order: list[Column], tag: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows with _nth and _run, and the runs (group, _run, _before, _total): the place in the group from 0 is
    _nth + _before, of _total.

    The rows are sorted over ranges, so a group of any size spreads over many tasks.  A run is the part of a group in one
    range; a join on group and _run, which no group can fill alone, places the rows.  The group must not be null, and the
    columns have none of these four names.  Rows equal in `order` lie in one range, so the order should tell them apart.
    """
    sorted_ = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    kept = scratch.stored(sorted_.withColumn("_nth", F.monotonically_increasing_id()).withColumn("_run", F.shiftright("_nth", 33)), tag)
    by = Window.partitionBy(group)
    runs = kept.groupBy(group, "_run").agg(F.count("*").alias("_n"), F.min("_nth").alias("_first"))
    upto = F.sum("_n").over(by.orderBy("_run").rowsBetween(Window.unboundedPreceding, 0))
    return kept, scratch.stored(runs.select(group, "_run", (upto - F.col("_n") - F.col("_first")).alias("_before"), F.sum("_n").over(by).alias("_total")), f"{tag}-runs")


Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freed(run: Batches) -> Batches:
    """run, which gives its freed memory back to the system when a task ends: workers live on and would keep it."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (a null key counts as the empty text)."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % n


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, with built-in functions only; text must not be null."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sep = np.zeros(256, bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    code = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lower = code.copy()
    lower[65:91] = code[97:123]
    return sep, code, lower


SEP, _CODE, _CODE_LOWER = _tables()
_BASE = 0x9E3779B97F4A7C15 | 5


class _Places:
    """An odd number for each place in a word, extended as longer words come."""

    def __init__(self) -> None:
        self.by = np.zeros(0, np.uint64)

    def of(self, n: int) -> np.ndarray:
        if len(self.by) < n:
            size = 1 << max(12, (n - 1).bit_length())
            self.by = mix64(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
        return self.by


_places = _Places()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of each text in them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = col.buffers()
    at = np.frombuffer(bounds, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `most` bytes together; a longer text stands alone."""
    lo = 0
    n = len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + most, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (one more at the end)."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    inside = np.empty(len(raw) + 1, bool)
    inside[0] = False
    np.logical_not(SEP[raw], out=inside[1:])
    cut = np.zeros(len(raw) + 1, bool)
    cut[at[at < len(raw)]] = True
    body = inside[1:]
    starts = np.flatnonzero(body & (~inside[:-1] | cut[:-1]))
    following = np.empty(len(raw), bool)
    following[:-1] = ~body[1:] | cut[1:-1]
    following[-1] = True
    ends = np.flatnonzero(body & following) + 1
    return starts, ends, np.searchsorted(starts, at)


_PUNCT = np.zeros(256, bool)
_PUNCT[list(range(0x21, 0x30)) + list(range(0x3A, 0x41)) + list(range(0x5B, 0x61)) + list(range(0x7B, 0x7F))] = True


def bare_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word_bounds without the ASCII punctuation around words; one of punctuation alone is an empty range."""
    starts, ends, first = word_bounds(raw, at)
    for edge, step, inner in ((ends, -1, -1), (starts, 1, 0)):
        open_ = np.arange(len(starts))
        while len(open_):
            open_ = open_[ends[open_] > starts[open_]]
            open_ = open_[_PUNCT[raw[edge[open_] + inner]]]
            edge[open_] += step
    return starts, ends, first


def hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range, which follow each other; with lower, A-Z count as a-z.

    The sum over bytes of the byte's number times the place's, both odd and without a pattern, so that no structure of a
    word makes it collide with another.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    code = _CODE_LOWER if lower else _CODE
    lo = 0
    while lo < len(starts):  # by ranges of bytes, as a text may be very long
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + HASH_BYTES, "right")))
        first, last = int(starts[lo]), int(ends[hi - 1])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        n = last - first
        place = np.arange(n, dtype=np.int32)
        place -= np.repeat(s.astype(np.int32), np.diff(np.append(s, n)))
        values = np.take(code, raw[first:last])
        values *= np.take(_places.of(int(place.max(initial=0)) + 1), place)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(values, out=total[1:])
        out[lo:hi] = mix64(total[e] - total[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def hashed_words(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the index of each text's first word."""
    starts, ends, first = word_bounds(raw, at)
    return hashed(raw, starts, ends, lower), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows of each text; a text of fewer words gives its whole sequence as one.

    Returns the hashes and the index of each text's first one.  A text without words gives none.
    """
    count = np.diff(first)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    if not len(words):
        return np.zeros(0, np.uint64), bounds
    padded = np.concatenate([words, np.zeros(n - 1, np.uint64)])
    acc = np.full(len(words), n, np.uint64)
    for i in range(n):
        acc = acc * np.uint64(_BASE) + padded[i : i + len(words)]
    out = np.empty(bounds[-1], np.uint64)
    doc = np.repeat(np.arange(len(count)), per)
    out = acc[first[doc] + (np.arange(bounds[-1]) - bounds[doc])]
    for d in np.flatnonzero((count > 0) & (count < n)):
        x = np.uint64(count[d])
        for w in words[first[d] : first[d + 1]]:
            x = np.uint64((int(x) * _BASE + int(w)) & (2**64 - 1))
        out[bounds[d]] = x
    return mix64(out), bounds


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each range of values given by consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
