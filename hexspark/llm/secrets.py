"""Secret scanning: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary made from ordinary text spends few tokens on words and many on random strings.
Runs of 16 or more base64-like characters whose characters per token stay under a threshold are
reported as random, unless they are digests of a known length, UUIDs, numbers, or identifiers (words
joined by case, hyphens or underscores, which the vocabulary itself spends few tokens on).  A run that
lies within a span of a fixed pattern is not reported again; one that reaches beyond it is.

Only words of 12 bytes or more can hold a match of the fixed patterns, so each batch is scanned for
these with numpy and the regular expressions see little of the text; results are the same as on whole
texts, as no pattern but `assign` can cross white space, and that one runs on whole texts.
"""

from __future__ import annotations

import base64
import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common

# Fixed by the task.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")

RANDOM_LEAST = 16
#: Characters a token: words of the vocabulary's languages have 2.5 to 5, invented ones over 2, random strings under 2.
EFFICIENCY = 1.9
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
_NO_END = float("inf")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]{1,4}")
#: The split that byte-level vocabularies of this kind are made with.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


def known(run: str) -> bool:
    """Whether a run is a digest, a UUID or a number."""
    return run.isdigit() or bool(_UUID.fullmatch(run)) or (bool(_HEX_ONLY.fullmatch(run)) and len(run) in DIGESTS)


@lru_cache(maxsize=2)
def _encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})


def efficiency(run: str, ranks: bytes) -> float:
    """Characters per token of a run under the vocabulary."""
    return len(run) / max(1, len(_encoder(ranks).encode_ordinary(run)))


def identifier(run: str, ranks: bytes) -> bool:
    """Whether the letters of a run, without marks and one short number at most, are words to the vocabulary."""
    parts = _WORDS.findall(run)
    letters = [p for p in parts if p[0].isalpha()]
    if not letters or len(parts) - len(letters) > 1:
        return False
    encode = _encoder(ranks).encode_ordinary
    return sum(map(len, letters)) >= EFFICIENCY * sum(len(encode(p)) for p in letters)


def find(text: str, ranks: bytes, words: list[tuple[int, str]], threshold: float = EFFICIENCY) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of one text in code points, by start, then kind.

    words: start and string of at least all its words of 12 characters or more.
    """
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    for at, word in words:
        if len(word) >= ACCESS_LEAST and "AKIA" in word:
            found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(word) if len(m[0]) >= ACCESS_LEAST]
        if len(word) >= HEX_LEAST:
            found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(word) if len(m[0]) >= HEX_LEAST]
    # Base spans by start with the furthest end so far: one search tells whether a run lies within any of them.
    base = sorted((a, b) for _, a, b in found)
    furthest = list(accumulate((b for _, b in base), max))
    for at, word in words:
        if len(word) < RANDOM_LEAST:
            continue
        for m in _RUN.finditer(word):
            s, e = at + m.start(), at + m.end()
            run = m[0]
            before = bisect_right(base, (s, _NO_END))
            if known(run) or before and furthest[before - 1] >= e:
                continue
            if efficiency(run, ranks) < threshold and not identifier(run, ranks):
                found.append(("random", s, e))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _long_words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, start and end byte (in the text) of each word of 12 bytes or more."""
    starts, ends, _ = common.word_bounds(raw, at)
    long = ends - starts >= 12
    starts, ends = starts[long], ends[long]
    doc = np.searchsorted(at, starts, "right") - 1
    return doc, starts - at[doc], ends - at[doc]


def scan_batch(col: pa.Array, ranks: bytes, threshold: float) -> Iterator[tuple[str, list]]:
    """Each text of a column with its spans."""
    raw, at = common.utf8_of(col)
    marks = np.zeros(256, bool)
    marks[[0x3D, 0x3A]] = True
    for lo, hi in common.pieces(at):
        part = raw[at[lo] : at[hi]]
        bounds = at[lo : hi + 1] - at[lo]
        doc, s, e = _long_words(part, bounds)
        first = np.searchsorted(doc, np.arange(hi - lo + 1))
        marked = common.sums_by(marks[part], bounds)
        worth = np.zeros(hi - lo, bool)
        long = e - s >= HEX_LEAST
        np.logical_or.at(worth, doc[long], True)
        worth |= marked > 0
        for i in range(hi - lo):
            if not worth[i]:
                yield "", []
                continue
            data = part[bounds[i] : bounds[i + 1]].tobytes()
            text = data.decode()
            a, b = first[i], first[i + 1]
            if len(text) == len(data):
                words = [(int(s[j]), text[s[j] : e[j]]) for j in range(a, b)]
            else:
                words, pos, seen = [], 0, 0
                for j in range(a, b):
                    seen += len(data[pos : s[j]].decode())
                    word = data[s[j] : e[j]].decode()
                    words.append((seen, word))
                    seen += len(word)
                    pos = int(e[j])
            yield text, find(text, ranks, words, threshold)


def _ranks(path: str) -> bytes:
    """The vocabulary, a file of fixed size that the driver reads and sends along; it raises where there is none."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary at {path}; give its place as ranks_path")
    with open(path, "rb") as f:
        return f.read()


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str = RANKS_PATH, threshold: float = EFFICIENCY) -> DataFrame:
    """key and spans (kind, start, end; code points, end exclusive) of every row, also of rows without any.

    A null text counts as empty and has no spans.  Repeated rows, null keys and other columns pass; only
    the two columns named are read.
    """
    ranks = _ranks(ranks_path)
    kind = docs.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for _, x in scan_batch(batch.column(1), ranks, threshold)]
            as_arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, as_arrow)], [key, "spans"])

    return docs.select(key, text).mapInArrow(common.freed(run), T.StructType([T.StructField(key, kind), T.StructField("spans", SPANS)]))


def _cut(text: str, spans: list, mark: Callable[[str], str]) -> str:
    out, pos = [], 0
    for kind, s, e in spans:
        if s >= pos:
            out += [text[pos:s], mark(kind)]
        pos = max(pos, e)
    return "".join([*out, text[pos:]])


def redact(docs: DataFrame, text: str = "text", ranks_path: str = RANKS_PATH, threshold: float = EFFICIENCY) -> DataFrame:
    """docs with every span replaced by ``[kind]``; spans that overlap go whole
    and become one mark, that of the first.

    All columns and rows stay; a null text stays null.
    """
    ranks = _ranks(ranks_path)
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(at)
            old = col.to_pylist()
            new = [_cut(x, spans, "[{}]".format) if spans else y for y, (x, spans) in zip(old, scan_batch(col, ranks, threshold), strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, col.type))

    return docs.mapInArrow(common.freed(run), docs.schema)
