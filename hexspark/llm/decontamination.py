"""Benchmark decontamination by SimHash windows, Hamming blocks and weighted shingles.

Every benchmark item has a 64-bit SimHash of its weighted five-word shingles; a shingle weighs as many as
its words have bytes, so weights need no table of counts.  In a document, windows of the sizes of the
items get fingerprints too.  A window can only reach the similarity asked for if the shingles it shares
with items of its size weigh that share of the lightest of them; every such window is fingerprinted.
Items of the window's size are looked up by blocks of the fingerprint: within the radius, some block
differs in few bits, and all values that near are looked up, so no item within the radius is missed.  Its
weighted Jaccard similarity to the window is then computed exactly.

An item of fewer than five words is one shingle: it is found where a document has these words in a row.

Items are sent to executors in blocks of bounded number; documents are never shuffled.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hexspark.llm import common

N, SIMILARITY = 5, 0.8
#: Fingerprints at similarity 0.8 differ in ten bits on average, with a deviation of three.  None: every
#: item of a window's size is compared, whatever its fingerprint.
RADIUS = 19
#: Blocks of a fingerprint: one of them differs in RADIUS // BLOCKS bits at most.
BLOCKS = 5
ITEMS_A_BLOCK = 20_000
_FILTER_BITS = 22

Words = tuple[np.ndarray, np.ndarray, np.ndarray]
Match = tuple[float, int, int]


def _words(raw: np.ndarray, at: np.ndarray) -> Words:
    """Hash and bytes of every word without the punctuation around it, and each text's first word."""
    starts, ends, first = common.bare_bounds(raw, at)
    return common.hashed(raw, starts, ends), ends - starts, first


def _weights(length: np.ndarray, n: int) -> np.ndarray:
    """Bytes, and one for each word, of the n words from each place on."""
    total = np.concatenate([[0], np.cumsum(length + 1)])
    return total[n:] - total[:-n]


def simhash(shingles: np.ndarray, weights: np.ndarray) -> int:
    """64 bits: each the sign of the weighted sum of the shingles' bits as +1 or -1."""
    bits = np.unpackbits(common.mix64(shingles ^ np.uint64(0x1B873593CC9E2D51)).view(np.uint8).reshape(-1, 8), axis=1)
    up = weights @ (bits * 2.0 - 1.0) > 0
    return int(np.packbits(up).view(np.uint64)[0])


def block_values(fingerprint: int) -> list[int]:
    """The fingerprint cut into blocks."""
    cuts = np.linspace(0, 64, BLOCKS + 1).astype(int).tolist()
    return [(fingerprint >> a) & ((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def near_masks(bits: int) -> list[np.ndarray]:
    """For each block, all differences of at most so many bits."""
    cuts = np.linspace(0, 64, BLOCKS + 1).astype(int).tolist()
    return [
        np.array([sum(1 << i for i in chosen) for k in range(bits + 1) for chosen in combinations(range(b - a), k)], np.int64)
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]


class Index:
    """Benchmark items: their shingles and weights, and by size their fingerprints' blocks."""

    def __init__(self, ids: list, texts: list[str], n: int = N, similarity: float = SIMILARITY, radius: int | None = RADIUS) -> None:
        self.n, self.radius, self.least, self.ids = n, radius, similarity, ids
        words, length, first = _words(*common.utf8_of(pa.array(texts, pa.string())))
        size = np.diff(first)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(dict)  # words, shingle -> items
        self.sets: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}  # item -> shingles in order, weights, their sum
        self.prints: dict[int, int] = {}
        self.of_size: dict[int, list[int]] = defaultdict(list)
        self.need: dict[int, float] = {}
        sizes_of: dict[int, set[int]] = defaultdict(set)
        codes, owners = [], []
        for i in range(len(ids)):
            own, own_length, m = words[first[i] : first[i + 1]], length[first[i] : first[i + 1]], int(size[i])
            if not m:
                continue
            if m < n:
                self.short[m].setdefault(int(common.shingle_hashes(own, np.array([0, m]), m)[0][0]), []).append(i)
                continue
            h, spot = np.unique(common.shingle_hashes(own, np.array([0, m]), n)[0], return_index=True)
            w = _weights(own_length, n)[spot]
            self.sets[i] = h, w, int(w.sum())
            self.prints[i] = simhash(h, w)
            self.of_size[m].append(i)
            self.need[m] = min(self.need.get(m, np.inf), similarity * self.sets[i][2])
            for x in h.tolist():
                sizes_of[x].add(m)
            for b, value in enumerate(block_values(self.prints[i])):
                codes.append(self._code(m, b, value))
                owners.append(i)
        order = np.argsort(np.array(codes, np.int64), kind="stable")
        self.codes, self.owners = np.array(codes, np.int64)[order], np.array(owners, np.int64)[order]
        self.masks = near_masks(0 if radius is None else radius // BLOCKS)
        self.known = np.array(sorted(sizes_of), np.uint64)
        counts = [len(sizes_of[x]) for x in self.known.tolist()]
        self.size_bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.sizes = np.array([m for x in self.known.tolist() for m in sorted(sizes_of[x])], np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.known & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True

    @staticmethod
    def _code(size: int, block: int, value):
        return ((size * BLOCKS + block) << 13) + value

    def near(self, size: int, mark: int, seen: Counter) -> list[int]:
        """Items of a size whose fingerprint lies within the radius."""
        if self.radius is None:
            return self.of_size[size]
        found: set[int] = set()
        for b, value in enumerate(block_values(mark)):
            probes = self._code(size, b, value ^ self.masks[b])
            lo, hi = np.searchsorted(self.codes, probes), np.searchsorted(self.codes, probes, "right")
            for a, z in zip(lo[lo < hi].tolist(), hi[lo < hi].tolist(), strict=True):
                found.update(self.owners[a:z].tolist())
        seen["in a block"] += len(found)
        return sorted(i for i in found if (self.prints[i] ^ mark).bit_count() <= self.radius)

    def similarity(self, item: int, shingles: np.ndarray, weights: np.ndarray) -> float:
        """Weighted Jaccard of an item's shingles and others, distinct and in order."""
        own, _, total = self.sets[item]
        at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
        shared = int(weights[own[at] == shingles].sum())
        return shared / (total + int(weights.sum()) - shared)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h of shingles that items have, and which ones they are."""
        if not len(self.known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spot = np.flatnonzero(self.filter[(h & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[spot]), len(self.known) - 1)
        ok = self.known[at] == h[spot]
        return spot[ok], at[ok]

    def windows(self, h: np.ndarray, weight: np.ndarray, places: np.ndarray, which: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """size, first and last shingle (exclusive) of each window heavy enough in shingles of items of its size."""
        count = self.size_bounds[which + 1] - self.size_bounds[which]
        row = np.repeat(np.arange(len(places)), count)
        size = self.sizes[np.repeat(self.size_bounds[which] - (np.cumsum(count) - count), count) + np.arange(len(row))]
        for m in np.unique(size).tolist():
            p = places[row[size == m]]
            total = np.concatenate([[0], np.cumsum(weight[p])])
            span = m - self.n + 1
            if len(h) <= span:
                starts = np.zeros(1, np.int64)
            else:
                step = np.zeros(len(h) + 1, np.int64)
                np.add.at(step, np.maximum(p - span + 1, 0), 1)
                np.add.at(step, p + 1, -1)
                starts = np.flatnonzero(np.cumsum(step)[: len(h) - span + 1])
            heavy = total[np.searchsorted(p, starts + span)] - total[np.searchsorted(p, starts)]
            for s in starts[heavy >= self.need[m]].tolist():
                yield m, s, min(len(h), s + span)

    def matches(self, h: np.ndarray, weight: np.ndarray, places: np.ndarray, which: np.ndarray, seen: Counter) -> dict[int, Match]:
        """Items found in one document: item -> best similarity, start and end word; of windows as good the first."""
        found: dict[int, Match] = {}
        for m, s, e in self.windows(h, weight, places, which):
            own, spot = np.unique(h[s:e], return_index=True)
            w = weight[s:e][spot]
            near = self.near(m, simhash(own, w), seen)
            seen["windows"] += 1
            seen["compared"] += len(near)
            for item in near:
                x = self.similarity(item, own, w)
                if x >= self.least and (item not in found or (-x, s) < (-found[item][0], found[item][1])):
                    found[item] = (x, s, e + self.n - 1)
        return found

    def search(self, col: pa.Array, seen: Counter | None = None) -> Iterator[tuple[int, dict[int, Match]]]:
        """Row number and matches of each text of a column that has any; seen counts windows and comparisons."""
        seen = Counter() if seen is None else seen
        raw, at = common.utf8_of(col)
        for lo, hi in common.pieces(at):
            words, length, first = _words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            out: dict[int, dict[int, Match]] = defaultdict(dict)
            for m, items in self.short.items():
                h, bounds = common.shingle_hashes(words, first, m)
                spot = np.flatnonzero(np.isin(h, np.array(list(items), np.uint64)))
                doc = np.searchsorted(bounds, spot, "right") - 1
                for d, p in zip(doc.tolist(), spot.tolist(), strict=True):
                    if first[d + 1] - first[d] >= m:
                        for item in items[int(h[p])]:
                            out[d].setdefault(item, (1.0, int(p - bounds[d]), int(p - bounds[d]) + m))
            h, bounds = common.shingle_hashes(words, first, self.n)
            places, which = self.hits(h)
            doc = np.searchsorted(bounds, places, "right") - 1
            for d in np.unique(doc).tolist():
                if first[d + 1] - first[d] >= self.n:
                    a, mine = bounds[d], doc == d
                    weight = _weights(length[first[d] : first[d + 1]], self.n)
                    out[d].update(self.matches(h[a : bounds[d + 1]], weight, places[mine] - a, which[mine], seen))
            yield from ((lo + d, found) for d, found in sorted(out.items()) if found)


def _indexes(benchmark: DataFrame, per_block: int, make: Callable[[list, list], Index]) -> Iterator[Index]:
    """Indexes over blocks of the items, by hash; a block is all that the driver holds."""
    items = benchmark.select("item_id", "text").where("text is not null")
    n_blocks = max(1, -(-items.count() // per_block))
    for b in range(n_blocks):
        part = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        rows = sorted(part.collect(), key=lambda r: (r[0] is not None, r[0], r[1]))
        yield make([r[0] for r in rows], [r[1] for r in rows])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    n: int = N, similarity: float = SIMILARITY, radius: int | None = RADIUS, per_block: int = ITEMS_A_BLOCK,
) -> DataFrame:
    """key, item_id, similarity, start_word, end_word: each item found in a row, by its best window.

    Words are compared without case and surrounding punctuation.  Items without words are in nothing, as
    are null and empty texts; an item of fewer than n words is found where its words stand in a row.  An
    item given twice is found twice; repeated rows of docs are each reported.  Similar windows beyond the
    radius are missed, of those at the similarity itself about one in a thousand; radius None misses none.  Of windows as
    good the first counts; texts of any length are searched whole; no rows or no items give none.  Other columns are not read,
    whatever their names; a key named as one of the other results raises.
    """
    if key.lower() in ("item_id", "similarity", "start_word", "end_word"):
        raise ValueError(f"the key {key} has the name of another result")
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("item_id", benchmark.schema["item_id"].dataType),
        T.StructField("similarity", T.DoubleType()), T.StructField("start_word", T.LongType()), T.StructField("end_word", T.LongType()),
    ])
    kinds = [to_arrow_type(schema["item_id"].dataType), pa.float64(), pa.int64(), pa.int64()]
    parts = []
    several = benchmark.count() > per_block
    for index in _indexes(benchmark, per_block, lambda ids, texts: Index(ids, texts, n, similarity, radius)):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, sent.value.ids[item], *m) for i, found in sent.value.search(batch.column(1)) for item, m in sorted(found.items())]
                at, *cols = zip(*rows, strict=True) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], schema.names)

        part = docs.select(key, text).mapInArrow(common.freed(run), schema)
        if several:  # one index at a time on the executors
            part = common.stored(part, "found")
            sent.destroy()
        parts.append(part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N, similarity: float = SIMILARITY, radius: int | None = RADIUS, per_block: int = ITEMS_A_BLOCK
) -> DataFrame:
    """docs without the rows that hold an item; columns are unchanged.

    With one block of items no row moves.  With more, rows are numbered and written once, and the numbers of
    those found in any block are taken out.
    """
    if benchmark.count() > per_block:
        (row,) = common.free_names(docs.columns, "row")
        rows = common.stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        gone = contaminated(rows, benchmark, row, text, n, similarity, radius, per_block).select(row).distinct()
        return rows.join(gone, row, "left_anti").select(*docs.columns)
    at = docs.columns.index(text)
    (index,) = _indexes(benchmark, per_block, lambda ids, texts: Index(ids, texts, n, similarity, radius))
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[i for i, _ in sent.value.search(batch.column(at))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(common.freed(run), docs.schema)
