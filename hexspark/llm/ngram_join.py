"""Exact Jaccard self-join on word n-grams with signature trees.

Equal sets are one class from the start.  For two sets of similarity t or more the symmetric difference
has at most d elements, d following from t and the sizes; so if both sets are dealt by hash into
K = d + 1 + e parts, at least e + 1 parts are equal.  Every set therefore emits a key per non-empty part
(shingles found in very many documents left aside, which leaves the bound intact), and a set with more
than e empty parts emits further keys, so that each linked pair shares a key.  Keys are sorted over
ranges of key and set, so that no key lies in one task alone, and sets that share one are clusters.  Many
keys are made in several passes over the texts and shuffled list by list, a list holding the keys of one
range, and scratch tables go when they have been read, so that the disk holds a copy of the texts, the
keys of one pass and the shuffle of one list at most.

Clusters are packed together into blocks, and over each block a signature tree does the join: leaves hold
token bitmaps, inner nodes the OR of their children's bitmaps and their range of sizes, and a dual
traversal drops node pairs whose greatest possible overlap is too small.  Pairs that remain are verified
on the sets themselves; links go into connected components and are counted for each set, the rows of its
class as its weight.  Where no counts are asked for, pairs connected already are passed over.

Clusters above a block of shingles are cut into blocks by size and joined block by block and between
blocks, so no task holds more than about two blocks.  Nothing is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexspark.llm import common
from hexspark.llm.components import components

#: Shingles in one block of a cluster; a task holds one block, or two when joining across.
BLOCK_SHINGLES = 1_500_000
#: Smaller clusters are packed into blocks of about so many shingles, a tree for each.
PACK_SHINGLES = 100_000
#: Lists a set's keys are dealt into, by their first bits; so many keys in all are shuffled at once, or one list.
KEY_BITS, KEYS_AT_ONCE = 3, 8_000_000
#: Bytes of text whose keys are written at once; of more, the lists are made in up to so many passes over the texts, as
#: all keys together take more disk than the texts.
TEXT_AT_ONCE, MOST_PASSES = 128_000_000, 4
#: A table of two or three numbers a row is broadcast up to so many rows; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: A shingle found so often among the shingles of a piece is a candidate for the very common, which are
#: those of the greatest total; the number of them is bounded as they are broadcast.
COMMON_PIECE, COMMON_IN_PIECE, COMMON_LEAST, COMMON_MOST = 4_000_000, 3, 32, 400_000
BAND = 1.5
BITS = 2048
LEAF, FAN = 8, 8
#: Pairs of nodes opened at a time; links found in one step spare the next ones the pairs they connect.
NODE_PAIRS = 128
#: Pairs of sets verified at a time when links are counted.
SET_PAIRS = 1 << 16


@dataclass(frozen=True)
class Likeness:
    """n-word shingles, and the least Jaccard similarity as num / den."""

    n: int = 5
    num: int = 80
    den: int = 100

    def bands(self, most: int) -> list[tuple[int, int]]:
        """[low, high) size ranges up to a size; sizes in a range differ by half at most, or by one."""
        out, low = [], 1
        while low <= most:
            high = max(low + 1, int(low * BAND))
            out.append((low, high))
            low = high
        return out

    def parts(self, low: int, high: int) -> tuple[int, int]:
        """Parts K and spare e for pairs whose smaller set has a size in [low, high); K = 0: only equal sets link."""
        small = high - 1
        d = (self.den - self.num) * (small + small * self.den // self.num) // (self.den + self.num)
        if d == 0:
            return 0, 0
        e = 2
        for _ in range(8):
            empty = (d + 1 + e) * np.exp(-low / (d + 1 + e))
            e = max(e, int(np.ceil(empty + 4 * np.sqrt(empty))))
        return d + 1 + e, e


def _salt(band: int, kind: int) -> np.uint64:
    return np.uint64((band * 0x9E3779B97F4A7C15 + kind * 0xD6E8FEB86659FD93) & (2**64 - 1))


def distinct_sets(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in a row, and the bounds of each text's."""
    words, first = common.hashed_words(raw, at)
    h, bounds = common.shingle_hashes(words, first, n)
    keep = np.ones(len(h), bool)
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a > 1:
            h[a:b].sort()
    keep[1:] = h[1:] != h[:-1]
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    return h[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def set_ids(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit identifier of each set: equal for equal sets."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(common.mix64(h ^ np.uint64(0x5851F42D4C957F2D)))])
    return common.mix64(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def keys_of(h: np.ndarray, bounds: np.ndarray, common_ones: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets in a row and the bounds of each set's: sets of similarity t or more share one."""
    size = np.diff(bounds)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(size) and size.max() > 0:
        least = -(-size * like.num // like.den)  # of a partner
        rare = ~np.isin(h, common_ones) if len(common_ones) else np.ones(len(h), bool)
        mixed = common.mix64(h + np.uint64(0x2545F4914F6CDD1D))
        for band, (low, high) in enumerate(like.bands(int(size.max()))):
            k, spare = like.parts(low, high)
            own = np.flatnonzero((size >= low) & (least < high))
            if k == 0 or not len(own):
                continue
            own, many = _emit(h, mixed, bounds, rare, own, k, spare, _salt(band, 1), found)
            if len(many):
                _, bare = _emit(h, mixed, bounds, np.ones(len(h), bool), many, k, spare, _salt(band, 2), found)
                if len(bare):
                    _emit(h, mixed, bounds, np.ones(len(h), bool), bare, k, spare, _salt(band, 3), found, empty=True)
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    doc, key = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    order = np.argsort(doc, kind="stable")
    return key[order].view(np.int64), np.searchsorted(doc[order], np.arange(len(bounds)))


def _emit(h, mixed, bounds, use, own, k, spare, salt, found, empty=False) -> tuple[np.ndarray, np.ndarray]:
    """Add the keys of the parts of the sets `own`; returns own and those of them with too many empty parts."""
    count = bounds[own + 1] - bounds[own]
    spot = np.repeat(bounds[own], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.arange(len(own)), count)
    ok = use[spot]
    spot, row = spot[ok], row[ok]
    cell = row * k + ((mixed[spot] >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    value = common.mix64(h[spot] ^ np.uint64(0xA0761D6478BD642F))
    cells = len(own) * k
    filled = np.bincount(cell, minlength=cells)
    high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), cells).astype(np.uint64)
    low = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), cells).astype(np.uint64)
    part = np.tile(np.arange(k, dtype=np.uint64), len(own))
    key = common.mix64(common.mix64((high << np.uint64(32)) + low + filled.astype(np.uint64)) + salt + part * np.uint64(0xE7037ED1A0B428DB))
    chosen = np.flatnonzero(filled == 0 if empty else filled > 0)
    found.append((own[chosen // k], key[chosen]))
    bare = (filled.reshape(len(own), k) == 0).sum(1)
    return own, own[bare > spare]


def key_lists(keys: np.ndarray, bounds: np.ndarray, wanted: Iterable[int] = range(1 << KEY_BITS)) -> list[pa.ListArray]:
    """The keys of all sets in a row as a list a set for each wanted value of the first KEY_BITS bits."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = (keys.view(np.uint64) >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    out = []
    for part in wanted:
        own = first == part
        upto = np.concatenate([[0], np.cumsum(np.bincount(doc[own], minlength=len(bounds) - 1))])
        out.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(keys[own])))
    return out


def common_shingles(docs: DataFrame, text: str, like: Likeness, scratch: common.Scratch) -> np.ndarray:
    """Hashes of the shingles found in very many documents, sorted; at most COMMON_MOST."""

    def many(parts: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(parts)
        h.sort()
        edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n = np.diff(np.append(edge, len(h)))
        ok = n >= COMMON_IN_PIECE
        return pa.RecordBatch.from_arrays([pa.array(h[edge[ok]].view(np.int64)), pa.array(n[ok])], ["h", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            raw, at = common.utf8_of(batch.column(0))
            for lo, hi in common.pieces(at):
                parts.append(distinct_sets(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], like.n)[0])
                held += len(parts[-1])
                if held > COMMON_PIECE:
                    yield many(parts)
                    parts, held = [], 0
        if held:
            yield many(parts)

    counts = docs.select(text).mapInArrow(common.freed(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_LEAST)
    counts = scratch.stored(counts, "common")
    # The most frequent, by a histogram over eighths of an octave, and of the bin in which the number ends a share by hash.
    level = F.floor(F.log2("n") * 8).cast("int")
    held, least, share = 0, None, 0
    for at, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        least = at
        if held + n > COMMON_MOST:
            share = 1000 * (COMMON_MOST - held) // n
            break
        held, share = held + n, 1000
    if least is None:
        scratch.drop(counts)
        return np.zeros(0, np.uint64)
    top = counts.where((level > least) | ((level == least) & (F.pmod("h", F.lit(1000)) < share))).select("h").toArrow()
    scratch.drop(counts)
    return np.sort(top.column("h").to_numpy().astype(np.int64).view(np.uint64))


class Tree:
    """A signature tree over sets in order of size."""

    def __init__(self, sets: list[np.ndarray], like: Likeness) -> None:
        self.like = like
        self.sets = sets
        maps = np.zeros((len(sets), BITS // 64), np.uint64)
        for lo in range(0, len(sets), 1024):  # bytes for bits are held for so many sets only
            part = sets[lo : lo + 1024]
            bits = np.zeros((len(part), BITS), bool)
            for row, s in zip(bits, part, strict=True):
                row[(s & np.uint64(BITS - 1)).astype(np.int64)] = True
            maps[lo : lo + 1024] = np.packbits(bits, axis=1).view(np.uint64)
        size = np.array([len(s) for s in sets])
        over = size - np.bitwise_count(maps).sum(1).astype(np.int64)  # elements beyond one a bit
        self.levels = [(maps, size, size, over)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, over = self.levels[-1]
            cut = np.arange(0, len(maps), step)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(over, cut)))
            step = FAN

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets under a and b may be similar: by their sizes and greatest possible overlap."""
        maps, low, high, over = self.levels[level]
        t, den = self.like.num, self.like.den
        ok = (high[a] * den >= t * low[b]) & (high[b] * den >= t * low[a])
        need = -(-(low[a] + low[b]) * t // (den + t))
        for s in range(0, len(a), 1 << 16):
            part = slice(s, s + (1 << 16))
            shared = np.bitwise_count(maps[a[part]] & maps[b[part]]).sum(1).astype(np.int64)
            ok[part] &= shared + np.minimum(over[a[part]], over[b[part]]) >= need[part]
        return ok

    def pairs(self, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of pairs of sets (i < j) that are wanted and may be similar, by dual traversal from the root."""
        # An entry holds pairs of nodes whose children are paired when its turn comes; children of one
        # entry are few, so the stack stays small.
        top = len(self.levels) - 1
        root = np.zeros(1, np.int64)
        ok = self.possible(top, root, root)
        stack = [(top, root[ok], root[ok])]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                if len(a):
                    yield a, b
                continue
            if len(a) > NODE_PAIRS:
                stack += [(level, a[s : s + NODE_PAIRS], b[s : s + NODE_PAIRS]) for s in range(0, len(a), NODE_PAIRS)]
                continue
            fan, n = (LEAF if level == 1 else FAN), len(self.levels[level - 1][0])
            x = np.repeat(a[:, None] * fan + np.arange(fan), fan, axis=1).ravel()
            y = np.tile(b[:, None] * fan + np.arange(fan), (1, fan)).ravel()
            ok = (x < y if level == 1 else x <= y) & (x < n) & (y < n)
            x, y = x[ok], y[ok]
            if level == 1:
                ok = wanted(x, y)
                x, y = x[ok], y[ok]
            ok = self.possible(level - 1, x, y)
            stack.append((level - 1, x[ok], y[ok]))

    def similar(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        both = np.concatenate([a, b])
        both.sort()
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return shared * self.like.den >= self.like.num * (len(a) + len(b) - shared)


def tree_links(sets: list[np.ndarray], group: list[int], side: list[int] | None, like: Likeness) -> list[tuple[int, int]]:
    """Verified links that connect all sets connected by links; sets of one group count as connected already.

    With sides, only links between different sides are looked for.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    first: dict[int, int] = {}
    parent = np.array([first.setdefault(group[x], i) for i, x in enumerate(order)], np.int64)
    sides = None if side is None else np.array(side)[order]

    def roots(x: np.ndarray) -> np.ndarray:
        up = parent[x]
        while (parent[up] != up).any():
            up = parent[up]
        parent[x] = up
        return up

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = int(parent[parent[i]])
        return i

    def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = roots(a) != roots(b)
        return ok if sides is None else ok & (sides[a] != sides[b])

    tree = Tree([sets[i] for i in order], like)
    links = []
    for a, b in tree.pairs(apart):
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            ri, rj = find(i), find(j)
            if ri != rj and tree.similar(i, j):
                parent[rj] = ri
                links.append((order[i], order[j]))
    return links


class Verifier:
    """Exact similarity of many pairs of sets: one set is marked, and the elements of its partners are looked up."""

    def __init__(self, sets: list[np.ndarray], like: Likeness) -> None:
        self.like = like
        self.size = np.array([len(s) for s in sets], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.size)])
        names, local = np.unique(np.concatenate(sets), return_inverse=True)
        self.local = local.astype(np.int32)
        self.mark = np.zeros(len(names), bool)

    def similar(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sets of each pair are similar."""
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])), len(x))
        shared = np.zeros(len(x), np.int64)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i, js = x[lo], y[lo:hi]
            own = self.local[self.bounds[i] : self.bounds[i + 1]]
            self.mark[own] = True
            if js[-1] - js[0] == hi - lo - 1:
                theirs = self.local[self.bounds[js[0]] : self.bounds[js[-1] + 1]]
            else:
                theirs = np.concatenate([self.local[s:e] for s, e in zip(self.bounds[js].tolist(), self.bounds[js + 1].tolist(), strict=True)])
            size = self.size[js]
            shared[lo:hi] = np.add.reduceat(self.mark[theirs], np.cumsum(size) - size, dtype=np.int64)
            self.mark[own] = False
        out = np.empty(len(x), bool)
        out[order] = shared * self.like.den >= self.like.num * (self.size[x] + self.size[y] - shared)
        return out


def tree_counts(sets: list[np.ndarray], weight: list[int], side: list[int] | None, like: Likeness) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect all sets connected by links, and for each set the weight of all sets linked with it.

    Every pair that the tree leaves is verified.  With sides, only pairs of different sides count.
    """
    order = np.array(sorted(range(len(sets)), key=lambda i: len(sets[i])))
    sides = None if side is None else np.array(side)[order]
    heavy = np.array(weight, np.int64)[order]
    ranked = [sets[i] for i in order]
    tree, verifier = Tree(ranked, like), Verifier(ranked, like)
    parent = list(range(len(sets)))
    total = np.zeros(len(sets), np.int64)
    links = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def wanted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.ones(len(a), bool) if sides is None else sides[a] != sides[b]

    def verify(parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        ok = verifier.similar(a, b)
        a, b = a[ok], b[ok]
        np.add.at(total, a, heavy[b])
        np.add.at(total, b, heavy[a])
        roots = np.array([find(i) for i in range(len(parent))])
        apart = roots[a] != roots[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            ri, rj = find(i), find(j)
            if ri != rj:
                parent[rj] = ri
                links.append((int(order[i]), int(order[j])))

    parts, held = [], 0
    for a, b in tree.pairs(wanted):
        parts.append((a, b))
        held += len(a)
        if held >= SET_PAIRS:
            verify(parts)
            parts, held = [], 0
    if parts:
        verify(parts)
    out = np.zeros(len(sets), np.int64)
    out[order] = total
    return links, out


def _link_tasks(rows: DataFrame, like: Likeness, count: bool = False) -> DataFrame:
    """Links (a, b) of sets found in each task, and if count, rows (a, null, n): n rows in this task are linked with set a.

    rows: task, side, grp, weight, sid, text, all rows of a task together.
    """

    def finish(parts: list[tuple]) -> list[tuple[int, int | None, int | None]]:
        seen: dict[int, int] = {}
        sets, group, weight, side, ids = [], [], [], [], []
        for grp, wt, sd, want, sid, s in parts:
            if want == sid and want not in seen:  # a key shared by rows of other texts brings those too
                seen[want] = len(ids)
                ids.append(want)
                sets.append(s)
                group.append(grp)
                weight.append(wt)
                side.append(sd)
        sides = side if len(set(side)) > 1 else None
        if len(ids) < 2:
            return []
        if not count:
            return [(ids[a], ids[b], None) for a, b in tree_links(sets, group, sides, like)]
        links, total = tree_counts(sets, weight, sides, like)
        return [(ids[a], ids[b], None) for a, b in links] + [(ids[i], None, n) for i, n in enumerate(total.tolist()) if n]

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["a", "b", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            raw, at = common.utf8_of(batch.column(5))
            task, side, grp, weight, sid = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for lo, hi in common.pieces(at):
                h, bounds = distinct_sets(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], like.n)
                ids = set_ids(h, bounds)
                for i in range(lo, hi):
                    if task[i] != now:
                        out += finish(parts)
                        now, parts = task[i], []
                    parts.append((grp[i], weight[i], side[i], sid[i], int(ids[i - lo]), h[bounds[i - lo] : bounds[i - lo + 1]].copy()))
            if out:
                yield as_batch(out)
        out = finish(parts)
        yield as_batch(out)

    placed = rows.select("task", "side", "grp", "weight", "sid", "text").repartition("task").sortWithinPartitions("task")
    return placed.mapInArrow(common.freed(run), "a long, b long, n long")


#: Columns of a set's keys, a list for each value of their first bits.
KEY_LISTS = [f"_keys{i}" for i in range(1 << KEY_BITS)]


def shingle_table(rows: DataFrame, passed: list[str], text: str, like: Likeness, often: Broadcast, wanted: range) -> DataFrame:
    """The columns passed, _n (shingles), _sid (null for empty sets) and the wanted KEY_LISTS of every row, in one pass over the texts.

    Of rows of equal sets in a task the first alone has keys.  often: the common_shingles, the same ones for all lists.
    """
    chosen = rows.select(*passed, text)
    schema = T.StructType([
        *chosen.schema.fields[:-1], T.StructField("_n", T.LongType()), T.StructField("_sid", T.LongType()), *(T.StructField(KEY_LISTS[i], T.ArrayType(T.LongType())) for i in wanted),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            raw, at = common.utf8_of(batch.column(batch.num_columns - 1))
            for lo, hi in common.pieces(at):
                h, bounds = distinct_sets(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], like.n)
                size, ids = np.diff(bounds), set_ids(h, bounds)
                fresh = np.zeros(hi - lo, bool)
                for i, x in enumerate(ids.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                mine = np.repeat(fresh, size)
                found, where = keys_of(h[mine], np.concatenate([[0], np.cumsum(size * fresh)]), often.value, like)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(len(passed))), pa.array(size), pa.array(ids, mask=size == 0), *key_lists(found, where, wanted)], schema.names
                )

    return chosen.mapInArrow(common.freed(run), schema)


def shared_keys(keyed: DataFrame, lists: list[str], total: int, scratch: common.Scratch) -> list[DataFrame]:
    """Written tables of what shared_pairs needs, from _sid and some of the KEY_LISTS of every set, `total` keys in all.

    Keys are taken a few lists at a time.  Their rows are sorted over ranges of key and set, so a key of very many
    sets is spread over tasks.  A key that goes on from one task to the next is known by the ends of the tasks, two
    rows of each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray | None, k: np.ndarray | None) -> pa.RecordBatch:
            none = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(a), none if b is None else pa.array(b), none if k is None else pa.array(k)], ["a", "b", "k"])

        hub = None  # key and first set of the run that goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            k, sid = (batch.column(i).to_numpy() for i in range(2))
            begins = np.concatenate([[hub is None or k[0] != hub[0]], k[1:] != k[:-1]])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(k)), -1))
            first = np.where(at >= 0, sid[at], 0 if hub is None else hub[1])
            if hub is None:
                yield out(first[:1].copy(), None, k[:1].copy())
            other = first != sid
            pairs = np.unique(np.stack([first[other], sid[other]]), axis=1)
            yield out(pairs[0].copy(), pairs[1].copy(), None)
            hub = int(k[-1]), int(first[-1])
        if hub is not None:
            yield out(np.array([hub[1]]), None, np.array([hub[0]]))

    found = []
    step = -(-len(lists) // min(len(lists), max(1, -(-total // KEYS_AT_ONCE))))
    for at in range(0, len(lists), step):
        keys = keyed.select(F.explode(F.concat(*lists[at : at + step])).alias("k"), F.col("_sid").alias("sid"))
        placed = keys.repartitionByRange("k", "sid").sortWithinPartitions("k", "sid")
        found.append(scratch.stored(placed.mapInArrow(common.freed(run), "a long, b long, k long"), "shared"))
    return found


def shared_pairs(found: DataFrame) -> DataFrame:
    """a, b: each set that shares a key with another, and the first set of that key; from a table of shared_keys."""
    ends = found.where("b is null")
    ends = ends.select(F.first("a").over(Window.partitionBy("k").orderBy("a")).alias("a"), F.col("a").alias("b")).where("a <> b")
    return found.where("b is not null").select("a", "b").unionByName(ends).distinct()


def _small(df: DataFrame) -> DataFrame:
    """df, a written table of a few numbers a row, to be broadcast if its rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _row_ranges(numbered: DataFrame, name: str) -> Iterator[Callable[[str], Column]]:
    """Ranges of row numbers that hold about BROADCAST_ROWS rows of numbered, a written table, each as a condition on a column."""
    ranges = max(1, -(-numbered.count() // BROADCAST_ROWS))
    cuts = sorted({int(x) for x in numbered.approxQuantile(name, [i / ranges for i in range(1, ranges)], 0.1 / ranges)}) if ranges > 1 else []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):

        def within(name: str, low: int | None = low, high: int | None = high) -> Column:
            return (F.lit(True) if low is None else F.col(name) >= low) & (F.lit(True) if high is None else F.col(name) < high)

        yield within


def _members(rows: DataFrame, placed: DataFrame, row: str, text: str, scratch: common.Scratch) -> DataFrame:
    """placed with the text of each of its rows.  Of many rows the numbers are broadcast range by range, so that texts are never shuffled."""
    out = []
    for within in _row_ranges(placed, "row"):
        side = F.broadcast(placed.where(within("row")).withColumnRenamed("row", "_at"))
        texts = rows.select(F.col(row).alias("_row"), F.col(text).alias("text")).where(within("_row"))
        out.append(scratch.stored(texts.join(side, F.col("_row") == F.col("_at")).drop("_row", "_at"), "members", True))
    return scratch.joined(out)


def _without(rows: DataFrame, row: str, gone: DataFrame, gone_id: str, scratch: common.Scratch) -> DataFrame:
    """rows but those numbered in gone, a written table.  Of many numbers each range is broadcast in turn, so that texts are never shuffled."""
    ranges = list(_row_ranges(gone, gone_id))
    parts = (rows.where(w(row)).join(F.broadcast(gone.where(w(gone_id))), F.col(row) == F.col(gone_id), "left_anti") for w in ranges)
    return next(parts) if len(ranges) == 1 else scratch.joined([scratch.stored(p, "left", True) for p in parts])


def _placed(clusters: DataFrame, classes: DataFrame, block: int, scratch: common.Scratch) -> tuple[DataFrame, DataFrame]:
    """cluster, sid, row, n, weight, block and task of every set of a cluster; and the clusters cut into several blocks."""
    sets = clusters.join(classes, F.col("node") == F.col("sid")).select(F.col("root").alias("cluster"), "sid", "row", "n", "weight")
    sets = scratch.stored(sets, "candidates")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large = scratch.stored(sets.groupBy("cluster").agg(F.sum("n").alias("all")).where(F.col("all") > block).select("cluster"), "large")
    packs = max(1, total // min(PACK_SHINGLES, block))
    whole = sets.withColumn("block", F.lit(0)).withColumn("task", F.xxhash64(F.lit(1), F.pmod(F.xxhash64("cluster"), F.lit(packs))))
    if large.isEmpty():
        return whole, large
    side = _small(large.select(F.col("cluster").alias("_c")))
    whole = whole.join(side, F.col("cluster") == F.col("_c"), "left_anti")
    cut = sets.join(side, F.col("cluster") == F.col("_c"), "left_semi")
    # Blocks by size: the sets of smaller sizes come first, those of one size in order of a hash.  Only sizes and their
    # numbers are ranked, not sets.
    sizes = cut.groupBy(F.col("cluster").alias("_c"), F.col("n").alias("_n")).agg((F.count("*") * F.col("n")).alias("_own"))
    upto = F.sum("_own").over(Window.partitionBy("_c").orderBy("_n"))
    sizes = scratch.stored(sizes.withColumn("_before", upto - F.col("_own")), "sizes")
    at = F.col("_before") + F.pmod(F.xxhash64(F.lit(2), "sid"), F.lit(1 << 20)) / float(1 << 20) * F.col("_own")
    cut = cut.join(_small(sizes), (F.col("cluster") == F.col("_c")) & (F.col("n") == F.col("_n"))).withColumn("block", F.floor(at / block).cast("int"))
    cut = cut.select(*sets.columns, "block").withColumn("task", F.xxhash64(F.lit(3), "cluster", "block"))
    return whole.unionByName(cut), large


def linked_sets(
    rows: DataFrame, size: int, like: Likeness, row: str, key: str, text: str, block: int, count: bool, scratch: common.Scratch, passed: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The set of every row, and an answer for every set that is linked or has several rows.

    rows: a written table with a unique number in the column row and `size` bytes of text.  Sets: row, key, the columns passed, _n, _sid.
    Answers: node (a _sid), root (of its component), component_id (its smallest key), n_links (0 without count).
    """
    often = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, text, like, scratch))
    step, found = len(KEY_LISTS) // min(MOST_PASSES, max(1, -(-size // TEXT_AT_ONCE))), []
    for at in range(0, len(KEY_LISTS), step):
        wanted = range(at, min(at + step, len(KEY_LISTS)))
        lists = [KEY_LISTS[i] for i in wanted]
        table = shingle_table(rows, [] if at else [row, key, *passed], text, like, often, wanted)
        keyed, (total,) = scratch.observed(table, "keys", F.sum(sum(F.size(c) for c in lists)))
        if not at:
            sets = scratch.stored(keyed.drop(*lists), "sets")
        found += shared_keys(keyed.where("_sid is not null"), lists, total or 0, scratch)
        scratch.drop(keyed)
    shared = scratch.joined(found)
    clusters = components(shared_pairs(shared))
    scratch.drop(shared)
    full = sets.where("_sid is not null")
    classes = full.groupBy(F.col("_sid").alias("sid")).agg(F.min(key).alias("rep"), F.min(row).alias("row"), F.first("_n").alias("n"), F.count("*").alias("weight"))
    classes = scratch.stored(classes, "classes")
    placed, large = _placed(clusters, classes, block, scratch)
    members = _members(rows, scratch.stored(placed, "placed"), row, text, scratch)

    tasks = members.select("task", F.lit(0).alias("side"), F.col("sid").alias("grp"), "weight", "sid", "text")
    links = scratch.stored(_link_tasks(tasks, like, count), "links")
    if not large.isEmpty():
        links = _counts_across(members, large, links, like, scratch) if count else _links_across(members, large, links, like, block, scratch)
    scratch.drop(members)
    roots = scratch.stored(components(links.where("b is not null").select("a", "b")), "roots")
    least = roots.join(classes, F.col("node") == F.col("sid")).groupBy(F.col("root").alias("_r")).agg(F.min("rep").alias("_least"))
    named = roots.join(_small(scratch.stored(least, "least")), F.col("root") == F.col("_r")).select(F.col("node").alias("_node"), "root", "_least")
    counts = links.where("b is null").groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("_links"))
    out = classes.join(named, F.col("sid") == F.col("_node"), "left").where((F.col("weight") > 1) | F.col("root").isNotNull())
    out = out.join(counts, F.col("sid") == F.col("_a"), "left").select(
        F.col("sid").alias("node"), F.coalesce("root", "sid").alias("root"), F.coalesce("_least", "rep").alias("component_id"),
        (F.col("weight") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"),
    )
    return sets, scratch.stored(out, "answers")


def link_components(docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text", block: int = BLOCK_SHINGLES, count: bool = True) -> DataFrame:
    """key, n_shingles, component_id and, if count, n_links for every row of docs.

    component_id is the smallest key reachable by links of similarity num / den or more; texts without
    words (null, empty) are linked with nothing and have their own key.  Repeated rows and rows of one key or
    of none are rows like any other: rows are told apart by a number they get when they are first written.
    Sets are compared by 64-bit hashes of shingles: a pair of different shingles or sets is taken for equal
    with a chance of 2^-64.  n_links is the number of other rows of that similarity or more, those of equal
    sets included; all pairs a tree leaves are verified for it.
    """
    scratch = common.Scratch(docs.sparkSession)
    numbered = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    rows, (size,) = scratch.observed(numbered, "rows", F.sum(F.octet_length("_text")), packed=True)
    sets, answers = linked_sets(rows, size or 0, like, "_row", "_key", "_text", block, count, scratch)
    scratch.drop(rows)
    out = sets.join(_small(answers), F.col("_sid") == F.col("node"), "left")
    return out.select(
        F.col("_key").alias(key), F.col("_n").alias("n_shingles"), F.coalesce("component_id", "_key").alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if count else []),
    )


def _block_pairs(state: DataFrame, like: Likeness) -> DataFrame:
    """Rows of tasks that join each two blocks of a cluster whose sizes allow a link."""
    spans = state.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    right = spans.select(F.col("cluster").alias("c2"), F.col("block").alias("b2"), F.col("low").alias("low2"))
    pairs = spans.join(right, (F.col("cluster") == F.col("c2")) & (F.col("block") < F.col("b2")) & (F.col("high") * like.den >= F.col("low2") * like.num))
    pairs = pairs.select("cluster", "block", "b2").withColumn("task", F.xxhash64("cluster", "block", "b2"))
    dealt = pairs.select("cluster", "task", F.explode(F.array(F.struct(F.col("block").alias("blk"), F.lit(0).alias("side")), F.struct(F.col("b2").alias("blk"), F.lit(1).alias("side")))).alias("x"))
    dealt = dealt.select(F.col("cluster").alias("c3"), "task", "x.blk", "x.side")
    return state.join(dealt, (F.col("cluster") == F.col("c3")) & (F.col("block") == F.col("blk"))).select("task", "side", "grp", "weight", "sid", "text")


def _counts_across(members: DataFrame, large: DataFrame, links: DataFrame, like: Likeness, scratch: common.Scratch) -> DataFrame:
    """Links and counts of all pairs of different blocks of large clusters, besides those within blocks."""
    rows = members.join(large.withColumnRenamed("cluster", "_c"), F.col("cluster") == F.col("_c")).drop("_c", "task").withColumn("grp", F.col("sid"))
    return scratch.stored(links.unionByName(_link_tasks(_block_pairs(rows, like), like, True)), "links")


def _links_across(members: DataFrame, large: DataFrame, links: DataFrame, like: Likeness, block: int, scratch: common.Scratch) -> DataFrame:
    """Links between the blocks of large clusters, given those within blocks.

    First the blocks' components meet through one set each.  Then blocks of clusters that are still in
    several components are joined pair by pair, where their sizes allow a link, looking only at pairs
    from different components.
    """
    rows = members.join(large.withColumnRenamed("cluster", "_c"), F.col("cluster") == F.col("_c")).drop("_c", "task")

    def rooted(found: DataFrame) -> DataFrame:
        roots = components(found).withColumnsRenamed({"node": "_n", "root": "_root"})
        return rows.join(roots, F.col("sid") == F.col("_n"), "left").withColumn("grp", F.coalesce("_root", "sid")).drop("_n", "_root")

    heads = rooted(links).withColumn("rk", F.row_number().over(Window.partitionBy("cluster", "block", "grp").orderBy("n", "sid"))).where("rk = 1")
    # One set of each component of a block meets those of other blocks, in tasks of about a block of shingles.
    heads = scratch.stored(heads.drop("rk"), "heads", True)
    tasks = max(1, -(-(heads.agg(F.sum("n")).first()[0] or 0) // block))
    met = heads.select(F.xxhash64("cluster", F.pmod("block", F.lit(tasks))).alias("task"), F.lit(0).alias("side"), "grp", "weight", "sid", "text")
    more = scratch.stored(links.unionByName(_link_tasks(met, like)), "links")
    scratch.drop(heads)
    held = scratch.stored(rooted(more), "state", True)
    several = held.groupBy("cluster").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x <> y").select(F.col("cluster").alias("_c"))
    state = held.join(several, F.col("cluster") == F.col("_c")).drop("_c")
    out = scratch.stored(more.unionByName(_link_tasks(_block_pairs(state, like), like)), "links")
    scratch.drop(held)
    return out


def deduplicated(docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest key, null keys last, ties broken by the text.

    Rows are told apart, not keys: repeated keys and null keys are rows like any other.  Rows without
    words all stay.  Columns are unchanged, whatever their names.
    """
    row, digest, gone_id = common.free_names([*docs.columns, "_n", "_sid", *KEY_LISTS, "node", "root", "component_id", "n_links"], "row", "digest", "gone")
    scratch = common.Scratch(docs.sparkSession)
    numbered = docs.withColumns({row: F.monotonically_increasing_id(), digest: F.xxhash64(text)})
    rows, (size,) = scratch.observed(numbered, "rows", F.sum(F.octet_length(text)), packed=True)
    sets, answers = linked_sets(rows, size or 0, like, row, key, text, BLOCK_SHINGLES, False, scratch, (digest,))
    found = sets.join(_small(answers), F.col("_sid") == F.col("node")).select("root", F.struct(F.col(key).isNull(), F.col(key), F.col(digest), F.col(row)).alias("rank"))
    found = scratch.stored(found, "found")
    scratch.drop(sets, answers)
    first = scratch.stored(found.groupBy(F.col("root").alias("_r")).agg(F.min("rank").alias("_first")), "first")
    gone = found.join(_small(first), F.col("root") == F.col("_r")).where(F.col("rank")[row] != F.col("_first")[row]).select(F.col("rank")[row].alias(gone_id))
    gone = scratch.stored(gone, "gone")
    scratch.drop(found, first)
    return _without(rows, row, gone, gone_id, scratch).drop(row, digest)
