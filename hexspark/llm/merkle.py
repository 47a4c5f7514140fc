"""A Merkle manifest of a data set: a digest and a proof for every row, under one root.

Rows are leaves.  Those of a source, ascending by key, are hashed together in runs of three until one node, the source's
subroot, is left; the subroots, ordered by source, likewise give the root.  H is SHA-256 in lower-case hex over its inputs joined,
digests as hex text.  The rows of a source of any size are numbered over sorted ranges and cut into aligned blocks of 3^8, each the
work of one task: it holds the block's digests, walks its leaves in order and keeps their authentication paths up to date by stacks
that hash the next nodes before they are needed.  The roots of blocks are rows of the level above, where the same is done; the path of
a block's root is then appended to those of its leaves, to which it travels as one more row of the block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexspark.llm.common import Scratch, free_names, freed, placed

#: Fixed by the task: nodes in a run, and what a leaf is made of.
RUN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block: 6561 leaves.
HEIGHT = 8
PATH = "array<struct<at: int, nodes: array<string>>>"


def digest(*fields: Column) -> Column:
    """H of fields: `-` for a null, else the number of bytes, a colon and the value."""

    def said(x: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))

    return F.sha2(F.concat(*(said(f.cast("string")) for f in fields)).cast("binary"), 256)


def proof(path: Column) -> Column:
    """The siblings of a path, level by level and left to right."""
    return F.flatten(F.transform(path, lambda s: s["nodes"]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""

    def up(h: Column, s: Column) -> Column:
        return F.sha2(F.concat_ws("", F.slice(s["nodes"], 1, s["at"]), h, F.slice(s["nodes"], s["at"] + 1, RUN)), 256)

    return F.aggregate(path, leaf, up)


def levels_of(n: int) -> int:
    """How often n nodes are hashed together until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // RUN), out + 1
    return out


def _join(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


class Treehash:
    """The nodes of the run `run` at a level, from the leaves below it, one leaf at a time; its stack holds a few nodes a level."""

    def __init__(self, leaves: list[str], counts: list[int], level: int, run: int) -> None:
        width = RUN ** (level + 1)
        self.leaves, self.counts, self.level = leaves, counts, level
        self.next, self.end = min(len(leaves), run * width), min(len(leaves), (run + 1) * width)
        self.stack: list[tuple[int, int, str]] = []  # level, place, digest

    def low(self) -> int | None:
        """The level of the lowest node, its own when fresh; None when it is done."""
        if self.next == self.end:
            return None
        return self.stack[-1][0] if self.stack else self.level

    def step(self) -> None:
        """Take one leaf and hash every run that it ends."""
        stack, level, place, node = self.stack, 0, self.next, self.leaves[self.next]
        self.next += 1
        while level < self.level and (place % RUN == RUN - 1 or place == self.counts[level] - 1):
            first = len(stack) - place % RUN
            node = _join([n for _, _, n in stack[first:]] + [node])
            del stack[first:]
            level, place = level + 1, place // RUN
        stack.append((level, place, node))

    def nodes(self) -> list[str]:
        while self.next < self.end:
            self.step()
        return [n for _, _, n in self.stack]


class Traversal:
    """The authentication paths of a block's leaves, one after the other.

    Each level has the run of nodes that the current leaf's path lies in, and a treehash of the run that follows.  A leaf pays for as
    many steps as there are levels; each goes to the treehash with the lowest node, so that none is late and their
    stacks together stay within a few nodes a level.
    """

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.leaves, self.levels, self.at = leaves, levels, 0
        self.counts = [len(leaves)]
        for _ in range(levels):
            self.counts.append(-(-self.counts[-1] // RUN))
        self.runs = [Treehash(leaves, self.counts, h, 0).nodes() for h in range(levels)]
        self.coming = [Treehash(leaves, self.counts, h, 1) for h in range(levels)]
        self.late = 0

    def root(self) -> str:
        return _join(self.runs[-1]) if self.levels else self.leaves[0]

    def path(self) -> list[tuple[int, list[str]]]:
        """For each level the place in the run, and the run's other nodes."""
        out, place = [], self.at
        for run in self.runs:
            at = place % RUN
            out.append((at, run[:at] + run[at + 1 :]))
            place //= RUN
        return out

    def advance(self) -> None:
        for _ in range(self.levels):
            lows = [(low, h) for h, t in enumerate(self.coming) if (low := t.low()) is not None]
            if not lows:
                break
            self.coming[min(lows)[1]].step()
        self.at += 1
        place = self.at
        for h in range(self.levels):
            if place % RUN:
                break
            place //= RUN
            self.late += self.coming[h].low() is not None
            self.runs[h] = self.coming[h].nodes()
            self.coming[h] = Treehash(self.leaves, self.counts, h, place + 1)


def _blocks(batches: Iterable[pa.RecordBatch], keys: tuple[int, ...]) -> Iterator[pa.Table]:
    """Runs of rows equal in the key columns, which follow each other; a run is held whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        marks = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        lo = 0
        for i, mark in enumerate(marks):
            if mark != last:
                if i > lo:
                    held.append(batch.slice(lo, i - lo))
                if held:
                    yield pa.Table.from_batches(held)
                held, lo, last = [], i, mark
        if lo < len(marks):
            held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


def _height(total: int, height: int) -> int:
    return height if total > RUN**height else levels_of(total)


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """nodes (grp, place, total, digest, ...) with their block, each block's rows in one task and in order."""
    out = nodes.withColumn("block", F.floor(F.col("place") / RUN**height).cast("long"))
    return out.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def block_roots(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The nodes of the level above: one for each block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, (0, 1)):
            grp, place, total = (block.column(i)[0].as_py() for i in (0, 1, 2))
            leaves = block.column(3).to_pylist()
            levels = _height(total, height)
            counts = [len(leaves)]
            for _ in range(levels):
                counts.append(-(-counts[-1] // RUN))
            (root,) = Treehash(leaves, counts, levels, 0).nodes()
            yield pa.RecordBatch.from_pydict({"grp": [grp], "place": [place], "total": pa.array([-(-total // RUN**height)], pa.int64()), "digest": [root]})

    rows = _in_blocks(nodes, height).select("grp", "block", "total", "digest")
    return rows.mapInArrow(freed(run), "grp string, place long, total long, digest string")


def block_paths(nodes: DataFrame, upper: DataFrame, height: int = HEIGHT) -> DataFrame:
    """nodes (grp, place, total, digest, kept struct) with their paths to the root, given those of the blocks' roots.

    upper: (grp, place, subroot, root, path) of each block.
    """
    kept = nodes.schema["kept"].dataType
    head = upper.select("grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("string").alias("digest"),
                        F.lit(None).cast(kept).alias("kept"), "subroot", "root", "path")
    none = [F.lit(None).cast(head.schema[c].dataType).alias(c) for c in ("subroot", "root", "path")]
    rows = nodes.select("grp", F.floor(F.col("place") / RUN**height).cast("long").alias("block"), "place", "total", "digest", "kept", *none)
    names = ["grp", "place", "total", "digest", "kept", "subroot", "root", "path"]
    struct = pa.list_(pa.struct([("at", pa.int32()), ("nodes", pa.list_(pa.string()))]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, (0, 1)):
            subroot, root, above = (block.column(i)[0].as_py() for i in (6, 7, 8))
            block = block.slice(1)
            above = [(s["at"], s["nodes"]) for s in above]
            leaves = block.column(4).to_pylist()
            walk = Traversal(leaves, _height(block.column(3)[0].as_py(), height))
            for lo in range(0, len(leaves), 1024):
                part = block.slice(lo, 1024).combine_chunks()
                at, nodes, per, ends = [], [], [0], [0]
                for _ in range(part.num_rows):
                    for a, n in walk.path() + above:
                        at.append(a)
                        nodes += n
                        per.append(len(nodes))
                    ends.append(len(at))
                    walk.advance()
                steps = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(nodes, pa.string()))], fields=list(struct.value_type))
                paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
                n = part.num_rows
                columns = [part.column(i) for i in (0, 2, 3, 4, 5)] + [pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()), paths]
                yield from pa.Table.from_arrays(columns, names).to_batches()

    both = rows.unionByName(head).repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    return both.mapInArrow(freed(run), f"grp string, place long, total long, digest string, kept {kept.simpleString()}, subroot string, root string, path {PATH}")


def _climbed(scratch: Scratch, nodes: DataFrame, most: int, height: int) -> list[DataFrame]:
    """The levels of blocks over nodes, the last of one node a group."""
    out = [nodes]
    while most > 1:
        out.append(scratch.stored(block_roots(out[-1], height), "roots"))
        most = -(-most // RUN**height)
    return out


def _most(runs: DataFrame) -> int:
    return runs.agg(F.max("_total")).first()[0] or 0


def _nodes(kept: DataFrame, runs: DataFrame, group: str) -> DataFrame:
    return kept.join(runs, [group, "_run"]).select(F.col(group).alias("grp"), (F.col("_nth") + F.col("_before")).alias("place"), F.col("_total").alias("total"), *(c for c in kept.columns if c not in (group, "_nth", "_run")))


def prove(rows: DataFrame, fields: Iterable[str] = FIELDS, key: str = "doc_id", group: str = "source", height: int = HEIGHT, **more: Column) -> DataFrame:
    """Every row's key, leaf, subroot, root and path, and the columns of `more`, which are computed where the leaf is.

    path: for each level from the leaf to the root its place in its run and the run's other nodes.  A null key goes before
    all others and a null group before all others; rows of one key are ordered by leaf, equal rows are leaves of their own.  An empty text
    is not a null.  No rows give no rows.  Texts of any length are read once, where the leaves are hashed; other columns do not matter.
    """
    names = dict(zip(more, free_names(["grp", "k", "leaf", "id"], *more), strict=True))
    cells = [F.col(group).cast("string").alias("grp"), F.col(key).alias("k"), digest(*(F.col(f) for f in fields)).alias("leaf"), *(c.alias(names[n]) for n, c in more.items())]
    scratch = Scratch(rows.sparkSession)
    # A null group becomes the empty text, the others begin with a mark.
    leaves = scratch.stored(rows.select(*cells).withColumn("grp", F.coalesce(F.concat(F.lit("="), "grp"), F.lit(""))).withColumn("id", F.monotonically_increasing_id()), "leaves")
    kept, runs = placed(scratch, leaves, "grp", [F.col("k").asc_nulls_first(), F.col("leaf"), F.xxhash64("id")], "placed")
    scratch.drop(leaves)
    nodes = _nodes(kept, runs, "grp").select("grp", "place", "total", F.col("leaf").alias("digest"), F.struct("k", *names.values()).alias("kept"))
    levels = _climbed(scratch, nodes, _most(runs), height)
    tops, top_runs = placed(scratch, levels[-1].select(F.lit("").alias("all"), F.col("grp").alias("own"), "digest"), "all", [F.col("own")], "subroots")
    crown = _nodes(tops, top_runs, "all").select("grp", "place", "total", "digest", F.struct("own").alias("kept"))
    crowns = _climbed(scratch, crown, _most(top_runs), height)
    top = crowns[-1].select("grp", "place", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    for level in reversed(crowns[:-1]):
        top = scratch.stored(block_paths(_with_kept(level), top, height), "tops")
    if len(crowns) == 1:
        top = crowns[0].join(top.select("grp", "place", "root", "path"), ["grp", "place"])
    upper = top.select(F.col("kept.own").alias("grp"), F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "root", "path")
    for level in reversed(levels[1:-1]):
        upper = scratch.stored(block_paths(_with_kept(level), upper, height).select("grp", "place", "subroot", "root", "path"), "uppers")
    if len(levels) == 1:
        done = levels[0].join(upper.drop("place"), "grp")  # a row a group
    else:
        done = block_paths(levels[0], upper, height)
    return done.select(F.col("kept.k").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path", *(F.col(f"kept.{at}").alias(n) for n, at in names.items()))


def _with_kept(nodes: DataFrame) -> DataFrame:
    return nodes if "kept" in nodes.columns else nodes.withColumn("kept", F.struct(F.lit(0).alias("none")))


def tampered(name: str, value: Column, fields: Iterable[str] = FIELDS) -> Column:
    """The leaf of a row in which one field has another value; for `more` of prove."""
    return digest(*(value if f == name else F.col(f) for f in fields))
