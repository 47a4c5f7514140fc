"""Prefix trie of conversations, built compressed.

A node is a sequence of first turns that some conversation has; its members are the conversations that begin with it.  Turns are told
apart by 96 bits of a digest of place, role and text; a node's id is the sum of those of its turns, three numbers of 32 bits each, so
the ids of a conversation of any length come from sums over ranges.  A conversation is cut into segments of SEGMENT turns; equal
segments after equal beginnings are one row with their number of conversations, so copies cost a row.  The rows are sorted over ranges by
beginning and turns, and each range is walked once: what a row shares with its neighbours tells where nodes branch, and
a stack of the branching, ending and last points of the row in hand sums up what lies below them.  An edge between two points is one
row.  Nodes that also lie in other ranges are given as points of their own, and their sums over the ranges are added.  At last the nodes
within an edge, which differ from its lower end by sums over the edge alone, are written out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexspark.llm.common import Scratch, freed, placed

SEGMENT = 64
ROOT = "0.0.0"
EDGE = "id string, above string, depth long, shared boolean, conv_id long, n_convs long, n_children long, n_leaves long, saved long, within array<long>"


def turn_digest(role: Column, text: Column) -> Column:
    """A turn's digest; nulls count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def _id(a: Column | str, b: Column | str, c: Column | str) -> Column:
    return F.format_string("%x.%x.%x", a, b, c)


def numbered(rows: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The turns (conv, _run, _nth, t, tok) over sorted ranges, and the runs; see common.placed.

    Turns go by their number, null first, then by digest; rows without a conversation are left out.
    """
    turns = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_digest(F.col(role), F.col(text)).alias("t"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("tok"), F.monotonically_increasing_id().alias("row"),
    )
    kept, runs = placed(scratch, turns, "conv", [F.col("turn").asc_nulls_first(), F.col("t"), F.xxhash64("row")], "turns")
    return kept.drop("turn", "row"), runs


def with_shared_starts(kept: DataFrame, runs: DataFrame, first: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first `first` turns of conversation `base`, then their own beyond as many; (conv, depth, t, tok), and all convs.

    first and base are of the column conv, first is `most` at most.
    """
    ids = runs.groupBy("conv").agg(F.first("_total").alias("total"))
    places = kept.join(runs, ["conv", "_run"]).withColumn("pos", F.col("_nth") + F.col("_before") + 1)
    wanted = ids.select(base.alias("conv")).distinct()
    starts = places.where(F.col("pos") <= most).join(wanted, "conv", "left_semi")
    starts = starts.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "t", "tok"))).alias("start"))
    convs = ids.select("conv", first.alias("first"), base.alias("base")).join(starts, "base", "left")
    convs = convs.select("conv", "first", F.slice(F.coalesce("start", F.array().cast(starts.schema["start"].dataType)), F.lit(1), F.col("first")).alias("start"))
    borrowed = convs.select("conv", F.explode("start").alias("s")).select("conv", F.col("s.pos").alias("depth"), "s.t", "s.tok")
    # How far the own turns move is joined to the runs, which no conversation fills alone.
    moved = runs.join(convs.select("conv", "first", (F.size("start") - F.col("first")).alias("by")), "conv")
    own = kept.join(moved, ["conv", "_run"]).withColumn("pos", F.col("_nth") + F.col("_before") + 1).where(F.col("pos") > F.col("first"))
    return borrowed.unionByName(own.select("conv", (F.col("pos") + F.col("by")).alias("depth"), "t", "tok")), ids.select("conv")


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """A row for each segment of a conversation: level, the ids before and after it, its turns, and whether more follow."""
    part = [F.conv(F.substring("d", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(3)]
    marked = turns.withColumn("d", F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "t"), 256))
    rows = marked.select("conv", F.floor((F.col("depth") - 1) / size).cast("long").alias("level"), "depth", *(p.alias(n) for p, n in zip(part, "abc", strict=True)), "tok")
    one = rows.groupBy("conv", "level").agg(
        F.sort_array(F.collect_list(F.struct("depth", "a", "b", "c", "tok"))).alias("seq"), *(F.sum(n).alias(n) for n in "abc"), F.sum("tok").alias("tokens")
    )
    by = Window.partitionBy("conv").orderBy("level")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    one = one.select("conv", "level", "seq", "tokens", *(F.sum(n).over(upto).alias(f"{n}1") for n in "abc"), *(F.col(n) for n in "abc"), F.lead("level").over(by).isNotNull().alias("more"))
    seq = F.transform("seq", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), s["c"].alias("c"), s["tok"].alias("tok")))
    before = [F.col(f"{n}1") - F.col(n) for n in "abc"]
    return one.select("conv", "level", _id(*before).alias("above"), _id("a1", "b1", "c1").alias("below"), seq.alias("seq"), "tokens", "more")


def _with_neighbours(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Distinct segments in order, with run and nth, and how many turns each shares with the one before and after it (left, right)."""
    sorted_ = rows.repartitionByRange("level", "above", "seq").sortWithinPartitions("level", "above", "seq")
    kept = scratch.stored(sorted_.withColumn("nth", F.monotonically_increasing_id()).withColumn("run", F.shiftright("nth", 33)), "segments")
    own = F.struct("above", "seq")
    ends = kept.groupBy("run").agg(F.min_by(own, "nth").alias("first"), F.max_by(own, "nth").alias("last"))
    over = Window.partitionBy(F.lit(0)).orderBy("run")  # a row a range
    ends = ends.select("run", F.lag("last").over(over).alias("before"), F.lead("first").over(over).alias("after"))
    by = Window.partitionBy("run").orderBy("nth")
    out = kept.select("*", F.lag(own).over(by).alias("_b"), F.lead(own).over(by).alias("_a")).join(ends, "run")

    def shared(other: Column) -> Column:
        differs = F.array_position(F.zip_with("seq", other["seq"], lambda x, y: x.eqNullSafe(y)), False)
        return F.coalesce(F.when(other["above"] == F.col("above"), differs - 1), F.lit(0)).cast("long")

    return out.select(*kept.columns, shared(F.coalesce("_b", "before")).alias("left"), shared(F.coalesce("_a", "after")).alias("right"))


class _Walk:
    """One range of sorted segments: the edges of its compressed trie, with sums over this range.

    A point on the stack is [depth, conv_id, n_convs, children, leaves, saved below it, left of the first row under it].  A node at a depth
    of that left or less began in an earlier range; so only deeper ones count as new here.
    """

    def __init__(self, size: int) -> None:
        self.size, self.out = size, [[] for _ in range(10)]
        self.group: tuple[int, str] | None = None
        self.right = 0

    def add(self, group: tuple[int, str], seq: list[dict], left: int, right: int, conv: int, n: int, children: int, leaves: int, saved: int) -> None:
        if group != self.group:
            self.close()
            self.group, self.stack = group, [[0, None, 0, 0, 0, 0, 0]]
            self.ids, self.toks = [tuple(int(x, 16) for x in group[1].split("."))], [0]
        else:
            self.pop(left, 0)
            del self.ids[left + 1 :], self.toks[left + 1 :]
        for s in seq[len(self.ids) - 1 :]:
            a, b, c = self.ids[-1]
            self.ids.append((a + s["a"], b + s["b"], c + s["c"]))
            self.toks.append(s["tok"])
        self.stack.append([len(seq), conv, n, children, leaves, saved, left])
        self.right = right

    def close(self) -> None:
        """End the group in hand; what its last row shares with the row after it lies in the next range too."""
        if self.group is not None:
            self.pop(0, self.right)
        self.group = None

    def pop(self, to: int, right: int) -> None:
        """Finish what lies below depth `to` on the row in hand."""
        stack = self.stack
        while stack[-1][0] > to:
            point = stack.pop()
            top = max(to, stack[-1][0])
            saved = self.edge(point, top, right)
            if stack[-1][0] < top:
                stack.append([top, None, 0, 0, 0, 0, point[6]])
            above = stack[-1]
            above[1] = point[1] if above[1] is None else min(above[1], point[1])
            above[2] += point[2]
            above[3] += point[6] <= top
            above[4] += point[4]
            above[5] += saved

    def edge(self, point: list, top: int, right: int) -> int:
        """Emit the nodes of depths top + 1 to the point's, those in several ranges one by one; what the first saves with all below it."""
        depth, conv, n, children, leaves, saved, left = point
        both = min(depth, max(top, left, right))
        sums = []  # from the point upwards
        for at in range(depth, top, -1):
            saved += (n - (at > left)) * self.toks[at]
            sums.append(saved)
        if depth > both:
            self.emit(depth, both, False, conv, n, children, leaves, sums[0], sums[depth - both - 1 : 0 : -1])
        for at in range(both, top, -1):
            self.emit(at, at - 1, True, conv, n, children if at == depth else int(at + 1 > left), leaves, sums[depth - at], [])
        return saved

    def emit(self, at: int, above: int, *values) -> None:
        ids = ("{:x}.{:x}.{:x}".format(*self.ids[x]) for x in (at, above))
        for column, value in zip(self.out, (*ids, self.group[0] * self.size + at, *values), strict=True):
            column.append(value)

    def taken(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.list_(pa.int64())]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.out, kinds, strict=True)], [c.split()[0] for c in EDGE.split(", ")])
        self.out = [[] for _ in range(10)]
        return batch


def _edges(rows: DataFrame, size: int) -> DataFrame:
    """The edges of every range."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, last = _Walk(size), None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for r in batch.slice(lo, 512).to_pylist():
                    if r["run"] != last:
                        walk.close()
                        last = r["run"]
                    walk.add((r["level"], r["above"]), r["seq"], r["left"], r["right"], r["conv"], r["n"], r["children"], r["leaves"], r["saved"])
                yield walk.taken()
        walk.close()
        yield walk.taken()

    wanted = rows.select("run", "nth", "level", "above", "seq", "left", "right", "conv", "n", "children", "leaves", "saved")
    return wanted.repartition("run").sortWithinPartitions("run", "nth").mapInArrow(freed(run), EDGE)


def _ends(last: DataFrame) -> DataFrame:
    """The digest of the conversations (id, conv) that end at each node; a node's are read in order and never held together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            ids, found = [], []
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != node:
                    if node is not None:
                        ids.append(node)
                        found.append(digest.hexdigest())
                    node, digest = at, sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.string()), "ends_sha256": pa.array(found, pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"id": [node], "ends_sha256": [digest.hexdigest()]})

    return last.select("id", "conv").repartition("id").sortWithinPartitions("id", "conv").mapInArrow(freed(run), "id string, ends_sha256 string")


def build(turns: DataFrame, convs: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The nodes of the trie of turns (conv, depth, t, tok), depths from 1 without gaps; convs are all conversations (conv), with turns or without.

    A row a node: conv_id, its smallest member; depth; parent_conv_id, that of its parent, null for the root; n_convs, members;
    n_children; n_leaves, childless nodes in its subtree, itself included; saved_tokens, over the subtree the tokens of a node's last turn
    times the members but one; ends_sha256, the digest of the members that end there.  Without conversations there are no nodes.
    A node with very many children is a hot key of one join, whose other side has a row for each point; Spark's adaptive
    plan splits it.  The members that end at one node are digested in one task, in order, two numbers at a time.
    """
    scratch = Scratch(turns.sparkSession)
    own = scratch.stored(_segments(turns, size), "parts")
    rows = own.groupBy("level", "above", "seq").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("below").alias("below"), F.first("tokens").alias("tokens"), F.bool_or("more").alias("more")
    )
    rows = scratch.stored(_with_neighbours(scratch, rows), "neighbours")
    new = F.aggregate(F.slice("seq", F.col("left").cast("int") + 1, size), F.lit(0).cast("long"), lambda x, s: x + s["tok"])
    childless = ~F.col("more") & (F.col("right") < F.size("seq"))
    groups = rows.groupBy("level", "above").agg(
        F.min("conv").alias("conv"), F.sum(F.col("n") * F.col("tokens") - new).alias("saved"), F.count_if(childless).alias("leaves"), F.count_if(F.col("left") == 0).alias("children")
    )
    groups = scratch.stored(groups, "groups")
    # What lies below a segment: each group's sums stand at one of its conversations, whose later levels are summed up to it.
    later = own.where(F.col("level") > 0).select("conv", "level", "above")
    later = later.join(groups.where(F.col("level") > 0).select("above", "conv", "saved", "leaves", "children"), ["above", "conv"], "left")
    down = Window.partitionBy("conv").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    later = later.select("above", "children", *(F.sum(F.coalesce(c, F.lit(0))).over(down).alias(c) for c in ("saved", "leaves")))
    below = later.groupBy(F.col("above").alias("below")).agg(F.max("children").alias("children"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    rows = rows.join(below, "below", "left").select(
        "run", "nth", "level", "above", "seq", "left", "right", "conv", "n", F.coalesce("children", F.lit(0)).alias("children"),
        F.coalesce("leaves", childless.cast("long")).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    edges = scratch.stored(_edges(rows, size), "edges")
    sums = [F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved"))]
    many = edges.where("shared").groupBy("id").agg(F.first("above").alias("above"), F.first("depth").alias("depth"), *sums, F.first("within").alias("within"))
    total = groups.agg(F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"), F.coalesce(F.sum(F.when(F.col("level") == 0, F.col("children"))), F.lit(0)).alias("children"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0").crossJoin(F.broadcast(total)).select(  # one row each
        F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("above"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.col("children").alias("n_children"),
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved", F.array().cast("array<bigint>").alias("within"),
    )
    points = scratch.stored(edges.where("not shared").drop("shared").unionByName(many).unionByName(root), "points")
    last = own.where(~F.col("more")).select(F.col("below").alias("id"), "conv")
    last = last.unionByName(convs.join(own.where("level = 0").select("conv"), "conv", "left_anti").select(F.lit(ROOT).alias("id"), "conv"))
    points = points.join(points.select(F.col("id").alias("above"), F.col("conv_id").alias("parent")), "above", "left").join(_ends(last), "id", "left")
    # Within an edge: the nodes over its point, the topmost first; each has one child and nothing ends there.
    none = F.sha2(F.lit("").cast("binary"), 256)
    n = F.size("within")
    inner = F.transform("within", lambda s, i: F.struct((F.col("depth") - n + i).alias("depth"), (i == 0).alias("top"), F.lit(1).cast("long").alias("n_children"), s.alias("saved"), none.alias("ends")))
    point = F.struct("depth", (n == 0).alias("top"), "n_children", "saved", F.coalesce("ends_sha256", none).alias("ends"))
    out = points.select("conv_id", "parent", "n_convs", "n_leaves", F.explode(F.concat(inner, F.array(point))).alias("x"))
    return out.select(
        "conv_id", "x.depth", F.when(F.col("x.top"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs", "x.n_children", "n_leaves",
        F.col("x.saved").alias("saved_tokens"), F.col("x.ends").alias("ends_sha256"),
    )
