"""Covers of polygons: the cells whose middle lies in one, found from coarse to fine over tasks, and kept as intervals.

Every cell below a cell has its middle within 0.65 hexagon steps of the cell's own.  A cell whose box of that size no edge of the
polygon meets is wholly in or out, so only the cells along edges are divided, seven ways, level by level.  A task divides a few
hundred and passes the rest on, each with the edges that matter in its range of latitudes, so neither a large polygon nor one of
many corners stays in one task.

The cells below a cell at one resolution are consecutive when cells are numbered by base cell and digits, so a cover is a few
intervals of numbers instead of a row a cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexspark.functions.grid import _UNIT, _bases, cells_of, centres_of, latlng_to_cell
from hexspark.functions.scalar import cell_hex, hex_cell
from hexspark.session import spread

#: How far below-cells stray, in steps of the hexagons at the face's middle; 0.5885 is the most that was measured.
STRAY = 0.65
#: Cells along edges that one task divides further before it passes them on.
FAN = 256
#: Intervals that are broadcast: 16 bytes each; more are joined by the range of numbers they lie in.
MOST_INTERVALS = 2_000_000
#: The resolution of those ranges.
RANGE_RESOLUTION = 3
_ROW = "polygon long, cell long, done boolean, middle double, edges array<double>"


# ---- geometry of one polygon


def unwrapped(ring: np.ndarray) -> np.ndarray:
    """The points of a ring with longitudes that go on beyond 180 degrees, closed.

    An edge goes the shorter way round; one of 360 degrees stays, as it means the whole circle.  A ring that goes
    round a pole is closed over the nearer pole.
    """
    ring = ring if (ring[0] == ring[-1]).all() else np.vstack([ring, ring[:1]])
    step = np.diff(ring[:, 0])
    wrong = (np.abs(step) > 180) & (np.abs(step) < 360)
    step = np.where(wrong, (step + 180) % 360 - 180, step)
    lon = np.concatenate([ring[:1, 0], ring[0, 0] + np.cumsum(step)])
    out = np.column_stack([lon, ring[:, 1]])
    if abs(lon[-1] - lon[0]) > 180:
        pole = np.copysign(90.0, ring[:, 1].mean())
        out = np.vstack([out, [[lon[-1], pole], [lon[0], pole], out[0]]])
    return out


def edges_of(rings: list) -> tuple[np.ndarray, float]:
    """Edges (x1, y1, x2, y2) of a polygon's rings on one continuous scale of longitudes, and the middle of that scale."""
    parts, middle = [], 0.0
    for ring in rings:
        points = np.array([p[:2] for p in ring], float).reshape(-1, 2)
        points = points[np.isfinite(points).all(1)]
        if not len(points):
            continue
        points = unwrapped(points)
        centre = (points[:, 0].min() + points[:, 0].max()) / 2
        if parts:  # a hole lies where the outer ring is
            points[:, 0] += 360 * np.round((middle - centre) / 360)
        else:
            middle = centre
        parts.append(np.hstack([points[:-1], points[1:]]))
    return (np.vstack(parts) if parts else np.zeros((0, 4))), middle


def _near(lon: np.ndarray, middle: float) -> np.ndarray:
    return (lon - middle + 180) % 360 - 180 + middle


def holds(lat: np.ndarray, lon: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether points lie within the edges by the even-odd rule; those on a lower or left edge do."""
    inside = np.zeros(len(lat), bool)
    for part in np.array_split(edges, max(1, len(edges) * max(1, len(lat)) // 4_000_000)):
        x1, y1, x2, y2 = part.T[:, None, :]
        crosses = (y1 > lat[:, None]) != (y2 > lat[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            inside ^= (np.count_nonzero(crosses & (lon[:, None] < (x2 - x1) * (lat[:, None] - y1) / (y2 - y1) + x1), axis=1) % 2).astype(bool)
    return inside


def _boxes(lat: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray]:
    """Half the height and width, in degrees, of boxes around all that lies below cells."""
    reach = STRAY * _UNIT / np.sqrt(7.0) ** res
    far = np.abs(np.radians(lat)) + reach
    wide = np.where(far < np.pi / 2, np.arcsin(np.clip(np.sin(reach) / np.maximum(np.cos(np.radians(lat)), 1e-9), 0, 1)), np.pi)
    return np.full(len(lat), np.degrees(reach)), np.degrees(wide)


def _met(lat, lon, high, wide, edges: np.ndarray) -> np.ndarray:
    """Whether any edge may meet each box."""
    out = np.zeros(len(lat), bool)
    for part in np.array_split(edges, max(1, len(edges) * max(1, len(lat)) // 2_000_000)):
        x1, y1, x2, y2 = part.T[:, None, :]
        w, e, s, n = (lon - wide)[:, None], (lon + wide)[:, None], (lat - high)[:, None], (lat + high)[:, None]
        apart = (np.maximum(x1, x2) < w) | (np.minimum(x1, x2) > e) | (np.maximum(y1, y2) < s) | (np.minimum(y1, y2) > n)
        # All corners on one side of the line.
        side = [(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x in (w, e) for y in (s, n)]
        apart |= (np.minimum.reduce(side) > 0) | (np.maximum.reduce(side) < 0)
        out |= (~apart).any(1)
    return out


# ---- from coarse to fine


def _top() -> np.ndarray:
    return np.array([(1 << 59) | (b << 45) | ((1 << 45) - 1) for b in range(122)], np.int64)


def children_of(cells: np.ndarray) -> np.ndarray:
    """The cells of the next resolution below cells of one resolution; a pentagon has no child of digit 1."""
    res = int(cells[0] >> 52) & 15
    shift = 3 * (14 - res)
    bare = (cells & ~np.int64(15 << 52) & ~np.int64(7 << shift)) | np.int64((res + 1) << 52)
    out = (bare[:, None] | (np.arange(7, dtype=np.int64) << shift)[None, :]).ravel()
    digits = (cells & ((1 << 45) - 1)) >> (3 * (15 - res))
    gap = _bases()[3][(cells >> 45) & 127] & (digits == 0)
    keep = np.ones((len(cells), 7), bool)
    keep[gap, 1] = False
    return out[keep.ravel()]


@cache
def _coarse_middles(res: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All cells of a coarse resolution, ascending, with their middles."""
    cells = _top()
    for _ in range(res):
        cells = children_of(cells)
    cells = np.sort(cells)
    return (cells, *centres_of(cells))


def _middles(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """centres_of; those of the coarsest cells, which every polygon begins with, are kept."""
    res = int(cells[0] >> 52) & 15
    if res > 2:
        return centres_of(cells)
    known, lat, lon = _coarse_middles(res)
    at = np.searchsorted(known, cells)
    return lat[at], lon[at]


#: Rows whose cells are divided side by side.
ABREAST = 64


def _divide(rows: list[tuple[int, np.ndarray, np.ndarray, float]], target: int) -> Iterator[tuple]:
    """Parts (polygon, cells, done, middle, edges) of rows (polygon, cells of one resolution, edges, middle).

    Cells that are wholly in are done, at the coarsest resolution; of those along edges a row goes on with fewer than FAN, and
    passes on as many or more, each with the edges in its range of latitudes.  Rows go down level by level together.
    """
    active: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, (_, cells, _, _) in enumerate(rows):
        if len(cells):
            active.setdefault(int(cells[0] >> 52) & 15, []).append((i, cells))
    while active:
        res = min(active)
        group = active.pop(res)
        lats, lons = _middles(np.concatenate([cells for _, cells in group]))
        highs, wides = _boxes(lats, res)
        at = 0
        for i, cells in group:
            own = slice(at, at + len(cells))
            at += len(cells)
            polygon, _, edges, middle = rows[i]
            lat, lon, high, wide = lats[own], _near(lons[own], middle), highs[own], wides[own]
            met = _met(lat, lon, high, wide, edges) if res < target else np.zeros(len(cells), bool)
            sure = np.flatnonzero(~met)
            inside = sure[holds(lat[sure], lon[sure], edges)]
            if len(inside):
                yield polygon, cells[inside], True, middle, None
            left = np.flatnonzero(met)
            if len(left) >= FAN:
                low, top = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
                for lo in range(0, len(left), 1024):
                    part = left[lo : lo + 1024]
                    yield polygon, cells[part], False, middle, [edges[(top >= lat[k] - high[k]) & (low <= lat[k] + high[k])].ravel() for k in part]
            elif len(left):
                active.setdefault(res + 1, []).append((i, children_of(cells[left])))


def _emitted(parts: list[tuple]) -> pa.RecordBatch:
    none = np.zeros(0)

    def column(values: Iterable[np.ndarray], kind: pa.DataType) -> pa.Array:
        return pa.array(np.concatenate(list(values)), kind)

    lists = [e for _, c, _, _, own in parts for e in (own if own is not None else [none] * len(c))]
    ends = np.concatenate([[0], np.cumsum([len(e) for e in lists])]).astype(np.int32)
    edges = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else none))
    columns = [
        column((np.full(len(c), p, np.int64) for p, c, *_ in parts), pa.int64()), column((c for _, c, *_ in parts), pa.int64()),
        column((np.full(len(c), d) for _, c, d, *_ in parts), pa.bool_()), column((np.full(len(c), m) for _, c, _, m, _ in parts), pa.float64()), edges,
    ]
    return pa.RecordBatch.from_arrays(columns, ["polygon", "cell", "done", "middle", "edges"])


def _batches(parts: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Parts as batches of a few megabytes."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += 32 * len(part[1]) + sum(e.nbytes for e in part[4] or ())
        if size >= 4 << 20:
            yield _emitted(held)
            held, size = [], 0
    if held:
        yield _emitted(held)


def compact_cover(polygons: DataFrame, resolution: int, rings: str = "rings", polygon: str = "polygon") -> DataFrame:
    """polygon and cell of the cells, of `resolution` or coarser, that stand for all cells of it with their middle in a polygon.

    polygons: a whole number and rings array<array<array<double>>>, longitude first; the first ring is the outer one, the others are
    holes.  Edges are straight in longitude and latitude.  Rows without rings, and points that are null or not finite, count for nothing.
    Rows of one number are one area each, so a cell may come twice; `intervals` makes them one.
    """

    def shapes(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for own, shape in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shape = [[[float("nan") if v is None else v for v in p] for p in ring if p is not None and len(p) > 1] for ring in shape.as_py() or [] if ring]
                edges, middle = edges_of(shape)
                if len(edges):
                    yield own, _top(), edges, middle

    def left(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            todo = batch.filter(pa.compute.invert(batch.column(2)))
            flat = todo.column(4)
            for i, (own, cell, middle) in enumerate(zip(*(todo.column(k).to_pylist() for k in (0, 1, 3)), strict=True)):
                yield own, children_of(np.array([cell], np.int64)), flat[i].values.to_numpy(zero_copy_only=False).reshape(-1, 4), middle

    def divided(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        while some := list(islice(rows, ABREAST)):
            yield from _batches(_divide(some, resolution))

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from divided(shapes(batches))

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = batch.filter(batch.column(2))
            if done.num_rows:
                yield done
            yield from divided(left([batch]))

    out = polygons.select(F.col(polygon).cast("long").alias("polygon"), rings).where(F.col("polygon").isNotNull())
    out = spread(out, "polygon").mapInArrow(first, _ROW)
    # A task goes three levels at least before it has enough to pass on.
    for _ in range(-(-max(0, resolution - 1) // 3)):
        out = spread(out, "cell").mapInArrow(again, _ROW)
    return out.select("polygon", "cell")


# ---- intervals


def number_of(cell: Column, resolution: int) -> tuple[Column, Column]:
    """The numbers of the first and last cell of `resolution` at or below a cell: base cell and digits, seven to a level."""
    res = F.shiftrightunsigned(cell, 52).bitwiseAND(F.lit(15))
    out = F.shiftrightunsigned(cell, 45).bitwiseAND(F.lit(127))
    for r in range(1, resolution + 1):
        digit = F.shiftrightunsigned(cell, 3 * (15 - r)).bitwiseAND(F.lit(7))
        out = out * 7 + F.when(res >= r, digit).otherwise(0)
    width = F.pow(F.lit(7.0), (F.lit(resolution) - res).cast("double")).cast("long")
    return out, out + width - 1


def numbered_cell(number: Column, resolution: int) -> Column:
    """The cell of a number."""
    out = F.lit((1 << 59) + (resolution << 52) + (1 << (3 * (15 - resolution))) - 1) + _div(number, 7**resolution) * (1 << 45)
    for r in range(1, resolution + 1):
        out = out + F.pmod(_div(number, 7 ** (resolution - r)), F.lit(7)) * (1 << (3 * (15 - r)))
    return out.cast("long")


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by).cast("long"))


def intervals(cover: DataFrame, resolution: int, *keys: str) -> DataFrame:
    """lo and hi of the numbers that a cover's cells stand for, joined where they overlap or follow each other; for each of `keys`.

    They are cut at the borders of resolution 3 or the target, if coarser, so that no window is larger than one such cell.
    """
    lo, hi = number_of(F.col("cell"), resolution)
    width = 7 ** (resolution - min(RANGE_RESOLUTION, resolution))
    spans = cover.select(*keys, lo.alias("lo"), hi.alias("hi"))
    # A coarser cell is cut at the borders it spans.
    cut = F.explode(F.sequence(_div(F.col("lo"), width), _div(F.col("hi"), width)))
    spans = spans.select(*keys, "lo", "hi", cut.alias("range"))
    spans = spans.select(*keys, "range", F.greatest("lo", F.col("range") * width).alias("lo"), F.least("hi", F.col("range") * width + width - 1).alias("hi"))
    by = Window.partitionBy(*keys, "range").orderBy("lo", "hi")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("new", F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0))
    groups = starts.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return groups.groupBy(*keys, "range", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(*keys, "lo", "hi")


def _is_cell(cell: Column, resolution: int) -> Column:
    """Whether a number has a cell: below a pentagon none has 1 for its first digit that is not 0."""
    pentagons = [int(b) for b in np.flatnonzero(_bases()[3])]
    digits = cell.bitwiseAND(F.lit((1 << 45) - 1))
    lead = F.lit(0)
    for r in range(resolution, 0, -1):
        digit = F.shiftrightunsigned(digits, 3 * (15 - r)).bitwiseAND(F.lit(7))
        lead = F.when(digit != 0, digit).otherwise(lead)
    return ~(F.shiftrightunsigned(cell, 45).bitwiseAND(F.lit(127)).isin(pentagons) & (lead == 1))


def expanded(spans: DataFrame, resolution: int, *keys: str) -> DataFrame:
    """A row for each cell of intervals, by its index."""
    numbers = spans.select(*keys, F.explode(F.sequence("lo", "hi")).alias("number"))
    return numbers.select(*keys, numbered_cell(F.col("number"), resolution).alias("cell")).where(_is_cell(F.col("cell"), resolution))


def inside(rows: DataFrame, spans: DataFrame, resolution: int, cell: str = "cell", most: int = MOST_INTERVALS) -> DataFrame:
    """The rows whose cell lies in disjoint intervals of numbers, as a semi join with all their cells would give.

    Up to `most` intervals, 16 bytes each, go to the tasks as two sorted arrays; beyond, rows and intervals meet in a join by
    the range of numbers both lie in, where a row finds one interval at most.  Null cells and those of another resolution are in none.
    """
    proper = F.shiftrightunsigned(F.col(cell), 52).bitwiseAND(F.lit(15)) == resolution
    number = F.when(proper, number_of(F.col(cell), resolution)[0])
    found = spans.limit(most + 1).select("lo", "hi")
    if found.count() <= most:
        table = found.toPandas().sort_values("lo")
        sent = rows.sparkSession.sparkContext.broadcast((table["lo"].to_numpy(np.int64), table["hi"].to_numpy(np.int64)))

        @F.arrow_udf("boolean")
        def held(numbers: pa.Array) -> pa.Array:
            lo, hi = sent.value
            x = numbers.fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(lo, x, "right") - 1
            return pa.array((at >= 0) & (x <= hi[at]) if len(lo) else np.zeros(len(x), bool))

        return rows.where(held(number))
    width = 7 ** (resolution - min(RANGE_RESOLUTION, resolution))
    new = [f"_{n}_{len(rows.columns)}" for n in ("number", "range", "lo", "hi")]
    right = spans.select(_div(F.col("lo"), width).alias(new[1]), F.col("lo").alias(new[2]), F.col("hi").alias(new[3]))
    left = rows.withColumn(new[0], number).withColumn(new[1], _div(F.col(new[0]), width))
    return left.join(right, (left[new[1]] == right[new[1]]) & (left[new[0]] >= right[new[2]]) & (left[new[0]] <= right[new[3]]), "left_semi").drop(*new[:2])


def cells_in(polygons: DataFrame, resolution: int, rings: str = "rings") -> DataFrame:
    """h3 of every cell with its middle in any of the polygons, each once; a polygon that holds no middle gives the cells of its outer ring's corners."""
    own = polygons.select(F.monotonically_increasing_id().alias("polygon"), F.col(rings).alias("rings"))
    cover = compact_cover(own, resolution)
    corners = own.join(cover.select("polygon").distinct(), "polygon", "left_anti").select(F.explode(F.element_at("rings", 1)).alias("p"))
    at = latlng_to_cell(F.col("p")[1], F.col("p")[0], resolution)
    cells = cover.select("cell").unionByName(corners.select(at.alias("cell")).where(F.col("cell").isNotNull()))
    return expanded(intervals(cells, resolution), resolution).select(cell_hex("cell").alias("h3"))


def covered_rows(rows: DataFrame, polygons: DataFrame, resolution: int, h3: str = "h3") -> DataFrame:
    """The rows whose cell, as text, has its middle in any of the polygons (polygon, rings)."""
    spans = intervals(compact_cover(polygons, resolution), resolution)
    name = f"_cell_{len(rows.columns)}"
    return inside(rows.withColumn(name, hex_cell(h3)), spans, resolution, name).drop(name)
