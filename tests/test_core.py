"""Functions, operators and sources of the core on small inputs with known results."""

import collections
import http.server
import json
import math
import re
import sqlite3
import struct
import threading
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hexspark.functions import geodesy, grid, scalar
from hexspark.operators import assess, catalog, chunks, completeness, cover, population, tiles, timeseries
from hexspark.sources import geotiff, gpkg

FEATURE = "bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>, sources array<struct<dataset:string>>"


def test_published_cells_and_base_cells():
    assert f"{grid.cells_of(np.array([37.3615593]), np.array([-122.0553238]), 7)[0]:x}" == "87283472bffffff"
    assert f"{grid.cells_of(np.array([37.7752702]), np.array([-122.4183073]), 9)[0]:x}" == "8928308280fffff"
    assert np.flatnonzero(grid._bases()[3]).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]


@pytest.mark.parametrize("res", [0, 1, 2, 5, 8, 15])
def test_middles_are_in_their_cells(res):
    rng = np.random.default_rng(res)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 20000))), rng.uniform(-180, 180, 20000)
    cells = np.unique(grid.cells_of(lat, lon, res))
    assert (grid.cells_of(*grid.centres_of(cells), res) == cells).all()
    if res <= 1:
        assert len(cells) == 2 + 120 * 7**res


def test_boundary_holds_the_middle():
    cell = grid.cells_of(np.array([27.7]), np.array([85.3]), 8)
    ring = grid.boundary_of(int(cell[0]))
    lat, lon = grid.centres_of(cell)
    assert len(ring) == 7 and cover.holds(lat, lon, cover.edges_of([ring])[0])[0]


def _polygons(spark, shapes):
    floats = [(i, [[[float(v) for v in p] for p in ring] for ring in rings]) for i, rings in enumerate(shapes)]
    return spark.createDataFrame(floats, "polygon long, rings array<array<array<double>>>")


def test_small_polygon_falls_back_to_its_corners(spark):
    ring = [[85.3, 27.7], [85.30001, 27.7], [85.30001, 27.70001], [85.3, 27.7]]
    want = f"{grid.cells_of(np.array([27.7]), np.array([85.3]), 8)[0]:x}"
    assert [r.h3 for r in cover.cells_in(_polygons(spark, [[ring]]), 8).collect()] == [want]
    with pytest.raises(ValueError):
        grid.cells_of(np.zeros(1), np.zeros(1), 16)


def _every(res):
    cells = cover._top()
    for _ in range(res):
        cells = cover.children_of(cells)
    return cells


SHAPES = {
    "box": [[[10, 40], [20, 40], [20, 50], [10, 50], [10, 40]]],
    "across the antimeridian": [[[179.5, -0.5], [-179.5, -0.5], [-179.5, 0.5], [179.5, 0.5]]],
    "large, with a hole": [[[-20, -30], [100, -40], [60, 70]], [[20, 0], [30, 0], [30, 10], [20, 10]]],
    "hole across": [[[160, -20], [-160, -20], [-160, 20], [160, 20]], [[175, -5], [-175, -5], [-175, 5], [175, 5]]],
    "pole": [[[0, 70], [90, 75], [180, 70], [-90, 65]]],
    "south pole": [[[0, -60], [-120, -80], [120, -70]]],
    "world": [[[-180, -60], [180, -60], [180, 84], [-180, 84]]],
    "many corners": [[[30 + (8 + (i % 2)) * np.cos(i / 200), 10 + (8 + (i % 2)) * np.sin(i / 200)] for i in range(1256)]],
}


@pytest.mark.parametrize("res", [1, 4])
def test_covers_equal_middles_in_polygons(spark, res):
    assert [len(_every(r)) for r in range(4)] == [2 + 120 * 7**r for r in range(4)]
    cells = _every(res)
    lat, lon = grid.centres_of(cells)
    want = {}
    for i, rings in enumerate(SHAPES.values()):
        edges, middle = cover.edges_of(rings)
        inside = np.zeros(len(cells), bool)
        x = (lon - middle + 180) % 360 - 180 + middle
        for x1, y1, x2, y2 in edges:  # edge by edge
            if y1 != y2:
                inside ^= ((y1 > lat) != (y2 > lat)) & (x < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)
        want[i] = set(cells[inside].tolist())
    spans = cover.intervals(cover.compact_cover(_polygons(spark, SHAPES.values()), res), res, "polygon")
    got = {i: set() for i in want}
    for r in cover.expanded(spans, res, "polygon").collect():
        assert r.cell not in got[r.polygon]
        got[r.polygon].add(r.cell)
    assert got == want
    # The degree at the antimeridian is about as many cells as one elsewhere.
    assert res == 1 or 0 < len(want[1]) < 20
    if res > 1:  # every shape holds a middle, so none falls back to its corners
        assert sorted(r.h3 for r in cover.cells_in(_polygons(spark, SHAPES.values()), res).collect()) == sorted({f"{c:x}" for i in want for c in want[i]})


def test_odd_polygons_cover_nothing(spark):
    nan = float("nan")
    rows = [(1, None), (2, []), (3, [[]]), (4, [None]), (5, [[[nan, 1.0], [2.0, nan]]]), (6, [[None, [1.0]]]), (None, [[[0.0, 0.0], [9.0, 0.0], [0.0, 9.0]]])]
    odd = spark.createDataFrame(rows, "polygon long, rings array<array<array<double>>>")
    assert cover.compact_cover(odd, 3).count() == 0
    line = cover.compact_cover(_polygons(spark, [[[[0, 0], [50, 0]]]]), 3)
    assert line.count() == 0 and cover.expanded(cover.intervals(line, 3), 3).count() == 0


@pytest.mark.parametrize("most", [cover.MOST_INTERVALS, 0])
@pytest.mark.parametrize("res", [2, 5])
def test_interval_join_equals_the_semi_join(spark, most, res):
    polygons = _polygons(spark, [SHAPES["across the antimeridian"], SHAPES["large, with a hole"], SHAPES["pole"], SHAPES["box"]])
    spans = cover.intervals(cover.compact_cover(polygons, res), res)
    cells = cover.expanded(spans, res)
    rng = np.random.default_rng(res)
    points = grid.cells_of(np.degrees(np.arcsin(rng.uniform(-1, 1, 3000))), rng.uniform(-180, 180, 3000), res).tolist()
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(points)] + [(-1, None), (-2, points[0] & ~(15 << 52) | (9 << 52)), (-3, points[0])], "lo long, cell long")
    want = rows.join(cells, "cell", "left_semi").select("lo", "cell").collect()
    got = cover.inside(rows, spans, res, most=most)
    assert got.columns == ["lo", "cell"] and sorted(got.collect()) == sorted(want) and len(want) > 100
    assert cover.inside(rows, spans.limit(0), res, most=most).count() == 0


def test_geodesic_length():
    # One degree of the equator and of a meridian, from the spheroid's closed forms.
    assert geodesy.inverse_m(*(np.array([x]) for x in (0.0, 0.0, 1.0, 0.0)))[0] == pytest.approx(111319.4908, abs=1e-3)
    assert geodesy.inverse_m(*(np.array([x]) for x in (0.0, 0.0, 0.0, 90.0)))[0] == pytest.approx(10001965.729, abs=1e-2)


@pytest.mark.parametrize(("line", "metres"), [
    ((-30, 0, 29.9, 179.8), 19989832.827610), ((0, 0, 0.5, 179.5), 19936288.579), ((0, 0, 0.5, 179.7), 19944127.421), ((90, 0, -90, 0), 20003931.4586), ((0, 0, 0, 180), 20003931.4586),
])
def test_published_lines_near_the_antipodes(line, metres):
    a, b, c, d = (np.array([float(x)]) for x in line)
    assert geodesy.inverse_m(b, a, d, c)[0] == pytest.approx(metres, abs=1e-3)
    assert geodesy.inverse_m(d, c, b, a)[0] == pytest.approx(metres, abs=1e-3)


def test_both_solvers_agree():
    rng = np.random.default_rng(1)
    lat1, lat2, lon = rng.uniform(-89, 89, 2000), rng.uniform(-89, 89, 2000), rng.uniform(0.01, 170, 2000)
    u1, u2 = (np.arctan((1 - geodesy._F) * np.tan(np.radians(x))) for x in (lat1, lat2))
    assert geodesy.antipodal_m(u1, u2, np.radians(lon)) == pytest.approx(geodesy.inverse_m(np.zeros(2000), lat1, lon, lat2), abs=1e-3)


def test_length_of_every_kind_of_shape():
    a, b = [(85.31, 27.71), (85.3105, 27.71)], [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    plain = [geodesy.line_wkb(a), geodesy.line_wkb(b), None, geodesy.line_wkb(a[:1])]
    multi = struct.pack("<BII", 1, 5, 2) + plain[0] + plain[1]
    high = struct.pack("<BII", 1, 1002, 2) + b"".join(struct.pack("<ddd", *p, 9.0) for p in a)
    swapped = struct.pack(">BII", 0, 2, 2) + b"".join(struct.pack(">dd", *p) for p in a)
    got = geodesy.length_m(pa.array([*plain, multi, high, swapped, struct.pack("<BIdd", 1, 1, 1.0, 2.0)], pa.binary()).slice(0)).to_pylist()
    first, second = got[0], got[1]
    assert first == pytest.approx(49.29, abs=0.05) and second == pytest.approx(111319.49 + 110574.39, abs=0.1)
    assert got[2:] == [None, 0.0, pytest.approx(first + second), pytest.approx(first), pytest.approx(first), 0.0]
    assert geodesy.length_m(pa.array([None, plain[0]], pa.binary()).slice(1)).to_pylist() == [pytest.approx(first, abs=1e-5)]


def test_exact_sums_equal_exact_arithmetic_under_any_partitioning(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(x * 10.0 ** rng.integers(-12, 18))) for g, x in zip(rng.integers(0, 40, 4000), rng.normal(size=4000), strict=True)]
    rows += [(90, None), (91, None), (91, -0.1), (92, 1e20), (92, 1.0), (92, -1e20), (93, 5e-20), (94, -1e-40), (95, float("inf")), (95, 1.0), (96, float("inf")), (96, float("-inf")), (97, float("nan"))]
    df = spark.createDataFrame(rows, "g int, x double")
    found = set()
    for way in (df.coalesce(1), df.repartition(4), df.repartition(211), df.orderBy("x"), df.orderBy(F.desc("x"))):
        got = {r.g: r.s for r in way.groupBy("g").agg(scalar.exact_sum("x").alias("s")).collect()}
        found.add(repr(sorted(got.items())))
    assert len(found) == 1
    for g in range(40):
        want = math.fsum(x for k, x in rows if k == g)
        assert abs(got[g] - want) <= np.spacing(abs(want))
    assert got[90] is None and got[91] == -0.1 and got[92] == 1.0 and got[93] == pytest.approx(5e-20) and got[94] == 0 and got[95] == float("inf")
    assert math.isnan(got[96]) and math.isnan(got[97])
    assert df.where("g = 90").agg(scalar.finite_sum("x")).first()[0] == 0.0
    with pytest.raises(Exception, match="range"):
        spark.createDataFrame([(1e36,)], "x double").agg(scalar.exact_sum("x")).collect()


def test_exact_sums_query_gives_no_task_a_fixed_share_of_the_table(spark):
    from hexspark.plans import queries

    plan = queries.QUERIES["exact_sums"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    repartitions = [x for x in plan.splitlines() if "Exchange" in x]
    assert len(repartitions) >= 3 and "SinglePartition" not in plan and "RoundRobinPartitioning(1)" not in plan
    assert min(int(n) for n in re.findall(r"(?:hash|range)partitioning\(.*?, (\d+)\), REPARTITION", plan)) >= min(211, int(spark.conf.get("spark.sql.shuffle.partitions")))


@pytest.mark.parametrize("res", [0, 1, 2, 3])
def test_boundaries_share_their_corners_and_fill_the_globe(res):
    cells = _every(res)
    lon, lat, bounds = grid.boundaries_of(cells)
    points, middle = grid._xyz(np.radians(lat), np.radians(lon)), grid._xyz(*(np.radians(x) for x in grid.centres_of(cells)))
    at, area = collections.Counter(), 0.0
    for i in range(len(cells)):
        ring = points[bounds[i] : bounds[i + 1]]
        a, b, m = ring[:-1], ring[1:], middle[i]
        assert (ring[0] == ring[-1]).all()
        part = 2 * np.arctan2(np.einsum("ij,j->i", np.cross(a, b), m), 1 + (a * b).sum(1) + a @ m + b @ m)
        assert (part > 0).all()  # the middle lies within
        area += part.sum()
        at.update(map(tuple, np.round(a, 9) + 0.0))
    assert area == pytest.approx(4 * np.pi, rel=1e-12)
    # Three cells meet at a corner, two at a point where an edge goes from face to face.
    assert set(at.values()) == ({2, 3} if res % 2 else {3})
    sizes = collections.Counter((np.diff(bounds) - 1).tolist())
    assert sizes[10 if res % 2 else 5] == 12 and (res % 2 or sizes[6] == len(cells) - 12)


def test_boundaries_of_many_cells(spark):
    cells = grid.cells_of(np.array([27.7, 52.5, -33.9]), np.array([85.3, 13.4, 151.2]), 8)
    rows = spark.createDataFrame([(int(c),) for c in cells] + [(None,)], "cell long")
    got = [r.ring for r in rows.coalesce(1).select(grid.cell_boundary("cell").alias("ring")).collect()]
    assert got == [grid.boundary_of(int(c)) for c in cells] + [None]


def test_rounding_is_by_scaled_doubles(spark):
    x = spark.createDataFrame([(997988.0499999999,), (None,), (2.25,)], "x double")
    con = duckdb.connect()
    got = [r[0] for r in x.select(scalar.rnd("x", 1)).collect()]
    assert got == [con.execute("select round(997988.0499999999::DOUBLE, 1)").fetchone()[0], None, 2.3]


def _features(spark):
    rows = [((85.31, 85.3101, 27.71, 27.7101), [("OpenStreetMap",)]), ((85.3102, 85.3103, 27.7102, 27.7103), [("OpenStreetMap",)]), ((85.3104, 85.3105, 27.7104, 27.7105), [("Microsoft",)])]
    line = geodesy.line_wkb([(85.31, 27.71), (85.3105, 27.71)])
    roads = [(bytearray(line), "road", [("OpenStreetMap",)], (85.31, 85.3105, 27.71, 27.7101)), (None, "road", None, (85.31, 85.3105, 27.71, 27.7101)), (bytearray(line), "rail", [("x",)], (85.31, 85.31, 27.71, 27.71))]
    b = spark.createDataFrame(rows, FEATURE)
    return b, spark.createDataFrame(roads, f"geometry binary, subtype string, sources array<struct<dataset:string>>, {FEATURE.split(', sources')[0]}")


def test_area_and_planet_agree(spark, tmp_path):
    b, r = _features(spark)
    b.write.parquet(f"{tmp_path}/b")
    r.write.parquet(f"{tmp_path}/r")
    out, dirs = f"file://{tmp_path}/out", (f"file://{tmp_path}/b", f"file://{tmp_path}/r")
    box = chunks.BoundingBox(85.30, 27.70, 85.32, 27.72)
    n = chunks.area_tiles(spark, box, *dirs, out)
    rows = spark.read.parquet(out)
    total = rows.agg(*(F.sum(c).alias(c) for c in ("bld_count", "bld_osm", "road_count", "road_osm", "road_len_m"))).first()
    assert tuple(total)[:4] == (3, 2, 2, 1) and total[4] == pytest.approx(49.3, abs=0.5)
    manifest = tiles.read_manifest(spark, out)
    assert n == rows.count() and set(manifest["tiles"]) == {x.h3_parent for x in rows.select("h3_parent").collect()}
    people = f"file://{tmp_path}/people"
    far = scalar.cell_hex(grid.latlng_to_cell(F.lit(52.5), F.lit(13.4), 8))
    spark.range(1).select(far.alias("h3"), F.lit(500.0).alias("population")).write.parquet(people)
    for _ in range(2):  # the second run finds its chunks done
        m = chunks.run_planet(spark, *dirs, f"{out}2", f"file://{tmp_path}/chunks", sources={"kontur": people}, lon_min=85, lon_max=86, lat_min=27, lat_max=28, lon_step=1, lat_step=0.5)
    two = spark.read.parquet(f"{out}2")
    assert m == n + 1 and two.where("population_kontur = 500 AND gap_score_kontur = 500 AND bld_count = 0 AND osm_pct IS NULL").count() == 1
    assert tiles.read_manifest(spark, f"{out}2")["populations"][0]["label"] == "Kontur Population"
    assert tiles.read_tiles(spark, out, list(manifest["tiles"]) + ["none"]).count() == n


def _scans(spark, run):
    """How many scans of Parquet files the jobs of run() have."""
    seen, write = [], chunks._write_chunks

    def counted(*args):
        seen.append(list(args[5]))
        return write(*args)

    chunks._write_chunks = counted
    try:
        run()
    finally:
        chunks._write_chunks = write
    return seen


def test_planet_in_one_scan_resumes_and_does_not_merge_a_part(spark, tmp_path):
    b, r = _features(spark)
    far = b.withColumn("bbox", F.struct(*((F.col(f"bbox.{c}") + (30.0 if c[0] == "y" else 0.0)).alias(c) for c in ("xmin", "xmax", "ymin", "ymax"))))
    b.unionByName(far).write.parquet(f"{tmp_path}/b")
    r.write.parquet(f"{tmp_path}/r")
    out, parts = f"file://{tmp_path}/out", f"file://{tmp_path}/parts"
    args, area = (spark, f"file://{tmp_path}/b", f"file://{tmp_path}/r", out, parts), dict(lon_min=80, lon_max=90, lat_min=20, lat_max=70, lon_step=5, lat_step=10)
    assert _scans(spark, lambda: chunks.run_planet(*args, **area)) == [list(range(10))]
    one = {x.h3: x for x in spark.read.parquet(out).collect()}
    whole = completeness.coverage(spark.read.parquet(args[1]), spark.read.parquet(args[2]), F.lit(True)).collect()
    assert {x.h3: (x.bld_count, x.bld_osm, x.road_count, x.road_len_m) for x in whole} == {h: (x.bld_count, x.bld_osm, x.road_count, x.road_len_m) for h, x in one.items()} and len(one) > 1
    assert sorted(p.name for p in (tmp_path / "parts").glob("chunk=*")) == ["chunk=1", "chunk=7"]
    assert _scans(spark, lambda: chunks.run_planet(*args, **area)) == []  # all done
    (tmp_path / "parts" / "done_0007.json").unlink()
    assert _scans(spark, lambda: chunks.run_planet(*args, **area)) == [[7]]
    assert {x.h3 for x in spark.read.parquet(out).collect()} == set(one)
    # Files that changed are read again; of other parameters nothing stays.
    b.write.mode("overwrite").parquet(f"{tmp_path}/b")
    assert _scans(spark, lambda: chunks.run_planet(*args, **area)) == [list(range(10))]
    assert [p.name for p in (tmp_path / "parts").glob("chunk=*")] == ["chunk=1"]
    # An input that cannot be read: nothing is merged, and a rerun resumes with what failed.
    (tmp_path / "b" / "broken.parquet").write_bytes(b"PAR1 this is no footer PAR1")
    (tmp_path / "none").mkdir()
    for bad in (args[1], f"file://{tmp_path}/missing"):
        tried = []
        with pytest.raises(RuntimeError, match="10 of 10 chunks failed and were not merged"):
            tried = _scans(spark, lambda: chunks.run_planet(spark, bad, args[2], f"{out}-bad", f"{parts}-bad", **area)) or tried  # noqa: B023
        assert not (tmp_path / "out-bad").exists()


def test_chunks_that_can_be_read_are_done_when_others_fail(spark, tmp_path, monkeypatch):
    b, r = _features(spark)
    b.write.parquet(f"{tmp_path}/b")
    r.write.parquet(f"{tmp_path}/r")
    write, calls = chunks._write_chunks, []

    def flaky(*args):
        calls.append(list(args[5]))
        if 3 in args[5]:
            spark.read.parquet(f"file://{tmp_path}/gone").count()
        return write(*args)

    monkeypatch.setattr(chunks, "_write_chunks", flaky)
    args, area = (spark, f"file://{tmp_path}/b", f"file://{tmp_path}/r", f"file://{tmp_path}/out", f"file://{tmp_path}/parts"), dict(lon_min=80, lon_max=90, lat_min=20, lat_max=40, lon_step=5, lat_step=10)
    with pytest.raises(RuntimeError, match="1 of 4 chunks failed"):
        chunks.run_planet(*args, **area)
    assert calls == [[0, 1, 2, 3], [0, 1], [2, 3], [2], [3]] and not (tmp_path / "out").exists()
    monkeypatch.setattr(chunks, "_write_chunks", write)
    assert _scans(spark, lambda: chunks.run_planet(*args, **area)) == [[3]] and (tmp_path / "out").exists()
    with pytest.raises(ZeroDivisionError):  # not an input that cannot be read
        monkeypatch.setattr(chunks, "_write_chunks", lambda *_: 1 // 0)
        chunks.run_planet(*args[:4], f"{args[4]}2", **area)


def test_boxes():
    boxes = chunks.chunk_boxes(-180, 180, -60, 84, 360, 12)
    assert len(boxes) == 12 and boxes[0] == chunks.BoundingBox(-180, -60, 180, -48) and boxes[-1].north == 84
    for bad in ((85.4, 27.7, 85.3, 27.8), (85.3, 27.8, 85.4, 27.7)):
        with pytest.raises(ValueError):
            chunks.BoundingBox(*bad)
    with pytest.raises(ValueError):
        chunks.chunk_boxes(0, 1, 0, 1, 0, 1)


def test_partials_of_a_border_cell_sum(spark):
    parts = spark.createDataFrame([("8abc", None, 3, 2, 3, 2, 1.0), ("8abc", "82", 5, 1, 5, 1, float("nan"))], "h3 string, h3_parent string, bld_count long, bld_osm long, road_count long, road_osm long, road_len_m double")
    row = completeness.shares(completeness.merge_partials(parts)).first()
    assert (row.h3_parent, row.bld_count, row.bld_osm, row.osm_pct, row.road_len_m) == ("82", 8, 3, 37.5, 1.0)


def test_gap_and_duplicates(spark):
    cells = spark.createDataFrame([("a1", "82", 10, 5, 0, 0, 0.0)], "h3 string, h3_parent string, bld_count long, bld_osm long, road_count long, road_osm long, road_len_m double")
    people = spark.createDataFrame([("a1", 1000.0), ("a1", 2.0)], "h3 string, population double")
    assert sorted(r.gap_score_p for r in population.attach(cells, {"p": people}).collect()) == [1.0, 500.0]
    assert population.duplicates(people).collect() == [("a1", 2)]


def _lzw(data):
    """Codes as TIFF packs them, made the plain way: a growing table, highest bit first, widths one code early."""
    bits, table, width, text = "", {bytes([i]): i for i in range(256)}, 9, b""
    bits += f"{256:09b}"
    size = 258
    for byte in data:
        more = text + bytes([byte])
        if more in table:
            text = more
            continue
        bits += f"{table[text]:0{width}b}"
        table[more], size = size, size + 1
        if size + 1 > 1 << width:
            width += 1
        if size >= 4094:
            bits += f"{256:0{width}b}"
            table, width, size = {bytes([i]): i for i in range(256)}, 9, 258
        text = bytes([byte])
    if text:
        bits += f"{table[text]:0{width}b}"
        size += 1
        if size + 1 > 1 << width and width < 12:
            width += 1
    bits += f"{257:0{width}b}"
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def _tiff(path, value, order="<", packing=1, big=False, predictor=1):
    """A raster of one row; value: a number or a row of them."""
    row = np.atleast_1d(np.array(value, order + "f4"))
    data = row.tobytes()
    if predictor == 2:
        whole = row.view(order + "u4").astype(np.uint32)
        data = np.diff(whole, prepend=np.uint32(0)).astype(order + "u4").tobytes()
    if predictor == 3:
        planes = np.frombuffer(row.astype(">f4").tobytes(), np.uint8).reshape(-1, 4).T.ravel()
        data = np.diff(planes, prepend=np.uint8(0)).tobytes()
    data = zlib.compress(data) if packing == 8 else _lzw(data) if packing == 5 else data
    tags = [(256, 3, 1, len(row)), (257, 3, 1, 1), (258, 3, 1, 32), (259, 3, 1, packing), (273, 4, 1, 0), (277, 3, 1, 1), (278, 3, 1, 1), (279, 4, 1, len(data)), (317, 3, 1, predictor), (339, 3, 1, 3), (33550, 12, 3, (0.01, 0.01, 0)), (33922, 12, 6, (0, 0, 0, 85.30, 27.72, 0)), (42113, 2, 7, b"-99999\0")]
    word, number, start = ("Q", "Q", 16) if big else ("I", "H", 8)
    width = struct.calcsize(word)
    at = start + struct.calcsize(number) + (4 + 2 * width) * len(tags) + width
    body, entries = b"", []
    place = at + sum(len(v) if kind == 2 else 8 * n for _, kind, n, v in tags if kind in (2, 12) and (len(v) if kind == 2 else 8 * n) > width)
    for tag, kind, n, v in tags:
        raw = v if kind == 2 else struct.pack(order + {12: "d", 3: "H", 4: "I"}[kind] * n, *(v if kind == 12 else (place if tag == 273 else v,)))
        if len(raw) > width:
            raw, body = struct.pack(order + word, at + len(body)), body + raw
        entries.append(struct.pack(order + "HH" + word, tag, kind, n) + raw.ljust(width, b"\0"))
    head = struct.pack(order + "HHHQ", 43, 8, 0, 16) if big else struct.pack(order + "HI", 42, 8)
    path.write_bytes((b"II" if order == "<" else b"MM") + head + struct.pack(order + number, len(tags)) + b"".join(entries) + struct.pack(order + word, 0) + body + data)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("packing", [1, 5, 8])
@pytest.mark.parametrize("predictor", [1, 2, 3])
@pytest.mark.parametrize("big", [False, True])
def test_kinds_of_rasters(tmp_path, order, packing, predictor, big):
    row = np.array([1.5, 2.25, -99999.0, 0.0, 7.0, 7.0] * 40, "f4")
    _tiff(tmp_path / "a.tif", row, order, packing, big, predictor)
    lon, lat, value = geotiff.Raster(str(tmp_path / "a.tif")).pixels(0)
    assert value.tolist() == row[row > 0].tolist() and lon[0] == pytest.approx(85.305) and lat[0] == pytest.approx(27.715)
    with (tmp_path / "a.tif").open("rb") as source:
        raster = geotiff.Raster("a", source)
        assert [raster.pixels(0)[2].tolist() for _ in range(2)] == [value.tolist()] * 2


def test_lzw_of_long_and_random_data():
    rng = np.random.default_rng(1)
    for data in (b"", b"a", b"ab" * 9000, rng.integers(0, 256, 20000, dtype=np.uint8).tobytes(), rng.integers(0, 3, 60000, dtype=np.uint8).tobytes()):
        assert geotiff.unpacked_lzw(_lzw(data)) == data
    with pytest.raises(ValueError):
        geotiff.unpacked_lzw(b"\xff\xff\xff\xff")


def _tiff_of_rows(path, band):
    """A plain GeoTIFF with a strip for each row."""
    high, wide = band.shape
    data = band.astype("<f4").tobytes()
    text = b"-99999\0\0"
    doubles = struct.pack("<3d", 0.01, 0.01, 0.0) + struct.pack("<6d", 0, 0, 0, 85.3, 27.72, 0)
    at = 8 + len(data)
    offsets, counts = struct.pack(f"<{high}I", *(8 + 4 * wide * i for i in range(high))), struct.pack(f"<{high}I", *[4 * wide] * high)
    places = {"o": at, "c": at + len(offsets), "s": at + len(offsets) + len(counts), "t": at + len(offsets) + len(counts) + 24, "n": at + len(offsets) + len(counts) + 72}
    tags = [(256, 4, 1, wide), (257, 4, 1, high), (258, 3, 1, 32), (259, 3, 1, 1), (262, 3, 1, 1), (273, 4, high, places["o"]), (277, 3, 1, 1), (278, 4, 1, 1), (279, 4, high, places["c"]),
            (339, 3, 1, 3), (33550, 12, 3, places["s"]), (33922, 12, 6, places["t"]), (42113, 2, len(text), places["n"])]
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0)
    path.write_bytes(struct.pack("<2sHI", b"II", 42, places["n"] + len(text)) + data + offsets + counts + doubles + text + ifd)


def test_rasters_to_series(spark, tmp_path):
    for n, (iso, year, v) in enumerate([("aaa", 2025, 100.0), ("bbb", 2025, 40.0), ("aaa", 2024, 999.0), ("ccc", 2025, -99999.0)]):
        _tiff(tmp_path / f"{iso}_pop_{year}_CN_1km_R2025A_UA_v1.tif", v, "<>"[n % 2], 8 if n % 2 else 1)
    cells = timeseries.year_cells(geotiff.read_year(spark, str(tmp_path), 2025), 2025)
    assert [(r.year, r.pop) for r in cells.collect()] == [(2025, 140.0)]
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*_pop_2025_*.tif").load(f"file://{tmp_path}")
    assert sorted(r.pop for r in geotiff.read_stored(stored).collect()) == [40.0, 100.0]
    assert geotiff.read_year(spark, f"file://{tmp_path}", 2024).count() == 1 and geotiff.remote("s3a://x/y") and not geotiff.remote("/x")
    with pytest.raises(FileNotFoundError):
        geotiff.read_year(spark, str(tmp_path), 1999)
    scratch, out = f"file://{tmp_path}/scratch", f"file://{tmp_path}/wide"
    cells.write.parquet(f"{scratch}/ts_2025.parquet")
    with pytest.raises(FileNotFoundError, match="2026"):
        timeseries.write_series(spark, scratch, out, [2025, 2026])
    assert timeseries.write_series(spark, scratch, out, [2025]) == 1
    manifest = tiles.read_manifest(spark, out)
    assert manifest["years"] == [2025] and manifest["cells"] == 1 and len(manifest["tiles"]) == 1


def test_stored_rasters_are_read_by_ranges(spark, tmp_path):
    """A raster of many blocks is read by several tasks, from wherever executors can open it."""
    rng = np.random.default_rng(2)
    band = np.where(rng.random((40, 30)) < 0.5, rng.random((40, 30)), -99999.0).astype("<f4")
    path = tmp_path / "deep" / "aaa_pop_2025_CN_1km_R2025A_UA_v1.tif"
    path.parent.mkdir()
    _tiff_of_rows(path, band)
    (tmp_path / "deep" / "bbb_pop_2024.tif").write_bytes(path.read_bytes())
    (tmp_path / "deep" / "note.tif").write_bytes(b"")
    assert geotiff.years_of(spark, f"file://{tmp_path}") == [2024, 2025]
    files = geotiff.listed(spark, f"file://{tmp_path}").where("year = 2025")
    got = geotiff.read_ranges(files, 4)
    want = sorted((85.3 + (c + 0.5) * 0.01, 27.72 - (r + 0.5) * 0.01, float(band[r, c])) for r, c in zip(*np.nonzero(band > 0), strict=True))
    assert np.array(sorted(map(tuple, got.collect()))) == pytest.approx(np.array(want))
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    assert geotiff.read_year(spark, str(tmp_path), 2025).count() == len(want)
    assert not geotiff.seekable("unheard-of://x/y.tif")


def test_geojson_files_as_tables(spark, tmp_path):
    box = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    features = [
        {"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Polygon", "coordinates": [box, box]}},
        {"type": "Feature", "properties": None, "geometry": None},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[box], [box, box]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "geometry": {"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": [[[1, 2], [3, 4, 5], [1, 2]]]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]}},
    ]
    for name, text in {"a.json": json.dumps({"type": "FeatureCollection", "features": features}, indent=1), "b.json": json.dumps(features[0]["geometry"]), "c.json": "no json", "d.json": " "}.items():
        (tmp_path / name).write_text(text)
    polygons, other = assess.read_geojson(spark, f"file://{tmp_path}/*.json")
    rows = sorted(polygons.collect(), key=lambda r: (r.source, r.feature, r.part))
    assert [(r.feature, r.part, len(r.rings), r.properties) for r in rows] == [(0, 0, 2, '{"a":1}'), (2, 0, 1, None), (2, 1, 2, None), (4, 0, 1, None), (0, 0, 2, None)]
    assert rows[3].rings == [[[1.0, 2.0], [3.0, 4.0, 5.0], [1.0, 2.0]]] and {r.type: r.n for r in other.collect()} == {"Point": 1, "LineString": 1, "invalid": 1}
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.ndjson").write_text("\n".join(json.dumps(f) for f in features * 300))
    polygons, other = assess.read_geojson(spark, f"file://{tmp_path}/lines", lines=True)
    assert polygons.count() == 1200 and {r.type: r.n for r in other.collect()} == {"Point": 300, "LineString": 300}
    assert polygons.select("line").distinct().count() == 900
    dicts, kinds = assess.polygons_of({"type": "FeatureCollection", "features": features[:4]})
    assert len(dicts) == 3 and kinds == {"Point"}


def test_export_is_one_file_of_all_rows(spark, tmp_path):
    cells = spark.createDataFrame([(f"{c:x}", i) for i, c in enumerate(_every(1))], "h3 string, n int")
    for rows in (cells.repartition(7), cells.limit(0), cells.coalesce(1).where("n = 5")):
        out = tmp_path / "area.json"
        assert assess.export(rows, f"file://{out}") == rows.count()
        read = json.loads(out.read_text())
        assert read["type"] == "FeatureCollection" and sorted(f["properties"]["n"] for f in read["features"]) == sorted(r.n for r in rows.collect())
        assert json.loads(assess.collection(rows))["features"].__len__() == rows.count()
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["area.json"]


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "p.gpkg")
    with sqlite3.connect(path) as db:
        db.executescript("CREATE TABLE gpkg_contents (table_name TEXT); INSERT INTO gpkg_contents VALUES ('people'); CREATE TABLE people (fid INTEGER PRIMARY KEY, h3 TEXT, population REAL);")
        db.executemany("INSERT INTO people (h3, population) VALUES (?, ?)", [("a", 1.4), ("a", 1.2), ("b", None)])
    stored = gpkg.read_stored(spark.read.format("binaryFile").load(f"file://{path}"))
    for rows in (gpkg.read_gpkg(spark, path), gpkg.read_gpkg(spark, f"file://{path}", "people"), stored):
        assert sorted(map(tuple, population.by_cell(rows).collect())) == [("a", 3.0), ("b", None)]


AREA = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": None}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[85.29, 27.67], [85.37, 27.67], [85.37, 27.74], [85.29, 27.74], [85.29, 27.67]]]]}}]}


def test_assessment(spark):
    cells = assess.covered(spark, AREA)
    assert 70 < cells.count() < 95
    rows = cells.limit(3).withColumns({"bld_count": F.lit(4), "bld_osm": F.lit(1), "osm_pct": F.lit(25.0), "road_count": F.lit(0), "road_pct": F.lit(None).cast("double"), "road_len_m": F.lit(500.0), "population_p": F.lit(10.0)})
    rows = assess.tile_rows(rows, ["p"])
    got = assess.summary(assess.inside(rows, cells), "population_p", "gap_score_p").first()
    assert (got.cells, got.bld_count, got.osm_pct, got.road_pct, got.km, got.people, got.gap) == (3, 12, 25.0, None, 1.5, 30.0, 0.0)
    assert assess.empty_cells(cells, rows).count() == cells.count() - 3
    t = assess.coloured(assess.scaled(rows, "population", F.col("population_p")), "gap_score").first()
    assert (t.r, t.g, t.b) == (215, 48, 39)  # flipped: the most is the worst
    assert json.loads(assess.collection(rows))["features"][0]["geometry"]["type"] == "Polygon"
    with pytest.raises(ValueError, match="Point"):
        assess.covered(spark, {"type": "Point", "coordinates": [0, 0]})
    with pytest.raises(ValueError):
        assess.view_polygon(0, 0, 10, 10)
    assert assess.selected_year([2015, 2025, 2030]) == 2025 and assess.selected_year([2015]) == 2015
    assert assess.sparkline([1.0, 1.0])[0] == (5.0, 22.0)


def _asset(iso, year, release="R2025A"):
    return iso, year, release, f"https://x.org/{iso}_pop_{year}_CN_1km_{release}_UA_v1.tif"


LISTING = "iso string, year int, release string, href string"


def test_catalogue_checks(spark, tmp_path):
    rows = spark.createDataFrame([_asset(i, y) for i in ("npl", "btn") for y in (2025, 2026)] + [_asset("npl", 2020, "R2024A")], LISTING)
    plan = catalog.refresh_plan(rows, {"release": "R2025A", "years": [2025, 2026]})
    assert (plan["release"], plan["years"], list(plan["assets"]["2025"]), plan["needs_update"]) == ("R2025A", [2025, 2026], ["btn", "npl"], False)
    for before in ({"release": "R2025A", "years": [2025]}, {"release": "R2024A", "years": [2025, 2026]}, {}):
        assert catalog.refresh_plan(rows, before)["needs_update"]
    for found, why in (([], "listed"), ([_asset("npl", 2025, "R2026A"), _asset("btn", 2025)], "R2026A"), ([_asset("npl", 2025), _asset("npl", 2026), _asset("btn", 2025)], "every year")):
        with pytest.raises(RuntimeError, match=why):
            catalog.refresh_plan(spark.createDataFrame(found, LISTING), {})
    catalog.save_plan(spark, plan, f"file://{tmp_path}/plan.json")
    assert catalog.load_plan(spark, f"file://{tmp_path}/plan.json") == plan
    with pytest.raises(FileNotFoundError):
        catalog.load_plan(spark, f"file://{tmp_path}/none.json")


class _Service(http.server.BaseHTTPRequestHandler):
    """A small catalogue: one country, two pages; the first search of all is dropped."""

    dropped, bodies = [], []

    def _say(self, answer):
        data = answer if isinstance(answer, bytes) else json.dumps(answer).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def do_GET(self):
        if self.path.startswith("/gone/"):
            self.send_error(404)
        elif self.path.endswith(".tif"):
            self._say(b"x" * 3_000_000)
        elif self.path == "/part/collections":
            self._say({"collections": [{"id": "npl"}], "numberReturned": 1, "numberMatched": 2})
        elif self.path == "/collections":
            self._say({"collections": [{"id": "npl"}], "numberReturned": 1, "numberMatched": 1})
        else:
            self.send_error(404)

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if not self.dropped:
            self.dropped.append(1)
            self.connection.close()
            return
        self.bodies.append(body)
        second = body.get("page") == 2
        item = {"id": f"npl_pop_{2026 if second else 2025}_CN_1km_R2025A_UA_v1", "assets": {"data": {"href": "h"}}}
        links = [] if second else [{"rel": "self"}, {"rel": "next", "body": {"page": 2}}]
        self._say({"features": [item, {"id": "npl_pop_2025_CN_100m_R2025A_v1", "assets": {}}], "links": links})

    def log_message(self, *_):
        pass


def test_service_is_listed_and_fetched(spark, tmp_path):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base, client = f"http://127.0.0.1:{server.server_port}", catalog.WebClient(5)
    try:
        rows = catalog.listing(spark, client, base)
        assert sorted(map(tuple, rows.collect())) == [("npl", 2025, "R2025A", "h"), ("npl", 2026, "R2025A", "h")]
        assert _Service.bodies[0]["collections"] == ["npl"] and _Service.bodies[1] == {"page": 2} and len(_Service.bodies) == 2
        with pytest.raises(RuntimeError, match="part of the"):
            catalog.countries(client, f"{base}/part")
        with pytest.raises(RuntimeError, match="404"):
            client.ask(f"{base}/none")
        name = "npl_pop_2025_CN_1km_R2025A_UA_v1.tif"
        store = f"file://{tmp_path}/in"
        assert catalog.fetch(spark, client, [f"{base}/{name}"], store) == 1 and [p.name for p in (tmp_path / "in").iterdir()] == [name]
        assert catalog.fetch(spark, client, [f"{base}/{name}"], store) == 0  # it is there
        with pytest.raises(Exception, match="404"):
            catalog.fetch(spark, client, [f"{base}/gone/{name.replace('2025', '2019', 1)}"], store)
        assert [p.name for p in (tmp_path / "in").iterdir()] == [name]
        assert (tmp_path / "in" / name).stat().st_size == 3_000_000
        for bad in (f"{base}/evil.tif", f"{base}/{name}.sh"):
            with pytest.raises(ValueError):
                catalog.fetch(spark, client, [bad], f"file://{tmp_path}/out")
        assert not (tmp_path / "out").exists()
    finally:
        server.shutdown()


def test_attempts_end():
    tries = []

    def broken():
        tries.append(1)
        raise OSError("dropped")

    with pytest.raises(OSError):
        catalog.patiently(broken, (0.0, 0.0))
    assert len(tries) == 3 and catalog.patiently(lambda: 5) == 5


def test_publishing(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    (a / "h3_parent=82").mkdir(parents=True)
    (a / "h3_parent=82/x.parquet").write_text("1")
    (a / "_SUCCESS").write_text("")
    tiles_at, store = f"file://{a}", catalog.Store(spark, f"file://{b}/within/it/")
    with pytest.raises(FileNotFoundError):
        catalog.publish(store, tiles_at)
    with pytest.raises(FileNotFoundError):
        store.manifest()
    (a / "manifest.json").write_text('{"release": "r"}')
    (b / "within/it/h3_parent=83").mkdir(parents=True)
    (b / "within/it/h3_parent=83/old.parquet").write_text("0")
    (b / "within/it/readme").write_text("stays")
    assert store.manifest() == {}
    with pytest.raises(RuntimeError, match="2 files"):
        catalog.verify(store, tiles_at)
    assert catalog.publish(store, tiles_at, "h3_parent=*/*") == 1
    catalog.verify(store, tiles_at)
    assert store.files() == {"manifest.json", "readme", "h3_parent=82/x.parquet"} and store.manifest()["release"] == "r"


def test_publishing_moves_only_what_changed(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"{c:x}", f"{c % 3}", float(c % 7)) for c in range(60)], "h3 string, h3_parent string, v double")
    store = catalog.Store(spark, f"file://{tmp_path}/to")

    def build(name, rows):
        tiles.write_tiles(rows, f"file://{tmp_path}/{name}")
        tiles.write_manifest(spark, f"file://{tmp_path}/{name}", 8, 2)
        return f"file://{tmp_path}/{name}"

    def read():
        return sorted(map(tuple, tiles.read_tiles(spark, store.root, ["0", "1", "2"]).select("h3", "v").collect()))

    one = build("one", rows)
    assert catalog.publish(store, one, "h3_parent=*/*") == 3 and catalog.publish(store, one, "h3_parent=*/*") == 0
    first, files = store.manifest(), store.files()
    # Built again, the files have other names and the same bytes, but for one tile.
    two = build("two", rows.withColumn("v", F.expr("CASE WHEN h3_parent = '1' THEN v + 1 ELSE v END")))
    monkeypatch.setattr(catalog, "copy_file", lambda *_: 1 / 0)
    put = store.put_all
    monkeypatch.setattr(store, "put_all", lambda names: (_ for _ in ()).throw(OSError("the store is gone")))
    with pytest.raises(OSError, match="gone"):
        catalog.publish(store, two, "h3_parent=*/*")
    assert store.manifest() == first and store.files() == files and read() == sorted((r.h3, r.v) for r in rows.collect())
    monkeypatch.setattr(store, "put_all", put)
    monkeypatch.undo()
    assert catalog.publish(store, two, "h3_parent=*/*") == 1
    now = store.manifest()
    assert [now["tiles"][p] == first["tiles"][p] for p in "012"] == [True, False, True] and len(store.files()) == 4
    assert read() == sorted((r.h3, r.v + (r.h3_parent == "1")) for r in rows.collect())
    catalog.verify(store, two)
    with pytest.raises(RuntimeError, match="1 files"):
        catalog.verify(store, one)
    # A published file that was spoilt is told by its bytes.
    (tmp_path / "to" / now["tiles"]["0"]).write_bytes(b"spoilt")
    assert len(catalog.unpublished(store, two)) == 1
    monkeypatch.setattr(catalog, "seekable", lambda path: False)  # through the driver
    assert catalog.publish(catalog.Store(spark, f"file://{tmp_path}/other"), two) == 3


def test_commands(spark, tmp_path):
    """A refresh from a listing to published tiles, as a user would run it."""
    from hexspark import cli

    rasters = tmp_path / "in"
    rasters.mkdir()
    for iso, value in (("aaa", 100.0), ("bbb", 40.0)):
        _tiff(rasters / f"{iso}_pop_2025_CN_1km_R2025A_UA_v1.tif", value)
    (tmp_path / "assets.json").write_text(json.dumps([_asset("aaa", 2025), _asset("bbb", 2025)]))
    (tmp_path / "published").mkdir()
    (tmp_path / "scratch").mkdir()
    at = f"file://{tmp_path}"
    parse = cli.parser().parse_args
    run = lambda *args: (lambda a: a.run(spark, a))(parse(list(args)))
    said = json.loads(run("refresh-plan", "--published", f"{at}/published", "--out", f"{at}/plan.json", "--assets", f"{tmp_path}/assets.json"))
    assert said == {"release": "R2025A", "years": [2025], "needs_update": True}
    assert run("refresh-year", "--rasters", str(rasters), "--out-dir", f"{at}/scratch", "--year", "2025") == "1 cells"
    assert run("refresh-publish", "--plan", f"{at}/plan.json", "--scratch-dir", f"{at}/scratch", "--tiles", f"{at}/tiles", "--to", f"{at}/published") == "built 1 cells, release R2025A"
    again = json.loads(run("refresh-plan", "--published", f"{at}/published", "--out", f"{at}/plan.json", "--assets", f"{tmp_path}/assets.json"))
    assert again["needs_update"] is False and spark.read.parquet(f"{at}/published").count() == 1


def test_sessions_and_where_the_features_are(spark):
    """Settings reach the session; the globs of a release are those of a store that its files system reads."""
    from hexspark import config, session

    same = session.session(threads=2, memory_limit="1g", temp_dir="/tmp/x", region="eu-west-1", **{"spark__sql__shuffle__partitions": spark.conf.get("spark.sql.shuffle.partitions")})
    assert same.conf.get("spark.hadoop.fs.s3a.endpoint.region") == "eu-west-1" and same.conf.get("spark.sql.adaptive.enabled") == "true"
    buildings, segments = config.feature_paths("2026-01-01.0")
    assert buildings.startswith("s3a://") and buildings.endswith("/2026-01-01.0/theme=buildings/type=building/*.parquet") and "type=segment" in segments


def test_named_paths():
    from hexspark.cli import named_paths

    assert named_paths(["a=x=y", "b=2", "a=3"]) == {"a": "3", "b": "2"} and named_paths(None) == {}
    for bad in ("a", "=x", "a="):
        with pytest.raises(ValueError):
            named_paths([bad])


def test_queries_equal_their_sql(spark):
    import math

    from hexspark.plans import queries

    con, d = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("customer", "supplier", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")

    def rows(df):
        df = df[sorted(df.columns)]
        plain = [tuple(None if x is None or (isinstance(x, float) and math.isnan(x)) else float(x) if isinstance(x, (int, float)) else str(x) for x in r) for r in df.itertuples(index=False)]
        return sorted(df.columns), sorted(plain, key=str)

    for name, sql in queries.SQL.items():
        assert rows(queries.QUERIES[name](spark, d).toPandas()) == rows(con.execute(sql).df()), name


def test_stream_sums(spark, tmp_path):
    from hexspark.streaming.binning import running_cells

    spark.createDataFrame([(85.3, 27.7, 2.0), (85.3, 27.7, 3.0), (85.3, 27.7, -1.0)], "lon double, lat double, pop double").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("lon double, lat double, pop double").parquet(f"{tmp_path}/in")
    q = running_cells(stream, 8).writeStream.outputMode("complete").format("memory").queryName("cells").start()
    q.processAllAvailable()
    q.stop()
    assert [r.pop for r in spark.table("cells").collect()] == [5.0]
