"""Areas: boxes, their division into chunks, and the resumable run over a planet."""

from __future__ import annotations

import hashlib
import json
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark import config
from hexspark.functions.scalar import in_closed_box, in_half_open_box
from hexspark.operators import completeness, population, tiles


@dataclass(frozen=True)
class BoundingBox:
    west: float
    south: float
    east: float
    north: float

    def __post_init__(self) -> None:
        if not (self.west < self.east and self.south < self.north):
            raise ValueError(f"degenerate box: {self}")


def chunk_boxes(lon_min: float, lon_max: float, lat_min: float, lat_max: float, lon_step: float, lat_step: float) -> list[BoundingBox]:
    """Boxes in rows from the south, each from the west, cut off at the upper ends."""
    if lon_step <= 0 or lat_step <= 0:
        raise ValueError("steps must be positive")

    def edges(low: float, high: float, step: float) -> list[tuple[float, float]]:
        out = []
        while low < high:
            out.append((low, min(low + step, high)))
            low += step  # sums of steps, so that edges agree to the last bit from run to run
        return out

    return [BoundingBox(w, s, e, n) for s, n in edges(lat_min, lat_max, lat_step) for w, e in edges(lon_min, lon_max, lon_step)]


def area_tiles(spark: SparkSession, box: BoundingBox, buildings: str, segments: str, out: str, resolution: int = config.CELL_RESOLUTION, parent: int = config.PARENT_RESOLUTION, release: str = config.RELEASE) -> int:
    """Coverage tiles of one box; number of cells."""
    rows = completeness.coverage(spark.read.parquet(buildings), spark.read.parquet(segments), in_closed_box(*astuple(box)), resolution, parent)
    count = tiles.write_tiles(rows, out)
    tiles.write_manifest(spark, out, resolution, parent, release)
    return count


def merge_tiles(spark: SparkSession, chunk_dir: str, out: str, resolution: int, parent: int, sources: dict[str, str] | None = None, release: str = config.RELEASE) -> int:
    """Sum the partials under chunk_dir and write tiles with the given populations; number of cells."""
    found = [p for pattern in ("chunk=*", "chunk_*.parquet") for p in tiles.matching(spark, f"{chunk_dir}/{pattern}")]
    parts = spark.read.schema(PARTIALS).parquet(*found) if found else spark.createDataFrame([], PARTIALS)
    people = {n: spark.read.parquet(p).select("h3", "population") for n, p in (sources or {}).items()}
    count = tiles.write_tiles(population.attach(completeness.merge_partials(parts), people, parent), out)
    tiles.write_manifest(spark, out, resolution, parent, release, list(people))
    return count


PARTIALS = "h3 string, h3_parent string, bld_count long, bld_osm long, road_count long, road_osm long, road_len_m double"


def run_planet(
    spark: SparkSession, buildings: str, segments: str, out: str, chunk_dir: str, resolution: int = config.CELL_RESOLUTION, parent: int = config.PARENT_RESOLUTION,
    sources: dict[str, str] | None = None, release: str = config.RELEASE, **area: float,
) -> int:
    """Partials of all chunks in one scan, a partition of chunk_dir each, then tiles.

    A chunk whose marker tells of the same box, parameters and input files is done and skipped on a rerun; the others are computed together.
    If input cannot be read, the chunks are halved until those that need it stand alone, so that the rest are done; if any
    failed nothing is merged, as tiles of a part would look whole.  A partition is replaced whole by Spark's own commit; a chunk without features has
    a marker alone.
    """
    boxes = chunk_boxes(**{**config.PLANET, **area})
    inputs = [tiles.signature(spark, path) for path in (buildings, segments)]
    prints = [hashlib.sha256(json.dumps([astuple(box), resolution, parent, buildings, segments, *inputs]).encode()).hexdigest() for box in boxes]

    def marker(n: int) -> str:
        return f"{chunk_dir}/done_{n:04d}.json"

    def attempt(todo: list[int]) -> list[int]:
        """The chunks of todo that failed."""
        try:
            _write_chunks(spark, buildings, segments, chunk_dir, boxes, todo, resolution, parent)
        except Exception as error:  # an input that cannot be read; anything else is raised
            if not _is_input_error(error):
                raise
            half = len(todo) // 2
            return attempt(todo[:half]) + attempt(todo[half:]) if half else todo
        for n in todo:
            tiles.write_text(spark, marker(n), prints[n])
        return []

    todo = [n for n, p in enumerate(prints) if tiles.read_text(spark, marker(n)) != p]
    for n in todo:  # of other parameters
        tiles.remove(spark, marker(n))
        tiles.remove(spark, f"{chunk_dir}/chunk={n}")
    failed = attempt(todo) if todo else []
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(boxes)} chunks failed and were not merged; a rerun resumes with them")
    return merge_tiles(spark, chunk_dir, out, resolution, parent, sources, release)


def _write_chunks(spark: SparkSession, buildings: str, segments: str, chunk_dir: str, boxes: list[BoundingBox], todo: list[int], resolution: int, parent: int) -> None:
    """The partials of some chunks by one scan of their features."""
    chunk = chunk_of(boxes)
    # Neighbouring boxes of a row make one box, so the filter that reaches the scan stays short.
    spans: list[BoundingBox] = []
    for n in todo:
        box = boxes[n]
        if spans and (spans[-1].east, spans[-1].south, spans[-1].north) == (box.west, box.south, box.north):
            box = BoundingBox(spans.pop().west, box.south, box.east, box.north)
        spans.append(box)
    where = reduce(Column.__or__, (in_half_open_box(*astuple(s)) for s in spans))
    rows = completeness.cell_counts(spark.read.parquet(buildings), spark.read.parquet(segments), where, resolution, chunk=chunk)
    out = completeness.partials(rows, parent, "chunk")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("chunk").parquet(chunk_dir)


#: Error conditions, and causes, that tell of input which cannot be read; a broken shuffle or a full disk is none of these.
_UNREADABLE = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER")
_CAUSES = ("java.net.SocketTimeoutException", "java.net.UnknownHostException", "java.net.ConnectException")


def _is_input_error(error: Exception) -> bool:
    """Whether a path or a store could not be read, by the condition of the error or of one it comes from."""
    condition = getattr(error, "getCondition", lambda: None)() or ""
    if condition.startswith(_UNREADABLE):
        return True
    # A failed stage reports its tasks' error in its text alone: the condition stands in brackets, a cause by its class.
    said = str(error)
    return any(f"[{c}" in said for c in _UNREADABLE) or any(f"{c}:" in said for c in _CAUSES)


def chunk_of(boxes: list[BoundingBox]) -> Column:
    """The number of the box of chunk_boxes that a feature inside one of them lies in, by its least corner."""
    wests, souths = sorted({b.west for b in boxes}), sorted({b.south for b in boxes})

    def place(c: Column, edges: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= c)) - 1

    return place(F.col("bbox.ymin"), souths) * len(wests) + place(F.col("bbox.xmin"), wests)


def numbered(features: DataFrame, boxes: list[BoundingBox], name: str = "chunk") -> DataFrame:
    """The features in any of the boxes of chunk_boxes, each with the number of its box, in one pass."""
    area = (min(b.west for b in boxes), min(b.south for b in boxes), max(b.east for b in boxes), max(b.north for b in boxes))
    return features.where(in_half_open_box(*area)).withColumn(name, chunk_of(boxes))
