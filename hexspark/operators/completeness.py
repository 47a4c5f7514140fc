"""Coverage per cell: counts of features, those of a chosen source, and road lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexspark import config
from hexspark.functions.geodesy import spheroid_length
from hexspark.functions.grid import latlng_to_cell
from hexspark.functions.scalar import cell_hex, cell_parent, centre, finite_sum, has_source, rnd, share


def feature_cells(features: DataFrame, resolution: int = config.CELL_RESOLUTION) -> DataFrame:
    """features with the cell of their box's centre; the geometry is not decoded for it."""
    return features.withColumn("cell", latlng_to_cell(*centre(), resolution))


def road_segments(segments: DataFrame) -> DataFrame:
    """Segments that are roads, with their length; the filter goes before the length."""
    return segments.where(F.col("subtype") == "road").withColumn("length_m", spheroid_length("geometry"))


def buildings_by_cell(buildings: DataFrame, own: Column | None = None, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """cell (and what else is among the keys), bld_count, bld_osm of rows that have a cell."""
    own = has_source(config.SOURCE) if own is None else own
    return buildings.groupBy(*keys).agg(F.count("*").alias("bld_count"), F.count_if(own).alias("bld_osm"))


def roads_by_cell(roads: DataFrame, own: Column | None = None, length: str = "length_m", keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """cell (and what else is among the keys), road_count, road_osm, road_len_m; lengths that are not finite count as 0."""
    own = has_source(config.SOURCE) if own is None else own
    return roads.groupBy(*keys).agg(F.count("*").alias("road_count"), F.count_if(own).alias("road_osm"), finite_sum(length).alias("road_len_m"))


def merged(buildings: DataFrame, roads: DataFrame, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """Both sides by cell, 0 where one has none; the aggregates already lie by cell, so the join moves nothing."""
    out = buildings.join(roads, list(keys), "full_outer")
    zero = {c: 0 for c in ("bld_count", "bld_osm", "road_count", "road_osm")} | {"road_len_m": 0.0}
    return out.select(*keys, *(F.coalesce(F.col(c), F.lit(z)).alias(c) for c, z in zero.items()))


def partials(cells: DataFrame, parent: int = config.PARENT_RESOLUTION, *more: str) -> DataFrame:
    """Counts by cell and parent as text, for merging with those of other areas; and the columns `more`."""
    names = ("bld_count", "bld_osm", "road_count", "road_osm", "road_len_m")
    return cells.select(cell_hex("cell").alias("h3"), cell_hex(cell_parent("cell", parent)).alias("h3_parent"), *names, *more)


def shares(rows: DataFrame, *more: str | Column) -> DataFrame:
    """Rows with percentages; those are null where there is nothing to share."""
    return rows.select(
        "h3", "h3_parent", "bld_count", "bld_osm", share("bld_osm", "bld_count").alias("osm_pct"),
        "road_count", "road_osm", share("road_osm", "road_count").alias("road_pct"), rnd("road_len_m", 1).alias("road_len_m"), *more,
    )


def coverage(buildings: DataFrame, segments: DataFrame, where: Column, resolution: int = config.CELL_RESOLUTION, parent: int = config.PARENT_RESOLUTION) -> DataFrame:
    """Coverage of the features that `where` admits, one row per cell."""
    return shares(partials(cell_counts(buildings, segments, where, resolution), parent))


def cell_counts(buildings: DataFrame, segments: DataFrame, where: Column, resolution: int = config.CELL_RESOLUTION, **more: Column) -> DataFrame:
    """Counts by cell of the features that `where` admits, and by the columns of `more`, made of a feature's box."""
    keys = (*more, "cell")
    b, r = (
        feature_cells(x.where(where).select(*(c.alias(n) for n, c in more.items()), *columns), resolution)
        for x, columns in ((buildings, ("bbox", "sources")), (segments, ("bbox", "sources", "subtype", "geometry")))
    )
    return merged(buildings_by_cell(b, keys=keys), roads_by_cell(road_segments(r), keys=keys), keys)


def merge_partials(chunks: DataFrame) -> DataFrame:
    """Partials of many areas summed by cell; the parent is any that is given."""
    return chunks.groupBy("h3").agg(
        F.any_value("h3_parent", F.lit(True)).alias("h3_parent"),
        *(F.sum(c).alias(c) for c in ("bld_count", "bld_osm", "road_count", "road_osm")),
        finite_sum("road_len_m").alias("road_len_m"),
    )
