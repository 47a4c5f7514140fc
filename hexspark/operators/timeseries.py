"""Gridded people by year: pixels to cells, and years to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark import config
from hexspark.functions.grid import latlng_to_cell
from hexspark.functions.scalar import cell_hex, cell_parent, exact_sum, is_finite, rnd
from hexspark.operators import tiles


def valid_pixels(pixels: DataFrame, nodata: float | None = None) -> DataFrame:
    """Pixels with people: finite, positive, and not the value for none."""
    ok = is_finite("pop") & (F.col("pop") > 0)
    return pixels.where(ok if nodata is None else ok & (F.col("pop") != nodata))


def bin_pixels(pixels: DataFrame, resolution: int = config.CELL_RESOLUTION) -> DataFrame:
    """cell, pop: sums over all pixels with their centre in the cell, whatever raster they come from."""
    cells = pixels.select(latlng_to_cell(F.col("lat"), F.col("lon"), resolution).alias("cell"), "pop")
    return positive(cells)


def positive(cells: DataFrame, *keys: str) -> DataFrame:
    """Rounded sums by cell where the sum is above 0, the same under any partitioning; a rounded 0 may remain."""
    keys = keys or ("cell",)
    return cells.groupBy(*keys).agg(exact_sum("pop").alias("s")).where("s > 0").select(*keys, rnd("s").alias("pop"))


def year_cells(pixels: DataFrame, year: int, resolution: int = config.CELL_RESOLUTION) -> DataFrame:
    return bin_pixels(pixels, resolution).select("cell", F.lit(year).alias("year"), "pop")


def pivot_years(rows: DataFrame, years: list[int], parent: int | None = config.PARENT_RESOLUTION) -> DataFrame:
    """h3, h3_parent and a column pop_<year> for each year, null where a cell has none: one shuffle by cell."""
    wide = rows.groupBy("cell").agg(*(rnd(F.sum(F.when(F.col("year") == y, F.col("pop")))).alias(f"pop_{y}") for y in years))
    parents = [] if parent is None else [cell_hex(cell_parent("cell", parent)).alias("h3_parent")]
    return wide.select(cell_hex("cell").alias("h3"), *parents, *(f"pop_{y}" for y in years))


def write_series(spark: SparkSession, scratch: str, out: str, years: list[int], release: str = config.SERIES_RELEASE, parent: int = config.PARENT_RESOLUTION) -> int:
    """Pivot the cells of each year, kept under scratch as ts_<year>.parquet, into tiles; number of cells.

    A year without cells would give a column of nulls, so it is refused.
    """
    missing = [y for y in years if not tiles.exists(spark, f"{scratch}/ts_{y}.parquet")]
    if missing:
        raise FileNotFoundError(f"no cells for {missing} under {scratch}")
    rows = spark.read.parquet(*(f"{scratch}/ts_{y}.parquet" for y in years))
    count = tiles.write_tiles(pivot_years(rows, years, parent), out)
    tiles.write_series_manifest(spark, out, years, count, release)
    return count


def year_totals(wide: DataFrame, years: list[int]) -> DataFrame:
    """year, total over all cells; null counts as 0."""
    one = wide.agg(*(F.coalesce(F.sum(f"pop_{y}"), F.lit(0.0)).alias(f"pop_{y}") for y in years))
    return one.select(F.explode(F.array(*(F.struct(F.lit(y).alias("year"), F.col(f"pop_{y}").alias("total")) for y in years))).alias("x")).select("x.*")
