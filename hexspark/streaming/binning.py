"""Pixels or events arriving over time, summed by cell as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexspark.functions.grid import latlng_to_cell


def running_cells(pixels: DataFrame, resolution: int) -> DataFrame:
    """cell, pop of a stream of lon, lat, pop; for update or complete output."""
    ok = (F.col("pop") > 0) & (F.abs("pop") < float("inf"))
    return pixels.where(ok).select(latlng_to_cell(F.col("lat"), F.col("lon"), resolution).alias("cell"), "pop").groupBy("cell").agg(F.sum("pop").alias("pop"))
