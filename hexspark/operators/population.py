"""People per cell, and where they live without being mapped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexspark import config
from hexspark.functions.scalar import cell_hex, cell_parent, exact_sum, gap, hex_cell, rnd
from hexspark.operators.completeness import shares


def by_cell(people: DataFrame) -> DataFrame:
    """h3, population: rounded sums, which do not depend on the partitions."""
    return people.groupBy("h3").agg(rnd(exact_sum("population")).alias("population"))


def attach(cells: DataFrame, sources: dict[str, DataFrame], parent: int = config.PARENT_RESOLUTION) -> DataFrame:
    """Coverage on all cells mapped or lived in, with population_<name> and gap_score_<name> per source.

    A cell given twice by a source gives two rows; see duplicates().
    """
    keys = reduce(DataFrame.union, [cells.select("h3"), *(s.select("h3") for s in sources.values())]).distinct()
    rows = keys.join(cells, "h3", "left")
    for name, s in sources.items():
        rows = rows.join(s.select("h3", F.col("population").alias(f"population_{name}")), "h3", "left")
    counts = ("bld_count", "bld_osm", "road_count", "road_osm")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts} | {"road_len_m": F.coalesce("road_len_m", F.lit(0.0))})
    rows = rows.withColumn("h3_parent", F.coalesce("h3_parent", cell_hex(cell_parent(hex_cell("h3"), parent))))
    more = []
    for name in sources:
        more.append(F.coalesce(F.col(f"population_{name}"), F.lit(0.0)).alias(f"population_{name}"))
        more.append(gap(f"population_{name}", "bld_osm", "bld_count").alias(f"gap_score_{name}"))
    return shares(rows, *more)


def duplicates(people: DataFrame, key: str = "h3") -> DataFrame:
    """Keys given more than once, with how often."""
    return people.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
