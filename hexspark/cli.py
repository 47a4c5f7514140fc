"""Command line: python -m hexspark.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import re
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hexspark import config
from hexspark.operators import catalog, chunks, population, tiles, timeseries
from hexspark.session import session
from hexspark.sources.geotiff import read_year, years_of
from hexspark.sources.gpkg import read_gpkg


def named_paths(pairs: list[str] | None) -> dict[str, str]:
    """Sources by name from texts like kontur=/data/people: all after the first = is the path, the last of a name counts."""
    found = [re.fullmatch(r"([^=]+)=(.+)", pair, re.DOTALL) for pair in pairs or ()]
    wrong = [pair for pair, m in zip(pairs or (), found, strict=True) if m is None]
    if wrong:
        raise ValueError(f"a source is given as name=path; these are not: {wrong}")
    return dict(m.groups() for m in found)


def _write_people(rows, out: str) -> tuple[int, float]:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(out)
    back = rows.sparkSession.read.parquet(out)
    return tuple(back.agg(F.count("*"), F.coalesce(F.sum(back.columns[-1]), F.lit(0.0))).first())


def area(spark: SparkSession, a: argparse.Namespace) -> str:
    b, s = config.feature_paths(a.release)
    n = chunks.area_tiles(spark, chunks.BoundingBox(*a.bbox), a.buildings or b, a.segments or s, a.out, a.resolution, a.partition_resolution, a.release)
    return f"wrote {n} cells to {a.out}"


def planet(spark: SparkSession, a: argparse.Namespace) -> str:
    sources = named_paths(a.population)
    if a.merge_only:
        n = chunks.merge_tiles(spark, a.chunk_dir, a.out, a.resolution, a.partition_resolution, sources, a.release)
    else:
        b, s = config.feature_paths(a.release)
        box = {k: getattr(a, k) for k in config.PLANET}
        n = chunks.run_planet(spark, a.buildings or b, a.segments or s, a.out, a.chunk_dir, a.resolution, a.partition_resolution, sources, a.release, **box)
    return f"merged {n} cells to {a.out}"


def people_gpkg(spark: SparkSession, a: argparse.Namespace) -> str:
    n, total = _write_people(population.by_cell(read_gpkg(spark, a.gpkg)), a.out)
    return f"wrote {n} cells, total population {total:,.0f}"


def people_raster(spark: SparkSession, a: argparse.Namespace) -> str:
    cells = timeseries.bin_pixels(read_year(spark, a.tif_dir, a.year))
    n, total = _write_people(cells.select(timeseries.cell_hex("cell").alias("h3"), F.col("pop").alias("population")), a.out)
    return f"wrote {n} cells, total population {total:,.0f}"


def write_year(spark: SparkSession, folder: str, scratch: str, year: int) -> int:
    rows = timeseries.year_cells(read_year(spark, folder, year), year)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{scratch}/ts_{year}.parquet")
    return spark.read.parquet(f"{scratch}/ts_{year}.parquet").count()


def series(spark: SparkSession, a: argparse.Namespace) -> str:
    years = [y for y in years_of(spark, a.tif_dir) if a.year_min <= y <= a.year_max]
    if not years:
        raise FileNotFoundError(f"no rasters of {a.year_min} to {a.year_max} under {a.tif_dir}")
    for y in years:
        write_year(spark, a.tif_dir, a.scratch_dir, y)
    n = timeseries.write_series(spark, a.scratch_dir, a.out, years)
    return f"wrote {n} cells for years {years[0]}-{years[-1]}"


def _published(spark: SparkSession, folder: str, to: str, prune: str | None) -> str:
    store = catalog.Store(spark, to)
    n = catalog.publish(store, folder, prune)
    catalog.verify(store, folder)
    return f"copied {n} files to {to}"


def publish(spark: SparkSession, a: argparse.Namespace) -> str:
    return _published(spark, a.tiles, a.to, a.prune)


def refresh_plan(spark: SparkSession, a: argparse.Namespace) -> str:
    """Ask the service, or read a listing from a JSON file, and write the plan."""
    if a.assets:
        rows = spark.createDataFrame([tuple(x) for x in json.loads(Path(a.assets).read_text())], "iso string, year int, release string, href string")
    else:
        rows = catalog.listing(spark, catalog.WebClient(), a.service)
    plan = catalog.refresh_plan(rows, catalog.Store(spark, a.published).manifest())
    catalog.save_plan(spark, plan, a.out)
    return json.dumps({k: plan[k] for k in ("release", "years", "needs_update")})


def refresh_year(spark: SparkSession, a: argparse.Namespace) -> str:
    """Bring a year's rasters, if a plan is given, and bin them."""
    if a.plan:
        plan = catalog.load_plan(spark, a.plan)
        n = catalog.fetch(spark, catalog.WebClient(), plan["assets"][str(a.year)].values(), a.rasters)
        print(f"{n} rasters of {a.year}")
    return f"{write_year(spark, a.rasters, a.out_dir, int(a.year))} cells"


def refresh_publish(spark: SparkSession, a: argparse.Namespace) -> str:
    plan = catalog.load_plan(spark, a.plan)
    n = timeseries.write_series(spark, a.scratch_dir, a.tiles, plan["years"], plan["release"])
    if a.to:
        _published(spark, a.tiles, a.to, "h3_parent=*/*")
    return f"built {n} cells, release {plan['release']}"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hexspark", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name: str, run, *required: str, **optional) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        for o, default in optional.items():
            p.add_argument(f"--{o.replace('_', '-')}", type=type(default) if default is not None else str, default=default)
        p.add_argument("--threads", type=int)
        p.add_argument("--memory-limit")
        p.add_argument("--temp-dir")
        return p

    grid = {"resolution": config.CELL_RESOLUTION, "partition_resolution": config.PARENT_RESOLUTION, "release": config.RELEASE, "buildings": None, "segments": None}
    command("area", area, "out", **grid).add_argument("--bbox", type=float, nargs=4, required=True, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    p = command("planet", planet, "out", "chunk-dir", **grid, **config.PLANET)
    p.add_argument("--merge-only", action="store_true")
    p.add_argument("--population", action="append", metavar="NAME=PATH")
    command("population", people_gpkg, "gpkg", "out")
    command("raster", people_raster, "tif-dir", "out", year=config.SERIES_YEAR)
    command("series", series, "tif-dir", "out", "scratch-dir", year_min=2015, year_max=2030)
    command("publish", publish, "tiles", "to", prune=None)
    command("refresh-plan", refresh_plan, "published", "out", assets=None, service=config.STAC)
    command("refresh-year", refresh_year, "rasters", "out-dir", "year", plan=None)
    command("refresh-publish", refresh_publish, "plan", "scratch-dir", "tiles", to=None)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    print(args.run(session(args.threads, args.memory_limit, args.temp_dir, config.REGION), args))


if __name__ == "__main__":
    main()
