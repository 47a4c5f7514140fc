"""GeoPackage layers as a Python data source: a .gpkg is an SQLite database.

One on a local disk is read in runs of rows, in parallel; one in another store comes through Spark's own reader as bytes and
is opened in memory by one task.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from hexspark.sources.geotiff import local, remote

ROWS = 50_000


def _layer(db: sqlite3.Connection, wish: str | None) -> str:
    return wish or db.execute("SELECT table_name FROM gpkg_contents ORDER BY table_name").fetchone()[0]


class GpkgSource(DataSource):
    """Options: path, layer (the first of the package), columns (h3,population), partitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        return "h3 string, population double"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = [f.name for f in schema.fields]
        self.path, self.layer, self.count = options["path"], options.get("layer"), int(options.get("partitions", 8))

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{_layer(db, self.layer)}"').fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = max(1, -(-(high - low + 1) // self.count))
        return [InputPartition((a, a + step)) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        low, high = partition.value
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            yield from _selected(db, self.layer, self.names, "WHERE rowid >= ? AND rowid < ?", (low, high))


def _selected(db: sqlite3.Connection, layer: str | None, names: list[str], where: str = "", values: tuple = ()) -> Iterator[pa.RecordBatch]:
    cols = ", ".join(f'"{n}"' for n in names)
    rows = db.execute(f'SELECT {cols} FROM "{_layer(db, layer)}" {where}', values)
    while part := rows.fetchmany(ROWS):
        h3, people = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(h3, pa.string()), pa.array([None if v is None else float(v) for v in people], pa.float64())], names)


def read_stored(files: DataFrame, layer: str | None = None) -> DataFrame:
    """h3 and population of the packages given as rows with their content."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                db = sqlite3.connect(":memory:")
                try:
                    db.deserialize(content.as_py())
                    yield from _selected(db, layer, ["h3", "population"])
                finally:
                    db.close()

    return files.select("content").mapInArrow(run, "h3 string, population double")


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    if remote(path):
        return read_stored(spark.read.format("binaryFile").load(path), layer)
    spark.dataSource.register(GpkgSource)
    reader = spark.read.format("gpkg").option("path", local(path))
    return (reader.option("layer", layer) if layer else reader).load()
