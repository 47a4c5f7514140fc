"""Tiles: one Parquet file per coarse parent, the manifest that names them, and reading the few that are needed."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hexspark import config

PARENT = "h3_parent"
MANIFEST = "manifest.json"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that all executors share; a local session without one uses its own temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/hexspark-{tag}-{uuid.uuid4().hex}"


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, sorted."""
    p, fs = _path(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(p) or ())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def signature(spark: SparkSession, pattern: str) -> str:
    """Changes when a file that a pattern matches does: a digest of their paths, lengths and times of change; empty if there is none."""
    out = []
    p, fs = _path(spark, pattern)
    for found in fs.globStatus(p) or ():
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            f = files.next()
            out.append(f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(out)).encode()).hexdigest() if out else ""


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first, so it is whole or absent."""
    part, fs = _path(spark, path + ".part")
    target, _ = _path(spark, path)
    sink = fs.create(part, True)
    sink.write(bytearray(text.encode()))
    sink.close()
    fs.delete(target, False)
    fs.rename(part, target)


def join_files(spark: SparkSession, paths: list[str], to: str, head: bytes, tail: bytes, skip: int = 0) -> None:
    """One file of others' bytes between a head and a tail, without the first `skip` bytes of the first that has any."""
    part, fs = _path(spark, to + ".part")
    sink = fs.create(part, True)
    try:
        sink.write(bytearray(head))
        for path in paths:
            p, own = _path(spark, path)
            if own.getFileStatus(p).getLen() == 0:
                continue
            source = own.open(p)
            try:
                source.skipNBytes(skip)
                skip = 0
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, sink, 1 << 20, False)
            finally:
                source.close()
        sink.write(bytearray(tail))
    finally:
        sink.close()
    target, _ = _path(spark, to)
    fs.delete(target, False)
    fs.rename(part, target)


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of all files under root, relative to it, sorted."""
    p, fs = _path(spark, root)
    base, out, it = fs.makeQualified(p).toString().rstrip("/") + "/", [], fs.listFiles(p, True)
    while it.hasNext():
        out.append(it.next().getPath().toString().removeprefix(base))
    return sorted(out)


def write_tiles(rows: DataFrame, out: str, mode: str = "overwrite") -> int:
    """Write rows by parent, one file each, and return their number, observed while writing.

    All rows of a parent go to one task: at parent resolution 2 it has 117 649 cells at most.
    """
    seen = Observation()
    dealt = rows.repartition(PARENT).observe(seen, F.count(F.lit(1)).alias("n"))
    dealt.write.mode(mode).partitionBy(PARENT).option("compression", "zstd").parquet(out)
    return seen.get["n"]


def tile_paths(spark: SparkSession, out: str) -> dict[str, str]:
    """Parent -> relative path; a parent of several files is refused."""
    found: dict[str, str] = {}
    for path in list_files(spark, out):
        head, _, name = path.partition("/")
        if head.startswith(f"{PARENT}=") and name.endswith(".parquet"):
            parent = head.removeprefix(f"{PARENT}=")
            if parent in found:
                raise RuntimeError(f"{out}: several files for parent {parent}")
            found[parent] = path
    return found


def write_manifest(spark: SparkSession, out: str, resolution: int, parent: int, release: str = config.RELEASE, populations: list[str] = ()) -> dict:
    labels = [{"name": n, **config.POPULATION_LABELS.get(n, {"label": n})} for n in populations]
    manifest = {"resolution": resolution, "partition_resolution": parent, "overture_release": release, "populations": labels, "tiles": tile_paths(spark, out)}
    write_text(spark, f"{out}/{MANIFEST}", json.dumps(manifest, indent=2))
    return manifest


def write_series_manifest(spark: SparkSession, out: str, years: list[int], cells: int, release: str = config.SERIES_RELEASE) -> dict:
    stamp = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    manifest = {"source": "worldpop", "release": release, "years": years, "cells": cells, "generated_at": stamp, "tiles": tile_paths(spark, out)}
    write_text(spark, f"{out}/{MANIFEST}", json.dumps(manifest, indent=2))
    return manifest


def read_manifest(spark: SparkSession, out: str) -> dict | None:
    text = read_text(spark, f"{out}/{MANIFEST}")
    return None if text is None else json.loads(text)


def read_tiles(spark: SparkSession, out: str, parents: list[str], manifest: dict | None = None) -> DataFrame | None:
    """Rows of the tiles of some parents, columns united by name; parents without a tile are left out, None if none has one."""
    manifest = manifest or read_manifest(spark, out) or {"tiles": {}}
    paths = [f"{out}/{manifest['tiles'][p]}" for p in parents if p in manifest["tiles"]]
    return spark.read.option("mergeSchema", "true").option("basePath", out).parquet(*paths) if paths else None


def read_pruned(spark: SparkSession, out: str, parents: list[str]) -> DataFrame:
    """The same by partition pruning on a directory of tiles, without a manifest."""
    return spark.read.option("mergeSchema", "true").parquet(out).where(F.col(PARENT).cast("string").isin(list(parents)))
