"""Session settings, and shipping this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Set on every session the library makes: adaptive plans, UTC, and partition values kept as text
#: (a partition named 82 is an identifier, not a number).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}

_shipped: set[str] = set()


def session(
    threads: int | None = None,
    memory_limit: str | None = None,
    temp_dir: str | None = None,
    region: str | None = None,
    master: str | None = None,
    **conf: str,
) -> SparkSession:
    """A SparkSession; threads, memory and spill folder bound a local one, a cluster's own settings stay."""
    builder = SparkSession.builder.appName("hexspark")
    if master or threads is not None:
        builder = builder.master(master or f"local[{threads}]")
    options = dict(DEFAULTS)
    if memory_limit is not None:
        options["spark.driver.memory"] = memory_limit
    if temp_dir is not None:
        options["spark.local.dir"] = temp_dir
    if region is not None:
        options["spark.hadoop.fs.s3a.endpoint.region"] = region
    return builder.config(map=options | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Small rows that stand for much work, dealt over as many tasks as shuffles have; an adaptive plan would put them into one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, as they may not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="hexspark-")) / "hexspark.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
