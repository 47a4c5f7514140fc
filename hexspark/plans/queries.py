"""Every operator of the core as a query over the test tables, with the SQL it is held against.

The tables have no shapes, so features are made of orders and line items: a key gives a cell of the
right layout, numbers give boxes and lengths, and flags give sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark import config
from hexspark.functions import geodesy, grid, scalar
from hexspark.operators import assess, catalog, completeness, cover, population, tiles, timeseries
from hexspark.operators.chunks import chunk_boxes, numbered

YEARS = [1995, 1996, 1997, 1998]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _key_cell(k: Column) -> Column:
    """A resolution-8 cell with base cell and digits from a whole number."""
    out = F.lit((1 << 59) + (8 << 52) + (1 << 21) - 1) + (k % 122) * (1 << 45)
    for i in range(8):
        out = out + F.floor(k % 7 ** (i + 1) / 7**i).cast("long") * (1 << (3 * (14 - i)))
    return out.cast("long")


def _cell(k: str) -> str:
    digits = " + ".join(f"(({k} % {7 ** (i + 1)}) // {7**i}) * {1 << (3 * (14 - i))}" for i in range(8))
    return f"CAST({(1 << 59) + (8 << 52) + (1 << 21) - 1} + ({k} % 122) * {1 << 45} + {digits} AS BIGINT)"


def _exact(c: Column | str) -> Column:
    """Eighths: their sums are exact in any order, so results do not depend on the partitioning."""
    return F.floor((F.col(c) if isinstance(c, str) else c) * 8.0) / 8.0


def _eighths(c: str) -> str:
    return f"(floor({c} * 8.0::DOUBLE) / 8.0::DOUBLE)"


def _parent(c: str, r: int = 2) -> str:
    return f"((({c}) & CAST({~(15 << 52)} AS BIGINT)) | CAST({r << 52} AS BIGINT) | CAST({(1 << (3 * (15 - r))) - 1} AS BIGINT))"


def _hex(c: str) -> str:
    return f"printf('%x', {c})"


def _rnd(x: str, d: int = 1) -> str:
    return f"round(({x}) * {float(10**d)}) / {float(10**d)}"


def _features(spark: SparkSession, d: str) -> DataFrame:
    q, p = F.col("l_quantity"), F.col("l_extendedprice") / 1000.0
    return _table(spark, d, "lineitem").select(
        _key_cell(F.col("l_suppkey")).alias("cell"),
        F.struct(q.alias("xmin"), (q + 1).alias("xmax"), p.alias("ymin"), (p + 1).alias("ymax")).alias("bbox"),
        F.array(F.struct(F.when(F.col("l_linestatus") == "F", config.SOURCE).otherwise("other").alias("dataset"))).alias("sources"),
    )


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "orders").select(
        _key_cell(F.col("o_custkey")).alias("cell"),
        F.when(F.col("o_orderpriority") == "5-LOW", "rail").otherwise("road").alias("subtype"),
        F.array(F.struct(F.when(F.col("o_orderstatus") == "F", config.SOURCE).otherwise("other").alias("dataset"))).alias("sources"),
        _exact("o_totalprice").alias("length_m"),
    )


_B = f"SELECT {_cell('l_suppkey')} AS cell, l_quantity AS x, l_extendedprice / 1000.0::DOUBLE AS y, l_linestatus = 'F' AS own FROM lineitem"
_R = f"SELECT {_cell('o_custkey')} AS cell, CASE WHEN o_orderpriority = '5-LOW' THEN 'rail' ELSE 'road' END AS subtype, o_orderstatus = 'F' AS own, {_eighths('o_totalprice')} AS length_m FROM orders"
_MERGED = f"""b0 AS ({_B}), r0 AS ({_R}),
b AS (SELECT cell, count(*) AS bld_count, count(*) FILTER (WHERE own) AS bld_osm FROM b0 GROUP BY 1),
r AS (SELECT cell, count(*) AS road_count, count(*) FILTER (WHERE own) AS road_osm, sum(length_m) AS road_len_m FROM r0 WHERE subtype = 'road' GROUP BY 1),
m AS (SELECT coalesce(b.cell, r.cell) AS cell, coalesce(bld_count, 0) AS bld_count, coalesce(bld_osm, 0) AS bld_osm, coalesce(road_count, 0) AS road_count,
 coalesce(road_osm, 0) AS road_osm, coalesce(road_len_m, 0.0) AS road_len_m FROM b FULL OUTER JOIN r ON b.cell = r.cell)"""
_PCT = f"{_rnd('bld_osm * 100.0::DOUBLE / nullif(bld_count, 0)')} AS osm_pct, {_rnd('road_osm * 100.0::DOUBLE / nullif(road_count, 0)')} AS road_pct"
_PEOPLE = f"SELECT {_hex(_cell('c_custkey'))} AS h3, round(sum({_eighths('c_acctbal')})) AS population FROM customer GROUP BY 1"


def _merged(spark: SparkSession, d: str) -> DataFrame:
    roads = _segments(spark, d).where(F.col("subtype") == "road")
    return completeness.merged(completeness.buildings_by_cell(_features(spark, d)), completeness.roads_by_cell(roads))


@_query(f"WITH {_MERGED} SELECT {_hex('cell')} AS h3, {_hex(_parent('cell'))} AS h3_parent, bld_count, bld_osm, road_count, road_osm, {_PCT}, {_rnd('road_len_m')} AS road_len_m FROM m")
def completeness_cells(spark: SparkSession, d: str) -> DataFrame:
    return completeness.shares(completeness.partials(_merged(spark, d)))


@_query(f"WITH b0 AS ({_B}) SELECT cell, count(*) AS n FROM b0 WHERE x BETWEEN 5 AND 20 AND y BETWEEN 10 AND 40 GROUP BY cell")
def closed_bbox_filter(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d).where(scalar.in_closed_box(5, 10, 20, 40)).groupBy("cell").agg(F.count("*").alias("n"))


@_query(f"WITH b0 AS ({_B}) SELECT CAST(floor(x / 10) AS INTEGER) AS col, CAST(floor(y / 25) AS INTEGER) AS line, count(*) AS n FROM b0 WHERE x >= 0 AND x < 55 AND y >= 0 AND y < 100 GROUP BY 1, 2")
def half_open_chunks(spark: SparkSession, d: str) -> DataFrame:
    boxes = chunk_boxes(0, 55, 0, 100, 10, 25)
    counts = numbered(_features(spark, d), boxes).groupBy("chunk").agg(F.count("*").alias("n"))
    return counts.select((F.col("chunk") % 6).alias("col"), F.floor(F.col("chunk") / 6).cast("int").alias("line"), "n")


@_query(f"WITH {_MERGED} SELECT {_hex('cell')} AS h3, {_hex(_parent('cell'))} AS h3_parent, bld_count, bld_osm, road_count, road_osm, {_rnd('road_len_m', 2)} AS road_len_m FROM m")
def chunk_partials(spark: SparkSession, d: str) -> DataFrame:
    return completeness.partials(_merged(spark, d)).withColumn("road_len_m", scalar.rnd("road_len_m", 2))


def _two_chunks(spark: SparkSession, d: str) -> DataFrame:
    f, r = _features(spark, d), _segments(spark, d).where(F.col("subtype") == "road")
    sides = [completeness.merged(completeness.buildings_by_cell(f.where(c)), completeness.roads_by_cell(r.where(e))) for c, e in (
        (F.col("bbox.xmin") < 25, F.col("length_m") < 100000), (F.col("bbox.xmin") >= 25, F.col("length_m") >= 100000))]
    return completeness.merge_partials(completeness.partials(sides[0]).unionByName(completeness.partials(sides[1])))


@_query(f"WITH {_MERGED} SELECT {_hex('cell')} AS h3, {_hex(_parent('cell'))} AS h3_parent, bld_count, bld_osm, road_count, road_osm, {_PCT}, {_rnd('road_len_m')} AS road_len_m FROM m")
def merge_chunks(spark: SparkSession, d: str) -> DataFrame:
    return completeness.shares(_two_chunks(spark, d))


def _side(where_b: str, where_r: str) -> str:
    return f"""SELECT coalesce(b.cell, r.cell) AS cell, coalesce(bld_count, 0) AS bld_count, coalesce(bld_osm, 0) AS bld_osm, coalesce(road_count, 0) AS road_count, coalesce(road_osm, 0) AS road_osm
FROM (SELECT cell, count(*) AS bld_count, count(*) FILTER (WHERE own) AS bld_osm FROM b0 WHERE {where_b} GROUP BY 1) b
FULL OUTER JOIN (SELECT cell, count(*) AS road_count, count(*) FILTER (WHERE own) AS road_osm FROM r0 WHERE subtype = 'road' AND {where_r} GROUP BY 1) r ON b.cell = r.cell"""


@_query(f"""WITH b0 AS ({_B}), r0 AS ({_R}), one AS ({_side('true', 'true')}),
two AS (SELECT cell, sum(bld_count) AS bld_count, sum(bld_osm) AS bld_osm, sum(road_count) AS road_count, sum(road_osm) AS road_osm
 FROM ({_side('x < 25', 'length_m < 100000')} UNION ALL {_side('x >= 25', 'length_m >= 100000')}) GROUP BY 1)
SELECT {_hex('cell')} AS h3, CAST(one.bld_count AS BIGINT) AS single, CAST(two.bld_count + 0 AS BIGINT) AS chunked, one.bld_osm = two.bld_osm AND one.road_count = two.road_count AND one.road_osm = two.road_osm AS same
FROM one FULL OUTER JOIN two USING (cell)""")
def chunked_equals_single(spark: SparkSession, d: str) -> DataFrame:
    one, two = (x.select("h3", *(F.col(c).alias(f"{c}{n}") for c in ("bld_count", "bld_osm", "road_count", "road_osm"))) for n, x in (("_1", completeness.partials(_merged(spark, d))), ("_2", _two_chunks(spark, d))))
    same = (F.col("bld_osm_1") == F.col("bld_osm_2")) & (F.col("road_count_1") == F.col("road_count_2")) & (F.col("road_osm_1") == F.col("road_osm_2"))
    return one.join(two, "h3", "full").select("h3", F.col("bld_count_1").alias("single"), F.col("bld_count_2").alias("chunked"), same.alias("same"))


@_query(f"WITH b0 AS ({_B}) SELECT cell, count(*) AS bld_count, count(*) FILTER (WHERE own) AS bld_osm, {_rnd('count(*) FILTER (WHERE own) * 100.0::DOUBLE / nullif(count(*), 0)')} AS osm_pct FROM b0 GROUP BY cell")
def osm_share(spark: SparkSession, d: str) -> DataFrame:
    return completeness.buildings_by_cell(_features(spark, d)).withColumn("osm_pct", scalar.share("bld_osm", "bld_count"))


# Prices are whole cents as doubles: their exact sum is that of the cents but for less than half a cent.
@_query("SELECT l_suppkey, CAST(round(sum(CAST(round(l_extendedprice * 100) AS HUGEINT)) / 100.0, 2) AS DOUBLE) AS total, CAST(1 AS BIGINT) AS sums FROM lineitem GROUP BY 1")
def exact_sums(spark: SparkSession, d: str) -> DataFrame:
    """Sums of plain doubles under several partitionings, and how many different ones there are."""
    rows = _table(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.col("l_extendedprice").alias("x"))
    # No way has a fixed few partitions, which would each hold a share of the table however large.
    ways = [rows, rows.repartitionByRange("x", "l_partkey"), rows.repartition("l_partkey", "l_suppkey").sortWithinPartitions("x"), rows.repartition(211, "x", "l_partkey")]
    sums = [w.groupBy("l_suppkey").agg(scalar.exact_sum("x").alias("s")) for w in ways]
    every = sums[0].unionByName(sums[1]).unionByName(sums[2]).unionByName(sums[3])
    return every.groupBy("l_suppkey").agg(F.round(F.max("s"), 2).alias("total"), F.count_distinct("s").alias("sums"))


_ODD = "CASE o_orderkey % 5 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN NULL ELSE floor(o_totalprice * 8.0::DOUBLE) / 8.0::DOUBLE END"


@_query(f"SELECT o_orderstatus, {_rnd(f'sum(CASE WHEN isfinite({_ODD}) THEN {_ODD} ELSE 0 END)')} AS total FROM orders GROUP BY 1")
def guarded_sum(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    odd = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k > 2, _exact("o_totalprice"))
    return _table(spark, d, "orders").select("o_orderstatus", odd.alias("x")).groupBy("o_orderstatus").agg(scalar.rnd(scalar.finite_sum("x"), 1).alias("total"))


@_query(f"WITH r0 AS ({_R}) SELECT cell, count(*) AS road_count, count(*) FILTER (WHERE own) AS road_osm FROM r0 WHERE subtype = 'road' GROUP BY cell")
def subtype_filter(spark: SparkSession, d: str) -> DataFrame:
    return completeness.roads_by_cell(_segments(spark, d).where(F.col("subtype") == "road")).select("cell", "road_count", "road_osm")


def _people(spark: SparkSession, d: str, key: str = "c_custkey") -> DataFrame:
    rows = _table(spark, d, "customer").select(scalar.cell_hex(_key_cell(F.col(key).cast("long"))).alias("h3"), _exact("c_acctbal").alias("population"))
    return population.by_cell(rows)


@_query(_PEOPLE)
def population_by_cell(spark: SparkSession, d: str) -> DataFrame:
    return _people(spark, d)


@_query(f"SELECT {_cell('c_nationkey')} AS cell, round(sum({_eighths('c_acctbal')})) AS pop FROM customer GROUP BY 1 HAVING sum({_eighths('c_acctbal')}) > 0")
def positive_population(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.positive(_table(spark, d, "customer").select(_key_cell(F.col("c_nationkey").cast("long")).alias("cell"), _exact("c_acctbal").alias("pop")))


@_query(f"SELECT {_hex(_cell('l_suppkey'))} AS h3 FROM lineitem UNION SELECT {_hex(_cell('o_custkey'))} FROM orders WHERE o_orderpriority <> '5-LOW' UNION SELECT {_hex(_cell('c_custkey'))} FROM customer")
def union_keys(spark: SparkSession, d: str) -> DataFrame:
    return completeness.partials(_merged(spark, d)).select("h3").union(_people(spark, d).select("h3")).distinct()


def _gap(pop: str) -> str:
    return f"round(coalesce({pop}, 0) * (1 - coalesce(c.bld_osm * 1.0::DOUBLE / nullif(c.bld_count, 0), 0)))"


def _attached(sources: dict[str, str]) -> str:
    keys = " UNION ".join(["SELECT h3 FROM c", *(f"SELECT h3 FROM p_{n}" for n in sources)])
    cols = ", ".join(f"coalesce(p_{n}.population, 0) AS population_{n}, {_gap(f'p_{n}.population')} AS gap_score_{n}" for n in sources)
    joins = " ".join(f"LEFT JOIN p_{n} ON k.h3 = p_{n}.h3" for n in sources)
    return f"""WITH {_MERGED}, c AS (SELECT {_hex('cell')} AS h3, bld_count, bld_osm FROM m), {', '.join(f'p_{n} AS ({q})' for n, q in sources.items())}, k AS ({keys})
SELECT k.h3, {_hex(_parent("CAST('0x' || k.h3 AS BIGINT)"))} AS h3_parent, coalesce(c.bld_count, 0) AS bld_count, {cols} FROM k LEFT JOIN c ON k.h3 = c.h3 {joins}"""


_NATION = f"SELECT {_hex(_cell('c_nationkey'))} AS h3, round(sum({_eighths('c_acctbal')})) AS population FROM customer GROUP BY 1"


@_query(_attached({"a": _PEOPLE}))
def population_gap(spark: SparkSession, d: str) -> DataFrame:
    out = population.attach(completeness.partials(_merged(spark, d)), {"a": _people(spark, d)})
    return out.select("h3", "h3_parent", "bld_count", "population_a", "gap_score_a")


@_query(_attached({"a": _PEOPLE, "b": _NATION}))
def multi_source_gap(spark: SparkSession, d: str) -> DataFrame:
    out = population.attach(completeness.partials(_merged(spark, d)), {"a": _people(spark, d), "b": _people(spark, d, "c_nationkey")})
    return out.select("h3", "h3_parent", "bld_count", "population_a", "gap_score_a", "population_b", "gap_score_b")


@_query(f"SELECT DISTINCT {_cell('o_custkey')} AS cell, {_parent(_cell('o_custkey'))} AS parent, {_parent(_parent(_cell('o_custkey'), 5))} AS again FROM orders")
def cell_parent(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "orders").select(_key_cell(F.col("o_custkey")).alias("cell")).distinct()
    return c.select("cell", scalar.cell_parent("cell", 2).alias("parent"), scalar.cell_parent(scalar.cell_parent("cell", 5), 2).alias("again"))


@_query(f"SELECT DISTINCT {_hex(_cell('o_custkey'))} AS h3, {_cell('o_custkey')} AS cell FROM orders")
def cell_hex_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    h = _table(spark, d, "orders").select(scalar.cell_hex(_key_cell(F.col("o_custkey"))).alias("h3")).distinct()
    return h.withColumn("cell", scalar.hex_cell("h3"))


@_query(f"""SELECT {_cell('event_id % 500')} AS cell, {_rnd('85.3 + (event_id % 500 + 0.5) * 0.01', 3)} AS lon, round(sum({_eighths('value')})) AS pop FROM events WHERE isfinite(value) AND {_eighths('value')} > 0 GROUP BY 1, 2 HAVING sum(value) > 0""")
def pixel_binning(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 500
    px = _table(spark, d, "events").select(_key_cell(k).alias("cell"), scalar.rnd(scalar.pixel_centre(k, 0, 85.3, 0.01), 3).alias("lon"), _exact("value").alias("pop"))
    return timeseries.positive(timeseries.valid_pixels(px), "cell", "lon")


def _years(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "orders").select(_key_cell(F.col("o_custkey")).alias("cell"), F.year("o_orderdate").alias("year"), _exact("o_totalprice").alias("pop"))


_YEARS = f"SELECT {_cell('o_custkey')} AS cell, CAST(year(o_orderdate) AS INTEGER) AS year, round(sum({_eighths('o_totalprice')})) AS pop FROM orders GROUP BY 1, 2 HAVING sum(o_totalprice) > 0"
_WIDE = f"SELECT {_hex('cell')} AS h3, {', '.join(f'round(sum(pop) FILTER (WHERE year = {y})) AS pop_{y}' for y in YEARS)} FROM y0 GROUP BY cell"


@_query(_YEARS)
def year_cells(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.positive(_years(spark, d), "cell", "year")


@_query(f"WITH y0 AS ({_YEARS}) SELECT {_hex('cell')} AS h3, {_hex(_parent('cell'))} AS h3_parent, {', '.join(f'round(sum(pop) FILTER (WHERE year = {y})) AS pop_{y}' for y in YEARS)} FROM y0 GROUP BY cell")
def pivot_years(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.pivot_years(year_cells(spark, d), YEARS)


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.pivot_years(year_cells(spark, d), YEARS, None)


_TOTALS = " UNION ALL ".join(f"SELECT {y} AS year, coalesce(sum(pop_{y}), 0) AS total FROM w" for y in YEARS)


@_query(f"WITH y0 AS ({_YEARS}), w AS ({_WIDE}) {_TOTALS}")
def unpivot_year_totals(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.year_totals(_wide(spark, d), YEARS)


@_query(f"WITH y0 AS ({_YEARS}), w AS ({_WIDE}), t AS ({_TOTALS}), b AS (SELECT total AS base FROM t ORDER BY year LIMIT 1) SELECT year, total, CAST(CASE WHEN base = 0 THEN 0 ELSE floor((total - base) / base * 100.0 + 0.5) END AS BIGINT) AS change FROM t, b")
def year_change(spark: SparkSession, d: str) -> DataFrame:
    return assess.year_change(unpivot_year_totals(spark, d))


_COVERED = f"(SELECT {_hex(_cell('s_suppkey * 37'))} AS h3 FROM supplier)"


def _area(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "supplier").select(scalar.cell_hex(_key_cell(F.col("s_suppkey") * 37)).alias("h3"))


@_query(f"WITH y0 AS ({_YEARS}), w AS ({_WIDE}) SELECT h3, coalesce(pop_{YEARS[0]}, 0) AS first_year FROM w WHERE h3 IN {_COVERED}")
def covered_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return assess.inside(assess.series_rows(_wide(spark, d), YEARS), _area(spark, d)).select("h3", F.element_at("series", 1).alias("first_year"))


@_query(f"WITH p AS ({_PEOPLE}) SELECT h3 FROM {_COVERED} a WHERE h3 NOT IN (SELECT h3 FROM p)")
def empty_cells_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return assess.empty_cells(_area(spark, d), _people(spark, d))


@_query(f"SELECT DISTINCT {_hex(_parent(_cell('c_custkey')))} AS h3_parent FROM customer")
def distinct_parents(spark: SparkSession, d: str) -> DataFrame:
    return assess.parents_of(_people(spark, d))


# People by nation: 25 cells, each with a parent of its own.
_PRUNED = [f"{(1 << 59) + (config.PARENT_RESOLUTION << 52) + (n % 122 << 45) + ((n % 7) << 42) + ((n % 49 // 7) << 39) + ((1 << 39) - 1):x}" for n in (0, 7, 14)]


@_query(f"WITH p AS ({_NATION}) SELECT h3, population, {_hex(_parent("CAST('0x' || h3 AS BIGINT)"))} AS h3_parent FROM p WHERE {_hex(_parent("CAST('0x' || h3 AS BIGINT)"))} IN ({', '.join(repr(p) for p in _PRUNED)})")
def tile_partition_pruning(spark: SparkSession, d: str) -> DataFrame:
    rows = _people(spark, d, "c_nationkey").withColumn("h3_parent", scalar.cell_hex(scalar.cell_parent(scalar.hex_cell("h3"), config.PARENT_RESOLUTION)))
    out = tiles.scratch(spark, "tiles")
    tiles.write_tiles(rows, out)
    return tiles.read_pruned(spark, out, _PRUNED).select("h3", "population", F.col("h3_parent").cast("string").alias("h3_parent"))


@_query(f"WITH p AS ({_PEOPLE}) SELECT h3, population AS population_a, CAST(NULL AS DOUBLE) AS population_b FROM p UNION ALL SELECT h3, NULL, population FROM ({_NATION})")
def schema_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    a, b = (_people(spark, d).withColumnRenamed("population", "population_a"), _people(spark, d, "c_nationkey").withColumnRenamed("population", "population_b"))
    out = tiles.scratch(spark, "union")
    a.write.parquet(f"{out}/tile=1")
    b.write.parquet(f"{out}/tile=2")
    return spark.read.option("mergeSchema", "true").parquet(f"{out}/tile=1", f"{out}/tile=2").select("h3", "population_a", "population_b")


@_query(f"""WITH q AS ({_attached({'a': _PEOPLE})}), {_MERGED.replace('b0 AS', 'b0 AS', 1)}
SELECT (SELECT count(*) FROM q) AS cells, CAST(sum(bld_count) AS BIGINT) AS bld_count, CAST(sum(bld_osm) AS BIGINT) AS bld_osm, {_rnd('sum(bld_osm) * 100.0::DOUBLE / nullif(sum(bld_count), 0)')} AS osm_pct,
 CAST(sum(road_count) AS BIGINT) AS road_count, CAST(sum(road_osm) AS BIGINT) AS road_osm, {_rnd('sum(road_osm) * 100.0::DOUBLE / nullif(sum(road_count), 0)')} AS road_pct,
 round(sum(road_len_m) / 1000.0) AS km, (SELECT sum(population_a) FROM q) AS people, (SELECT sum(gap_score_a) FROM q) AS gap FROM m""")
def area_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = population.attach(completeness.partials(_merged(spark, d)), {"a": _people(spark, d)})
    return assess.summary(rows, "population_a", "gap_score_a").withColumn("km", scalar.rnd("km"))


@_query(f"WITH p AS ({_PEOPLE}) SELECT h3, {_rnd('population / nullif((SELECT greatest(0, max(population)) FROM p), 0)', 6)} AS t FROM p")
def metric_scale(spark: SparkSession, d: str) -> DataFrame:
    return assess.scaled(_people(spark, d), "population", F.col("population")).select("h3", scalar.rnd("t", 6).alias("t"))


def _channel(i: int) -> str:
    (_, a), (_, b), (_, c) = scalar.STOPS
    return f"CAST(floor(CASE WHEN t <= 0.5 THEN {a[i]}.0::DOUBLE + {b[i] - a[i]} * (t / 0.5::DOUBLE) ELSE {b[i]}.0::DOUBLE + {c[i] - b[i]} * ((t - 0.5::DOUBLE) / 0.5::DOUBLE) END + 0.5::DOUBLE) AS INTEGER)"


@_query(f"WITH s AS (SELECT l_orderkey, l_linenumber, l_extendedprice, greatest(0.0::DOUBLE, least(1.0::DOUBLE, l_discount * 12.0::DOUBLE)) AS t FROM lineitem) SELECT l_orderkey, l_linenumber, l_extendedprice, {_channel(0)} AS r, {_channel(1)} AS g, {_channel(2)} AS b FROM s")
def color_ramp(spark: SparkSession, d: str) -> DataFrame:
    r, g, b = scalar.ramp(F.col("l_discount") * 12.0)
    return _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", r.alias("r"), g.alias("g"), b.alias("b"))


@_query(f"SELECT s_suppkey, {_rnd('abs((s_acctbal / 10000.0::DOUBLE) * 111.32::DOUBLE * cos((50.0::DOUBLE + 51.0::DOUBLE) / 2.0::DOUBLE * pi() / 180.0::DOUBLE) * (51.0::DOUBLE - 50.0::DOUBLE) * 110.57::DOUBLE)', 3)} AS km2 FROM supplier")
def viewport_area(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("s_acctbal") / 10000.0
    return _table(spark, d, "supplier").select("s_suppkey", scalar.rnd(scalar.view_area_km2(F.lit(0.0), F.lit(50.0), e, F.lit(51.0)), 3).alias("km2"))


_ISO = "substr(lower(replace(c_mktsegment, ' ', '')), 1, 3)"
_ID = f"CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE '' END || {_ISO} || '_pop_' || (2020 + c_custkey % 5) || '_CN_1km_R202' || (4 + CASE WHEN c_custkey % 50 < 40 THEN 1 ELSE 0 END) || 'A_UA_v1'"
_ASSETS = f"SELECT id, regexp_extract(id, '{config.ASSET_PATTERN}', 1) AS iso, CAST(regexp_extract(id, '{config.ASSET_PATTERN}', 2) AS INTEGER) AS year, regexp_extract(id, '{config.ASSET_PATTERN}', 3) AS release FROM (SELECT {_ID} AS id FROM customer) WHERE regexp_matches(id, '{config.ASSET_PATTERN}')"


def _assets(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    iso = F.substring(F.lower(F.regexp_replace("c_mktsegment", " ", "")), 1, 3)
    release = F.concat(F.lit("R202"), F.when(k % 50 < 40, "5").otherwise("4"), F.lit("A"))
    ids = F.concat(F.when(k % 7 == 0, "x").otherwise(""), iso, F.lit("_pop_"), (F.lit(2020) + k % 5).cast("string"), F.lit("_CN_1km_"), release, F.lit("_UA_v1"))
    return catalog.assets_of(_table(spark, d, "customer").select(ids.alias("id")))


@_query(_ASSETS)
def asset_regex(spark: SparkSession, d: str) -> DataFrame:
    return _assets(spark, d)


@_query(f"WITH a AS ({_ASSETS}) SELECT id, iso, year, release FROM a WHERE release = (SELECT max(release) FROM a)")
def latest_release(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(_assets(spark, d))


_LAG = f"SELECT iso, year, release FROM ({_ASSETS}) WHERE iso <> 'bui' OR release = 'R2024A'"


@_query(f"WITH a AS ({_LAG}) SELECT DISTINCT iso FROM a WHERE iso NOT IN (SELECT iso FROM a WHERE release = (SELECT max(release) FROM a))")
def lagging_countries(spark: SparkSession, d: str) -> DataFrame:
    return catalog.lagging(_assets(spark, d).where("iso <> 'bui' OR release = 'R2024A'"))


@_query(f"WITH a AS ({_ASSETS}), s AS (SELECT year, string_agg(DISTINCT iso, ',' ORDER BY iso) AS isos FROM a GROUP BY year) SELECT year, isos, (SELECT count(DISTINCT isos) = 1 FROM s) AS same FROM s")
def consistent_years(spark: SparkSession, d: str) -> DataFrame:
    s = catalog.country_sets(_assets(spark, d)).select("year", F.array_join("isos", ",").alias("isos"))
    one = s.agg((F.count_distinct("isos") == 1).alias("same"))
    return s.crossJoin(F.broadcast(one))


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@_query(f"SELECT {_hex(_cell('c_nationkey'))} AS h3, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def duplicate_cells(spark: SparkSession, d: str) -> DataFrame:
    return population.duplicates(_table(spark, d, "customer").select(scalar.cell_hex(_key_cell(F.col("c_nationkey").cast("long"))).alias("h3")))


_HAVERSINE = "2.0 * 6371008.8 * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * pow(sin(radians(e - c) / 2), 2))))"


@_query(f"WITH s AS (SELECT c_custkey, c_acctbal / 200.0::DOUBLE AS a, c_custkey % 80 * 1.0::DOUBLE AS b, c_custkey % 170 * 1.0::DOUBLE AS c, -(c_custkey % 90) * 1.0::DOUBLE AS e FROM customer) SELECT c_custkey, {_rnd(_HAVERSINE, 2)} AS metres FROM s")
def great_circle_length(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    m = scalar.great_circle_m(F.col("c_acctbal") / 200.0, (k % 170) * 1.0, (k % 80) * 1.0, -(k % 90) * 1.0)
    return _table(spark, d, "customer").select("c_custkey", scalar.rnd(m, 2).alias("metres"))


@_query(f"WITH y0 AS ({_YEARS}), w AS ({_WIDE}), p AS ({_PEOPLE}) SELECT p.h3, coalesce(CASE WHEN w.h3 IS NOT NULL THEN coalesce(w.pop_1996, 0) END, p.population, 0) AS people FROM p LEFT JOIN w ON p.h3 = w.h3")
def series_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = _people(spark, d).withColumnRenamed("population", "population_a")
    return assess.with_year(rows, assess.series_rows(_wide(spark, d), YEARS), YEARS, 1996, "a").select("h3", "people")


@_query(f"WITH {_MERGED} SELECT {_hex('cell')} AS h3, bld_count, bld_osm, {_PCT}, road_count, road_osm, {_rnd('road_len_m')} AS road_len_m, 0.0::DOUBLE AS population_x, 0.0::DOUBLE AS gap_score_x FROM m")
def tile_rows(spark: SparkSession, d: str) -> DataFrame:
    return assess.tile_rows(completeness_cells(spark, d), ["x"])


@_query(f"WITH p AS ({_PEOPLE}) SELECT h3 FROM {_COVERED} a WHERE h3 NOT IN (SELECT h3 FROM p) ORDER BY h3 LIMIT 3")
def first_missing(spark: SparkSession, d: str) -> DataFrame:
    return empty_cells_anti_join(spark, d).orderBy("h3").limit(3)


@_query(f"SELECT year, iso, max('https://example.org/' || id || '.tif') AS href FROM ({_ASSETS}) GROUP BY year, iso")
def year_map(spark: SparkSession, d: str) -> DataFrame:
    maps = catalog.hrefs_by_year(_assets(spark, d).withColumn("href", F.concat(F.lit("https://example.org/"), "id", F.lit(".tif"))))
    return maps.select("year", F.explode("hrefs").alias("iso", "href"))


def _points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return _table(spark, d, "events").select("event_id", ((k * 37) % 170 - 85.0 + F.col("value") / 1000.0).alias("lat"), ((k * 101) % 360 - 180.0).alias("lon"))


@_query()
def latlng_to_cell(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).select("event_id", grid.latlng_to_cell(F.col("lat"), F.col("lon"), 8).alias("cell"))


def _inverse_sql(rounds: int = 6) -> str:
    """The inverse formula on the spheroid, a step of its iteration a table; short lines settle in three."""
    f, a = "(1.0::DOUBLE / 298.257223563::DOUBLE)", "6378137.0::DOUBLE"
    out = f"""WITH p AS (SELECT event_id, (event_id * 37) % 170 - 85.0::DOUBLE + value / 1000.0::DOUBLE AS lat, (event_id * 101) % 360 - 180.0::DOUBLE AS lon FROM events),
u AS (SELECT event_id, radians((lon + 0.01::DOUBLE) - lon) AS l, atan((1 - {f}) * tan(radians(lat))) AS u1, atan((1 - {f}) * tan(radians(lat + 0.01::DOUBLE))) AS u2 FROM p),
t0 AS (SELECT *, l AS lam FROM u)"""
    for i in range(rounds):
        out += f""",
s{i} AS (SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM t{i}),
c{i} AS (SELECT *, atan2(ss, cs) AS sigma, cos(u1) * cos(u2) * sin(lam) / ss AS sa FROM s{i}),
m{i} AS (SELECT *, 1 - sa * sa AS ca, CASE WHEN 1 - sa * sa = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / (1 - sa * sa) END AS cm FROM c{i}),
k{i} AS (SELECT *, {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) AS c FROM m{i}),
t{i + 1} AS (SELECT event_id, l, u1, u2, l + (1 - c) * {f} * sa * (sigma + c * ss * (cm + c * cs * (-1 + 2 * cm * cm))) AS lam{", ss, cs, sigma, ca, cm" if i == rounds - 1 else ""} FROM k{i})"""
    b = f"({a} * (1 - {f}))"
    out += f""",
g AS (SELECT *, ca * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS k FROM t{rounds}),
h AS (SELECT *, 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS big, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS small FROM g)
SELECT event_id, {_rnd(f'{b} * big * (sigma - small * ss * (cm + small / 4 * (cs * (-1 + 2 * cm * cm) - small / 6 * cm * (-3 + 4 * ss * ss) * (-3 + 4 * cm * cm))))', 1)} AS metres FROM h"""
    return out


@_query(_inverse_sql())
def geodesic_length(spark: SparkSession, d: str) -> DataFrame:
    line = geodesy.segment_wkb(F.col("lon"), F.col("lat"), F.col("lon") + 0.01, F.col("lat") + 0.01)
    return _points(spark, d).select("event_id", scalar.rnd(geodesy.spheroid_length(line), 1).alias("metres"))


def _polygons(spark: SparkSession, d: str) -> DataFrame:
    """An area for each supplier: a box, a triangle, or a box with a hole; some lie across the antimeridian, others around a pole."""
    k = F.col("s_suppkey")
    size = 0.2 + F.abs(F.col("s_acctbal")) / 8000.0
    w, s = (k * 37) % 360 - 180.0 - 0.3, (k * 17) % 150 - 75.0

    def ring(*points: tuple[Column, Column]) -> Column:
        return F.array(*(F.array(F.pmod(x + 180.0, F.lit(360.0)) - 180.0, y) for x, y in points))

    box = ring((w, s), (w + size, s), (w + size, s + size), (w, s + size), (w, s))
    hole = ring((w + size * 0.25, s + size * 0.25), (w + size * 0.5, s + size * 0.25), (w + size * 0.5, s + size * 0.75))
    cap = ring(*((F.lit(x * 1.0), 86.0 + size) for x in (-150, -60, 30, 120)))
    shape = F.when(k % 50 == 0, F.array(cap)).when(k % 3 == 0, F.array(box, hole)).when(k % 3 == 1, F.array(ring((w, s), (w + size, s), (w, s + size)))).otherwise(F.array(box))
    return _table(spark, d, "supplier").select(k.cast("long").alias("polygon"), shape.alias("rings"))


@_query()
def polygon_cells(spark: SparkSession, d: str) -> DataFrame:
    spans = cover.intervals(cover.compact_cover(_polygons(spark, d), 5), 5, "polygon")
    return cover.expanded(spans, 5, "polygon").select(F.col("polygon").alias("s_suppkey"), scalar.cell_hex("cell").alias("h3"))


@_query()
def area_cells(spark: SparkSession, d: str) -> DataFrame:
    return cover.cells_in(_polygons(spark, d), 5)


_BARE = ", ".join(map(str, (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)))  # base cells that are pentagons


def _coarse(spark: SparkSession, d: str, least: int, kinds: int) -> DataFrame:
    """Cells of several resolutions, none below a pentagon."""
    k = F.col("s_suppkey") * 37
    cells = _table(spark, d, "supplier").where(f"(s_suppkey * 37) % 122 NOT IN ({_BARE})").select("s_suppkey", _key_cell(k).alias("fine"))
    res = F.col("s_suppkey") % kinds
    cell = F.coalesce(*(F.when(res == i, scalar.cell_parent("fine", least + i)) for i in range(kinds)))
    return cells.select(cell.alias("cell"))


def _coarse_sql(least: int, kinds: int) -> str:
    cases = " ".join(f"WHEN {i} THEN {_parent(_cell('s_suppkey * 37'), least + i)}" for i in range(kinds))
    return f"SELECT DISTINCT CASE s_suppkey % {kinds} {cases} END AS cell FROM supplier WHERE (s_suppkey * 37) % 122 NOT IN ({_BARE})"


@_query(f"""WITH c AS ({_coarse_sql(2, 4)}), o AS (SELECT {_cell('o_custkey')} AS cell, o_orderkey FROM orders)
SELECT o_orderkey, {_hex('cell')} AS h3 FROM o WHERE {' OR '.join(f"{_parent('o.cell', r)} IN (SELECT cell FROM c)" for r in range(2, 6))}""")
def interval_semi_join(spark: SparkSession, d: str) -> DataFrame:
    spans = cover.intervals(_coarse(spark, d, 2, 4), 8)
    rows = _table(spark, d, "orders").select("o_orderkey", _key_cell(F.col("o_custkey")).alias("cell"))
    return cover.inside(rows, spans, 8).select("o_orderkey", scalar.cell_hex("cell").alias("h3"))


@_query(f"""WITH c AS ({_coarse_sql(3, 3)}), f AS (
 SELECT (cell & CAST({~(15 << 52)} AS BIGINT) & CAST({~(7 << 33)} AS BIGINT) & CAST({~(7 << 30)} AS BIGINT)) | CAST({5 << 52} AS BIGINT) AS bare, (cell >> 52) & 15 AS res, (cell >> 33) & 7 AS d4, (cell >> 30) & 7 AS d5 FROM c)
SELECT DISTINCT {_hex("bare | (CAST(CASE WHEN res >= 4 THEN d4 ELSE a END AS BIGINT) << 33) | (CAST(CASE WHEN res >= 5 THEN d5 ELSE b END AS BIGINT) << 30)")} AS h3 FROM f, range(7) AS x(a), range(7) AS y(b)""")
def union_of_covers(spark: SparkSession, d: str) -> DataFrame:
    return cover.expanded(cover.intervals(_coarse(spark, d, 3, 3), 5), 5).select(scalar.cell_hex("cell").alias("h3"))


@_query()
def geojson_features(spark: SparkSession, d: str) -> DataFrame:
    return assess.features(polygon_cells(spark, d))
