"""Mixing sources to target weights by hash-threshold histograms, with DataFrame operations only.

Sizes are summed by source and hash bucket.  For each source the cumulative histogram gives the bucket
in which its budget ends; only that bucket is divided again, by the next bits of the hash, until the
budget ends at a bucket's edge or in a bucket of one row.  The result is a threshold for each source,
and a row is taken once more if its hash lies below it: nothing is sorted and no row moves for the
decision.  Thresholds are nested: a larger budget for a source takes a superset of the rows.

The hash is that of the row's key, source and text, so rows that share a key are told apart.  Rows equal
in all three are interchangeable; where the budget ends among them, a hash of their places divides them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexspark.llm import common

#: Weights of the sources in code point order, repeating; and how often a source may be repeated.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BITS, LEVELS = 12, 5  # 60 bits of the hash in all
SEED = 77
#: A table of sources is broadcast up to so many rows; beyond, rows are joined by source and salt.
BROADCAST_SOURCES = 500_000
SALTS = 64


@dataclass(frozen=True)
class Names:
    """Columns read; all others of the input are left alone."""

    id: str = "doc_id"
    source: str = "source"
    text: str = "text"


def row_hash(names: Names) -> Column:
    """60 bits of the MD5 of a row's key, source and text; nulls differ from empty texts."""

    def marked(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c), F.lit(""))

    whole = F.concat_ws("|", marked(F.col(names.id).cast("string")), marked(F.col(names.source).cast("string")), marked(F.md5(F.col(names.text))))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def place_hash(at: str) -> Column:
    """60 bits of a hash of a row's place."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(at)), 4)


def _top(h: Column, level: int) -> Column:
    return F.shiftright(h, BITS * (LEVELS - 1 - level))


def _by_source(rows: DataFrame, src: str, h: Column, table: DataFrame, key: str, n_sources: int) -> DataFrame:
    """rows joined with a table of one row per source: no shuffle of rows, or one by source and salt if sources are very many."""
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(table), F.col(src).eqNullSafe(F.col(key)))
    salt, other = common.free_names([*rows.columns, *table.columns], "salt", "table_salt")
    dealt = table.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn(salt, F.pmod(h, F.lit(SALTS)).cast("int"))
    return salted.join(dealt, F.col(src).eqNullSafe(F.col(key)) & (F.col(salt) == F.col(other))).drop(salt, other)


def _ranked(sizes: DataFrame) -> DataFrame:
    """src, source_size and rk, the place of the source in code point order, null last.

    Sources are sorted in ranges; a range's first place is the number of sources in those before it, so no
    task ranks them all.
    """
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size")).orderBy(F.col("src").asc_nulls_last())
    per = common.stored(per.select("src", "source_size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sources")
    counts = per.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select(F.col("part").alias("p2"), (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    at = F.col("at").bitwiseAND((1 << 33) - 1)
    return per.join(F.broadcast(before), F.col("part") == F.col("p2")).select("src", "source_size", (F.col("before") + at).alias("rk"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> tuple[DataFrame, int]:
    """One row per source: src, source_size, target, full; and the number of sources.

    A source's weight is that of its place in code point order, null last.  Targets are shares of the
    total in proportion to the weights; one above `repeats` times its source's size stops there, and
    the excess goes to the others by weight until none is above.  Each round is one aggregate over the
    table of sources; the factor only rises, so rounds end.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rk") % len(weights)).cast("int") + 1)
    ranked = common.stored(_ranked(sizes).select("src", "source_size", weight.cast("double").alias("weight")), "weights")
    total, n = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    budget = share * total
    top = F.col("source_size").cast("double") * repeats
    factor = 0.0
    while n:
        held = top <= F.col("weight") * factor
        full, open_weight = ranked.agg(
            F.sum(F.when(held, top).otherwise(0.0)), F.sum(F.when(held, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            factor = float("inf")
            break
        now = max(0.0, budget - full) / open_weight
        if now <= factor:
            break
        factor = now
    target = top if factor == float("inf") else F.least(top, F.col("weight") * factor)
    return ranked.select("src", "source_size", target.alias("target"), (target >= top).alias("full")), n


def thresholds(sizes: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """src, source_size, target, `whole` (copies every row gets), `low` and `low2`: a row gets one more if its
    hash is below low, or equals low and the hash of its place is below low2.

    Level by level, the histogram of the rows in each source's boundary bucket is summed by the next
    12 bits; a source leaves when its budget ends at a bucket's edge or in a bucket of one row, which is
    taken if that comes nearer to the target.  Levels end when no source is left.
    """
    per_row = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    whole = F.when(F.col("full"), F.floor(F.round(per_row))).otherwise(F.floor(per_row)).cast("long")
    state = targets.withColumn("whole", whole)
    state = state.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    zero = F.lit(0).cast("long")
    state = state.withColumns({"open": F.col("rest") > 0, "bucket": zero, "low": zero, "low2": zero}).drop("full")
    state = common.stored(state, "edges")
    by_bucket = Window.partitionBy("s3").orderBy("b")
    for level in range(2 * LEVELS):
        if state.where("open").isEmpty():
            break
        among_equal, step = level >= LEVELS, level % LEVELS
        edge = state.where("open").select(F.col("src").alias("s2"), F.col("bucket").alias("parent"), F.col("low").alias("tie"))
        rows = _by_source(sizes, "src", F.col("h"), edge, "s2", n_sources)
        if among_equal:
            rows = rows.where(F.col("h") == F.col("tie"))
        b = _top(place_hash("at") if among_equal else F.col("h"), step)
        inside = rows.where(F.shiftright(b, BITS) == F.col("parent")) if step else rows
        hist = inside.groupBy(F.col("src").alias("s3"), b.alias("b")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        cum = hist.withColumn("upto", F.sum("words").over(by_bucket))
        joined = state.where("open").join(cum, F.col("src").eqNullSafe(F.col("s3")), "left")
        fits = F.col("upto") <= F.col("rest")
        picked = joined.groupBy(*state.columns).agg(
            F.max(F.when(fits, F.col("upto"))).alias("used"), F.min(F.when(~fits, F.struct("b", "words", "n"))).alias("end")
        )
        left = F.col("rest") - F.coalesce(F.col("used"), F.lit(0)).cast("double")
        one = (F.col("end.n") == 1) | F.lit(level == 2 * LEVELS - 1)
        more = F.col("end").isNotNull() & (left > 0) & ~one
        # No bucket beyond the budget: every row of the parent is below the next bucket.
        edge_at = F.coalesce(F.col("end.b"), F.shiftleft((F.col("bucket") if step else zero) + 1, BITS))
        edge_at = F.when(one & (F.col("end.words") - left < left), edge_at + 1).otherwise(edge_at)
        cut = F.shiftleft(edge_at, BITS * (LEVELS - 1 - step))
        low, low2 = (F.col("low"), cut) if among_equal else (cut, zero)
        moved = picked.select(
            "src", "source_size", "target", "whole", left.alias("rest"), more.alias("open"), edge_at.alias("bucket"), low.alias("low"), low2.alias("low2")
        )
        state = common.stored(state.where("not open").unionByName(moved), "edges")
    return state.select("src", "source_size", "target", "whole", "low", "low2")


def _sizes(docs: DataFrame, names: Names, at: Column) -> DataFrame:
    """id, src, size, h and at (the row's place) of every row."""
    return common.stored(
        docs.select(
            F.col(names.id).alias("id"),
            F.col(names.source).alias("src"),
            common.word_count(F.coalesce(F.col(names.text), F.lit(""))).alias("size"),
            row_hash(names).alias("h"),
            at.alias("at"),
        ),
        "sizes",
    )


def _copies(h: Column, at: str, repeats: int, whole: str, low: str, low2: str) -> Column:
    more = (h < F.col(low)) | ((h == F.col(low)) & (place_hash(at) < F.col(low2)))
    return F.least(F.lit(repeats), F.col(whole) + more.cast("long"))


def mix(docs: DataFrame, names: Names = Names(), weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = MOST_REPEATS) -> DataFrame:
    """The mix as numbers: doc_id, size, source_size, target, taken, for every row of docs.

    size counts the words of the text (null: 0).  taken is size times the copies the mix holds of the
    row, 0 to `repeats`.  Repeated rows each count; of rows equal in key, source and text as many are
    taken as the target asks for.  Null sources form one source; a row of no words takes none; an empty
    table gives no rows.  Other columns of docs, whatever their names, are not read.
    """
    sizes = _sizes(docs, names, F.monotonically_increasing_id())
    targets, n = source_targets(sizes, weights, share, repeats)
    limits = thresholds(sizes, targets, n).withColumnRenamed("src", "s2")
    return _by_source(sizes, "src", F.col("h"), limits, "s2", n).select(
        F.col("id").alias(names.id), "size", "source_size", "target",
        (F.col("size") * _copies(F.col("h"), "at", repeats, "whole", "low", "low2")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, names: Names = Names(), weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = MOST_REPEATS) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns and mix_copies, how often each is taken.

    The thresholds are joined to the rows as they are read; the texts are not shuffled.  Only where a
    budget ends among equal rows are the rows written first, so that their places are fixed.  A column
    mix_copies of docs is replaced; any other name may occur.
    """
    docs = docs.drop("mix_copies")
    at, s2, whole, low, low2 = common.free_names([*docs.columns, "mix_copies"], "at", "s2", "whole", "low", "low2")
    rows = docs.withColumn(at, F.lit(0).cast("long"))
    sizes = _sizes(docs, names, F.monotonically_increasing_id())
    targets, n = source_targets(sizes, weights, share, repeats)
    limits = thresholds(sizes, targets, n)
    if not limits.where("low2 > 0").isEmpty():
        rows = common.stored(docs.withColumn(at, F.monotonically_increasing_id()), "rows")
        sizes = _sizes(rows, names, F.col(at))
        limits = thresholds(sizes, targets, n)
    limits = limits.select(*(F.col(c).alias(to) for c, to in (("src", s2), ("whole", whole), ("low", low), ("low2", low2))))
    joined = _by_source(rows, names.source, row_hash(names), limits, s2, n)
    copies = _copies(row_hash(names), at, repeats, whole, low, low2)
    return joined.withColumn("mix_copies", copies.cast("int")).where("mix_copies > 0").drop(at, s2, whole, low, low2)
