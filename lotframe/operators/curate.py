"""Filters, projection, union, keep-first dedupe, stable order, per-group limits, and incremental append.

Order is data: rows carry ``_pos`` (any orderable column or struct), and no window spans the whole table.

Deviations from the record-at-a-time original, on purpose: projection runs after dedupe, so that rows are told apart by
their true url; sorting never fails on nulls, which go last in both directions (``strict=True`` tests for them and
returns the input order instead).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lotframe.schema import NA, TYPES, field_matches
from lotframe.sources.shared import fresh_path, written

#: What ``skip_counts`` may count.
OUTCOMES = ("kept", "country", "modified", "year", "vin", "year is null")


# predicates


def foreign(country: Column) -> Column:
    return country.isNotNull() & ~country.isin("", "USA")


def modified(title: Column) -> Column:
    return F.contains(F.lower(title), F.lit("modified"))


def out_of_years(year: Column, low: Column, high: Column) -> Column:
    """Outside inclusive bounds; a bound of null or 0 is none. Null if the year is null and there is a bound."""
    low, high = F.nullif(low, F.lit(0)), F.nullif(high, F.lit(0))
    return (low.isNotNull() & (year < low)) | (high.isNotNull() & (year > high))


def no_vin(vin: Column) -> Column:
    return vin.isNull() | vin.isin("", NA)


def sold(price: Column) -> Column:
    return F.coalesce(price > 0, F.lit(False))


def skip_reason(df: DataFrame, min_year: str = "min_year", max_year: str = "max_year") -> DataFrame:
    """Adds ``skip_reason`` (null: kept; else country, modified, year or vin, the first that holds) and ``_error`` for rows
    that cannot be judged: a year is null where there is a bound."""
    outside = out_of_years(F.col("year"), F.col(min_year), F.col(max_year))
    bounded = F.coalesce(F.nullif(F.col(min_year), F.lit(0)), F.nullif(F.col(max_year), F.lit(0))).isNotNull()
    earlier = foreign(F.col("country")) | modified(F.coalesce("title", F.lit("")))
    reason = (
        F.when(foreign(F.col("country")), "country")
        .when(modified(F.coalesce("title", F.lit(""))), "modified")
        .when(F.coalesce(outside, F.lit(False)), "year")
        .when(no_vin(F.col("vin")), "vin")
    )
    error = F.when(~earlier & F.col("year").isNull() & bounded, "year is null")
    return df.withColumns({"skip_reason": F.when(error.isNull(), reason), "_error": error})


def write_kept(judged: DataFrame, path: str) -> dict[str, int]:
    """Writes the kept rows and returns how many rows had each outcome, counted in the same pass."""
    seen = Observation("outcomes")
    outcome = F.when(F.col("_error").isNotNull(), F.col("_error")).otherwise(F.coalesce("skip_reason", F.lit("kept")))
    counts = [F.count_if(outcome == o).alias(o) for o in OUTCOMES]
    judged.observe(seen, *counts).where("skip_reason IS NULL AND _error IS NULL").drop("skip_reason", "_error").write.parquet(path)
    return {k: n for k, n in seen.get.items() if n}


def skip_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("_error", "skip_reason", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


def has_value(df: DataFrame, target=NA, fields: Sequence[str] | None = None) -> Column:
    """Does any of the fields (all, if none are named) equal the target? Fields that are absent do not match."""
    found = [field_matches(df, f, target) for f in (fields or df.columns) if f in df.columns]
    return reduce(lambda a, b: a | b, (c for c in found if c is not None), F.lit(False))


def value_filter(df: DataFrame, target=NA, fields: Sequence[str] | None = None, invert: bool = False) -> DataFrame:
    hit = has_value(df, target, fields)
    return df.where(~hit if invert else hit)


def project(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Named fields keep their values, all others go to the defaults of a listing; other columns are kept."""
    default = {"source": F.lit("unknown"), "url": F.lit(""), "title": F.lit(""), "convertible": F.lit(False)}
    columns = []
    for c in df.columns:
        if c in fields or c not in TYPES:
            columns.append(F.col(c))
        else:
            empty = F.array() if TYPES[c].simpleString().startswith("array") else default.get(c, F.lit(None))
            columns.append(empty.cast(TYPES[c]).alias(c))
    return df.select(*columns)


# joins with small tables


def attach_targets(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """Pages with the target of their slug. Targets are a parameter table; Spark broadcasts them if they are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise."""
    return pages.join(targets, "slug")


#: The most bits of a key filter: 8 MB, as it is broadcast. More keys only let more others pass.
FILTER_BITS = 1 << 26


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_bucket, _bits): a Bloom filter of one hash, as bitmaps of 32,768 bits. Built by one aggregation with map-side combine."""
    at = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return keys.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))


def may_hold(df: DataFrame, filtered: DataFrame, key: str, bits: int, name: str) -> DataFrame:
    """Adds a flag: false only where the key is surely in no row that the filter was built of."""
    at = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (position % 8).cast("int")) == 1
    marked = df.withColumn("_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(filtered), "_bucket", "left")
    return marked.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_bucket", "_bits")


def mark_known(df: DataFrame, known: DataFrame, key: str = "lot_number", prefilter: bool = False) -> DataFrame:
    """Adds ``known``: is the key in the table of known keys? Null and N/A never are. ``prefilter``: for a large table of
    known keys; a Bloom filter of it is broadcast first, and only rows that it lets pass are shuffled and joined."""
    found = known.select(F.col(key).alias("_known_key")).where(F.col(key).isNotNull() & (F.col(key).cast("string") != NA)).distinct()

    def joined(rows: DataFrame) -> DataFrame:
        return rows.join(found, F.col(key) == F.col("_known_key"), "left").withColumn("known", F.col("_known_key").isNotNull()).drop("_known_key")

    if not prefilter:
        return joined(df)
    bits = min(FILTER_BITS, max(1 << 15, 32 * found.count()))
    passed = may_hold(df, key_filter(found, "_known_key", bits), key, bits, "_may")
    return joined(passed.where("_may").drop("_may")).unionByName(passed.where("NOT _may").drop("_may").withColumn("known", F.lit(False)))


# union, dedupe, order, limits


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames with ``_pos`` = (frame, position); columns that a frame lacks are null."""
    placed = [f.withColumn("_pos", F.struct(F.lit(i).alias("frame"), F.col("_pos").alias("at"))) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)


def keep_first(df: DataFrame, key: str = "url", pos: str = "_pos", drop_falsy: bool = True) -> DataFrame:
    """The first row of each key by position. Rows whose key is null, empty, zero or false go too unless ``drop_falsy`` is
    off (then they are keys like any other)."""
    if drop_falsy:
        kind = df.schema[key].dataType.simpleString()
        falsy = {"string": "", "boolean": False}.get(kind, 0 if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal") else None)
        df = df.where(F.col(key).isNotNull() & (F.col(key) != falsy)) if falsy is not None else df.where(F.col(key).isNotNull())
    first = F.row_number().over(Window.partitionBy(key).orderBy(pos))
    return df.withColumn("_first", first).where("_first = 1").drop("_first")


def dedupe_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """combined, final and removed counts, one row."""
    a = before.agg(F.count("*").alias("combined")).withColumn("_one", F.lit(1))
    b = after.agg(F.count("*").alias("final")).withColumn("_one", F.lit(1))
    return a.join(b, "_one").select("combined", "final", (F.col("combined") - F.col("final")).alias("removed"))


def sort_rows(df: DataFrame, fields: Sequence[str], reverse: bool = False, pos: str = "_pos", strict: bool = False) -> DataFrame:
    """Stable order by several fields; in both directions ties stay in their original order and nulls come last."""
    if not fields or strict and not df.where(reduce(lambda a, b: a | b, (F.col(f).isNull() for f in fields))).isEmpty():
        return df.orderBy(pos)
    return df.orderBy(*(F.col(f).desc_nulls_last() if reverse else F.col(f).asc_nulls_last() for f in fields), pos)


def ranked(df: DataFrame, by: Sequence[str | Column], name: str = "rank", start: int | Column = 1) -> DataFrame:
    """The rows with their places 1, 2, ... in the order of ``by``, which should tell all rows apart. The table is sorted by
    ranges and written; a row's place is that in its range behind what earlier ranges hold, which is one number a range, so
    no task sorts more than a range."""
    spark = df.sparkSession
    laid = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    laid = laid.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    laid = written(laid.withColumn("_at", F.col("_at") - F.shiftleft(F.col("_range").cast("long"), 33)), fresh_path(spark, "ranked"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = laid.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    return laid.join(F.broadcast(ranges), "_range").withColumn(name, F.col("_ahead") + F.col("_at") + start).drop("_range", "_at", "_ahead")


def rank_rows(df: DataFrame, fields: Sequence[str], reverse: bool = False, pos: str = "_pos", name: str = "rank") -> DataFrame:
    """The order of ``sort_rows`` as a column."""
    return ranked(df, [*(F.col(f).desc_nulls_last() if reverse else F.col(f).asc_nulls_last() for f in fields), F.col(pos)], name)


def limit_per_group(df: DataFrame, group: str, n: int = 100, pos: str = "_pos") -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(group).orderBy(pos))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def until_known(df: DataFrame, group: str = "slug", pos: str = "_pos", known: str = "known") -> DataFrame:
    """The rows of each group before its first known row. One aggregation with map-side combine and a join on the
    group; the cuts are one row per group that has one."""
    cuts = df.where(F.col(known)).groupBy(group).agg(F.min(pos).alias("_cut"))
    joined = df.join(cuts, group, "left")
    return joined.where(F.col("_cut").isNull() | (F.col(pos) < F.col("_cut"))).drop("_cut")


def first_yielding_group(df: DataFrame, group_ord: str = "slug_ord", kept: str = "skip_reason", within: str | None = None) -> DataFrame:
    """The rows of the first group, in order, in which a row is kept (``kept`` is null); none if no group keeps any.
    within: do so for each value of that column."""
    keys = [within] if within else []
    sound = df.where(F.col(kept).isNull())
    first = sound.groupBy(*keys).agg(F.min(group_ord).alias("_first"))
    if keys:
        return df.join(first, keys).where(F.col(group_ord) == F.col("_first")).drop("_first")
    return df.join(first, F.col(group_ord) == F.col("_first"), "left_semi")
