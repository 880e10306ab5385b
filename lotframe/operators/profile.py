"""Profiles: missing fields, value occurrences and frequencies, prices, and before/after reports. One pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotframe.schema import NA, field_matches, infer_missing, quality_missing

# The fields of the missing-field summary and of the frequency table.
SUMMARY_FIELDS = ("vin", "lot_number", "seller", "seller_type", "high_bidder", "engine", "transmission", "exterior_color", "interior_color", "mileage", "location", "number_of_bids", "listing_details")
FREQUENCY_FIELDS = ("engine", "transmission", "variant")


def _counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(field, n, total): how many rows meet each condition."""
    totals = df.agg(F.count("*").alias("_total"), *(F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())))
    items = F.explode(F.array(*(F.struct(F.lit(name).alias("field"), F.col(f"c{i}").alias("n")) for i, name in enumerate(conditions))))
    return totals.select(items.alias("x"), "_total").select("x.field", "x.n", F.col("_total").alias("total"))


def _percent(n: str, total: str) -> Column:
    return F.when(F.col(total) > 0, F.col(n) * 100.0 / F.col(total)).otherwise(0.0)


def missing_fields(df: DataFrame, fields: Sequence[str] = SUMMARY_FIELDS) -> DataFrame:
    """(field, missing, percent, complete) of the kept rows; order by missing desc for the printed form."""
    names = [f for f in fields if f in df.columns]
    found = _counts(df, {f: quality_missing(F.col(f), df.schema[f].dataType) for f in names})
    return found.select("field", F.col("n").alias("missing"), _percent("n", "total").alias("percent"), (F.col("n") == 0).alias("complete"))


def value_occurrences(df: DataFrame, target=NA, fields: Sequence[str] | None = None) -> DataFrame:
    """(field, n, percent of all rows) where a field holds the target; fields without any are left out."""
    found = {f: field_matches(df, f, target) for f in (fields or df.columns) if f in df.columns}
    found = {f: c for f, c in found.items() if c is not None}
    if not found:
        return df.sparkSession.createDataFrame([], "field string, n long, percent double")
    return _counts(df, found).where("n > 0").select("field", "n", _percent("n", "total").alias("percent"))


def price_summary(df: DataFrame, price: str = "price") -> DataFrame:
    """total, with_price, average, low and high of the rows that are sold."""
    p = F.when(F.col(price) > 0, F.col(price))
    return df.agg(F.count("*").alias("total"), F.count(p).alias("with_price"), F.avg(p).alias("average"), F.min(p).alias("low"), F.max(p).alias("high"))


def frequencies(df: DataFrame, fields: Sequence[str] = FREQUENCY_FIELDS) -> DataFrame:
    """(field, value, n) of non-empty values, N/A among them."""
    items = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    return df.select(items.alias("x")).select("x.field", "x.value").where("value is not null and value <> ''").groupBy("field", "value").agg(F.count("*").alias("n"))


def reduction(before: DataFrame, after: DataFrame, fields: Sequence[str] = FREQUENCY_FIELDS) -> DataFrame:
    """(field, before, after, reduction, listed): distinct values, and whether there are few enough (20) to list."""

    def distinct(df: DataFrame, name: str) -> DataFrame:
        return frequencies(df, fields).groupBy("field").agg(F.count("*").alias(name))

    every = before.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    both = every.join(distinct(before, "before"), "field", "left").join(distinct(after, "after"), "field", "left")
    b, a = F.coalesce("before", F.lit(0)), F.coalesce("after", F.lit(0))
    return both.select("field", b.alias("before"), a.alias("after"), (b - a).alias("reduction"), (b <= 20).alias("listed"))


def reduction_details(before: DataFrame, after: DataFrame, fields: Sequence[str] = FREQUENCY_FIELDS) -> DataFrame:
    """(field, phase, value, n) for the fields with 20 distinct values or fewer before."""
    few = frequencies(before, fields).groupBy("field").agg(F.count("*").alias("k")).where("k <= 20").select("field")
    both = frequencies(before, fields).withColumn("phase", F.lit("before")).union(frequencies(after, fields).withColumn("phase", F.lit("after")))
    return both.join(few, "field").select("field", "phase", "value", "n")


def inference_need(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, missing, percent) and, on each row, the rows in total, needing and complete."""
    flags = {f: infer_missing(F.col(f), df.schema[f].dataType) for f in fields}
    needy = None
    for c in flags.values():
        needy = c if needy is None else needy | c
    totals = df.agg(F.count("*").alias("total"), F.count_if(needy).alias("needing"), *(F.count_if(c).alias(f"c{i}") for i, c in enumerate(flags.values())))
    items = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"c{i}").alias("missing")) for i, f in enumerate(fields))))
    rows = totals.select(items.alias("x"), "total", "needing").select("x.field", "x.missing", "total", "needing")
    return rows.withColumns({"percent": _percent("missing", "total"), "complete": F.col("total") - F.col("needing")})


def dry_run(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: calls, fields to infer, what asking for every field would infer, and the percentage saved."""
    need = inference_need(df, fields).agg(F.first("needing").alias("calls"), F.sum("missing").alias("fields_to_infer"))
    naive = F.col("calls") * len(fields)
    return need.select("calls", "fields_to_infer", naive.alias("naive_fields"), F.when(naive > 0, (naive - F.col("fields_to_infer")) * 100.0 / naive).alias("saved_percent"))


def dry_run_samples(df: DataFrame, fields: Sequence[str], n: int = 5, pos: str = "_pos") -> DataFrame:
    """The first rows that need inference, with the fields they lack."""
    lacking = F.filter(F.array(*(F.when(infer_missing(F.col(f), df.schema[f].dataType), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    title = F.substring(F.coalesce("title", F.lit(NA)), 1, 50) if "title" in df.columns else F.lit(NA)
    return df.select(pos, title.alias("title"), lacking.alias("na_fields")).where(F.size("na_fields") > 0).orderBy(pos).limit(n)
