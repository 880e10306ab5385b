"""Conforming listings and loading them into dimensions and a fact table by keyed upsert, set-based.

Surrogate ids are dense: new keys are numbered in their order after the greatest id there is, by ranges of the sorted keys,
so a rerun gives the same ids and no counter is shared. Plain Parquet knows no MERGE: ``upsert`` returns a new snapshot with
the action of each row, and ``Snapshot`` keeps a table in hash buckets of its key, of which an upsert rewrites only those
that it touches.

Deviations from the row-at-a-time original, on purpose: a bad row goes to quarantine and costs no other row; a null price
loads as null cents (``strict=True`` quarantines a present null, as the original fails on it).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lotframe.operators.curate import ranked
from lotframe.sources.shared import fresh_path, written

# The columns of the fact table besides url and the ids.
FACT_COLUMNS = (
    "source lot_number seller seller_type result high_bidder title vin year listing_details engine transmission "
    "exterior_color interior_color mileage sale_price sale_date reserve_met number_of_bids location"
).split()


def variant_key(variant: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(variant), F.lit("")), F.lit("STANDARD"))


def dimension(existing: DataFrame | None, keys: DataFrame) -> DataFrame:
    """Existing rows and one new row for each natural key (all columns of ``keys``) not there yet, with the next ids."""
    names = keys.columns
    new = keys.dropDuplicates(names).where(F.col(names[-1]).isNotNull())
    if existing is not None:
        new = new.join(existing.select(*names), names, "left_anti")
    last = 0 if existing is None else existing.agg(F.max("id")).first()[0] or 0
    new = ranked(new, names, "id", last + 1).select("id", *names)
    return new if existing is None else existing.select("id", *names).unionByName(new)


def dimensions(listings: DataFrame, makes: DataFrame | None = None, models: DataFrame | None = None, variants: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """makes(id, name), models(id, make_id, name), variants(id, model_id, name), names in capitals."""
    named = listings.select(F.upper("make").alias("make"), F.upper("model").alias("model"), variant_key(F.col("variant")).alias("variant"))
    makes = dimension(makes, named.select(F.col("make").alias("name")))
    with_make = named.join(makes.select(F.col("id").alias("make_id"), F.col("name").alias("make")), "make")
    models = dimension(models, with_make.select("make_id", F.col("model").alias("name")))
    with_model = with_make.join(models.select(F.col("id").alias("model_id"), "make_id", F.col("name").alias("model")), ["make_id", "model"])
    return makes, models, dimension(variants, with_model.select("model_id", F.col("variant").alias("name")))


def batch_make_model(listings: DataFrame, pos: str = "_pos") -> DataFrame:
    """Make and model of the first record for the whole batch."""
    first = listings.agg(F.min_by(F.struct("make", "model"), pos).alias("m")).first()["m"]
    if first is None:
        return listings
    return listings.withColumns({"make": F.lit(first["make"]), "model": F.lit(first["model"])})


def conform(listings: DataFrame) -> DataFrame:
    """Prices in cents, reserve_met true or null, details as JSON text or null if empty; ``N/A`` texts pass. excerpt and
    convertible are not loaded. make, model and variant are natural keys in capitals."""
    cents = F.col("price").cast("bigint") * 100
    others = {
        "source": F.coalesce("source", F.lit("bringatrailer")),
        "listing_details": F.when(F.size("listing_details") > 0, F.to_json("listing_details")),
        "sale_price": cents,
        "reserve_met": F.when(F.coalesce(cents, F.lit(0)) != 0, F.lit(True)),
    }
    facts = [others.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS if c in others or c in listings.columns]
    kept = [c for c in ("_pos",) if c in listings.columns]
    return listings.select("url", F.upper("make").alias("make"), F.upper("model").alias("model"), variant_key(F.col("variant")).alias("variant"), *facts, *kept)


def with_ids(facts: DataFrame, makes: DataFrame, models: DataFrame, variants: DataFrame) -> DataFrame:
    """Natural keys replaced by ids; a fact whose key is in no dimension keeps null ids."""
    out = facts.join(makes.select(F.col("id").alias("make_id"), F.col("name").alias("make")), "make", "left")
    out = out.join(models.select(F.col("id").alias("model_id"), "make_id", F.col("name").alias("model")), ["make_id", "model"], "left")
    out = out.join(variants.select(F.col("id").alias("variant_id"), "model_id", F.col("name").alias("variant")), ["model_id", "variant"], "left")
    return out.drop("make", "model", "variant")


def quarantine(listings: DataFrame, strict: bool = False, price_present: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows with ``_error``). Rows need a url, a make and a model; strict: a price that is present must not be
    null."""
    errors = [F.when(F.col(c).isNull(), f"no {c}") for c in ("url", "make", "model") if c in listings.columns]
    if strict:
        errors.append(F.when((price_present if price_present is not None else F.lit(True)) & F.col("price").isNull(), "price is null"))
    marked = listings.withColumn("_error", F.coalesce(*errors))
    return marked.where("_error is null").drop("_error"), marked.where("_error is not null")


def load_facts(listings: DataFrame, makes: DataFrame | None = None, models: DataFrame | None = None, variants: DataFrame | None = None, strict: bool = False):
    """(facts with ids, quarantined rows, the three dimensions with their new rows): every listing is in one of the first
    two."""
    sound, failed = quarantine(listings, strict)
    found = dimensions(sound, makes, models, variants)
    return with_ids(conform(sound), *found), failed, found


def last_per_key(df: DataFrame, key: str = "url", pos: str = "_pos") -> DataFrame:
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(pos)))
    return df.withColumn("_last", last).where("_last = 1").drop("_last")


def upsert(current: DataFrame, incoming: DataFrame, key: str = "url", pos: str = "_pos") -> DataFrame:
    """The new snapshot: all columns but the key are taken from the incoming row where there is one (the last of its key),
    else from the current row; ``action`` is inserted, updated or unchanged."""
    columns = [c for c in current.columns if c != key]
    new = last_per_key(incoming, key, pos).select(F.col(key), *(F.col(c).alias(f"_new_{c}") for c in columns)).withColumn("_new", F.lit(True))
    both = current.withColumn("_old", F.lit(True)).join(new, key, "full_outer")
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "unchanged").otherwise("updated")
    return both.select(key, *(F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns), action.alias("action"))


class Snapshot:
    """A table in hash buckets of its key. A version is a list of the folder that holds each bucket; an upsert writes the
    buckets that it touches to new folders and then a new list, which counts from the moment it is complete, so readers of
    the version before see no change and a broken upsert leaves none. Files of other buckets stay as they are. One writer at
    a time."""

    def __init__(self, spark: SparkSession, path: str, key: str = "url", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._path, self._system = hadoop, hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the last complete version, 0 if there is none."""
        at = self._path(f"{self.path}/versions")
        found = [s.getPath() for s in self._system.listStatus(at)] if self._system.exists(at) else []
        return max([0, *(int(p.getName()) for p in found if self._system.exists(self._path(p, "_SUCCESS")))])

    def _folders(self, version: int) -> dict[int, str]:
        if not version:
            return {}
        rows = self.spark.read.schema("bucket int, folder string, buckets int").json(f"{self.path}/versions/{version}").collect()  # one a bucket
        if any(r["buckets"] != self.buckets for r in rows):
            raise ValueError(f"{self.path} has another number of buckets")
        return {r["bucket"]: r["folder"] for r in rows}

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of a version, the last if not given, or of some buckets of it; None if there are none."""
        folders = self._folders(self.version() if version is None else version)
        some = sorted(f for b, f in folders.items() if buckets is None or b in buckets)
        return self.spark.read.parquet(*(f"{self.path}/{f}" for f in some)) if some else None

    def upsert(self, incoming: DataFrame, pos: str = "_pos") -> dict[str, int]:
        """Rows of ``incoming`` replace those of their key, the last one of each; returns the numbers of rows inserted and
        updated, and of buckets written."""
        number = self.version()
        folders, new = self._folders(number), number + 1
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        last = written(last_per_key(incoming, self.key, pos).drop(pos).withColumn("bucket", bucket), fresh_path(self.spark, "incoming"))
        touched = [r[0] for r in last.select("bucket").distinct().collect()]
        if not touched:
            return {"inserted": 0, "updated": 0, "buckets": 0}
        columns = [c for c in last.columns if c != "bucket"]
        current = self.read(number, touched)
        current = last.select(*columns).limit(0) if current is None else current.select(*columns)
        after = upsert(current, last.withColumn(pos, F.lit(0)), self.key, pos)
        seen = Observation("upsert")
        after = after.withColumn("bucket", bucket).observe(seen, *(F.count_if(F.col("action") == a).alias(a) for a in ("inserted", "updated")))
        folder = f"data/{new}-{uuid.uuid4().hex}"  # that of a broken upsert is never met again
        after.drop("action").repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        folders |= {b: f"{folder}/bucket={b}" for b in touched}
        rows = [(b, f, self.buckets) for b, f in sorted(folders.items())]
        self.spark.createDataFrame(rows, "bucket int, folder string, buckets int").coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/{new}")
        return {**seen.get, "buckets": len(touched)}


def load_counts(incoming: DataFrame, current: DataFrame, failed: DataFrame | None = None, key: str = "url", pos: str = "_pos") -> DataFrame:
    """One row: inserted, updated, errors, total. Every incoming row counts: the first of a new key as inserted, all others
    as updated."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(pos)) == 1
    known = current.select(key).distinct().withColumn("_known", F.lit(True))
    marked = incoming.withColumn("_first", first).join(known, key, "left")
    counts = marked.agg(F.count_if(F.col("_first") & F.col("_known").isNull()).alias("inserted"), F.count("*").alias("loaded"))
    bad = failed.agg(F.count("*").alias("errors")) if failed is not None else None
    counts = counts.withColumn("_one", F.lit(1))
    counts = counts.join(bad.withColumn("_one", F.lit(1)), "_one") if bad is not None else counts.withColumn("errors", F.lit(0).cast("long"))
    return counts.select("inserted", (F.col("loaded") - F.col("inserted")).alias("updated"), "errors", (F.col("loaded") + F.col("errors")).alias("total"))
