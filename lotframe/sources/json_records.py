"""Files of JSON arrays and parameter files, as DataFrames; and the sinks.

Arrays are read by byte ranges (``json_arrays``), so a file may be of any size. Records keep their order as (_file, _pos). As
VARIANT, a record tells an absent key from a null. Files that are looked for are listed by folder, one call each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lotframe.schema import LISTING_SCHEMA, render, with_defaults
from lotframe.sources.json_arrays import read_arrays
from lotframe.sources.shared import fresh_path, written


def _there(spark: SparkSession, paths: Sequence[str]) -> list[str | None]:
    """The whole names of files, None for those that are not there: every folder concerned is listed once."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders: dict[str, tuple[str, set[str]]] = {}
    out = []
    for path in paths:
        folder, _, name = path.rpartition("/")
        folder = folder or ("/" if path.startswith("/") else ".")
        if folder not in folders:
            at = jvm.org.apache.hadoop.fs.Path(folder)
            system = at.getFileSystem(conf)
            names = set()
            if system.exists(at):
                globbed = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(system.listStatus(at))
                listed = jvm.java.util.Arrays.toString(globbed) if len(globbed) > 4096 else None
                names = {x.rpartition("/")[2] for x in listed[1:-1].split(", ")} if listed else {p.getName() for p in globbed}
            folders[folder] = at.makeQualified(system.getUri(), system.getWorkingDirectory()).toString(), names
        whole, names = folders[folder]
        out.append(f"{whole.rstrip('/')}/{name}" if name in names else None)
    return out


def _placed(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(_file, path, at) in the order of the arguments, and the whole names of the files that are there."""
    whole = _there(spark, paths)
    rows = [(i, p, w) for i, (p, w) in enumerate(zip(paths, whole, strict=True))]
    return spark.createDataFrame(rows, "_file int, path string, at string"), sorted({w for w in whole if w})


def _plain(name: Column) -> Column:
    """A whole name out of ``_metadata.file_path``, where blanks and other signs are escaped."""
    return F.try_url_decode(F.regexp_replace(name, r"\+", "%2B"))


def scan_records(spark: SparkSession, *paths: str, strict: bool = False) -> DataFrame:
    """(_file, _pos, record VARIANT) of all files. A file that is missing, unreadable or no array gives no rows; with
    ``strict`` it is an error. If of two or more files none is an array, that is an error too."""
    order, there = _placed(spark, paths)
    if there:
        records, files = read_arrays(spark, there)
        judged = order.join(files.select(_plain(F.col("path")).alias("at"), "is_array"), "at", "left")
    if not there or strict or len(paths) > 1:  # one row for each name given
        bad = [r[0] for r in judged.where("is_array IS NOT TRUE").select("path").collect()] if there else list(paths)
        if bad and (strict or len(bad) == len(paths) > 1):
            raise ValueError(f"no JSON array: {bad}")
        if not there:
            return spark.createDataFrame([], "_file int, _pos int").withColumn("record", F.try_parse_json(F.lit("null")))
    named = records.select(_plain(F.col("path")).alias("at"), F.col("_pos").cast("int").alias("_pos"), "record")
    return named.join(F.broadcast(order.select("at", "_file")), "at").select("_file", "_pos", "record")


def field(name: str, kind: str = "string", record: str = "record") -> Column:
    return F.try_variant_get(F.col(record), f"$.{name}", kind)


def present(name: str, record: str = "record") -> Column:
    """Is the key there, be it null?"""
    return F.variant_get(F.col(record), f"$.{name}", "variant").isNotNull()


def listings_of(records: DataFrame) -> DataFrame:
    """Typed listings with the defaults of a read, with their _file and _pos."""
    typed = records.select("_file", "_pos", *(field(f.name, f.dataType.simpleString()).alias(f.name) for f in LISTING_SCHEMA))
    return with_defaults(typed, "_file", "_pos")


def load_listings(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of one file; a missing file is empty."""
    return listings_of(scan_records(spark, path))


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings as ``save_listings`` wrote them, with the defaults of a read."""
    return with_defaults(spark.read.schema(LISTING_SCHEMA).json(path))


def known_lots(listings: DataFrame) -> DataFrame:
    """Lot numbers that are there already."""
    return listings.select("lot_number").where("lot_number is not null and lot_number <> 'N/A'").distinct()


def save_listings(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines, missing text as N/A, nulls kept; directories are made."""
    render(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def save_arrays(records: DataFrame, path: str, pos: str = "_pos", per_file: int = 10_000) -> list[str]:
    """JSON text (column ``json``) as files of one array each, ``per_file`` positions to a file, in order of position; the
    names of the files are returned. For readers that want arrays: an array is one record, so files are kept small."""
    part = F.floor(F.col(pos) / per_file).cast("long").alias("part")
    arrays = records.groupBy(part).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("at"), "json"))).alias("items"))
    body = F.concat(F.lit("["), F.array_join("items.json", ","), F.lit("]"))
    arrays.select(body.alias("value"), "part").write.partitionBy("part").text(path)
    names = records.sparkSession.read.format("binaryFile").load(path).select("part", F.col("path")).orderBy("part").collect()
    return [r["path"] for r in names]


def save_batch(df: DataFrame, base: str) -> str:
    """Append mode: the batch goes to ``{base}_n{count}``; that path is returned."""
    seen, spark = Observation("batch"), df.sparkSession
    draft = f"{base}_{uuid.uuid4().hex}"
    save_listings(df.observe(seen, F.count("*").alias("n")), draft)  # counted while it is written
    path = f"{base}_n{seen.get['n']}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(hadoop(path)) or not system.rename(hadoop(draft), hadoop(path)):
        system.delete(hadoop(draft), True)
        raise FileExistsError(path)
    return path


def scan_targets(spark: SparkSession, *paths: str) -> DataFrame:
    """(car, slug_ord, slug, make, model_full, model_short, min_year, max_year): one row for each slug of a target.
    The first alias of a key that is present counts; a missing short name is the full one, a missing full name the
    short one stripped."""
    records = scan_records(spark, *paths)

    def alias(*names: str) -> Column:
        picked = F.when(F.lit(False), F.lit(None).cast("string"))
        for n in names:
            picked = picked.when(present(n), field(n))
        return picked

    rows = records.select(
        "_file",
        "_pos",
        F.coalesce(field("slug", "array<string>"), F.array(field("slug"))).alias("slugs"),
        field("make").alias("make"),
        alias("modelShort", "modelSHort", "modelshort").alias("short"),
        alias("modelFull", "modelfull").alias("full"),
        field("minYear", "int").alias("min_year"),
        field("maxYear", "int").alias("max_year"),
    )
    full = F.nullif("full", F.lit(""))
    short = F.coalesce(F.nullif("short", F.lit("")), full, F.lit(""))
    stripped = F.regexp_replace(short, r"(?U)^\s+|\s+$", "")
    return rows.select(
        F.struct("_file", "_pos").alias("car"),
        F.posexplode("slugs").alias("slug_ord", "slug"),
        "make",
        F.coalesce(full, stripped).alias("model_full"),
        short.alias("model_short"),
        "min_year",
        "max_year",
    )


def scan_rules(spark: SparkSession, path: str) -> DataFrame:
    """(field, from_value, to_value) of a rules file; keys of variant are upper-cased, and the last of equal ones counts."""
    maps = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    each = maps.select(F.explode("m").alias("field", "map")).select("field", F.posexplode(F.map_entries("map")).alias("at", "e"))
    key = F.when(F.col("field") == "variant", F.upper("e.key")).otherwise(F.col("e.key"))
    return each.groupBy("field", key.alias("from_value")).agg(F.max_by("e.value", "at").alias("to_value"))


def scan_interface(spark: SparkSession, path: str) -> DataFrame:
    """(field, kind, enum_values): kind is a type name, or ``enum``."""
    root = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    values = F.from_json("v", "array<string>")
    is_list = F.startswith("v", F.lit("["))
    return root.select(F.explode("m").alias("field", "v")).select("field", F.when(is_list, "enum").otherwise(F.col("v")).alias("kind"), F.when(is_list, values).alias("enum_values"))


def preflight(spark: SparkSession, *paths: str, key: str = "url") -> DataFrame:
    """One report row a file: exists, bytes, valid_json, is_list, n_items, first_is_object, first_keys, has_key, and ok
    (an empty list is ok, with is_empty set; a missing key is ok too). Arrays are read by ranges; only files that are none
    are parsed whole, to tell other JSON from none."""
    order, there = _placed(spark, paths)
    kind = "at string, length long, is_list boolean, n_items int, first variant, other string"
    if there:
        records, files = read_arrays(spark, there)
        arrays = files.where("is_array").select(_plain(F.col("path")).alias("at"))
        arrays = written(arrays.withColumn("is_list", F.lit(True)), fresh_path(spark, "arrays-found"))
        listed = {r["at"] for r in arrays.collect()}  # of the files named
        named = records.select(_plain(F.col("path")).alias("at"), "_pos", "record")
        counts = named.groupBy("at").agg(F.count("*").cast("int").alias("n_items"))
        first = named.where("_pos = 0").select("at", F.col("record").alias("first"))
        sizes = spark.read.format("binaryFile").load(there).select(F.col("path").alias("at"), "length")
        rest = [w for w in there if w not in listed]
        other = spark.createDataFrame([], "at string, other string")
        if rest:
            other = spark.read.format("binaryFile").load(rest).select(F.col("path").alias("at"), F.schema_of_variant(F.try_parse_json(F.col("content").cast("string"))).alias("other"))
        found = sizes.join(arrays, "at", "left").join(counts, "at", "left").join(first, "at", "left").join(other, "at", "left")
    else:
        found = spark.createDataFrame([], kind.replace("first variant, ", "")).withColumn("first", F.try_parse_json(F.lit("null")))
    report = order.join(found, "at", "left").withColumn("there", F.col("length").isNotNull()).withColumn("is_list", F.coalesce("is_list", F.lit(False)))
    report = report.withColumn("keys", F.map_keys(F.try_variant_get("first", "$", "map<string,variant>"))).withColumn("n_items", F.when(F.col("is_list"), F.coalesce("n_items", F.lit(0))))
    is_object = F.when(F.col("n_items") > 0, F.col("keys").isNotNull())
    return report.select(
        "_file",
        "path",
        F.col("there").alias("exists"),
        F.col("length").alias("bytes"),
        (F.col("is_list") | F.col("other").isNotNull()).alias("valid_json"),
        "is_list",
        "n_items",
        (F.col("n_items") == 0).alias("is_empty"),
        is_object.alias("first_is_object"),
        F.slice("keys", 1, 5).alias("first_keys"),
        F.array_contains("keys", key).alias("has_key"),
        (F.col("is_list") & F.coalesce(is_object, F.lit(True))).alias("ok"),
    )


def save_run(run: DataFrame, results: DataFrame, errors: DataFrame, updated: DataFrame, path: str) -> None:
    """The envelope of an inference run as four tables: runs, results, errors and the updated records."""
    for name, df in (("runs", run), ("results", results), ("errors", errors), ("updated", updated)):
        df.write.mode("append").parquet(f"{path}/{name}")
