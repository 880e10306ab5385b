"""Scans and sinks: rows of the driver's tables are written in the formats of the library, scanned back and compared."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotframe.operators import extract, infer, load
from lotframe.plans.listing_queries import EXTRACT_SQL, VIEW, listing_view, read
from lotframe.plans.table_queries import ASKED, INFER_GAPS, PROMPTED, answer, gappy
from lotframe.sources import json_records as J
from lotframe.sources.shared import fresh_path

PER_FILE = 10_000


def _order_arrays(spark: SparkSession, sf_dir: str) -> list[str]:
    """Orders as files of JSON arrays. Every third record has a note, of which every second is null."""
    key = F.col("o_orderkey")
    note = F.when(key % 6 == 0, F.lit("null")).when(key % 3 == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
    text = F.concat(F.lit('{"url":"u'), key.cast("string"), F.lit('","price":'), F.floor("o_totalprice").cast("string"), F.coalesce(F.concat(F.lit(',"note":'), note), F.lit("")), F.lit("}"))
    return J.save_arrays(read(spark, sf_dir, "orders").select(key.alias("_pos"), text.alias("json")), fresh_path(spark, "arrays"), per_file=PER_FILE)


def scan_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in the order given, one missing among them: absent keys are told from nulls."""
    paths = _order_arrays(spark, sf_dir)
    rows = J.scan_records(spark, *paths[:1], paths[0] + ".gone", *paths[1:])
    return rows.select("_file", "_pos", J.field("url").alias("url"), J.field("price", "bigint").alias("price"), J.field("note").alias("note"), J.present("note").alias("has_note"))


ARRAYS_SQL = f"""
WITH o AS (SELECT *, dense_rank() OVER (ORDER BY o_orderkey // {PER_FILE}) AS f, row_number() OVER (PARTITION BY o_orderkey // {PER_FILE} ORDER BY o_orderkey) - 1 AS p FROM orders)
SELECT CASE WHEN f = 1 THEN 0 ELSE f END::INT AS _file, p::INT AS _pos, 'u' || o_orderkey AS url, floor(o_totalprice)::BIGINT AS price,
    CASE WHEN o_orderkey % 6 = 3 THEN o_orderpriority END AS note, o_orderkey % 3 = 0 AS has_note FROM o
"""


def scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as listings with the defaults of a read; every file has to be an array."""
    rows = J.listings_of(J.scan_records(spark, *_order_arrays(spark, sf_dir), strict=True))
    return rows.select("_file", "_pos", "url", "source", "title", "price", "convertible", F.size("excerpt").alias("excerpts"))


TYPED_SQL = f"""
SELECT (dense_rank() OVER (ORDER BY o_orderkey // {PER_FILE}) - 1)::INT AS _file, (row_number() OVER (PARTITION BY o_orderkey // {PER_FILE} ORDER BY o_orderkey) - 1)::INT AS _pos,
    'u' || o_orderkey AS url, 'unknown' AS source, '' AS title, floor(o_totalprice)::BIGINT AS price, false AS convertible, 0 AS excerpts FROM orders
"""


def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports on the same files and on one that is missing."""
    paths = _order_arrays(spark, sf_dir)
    report = J.preflight(spark, *paths, paths[0] + ".gone")
    return report.select("_file", "exists", "valid_json", "is_list", "n_items", "is_empty", "first_is_object", F.array_join(F.array_sort("first_keys"), ",").alias("first_keys"), "has_key", "ok")


PREFLIGHT_SQL = f"""
WITH f AS (SELECT o_orderkey // {PER_FILE} AS part, count(*) AS n, arg_min(o_orderkey % 3 = 0, o_orderkey) AS noted FROM orders GROUP BY 1),
g AS (SELECT (row_number() OVER (ORDER BY part) - 1)::INT AS _file, n, noted FROM f)
SELECT _file, true AS exists, true AS valid_json, true AS is_list, n::INT AS n_items, false AS is_empty, true AS first_is_object, CASE WHEN noted THEN 'note,price,url' ELSE 'price,url' END AS first_keys, true AS has_key, true AS ok FROM g
UNION ALL SELECT count(*)::INT, false, false, false, NULL, NULL, NULL, NULL, NULL, false FROM g
"""


def save_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as a batch and read back: empty text comes back as N/A, and the lots known are those with a number."""
    key = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(
        F.concat(F.lit("u"), key.cast("string")).alias("url"),
        F.col("o_orderpriority").alias("title"),
        F.when(key % 5 != 0, key.cast("string")).alias("lot_number"),
        F.when(key % 4 != 0, F.floor("o_totalprice")).alias("price"),
        F.when(key % 7 == 0, "").otherwise(F.col("o_orderstatus")).alias("vin"),
        F.lit("USA").alias("country"),
    )
    back = J.read_listings(spark, J.save_batch(rows, fresh_path(spark, "batch")))
    known = J.known_lots(back).withColumn("known", F.lit(True))
    return back.join(known, "lot_number", "left").select("url", "title", "source", "lot_number", "price", "vin", "convertible", "country", F.coalesce("known", F.lit(False)).alias("known"))


SAVED_SQL = """
SELECT 'u' || o_orderkey AS url, o_orderpriority AS title, 'unknown' AS source, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey::VARCHAR ELSE 'N/A' END AS lot_number,
    CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice)::BIGINT END AS price, CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE o_orderstatus END AS vin,
    false AS convertible, NULL::VARCHAR AS country, o_orderkey % 5 <> 0 AS known FROM orders
"""


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets made of parts: one slug or two, names under every alias, some left out."""
    key, name = F.col("p_partkey"), F.col("p_name")
    slug = F.when(key % 2 == 0, F.concat(F.lit('"s'), key.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('["s'), key.cast("string"), F.lit('","t'), key.cast("string"), F.lit('"]')))
    short = F.element_at(F.array(F.lit(',"modelShort":"'), F.lit(',"modelSHort":"'), F.lit(',"modelshort":"'), F.lit(None)), (key % 4 + 1).cast("int"))
    full = F.element_at(F.array(F.lit(',"modelFull":"'), F.lit(',"modelfull":"'), F.lit(None)), (key % 3 + 1).cast("int"))
    years = F.when(key % 5 == 0, F.concat(F.lit(',"minYear":'), "p_size"))
    text = F.concat(
        F.lit('{"slug":'), slug, F.lit(',"make":"'), "p_brand", F.lit('"'), F.coalesce(F.concat(short, name, F.lit(' "')), F.lit("")), F.coalesce(F.concat(full, F.upper(name), F.lit('"')), F.lit("")), F.coalesce(years, F.lit("")), F.lit("}")
    )
    paths = J.save_arrays(read(spark, sf_dir, "part").select(key.alias("_pos"), text.alias("json")), fresh_path(spark, "targets"), per_file=PER_FILE)
    found = J.scan_targets(spark, *paths)
    return found.select("slug_ord", "slug", "make", "model_full", "model_short", "min_year", "max_year")


TARGETS_SQL = """
WITH p AS (
    SELECT *, CASE WHEN p_partkey % 4 <> 3 THEN p_name || ' ' WHEN p_partkey % 3 <> 2 THEN upper(p_name) ELSE '' END AS short,
        unnest(CASE WHEN p_partkey % 2 = 0 THEN [0] ELSE [0, 1] END) AS place FROM part
)
SELECT place::INT AS slug_ord, CASE place WHEN 0 THEN 's' ELSE 't' END || p_partkey AS slug, p_brand AS make, CASE WHEN p_partkey % 3 <> 2 THEN upper(p_name) ELSE trim(short) END AS model_full,
    short AS model_short, CASE WHEN p_partkey % 5 = 0 THEN p_size END AS min_year, NULL::INT AS max_year FROM p
"""


def _one_file(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = fresh_path(spark, name)
    rows.coalesce(1).write.text(path)
    return path


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rules file made of the distinct types and brands of parts (a parameter table, whatever the number of parts)."""
    part = read(spark, sf_dir, "part")
    pairs = [part.select(F.col(c).alias("k"), F.lower(c).alias("v")).distinct().agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))).alias(c)) for c in ("p_type", "p_brand")]
    both = pairs[0].crossJoin(pairs[1])  # of one row each
    text = F.concat(F.lit('{"engine":'), "p_type", F.lit(',"variant":'), "p_brand", F.lit("}"))
    return J.scan_rules(spark, _one_file(spark, both.select(text), "rules"))


RULES_SQL = "SELECT DISTINCT 'engine' AS field, p_type AS from_value, lower(p_type) AS to_value FROM part UNION ALL SELECT DISTINCT 'variant', upper(p_brand), lower(p_brand) FROM part"


def interface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interface file: the types of parts as an enum, sizes as integers."""
    enum = read(spark, sf_dir, "part").select("p_type").distinct().agg(F.to_json(F.array_sort(F.collect_list("p_type"))).alias("e"))
    found = J.scan_interface(spark, _one_file(spark, enum.select(F.concat(F.lit('{"p_size":"integer","p_type":'), "e", F.lit("}"))), "interface"))
    return found.select("field", "kind", F.array_join("enum_values", ",").alias("enum_values"))


INTERFACE_SQL = "SELECT 'p_size' AS field, 'integer' AS kind, NULL AS enum_values UNION ALL SELECT 'p_type', 'enum', string_agg(DISTINCT p_type, ',' ORDER BY p_type) FROM part"


def with_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the listing view by the rules of a profile file, which names engine and mileage and leaves the rest."""
    given = {
        "source_name": "elsewhere",
        "rules": {
            "engine": [{"kind": "detail", "patterns": list(extract.ENGINE), "group": 0, "dashes": True}],
            "mileage": [{"kind": "detail", "patterns": list(extract.MILEAGE_DETAIL), "transform": "handle_k_miles", "hint": "miles"}, {"kind": "title", "patterns": list(extract.MILEAGE_TITLE), "transform": "multiply_1000"}],
        },
    }
    profile = extract.read_profile(spark, _one_file(spark, spark.createDataFrame([(json.dumps(given),)], "value string"), "profile"))
    view = listing_view(spark, sf_dir)
    return view.select("lot", F.lit(profile.source_name).alias("source"), extract.engine(F.col("details"), profile.rules["engine"]).alias("engine"), extract.mileage(F.col("details"), F.col("title"), rules=profile.rules["mileage"]).alias("mileage"))


PROFILE_SQL = f"WITH {VIEW} SELECT lot, 'elsewhere' AS source, engine, mileage FROM found"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole listing records from the raw texts of pages, which the listing view stands in for."""
    view = listing_view(spark, sf_dir)
    lot, null = F.col("lot"), F.lit(None).cast("string")

    def entry(label: str, text, place=null, member=null):
        return F.struct(F.lit(label).alias("label"), text.alias("parent_text"), place.alias("map_link"), member.alias("member_link"))

    bid = lambda who, amount: F.struct(F.concat(F.lit(who), lot.cast("string")).alias("bidder"), F.concat(F.lit("bid USD $"), amount).alias("text"))
    raw = F.struct(
        F.col("title"),
        F.col("details"),
        F.array(F.col("details")[0]).alias("links"),
        F.array(entry("Location", F.lit("Location"), F.col("slug")), entry("Seller", F.lit("Seller"), null, F.col("make")), entry("Lot", F.concat(F.lit("Lot #"), lot.cast("string")))).alias("essentials"),
        F.array(F.struct(F.lit("Bids").alias("label"), (lot % 40).cast("string").alias("value"))).alias("stats"),
        F.array(bid("a", F.lit("1")), bid("b", F.format_number("price", 0)), bid("c", F.lit("2"))).alias("bids"),
        F.array(F.when(lot % 2 == 0, "Convertibles").otherwise("Coupes")).alias("group_titles"),
        F.col("country"),
        F.slice("details", 6, 2).alias("excerpt"),
    )
    rows = view.select(F.concat(F.lit("u"), lot.cast("string")).alias("url"), raw.alias("raw"), "make", F.col("slug").alias("model_full"), "model_short", "price")
    found = extract.extract_listings(rows.withColumnRenamed("price", "paid"), price=F.col("paid"))
    found = found.select(*(F.array_join(c, "|").alias(c) if c in ("listing_details", "excerpt") else c for c in found.columns if c not in ("model_short", "paid", "model_full")))
    return found


RECORDS_SQL = EXTRACT_SQL.rsplit("SELECT", 1)[0] + """
SELECT 'u' || lot AS url, 'bringatrailer' AS source, title, lot::VARCHAR AS lot_number, make AS seller, NULL::VARCHAR AS seller_type,
    CASE WHEN coalesce(price, 0) <> 0 THEN 'Sold' ELSE 'Reserve Not Met' END AS result,
    CASE WHEN coalesce(price, 0) = 0 OR price = 2 THEN 'c' WHEN price IS NOT NULL THEN 'b' END || lot AS high_bidder, price, NULL::VARCHAR AS sale_date, (lot % 40)::INT AS number_of_bids,
    vin, year, make, slug AS model, CASE WHEN rest = '' OR lower(split_part(rest, ' ', 1)) IN ('for', 'with', 'in', 'at', 'by', 'from', 'on', 'and', 'the') THEN 'Standard' ELSE rest END AS variant,
    lot % 2 = 0 AS convertible, engine, transmission, exterior_color, interior_color, mileage, slug AS location, country, array_to_string(details, '|') AS listing_details, array_to_string(details[6:7], '|') AS excerpt
FROM named
"""


def _run(spark: SparkSession, sf_dir: str) -> str:
    """An inference run, saved as its four tables; their folder."""
    answered = infer.infer(gappy(spark, sf_dir), answer, ASKED)
    table = infer.results(answered, ASKED)
    path = fresh_path(spark, "run")
    J.save_run(infer.run_stats(table, ASKED), table, infer.errors(table), infer.merge(answered), path)
    return path


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{_run(spark, sf_dir)}/results")
    return table.select("index", "url", F.array_join("fields_inferred", ",").alias("fields_inferred"), F.array_join("fields_skipped", ",").alias("fields_skipped"), F.try_element_at("inferred_values", F.lit("seller_type")).alias("seller_type"), "attempts", "error")


_SKIPPED = "array_to_string(list_filter(['engine', 'interior_color', 'location', 'seller_type'], lambda x: NOT list_contains(m, x)), ',')"
RESULTS_SQL = f"""
WITH {PROMPTED}
SELECT _pos AS index, url, array_to_string(m, ',') AS fields_inferred, {_SKIPPED} AS fields_skipped,
    CASE WHEN NOT ({INFER_GAPS["seller_type"]}) THEN seller_type WHEN h[1] = '0' THEN NULL WHEN h[4] IN ('0', '4', '8', 'c') THEN 'Dealer' WHEN h[4] IN ('1', '5', '9', 'd') THEN 'Private Party' END AS seller_type,
    CASE WHEN h[1] = '0' THEN 3 ELSE 1 END::INT AS attempts, CASE WHEN h[1] = '0' THEN 'no JSON in the answer: I cannot say.' END AS error
FROM x
"""


def run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_run(spark, sf_dir)}/errors")


ERRORS_SQL = f"WITH {PROMPTED} SELECT _pos AS index, 'no JSON in the answer: I cannot say.' AS message FROM x WHERE h[1] = '0'"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a loaded fact, its ids resolved to names again, or as a quarantined row with the reason."""
    key = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select(
        F.when(key % 50 != 0, F.concat(F.lit("u"), key.cast("string"))).alias("url"),
        key.alias("_pos"),
        F.when(key % 11 != 0, F.lower("c_mktsegment")).alias("make"),
        F.when(key % 13 != 0, F.lower("o_orderstatus")).alias("model"),
        F.when(key % 3 != 0, F.lower("o_orderpriority")).alias("variant"),
        F.floor("o_totalprice").alias("price"),
        F.array("o_orderpriority").alias("listing_details"),
        F.lit(None).cast("string").alias("source"),
    )
    loaded, failed, (makes, models, variants) = load.load_facts(rows)
    named = loaded
    for name, table in (("make", makes), ("model", models), ("variant", variants)):
        named = named.join(table.select(F.col("id").alias(f"{name}_id"), F.col("name").alias(name)), f"{name}_id", "left")
    nulls = [F.lit(None).cast("string").alias(c) for c in ("make", "model", "variant")]
    return named.select("_pos", "make", "model", "variant", "sale_price", F.lit(None).cast("string").alias("error")).union(failed.select("_pos", *nulls, F.lit(None).cast("long"), "_error"))


FACTS_SQL = """
WITH j AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN 'no url' WHEN o_orderkey % 11 = 0 THEN 'no make' WHEN o_orderkey % 13 = 0 THEN 'no model' END AS error FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey AS _pos, CASE WHEN error IS NULL THEN upper(c_mktsegment) END AS make, CASE WHEN error IS NULL THEN upper(o_orderstatus) END AS model,
    CASE WHEN error IS NULL THEN CASE WHEN o_orderkey % 3 <> 0 THEN upper(o_orderpriority) ELSE 'STANDARD' END END AS variant,
    CASE WHEN error IS NULL THEN floor(o_totalprice)::BIGINT * 100 END AS sale_price, error FROM j
"""

QUERIES = {
    "scan_arrays": (scan_arrays, ARRAYS_SQL),
    "scan_typed": (scan_typed, TYPED_SQL),
    "scan_preflight": (preflight, PREFLIGHT_SQL),
    "scan_saved_listings": (save_and_read, SAVED_SQL),
    "scan_targets": (targets, TARGETS_SQL),
    "scan_rules": (rules, RULES_SQL),
    "scan_interface": (interface, INTERFACE_SQL),
    "extract_with_profile": (with_profile, PROFILE_SQL),
    "extract_records": (records, RECORDS_SQL),
    "infer_results": (run_results, RESULTS_SQL),
    "infer_errors": (run_errors, ERRORS_SQL),
    "load_facts": (facts, FACTS_SQL),
}
