"""Dedupe, order, incremental append, profiles, normalisation, inference and load over the driver's tables."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotframe import streaming
from lotframe.operators import curate, infer, load, normalize, profile
from lotframe.plans.listing_queries import VIEW, fields, listing_view, read
from lotframe.sources.shared import fresh_path


def union_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of documents (all, then the even ones again), kept first by text."""
    docs = read(spark, sf_dir, "documents").withColumn("_pos", F.col("doc_id"))
    both = curate.union_all([docs, docs.where("doc_id % 2 = 0").drop("n_chars")])
    return curate.keep_first(both, "text").select("doc_id", "lang", "source", F.col("_pos.frame").alias("frame"))


KEEP_FIRST_SQL = "SELECT doc_id, lang, source, 0 AS frame FROM documents WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"


def dedupe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("_pos", F.col("doc_id"))
    return curate.dedupe_report(docs, curate.keep_first(docs, "text", drop_falsy=False))


DEDUPE_SQL = "SELECT count(*) AS combined, count(DISTINCT text) AS final, count(*) - count(DISTINCT text) AS removed FROM documents"


def limit_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("_pos", F.col("doc_id"))
    return curate.limit_per_group(docs, "source", 3).select("source", "doc_id")


LIMIT_SQL = "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3"


def stable_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by type and size, descending; ties stay in order of key."""
    part = read(spark, sf_dir, "part").withColumn("_pos", F.col("p_partkey"))
    return curate.sort_rows(part, ["p_type", "p_size"], reverse=True).select("p_type", "p_size", "p_partkey")


SORT_SQL = "SELECT p_type, p_size, p_partkey FROM part ORDER BY p_type DESC, p_size DESC, p_partkey"


def sorted_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by type, brand and size, ascending and strict: there are no nulls, so the order asked for is given."""
    part = read(spark, sf_dir, "part").withColumn("_pos", F.col("p_partkey"))
    return curate.sort_rows(part, ["p_type", "p_brand", "p_size"], strict=True).select("p_type", "p_brand", "p_size", "p_partkey")


SORT_UP_SQL = "SELECT p_type, p_brand, p_size, p_partkey FROM part ORDER BY p_type, p_brand, p_size, p_partkey"


def sorted_strictly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict order by a column with nulls: the rows come in their first order."""
    part = read(spark, sf_dir, "part").withColumns({"_pos": F.col("p_partkey"), "gap": F.when(F.col("p_partkey") % 9 != 0, F.col("p_size"))})
    return curate.sort_rows(part, ["gap"], strict=True).select("gap", "p_partkey")


STRICT_SQL = "SELECT CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS gap, p_partkey FROM part ORDER BY p_partkey"


def append_until_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New orders of each customer before the first one already known (keys that end in 3 and are divisible by 7)."""
    orders = read(spark, sf_dir, "orders").withColumns({"slug": F.col("o_custkey"), "_pos": F.col("o_orderkey"), "lot_number": F.col("o_orderkey").cast("string")})
    known = orders.where("o_orderkey % 7 = 3").select("lot_number")
    return curate.until_known(curate.mark_known(orders, known, prefilter=True)).select("o_custkey", "o_orderkey")


UNTIL_SQL = """
WITH cut AS (SELECT o_custkey, min(o_orderkey) AS c FROM orders WHERE o_orderkey % 7 = 3 GROUP BY 1)
SELECT o_custkey, o_orderkey FROM orders LEFT JOIN cut USING (o_custkey) WHERE c IS NULL OR o_orderkey < c
"""


def append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as cards that arrive in three batches, in order of key."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("slug"), F.col("o_orderkey").alias("_pos"), F.col("o_orderkey").cast("string").alias("lot_number"))
    known = orders.where("_pos % 7 = 3").select("lot_number")
    low, high = orders.agg(F.min("_pos"), F.max("_pos")).first()
    cards, out = fresh_path(spark, "cards"), fresh_path(spark, "appended")
    third = F.floor((F.col("_pos") - low) * 3 / max(1, high - low + 1))
    for part in range(3):
        orders.where(third == part).write.mode("append").parquet(cards)
        arrived = spark.readStream.schema(orders.schema).parquet(cards)
        streaming.append_stream(arrived, known, out, f"{out}-state").awaitTermination()
    found = spark.read.parquet(out)
    return found.select(F.col("slug").cast("long").alias("o_custkey"), F.col("_pos").alias("o_orderkey"))


def rank_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of parts by type and size, descending, as a column."""
    part = read(spark, sf_dir, "part").select("p_type", "p_size", "p_partkey").withColumn("_pos", F.col("p_partkey"))
    return curate.rank_rows(part, ["p_type", "p_size"], reverse=True).select("p_partkey", "rank")


RANK_SQL = "SELECT p_partkey, row_number() OVER (ORDER BY p_type DESC, p_size DESC, p_partkey) AS rank FROM part"


def first_slug_with_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer, the first priority class (as slug) in which an order above 400,000 is kept, and its orders."""
    orders = read(spark, sf_dir, "orders").withColumns(
        {"slug_ord": F.substring("o_orderpriority", 1, 1).cast("int"), "skip_reason": F.when(F.col("o_totalprice") <= 400000, "cheap")}
    )
    return curate.first_yielding_group(orders, within="o_custkey").select("o_custkey", "o_orderkey", "slug_ord", "skip_reason")


FIRST_SLUG_SQL = """
WITH o AS (SELECT *, substr(o_orderpriority, 1, 1)::INT AS slug_ord, CASE WHEN o_totalprice <= 400000 THEN 'cheap' END AS skip_reason FROM orders),
f AS (SELECT o_custkey, min(slug_ord) AS slug_ord FROM o WHERE skip_reason IS NULL GROUP BY 1)
SELECT o_custkey, o_orderkey, slug_ord, skip_reason FROM o JOIN f USING (o_custkey, slug_ord)
"""


def targets_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with the target of their slug; targets are made from the part types."""
    types = read(spark, sf_dir, "part").groupBy(F.col("p_type").alias("slug")).agg(F.min("p_size").alias("min_year"), F.max("p_name").alias("model_full"))
    pages = listing_view(spark, sf_dir).select("lot", "slug")
    return curate.attach_targets(pages, types).groupBy("slug", "min_year", "model_full").agg(F.count("*").alias("n"))


TARGETS_SQL = f"WITH {VIEW}, t AS (SELECT p_type AS slug, min(p_size) AS min_year, max(p_name) AS model_full FROM part GROUP BY 1) SELECT slug, min_year, model_full, count(*) AS n FROM listing JOIN t USING (slug) GROUP BY ALL"


def value_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the value in any text field, and inverted, counted by status."""
    orders = read(spark, sf_dir, "orders")
    parts = []
    for invert in (False, True):
        rows = curate.value_filter(orders, "4-NOT SPECIFIED", invert=invert)
        parts.append(rows.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("inverted", F.lit(invert)))
    return parts[0].union(parts[1])


VALUE_SQL = "SELECT o_orderstatus, count(*) AS n, o_orderpriority <> '4-NOT SPECIFIED' AS inverted FROM orders GROUP BY ALL"


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with gaps of all kinds."""
    view = listing_view(spark, sf_dir)
    f = fields(view)
    lot = F.col("lot")
    engine = F.when(lot % 5 == 0, "N/A").when(lot % 5 == 1, " ").when(lot % 5 == 2, F.lit(None)).otherwise(f["engine"])
    return view.select(
        lot.alias("_pos"),
        F.concat(F.lit("u"), lot.cast("string")).alias("url"),
        "title",
        engine.alias("engine"),
        F.when(lot % 3 == 0, "N/A").otherwise(f["interior_color"]).alias("interior_color"),
        F.when(lot % 7 != 0, f["mileage"]).alias("mileage"),
        F.when(lot % 2 == 0, "N/A").otherwise("Dealer").alias("seller_type"),
        F.when(lot % 4 == 0, F.array().cast("array<string>")).otherwise(F.slice("details", 2, 2)).alias("listing_details"),
        F.slice("details", 6, 1).alias("excerpt"),
        "price",
    )


GAPPY = """
, g AS (
    SELECT lot AS _pos, 'u' || lot AS url, title, CASE lot % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN ' ' WHEN 2 THEN NULL ELSE engine END AS engine,
        CASE WHEN lot % 3 = 0 THEN 'N/A' ELSE interior_color END AS interior_color, CASE WHEN lot % 7 <> 0 THEN mileage END AS mileage,
        CASE WHEN lot % 2 = 0 THEN 'N/A' ELSE 'Dealer' END AS seller_type, CASE WHEN lot % 4 = 0 THEN [] ELSE details[2:3] END AS listing_details, details[6:6] AS excerpt, price
    FROM found
)
"""
GAPS = "engine IS NULL OR engine = 'N/A'", "interior_color IS NULL OR interior_color = 'N/A'", "mileage IS NULL", "seller_type IS NULL OR seller_type = 'N/A'", "listing_details IS NULL OR len(listing_details) = 0"


def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_fields(gappy(spark, sf_dir))


MISSING_SQL = f"WITH {VIEW}{GAPPY}, c AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS field, count(*) FILTER (WHERE {c}) AS missing, count(*) AS total FROM g" for n, c in zip(("engine", "interior_color", "mileage", "seller_type", "listing_details"), GAPS, strict=True)
) + ") SELECT field, missing, missing * 100.0::DOUBLE / total AS percent, missing = 0 AS complete FROM c"


def value_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_occurrences(gappy(spark, sf_dir))


VALUES_SQL = f"WITH {VIEW}{GAPPY}, c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS field, count(*) FILTER (WHERE {n} = 'N/A') AS n, count(*) AS total FROM g" for n in ("engine", "interior_color", "seller_type", "title")) + ") SELECT field, n, n * 100.0::DOUBLE / total AS percent FROM c WHERE n > 0"


def price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.price_summary(listing_view(spark, sf_dir))


PRICES_SQL = f"WITH {VIEW} SELECT count(*) AS total, count(*) FILTER (WHERE price > 0) AS with_price, avg(price) FILTER (WHERE price > 0) AS average, min(price) FILTER (WHERE price > 0) AS low, max(price) FILTER (WHERE price > 0) AS high FROM listing"


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequencies(read(spark, sf_dir, "part"), ("p_type", "p_brand", "p_name"))


FREQUENCY_SQL = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value, count(*) AS n FROM part WHERE {f} <> '' GROUP BY {f}" for f in ("p_type", "p_brand", "p_name"))

#: Rules with mixed-case keys: only those of variants ignore case, and N/A maps for variants alone.
RULES = [("engine", "ECONOMY", "Economy"), ("engine", "small", "never"), ("engine", "N/A", "never"), ("transmission", "Brand#2", "Two"), ("variant", "red widget", "Red Thing"), ("variant", "N/A", "Unknown")]


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    na = F.col("p_partkey") % 9 == 0
    return p.select(
        "p_partkey", F.when(na, "N/A").otherwise(F.col("p_type")).alias("engine"), F.col("p_brand").alias("transmission"), F.when(na, "N/A").otherwise(F.initcap("p_name")).alias("variant")
    )


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(_parts(spark, sf_dir), spark.createDataFrame(RULES, "field string, from_value string, to_value string"))


NORMALIZED_SQL = """
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'N/A' WHEN p_type = 'ECONOMY' THEN 'Economy' ELSE p_type END AS engine,
    CASE WHEN p_brand = 'Brand#2' THEN 'Two' ELSE p_brand END AS transmission,
    CASE WHEN p_partkey % 9 = 0 THEN 'Unknown' WHEN p_name = 'red widget' THEN 'Red Thing'
        ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') END AS variant
FROM part
"""


def normalized_by_saved_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by rules that were saved and read back, some of them overruled by later ones."""
    rows = [(0, f, a, "overruled") for f, a, _ in RULES] + [(1 + i, *r) for i, r in enumerate(RULES)]
    path = fresh_path(spark, "rules")
    normalize.save_rules(spark.createDataFrame(rows, "_pos int, field string, from_value string, to_value string"), path)
    return normalize.normalize(_parts(spark, sf_dir), normalize.read_rules(spark, path))


def reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.reduction(_parts(spark, sf_dir), normalized(spark, sf_dir))


REDUCTION_SQL = f"""
WITH a AS ({NORMALIZED_SQL}), b AS (
    SELECT CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE p_type END AS engine, p_brand AS transmission, CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE p_name END AS variant FROM part
), c AS (
    SELECT 'engine' AS field, (SELECT count(DISTINCT engine) FROM b) AS before, (SELECT count(DISTINCT engine) FROM a) AS after
    UNION ALL SELECT 'transmission', (SELECT count(DISTINCT transmission) FROM b), (SELECT count(DISTINCT transmission) FROM a)
    UNION ALL SELECT 'variant', (SELECT count(DISTINCT variant) FROM b), (SELECT count(DISTINCT variant) FROM a)
) SELECT field, before, after, before - after AS reduction, before <= 20 AS listed FROM c
"""


def reduction_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values before and after, of the fields with few of them."""
    return profile.reduction_details(_parts(spark, sf_dir), normalized(spark, sf_dir))


DETAILS_SQL = f"""
WITH a AS ({NORMALIZED_SQL}), b AS (
    SELECT CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE p_type END AS engine, p_brand AS transmission,
        CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') END AS variant FROM part
), u AS (
    {" UNION ALL ".join(f"SELECT '{f}' AS field, '{phase}' AS phase, {f} AS value FROM {t}" for f in ("engine", "transmission", "variant") for phase, t in (("before", "b"), ("after", "a")))}
), few AS (SELECT field FROM u WHERE phase = 'before' GROUP BY field HAVING count(DISTINCT value) <= 20)
SELECT field, phase, value, count(*) AS n FROM u JOIN few USING (field) GROUP BY ALL
"""


def rule_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.candidates(_parts(spark, sf_dir), pos="p_partkey")


CANDIDATES_SQL = """
WITH b AS (SELECT p_partkey AS p, CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE p_type END AS engine, p_brand AS transmission,
    CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') END AS variant FROM part),
u AS (SELECT 'engine' AS field, engine AS value, p FROM b UNION ALL SELECT 'transmission', transmission, p FROM b UNION ALL SELECT 'variant', variant, p FROM b)
SELECT field, value, count(*) AS n, min(p) AS first_seen FROM u GROUP BY field, value
"""


# inference: the fields of the gappy listings, and a generator that answers from the prompt alone

ASKED = ("engine", "interior_color", "location", "seller_type")


def answer(prompt: str) -> str:
    """A stand-in for a model: always the same answer to the same prompt; sometimes none that can be read."""
    h = hashlib.md5(prompt.encode()).hexdigest()
    if h[0] == "0":
        return "I cannot say."
    kinds = ["Dealer", "Private Party", "Someone", None]
    return "Sure: " + json.dumps({"engine": f"engine {h[1]}", "interior_color": None if h[2] == "0" else f"color {h[2]}", "location": 7, "seller_type": kinds[int(h[3], 16) % 4]})


def inference_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infer.with_prompts(gappy(spark, sf_dir), ASKED)
    return rows.select("url", F.array_join("na_fields", ",").alias("na_fields"), F.array_join("skipped_fields", ",").alias("skipped_fields"), F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


INFER_GAPS = {"engine": "engine IS NULL OR engine = 'N/A' OR trim(engine) = ''", "interior_color": "interior_color IS NULL OR interior_color = 'N/A'", "location": "true", "seller_type": "seller_type = 'N/A'"}
_LISTED = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in INFER_GAPS.items()) + "], lambda x: x IS NOT NULL)"
PROMPTED = f"""
{VIEW}{GAPPY}, n AS (SELECT *, {_LISTED} AS m, array_to_string(listing_details, chr(10)) AS d, array_to_string(excerpt, chr(10)) AS e FROM g),
w AS (SELECT *, CASE WHEN len(m) = 1 THEN 'field' ELSE 'fields' END AS word FROM n),
x AS (
    SELECT *, md5('Given this car listing data, infer the missing ' || word || ' (' || array_to_string(list_transform(m, lambda x: '"' || x || '"'), ', ') || ') based on the listing_details and excerpt.' || chr(10) || chr(10)
    || 'Listing Details:' || chr(10) || coalesce(d, '') || chr(10) || chr(10) || 'Excerpt:' || chr(10) || coalesce(e, '') || chr(10) || chr(10)
    || 'Extract and return ONLY a valid JSON object with these ' || len(m) || ' ' || word || ':' || chr(10)
    || array_to_string(list_transform(m, lambda x: '    "' || x || '": ' || CASE WHEN x = 'seller_type' THEN 'one of ["Private Party", "Dealer"]' ELSE 'string' END), ',' || chr(10)) || chr(10) || chr(10)
    || 'For enum fields, use ONLY the specified values.' || chr(10) || 'For other fields, use null if you cannot infer the value.' || chr(10) || chr(10)
    || 'Return ONLY the JSON object in this format, no other text:' || chr(10) || '{{' || chr(10)
    || array_to_string(list_transform(m, lambda x: '    "' || x || '": "..."'), ',' || chr(10)) || chr(10) || '}}') AS h
    FROM w
)
"""
PROMPTS_SQL = f"""
WITH {PROMPTED}
SELECT url, array_to_string(m, ',') AS na_fields, array_to_string(list_filter(['engine', 'interior_color', 'location', 'seller_type'], lambda x: NOT list_contains(m, x)), ',') AS skipped_fields, h AS prompt_md5 FROM x
"""


def inference_need(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.inference_need(gappy(spark, sf_dir), ("engine", "interior_color", "seller_type"))


NEED_SQL = f"""
WITH {VIEW}{GAPPY}, t AS (SELECT count(*) AS total, count(*) FILTER (WHERE {INFER_GAPS['engine']} OR {INFER_GAPS['interior_color']} OR {INFER_GAPS['seller_type']}) AS needing FROM g),
c AS ({" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE {INFER_GAPS[f]}) AS missing FROM g" for f in ("engine", "interior_color", "seller_type"))})
SELECT field, missing, total, needing, missing * 100.0::DOUBLE / total AS percent, total - needing AS complete FROM c CROSS JOIN t
"""


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dry_run(gappy(spark, sf_dir), ("engine", "interior_color", "seller_type"))


DRY_SQL = f"WITH n AS ({NEED_SQL}) SELECT any_value(needing) AS calls, sum(missing)::BIGINT AS fields_to_infer, any_value(needing) * 3 AS naive_fields, (any_value(needing) * 3 - sum(missing)) * 100.0::DOUBLE / (any_value(needing) * 3) AS saved_percent FROM n"


def dry_run_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows that a run would ask for."""
    rows = profile.dry_run_samples(gappy(spark, sf_dir), ("engine", "interior_color", "seller_type"))
    return rows.select("_pos", "title", F.array_join("na_fields", ",").alias("na_fields"))


SAMPLES_SQL = f"""
WITH {VIEW}{GAPPY}, n AS (SELECT _pos, substr(title, 1, 50) AS title, list_filter([{", ".join(f"CASE WHEN {INFER_GAPS[f]} THEN '{f}' END" for f in ("engine", "interior_color", "seller_type"))}], lambda x: x IS NOT NULL) AS m FROM g)
SELECT _pos, title, array_to_string(m, ',') AS na_fields FROM n WHERE len(m) > 0 ORDER BY _pos LIMIT 5
"""


def inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records after inference: only N/A texts are filled."""
    rows = gappy(spark, sf_dir)
    return infer.merge(infer.infer(rows, answer, ASKED)).select("url", "engine", "interior_color", "seller_type")


MERGED_SQL = f"""
WITH {PROMPTED}
SELECT url,
    CASE WHEN engine = 'N/A' AND h[1] <> '0' THEN 'engine ' || h[2] ELSE engine END AS engine,
    CASE WHEN interior_color = 'N/A' AND h[1] <> '0' AND h[3] <> '0' THEN 'color ' || h[3] ELSE interior_color END AS interior_color,
    CASE WHEN seller_type = 'N/A' AND h[1] <> '0' THEN CASE WHEN h[4] IN ('0', '4', '8', 'c') THEN 'Dealer' WHEN h[4] IN ('1', '5', '9', 'd') THEN 'Private Party' ELSE 'N/A' END ELSE seller_type END AS seller_type
FROM x
"""


def inference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = infer.results(infer.infer(gappy(spark, sf_dir), answer, ASKED), ASKED)
    counts = F.col("fields_inferred")
    stats = infer.run_stats(table, ASKED)
    return stats.select("total_entries", "entries_with_na", "entries_skipped", "llm_calls", "successful", "failed", *(counts[f].alias(f"filled_{f}") for f in ASKED))


STATS_SQL = f"""
WITH {PROMPTED}, y AS (SELECT *, h[1] <> '0' AS ok FROM x)
SELECT count(*) AS total_entries, count(*) AS entries_with_na, 0::BIGINT AS entries_skipped, (count(*) FILTER (WHERE ok) + 3 * count(*) FILTER (WHERE NOT ok))::BIGINT AS llm_calls,
    count(*) FILTER (WHERE ok) AS successful, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok AND ({INFER_GAPS['engine']})) AS filled_engine,
    count(*) FILTER (WHERE ok AND ({INFER_GAPS['interior_color']}) AND h[3] <> '0') AS filled_interior_color, count(*) FILTER (WHERE ok) AS filled_location,
    count(*) FILTER (WHERE ok AND seller_type = 'N/A' AND h[4] IN ('0', '4', '8', 'c', '1', '5', '9', 'd')) AS filled_seller_type
FROM y
"""


# load: orders as listings


def _orders(spark: SparkSession, sf_dir: str, where: str, shift: int) -> DataFrame:
    o = read(spark, sf_dir, "orders").where(where).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select(
        F.concat(F.lit("u"), F.expr("o_orderkey div 6").cast("string")).alias("url"),
        F.col("o_orderkey").alias("_pos"),
        F.lower("c_mktsegment").alias("make"),
        F.lower("o_orderstatus").alias("model"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lower("o_orderpriority")).alias("variant"),
        F.when(F.col("o_orderkey") % 4 != 0, F.floor("o_totalprice") + shift).alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(F.col("o_orderpriority"))).otherwise(F.array().cast("array<string>")).alias("listing_details"),
        F.when(F.col("o_orderkey") % 2 == 0, "bringatrailer").alias("source"),
        F.lit("N/A").alias("seller"),
    )


def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys of all variants with their model and make."""
    makes, models, variants = load.dimensions(_orders(spark, sf_dir, "true", 0))
    out = variants.select(F.col("name").alias("variant"), "model_id").join(models.select(F.col("id").alias("model_id"), "make_id", F.col("name").alias("model")), "model_id")
    return out.join(makes.select(F.col("id").alias("make_id"), F.col("name").alias("make")), "make_id").select("make", "model", "variant")


DIMENSIONS_SQL = "SELECT DISTINCT c_mktsegment AS make, o_orderstatus AS model, CASE WHEN o_orderkey % 3 <> 0 THEN upper(o_orderpriority) ELSE 'STANDARD' END AS variant FROM orders JOIN customer ON o_custkey = c_custkey"


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = load.last_per_key(load.conform(_orders(spark, sf_dir, "o_orderkey % 3 <> 0", 0))).drop("_pos")
    incoming = load.conform(_orders(spark, sf_dir, "o_orderkey % 4 = 1 OR o_orderkey % 3 = 0", 7))
    return load.upsert(current, incoming).select("url", "make", "model", "variant", "sale_price", "reserve_met", "listing_details", "source", "seller", "action")


_CONFORMED = """
SELECT 'u' || (o_orderkey // 6) AS url, o_orderkey AS pos, c_mktsegment AS make, o_orderstatus AS model, CASE WHEN o_orderkey % 3 <> 0 THEN upper(o_orderpriority) ELSE 'STANDARD' END AS variant,
    CASE WHEN o_orderkey % 4 <> 0 THEN (floor(o_totalprice)::BIGINT + {shift}) * 100 END AS sale_price, CASE WHEN o_orderkey % 4 <> 0 THEN true END AS reserve_met,
    CASE WHEN o_orderkey % 2 = 0 THEN '["' || o_orderpriority || '"]' END AS listing_details, 'bringatrailer' AS source, 'N/A' AS seller
FROM orders JOIN customer ON o_custkey = c_custkey WHERE {where} QUALIFY row_number() OVER (PARTITION BY o_orderkey // 6 ORDER BY o_orderkey DESC) = 1
"""
_COLUMNS = ("make", "model", "variant", "sale_price", "reserve_met", "listing_details", "source", "seller")
UPSERT_SQL = f"""
WITH c AS ({_CONFORMED.format(shift=0, where="o_orderkey % 3 <> 0")}), n AS ({_CONFORMED.format(shift=7, where="o_orderkey % 4 = 1 OR o_orderkey % 3 = 0")})
SELECT coalesce(n.url, c.url) AS url, {", ".join(f"CASE WHEN n.url IS NOT NULL THEN n.{x} ELSE c.{x} END AS {x}" for x in _COLUMNS)},
    CASE WHEN c.url IS NULL THEN 'inserted' WHEN n.url IS NULL THEN 'unchanged' ELSE 'updated' END AS action
FROM c FULL OUTER JOIN n ON c.url = n.url
"""


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads into a table in hash buckets, of which the second rewrites those that it touches."""
    table = load.Snapshot(spark, fresh_path(spark, "facts"), buckets=16)
    table.upsert(load.conform(_orders(spark, sf_dir, "o_orderkey % 3 <> 0", 0)))
    table.upsert(load.conform(_orders(spark, sf_dir, "o_orderkey % 4 = 1 OR o_orderkey % 3 = 0", 7)))
    return table.read().select("url", *_COLUMNS)


SNAPSHOT_SQL = f"SELECT * EXCLUDE (action) FROM ({UPSERT_SQL})"


def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of models after two loads, the second of which brings new ones."""
    o = _orders(spark, sf_dir, "true", 0)
    first = load.dimensions(o.where("model <> 'p'"))
    makes, models, _ = load.dimensions(o, *first)
    return models.join(makes.select(F.col("id").alias("make_id"), F.col("name").alias("make")), "make_id").select("id", "make", F.col("name").alias("model"))


DENSE_SQL = """
WITH m AS (SELECT DISTINCT c_mktsegment AS make, o_orderstatus AS model FROM orders JOIN customer ON o_custkey = c_custkey),
makes AS (SELECT make, min(model = 'P') AS late FROM m GROUP BY make), made AS (SELECT make, row_number() OVER (ORDER BY late, make) AS make_id FROM makes)
SELECT row_number() OVER (ORDER BY model = 'P', make_id, model) AS id, make, model FROM m JOIN made USING (make)
"""


def first_make_and_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make and model of the first record for the whole batch."""
    rows = load.conform(load.batch_make_model(_orders(spark, sf_dir, "o_orderkey % 5 = 2", 0)))
    return rows.select(F.col("_pos").alias("o_orderkey"), "make", "model", "variant")


FIRST_SQL = """
WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 = 2)
SELECT o_orderkey, (SELECT c_mktsegment FROM j ORDER BY o_orderkey LIMIT 1) AS make, (SELECT o_orderstatus FROM j ORDER BY o_orderkey LIMIT 1) AS model,
    CASE WHEN o_orderkey % 3 <> 0 THEN upper(o_orderpriority) ELSE 'STANDARD' END AS variant FROM j
"""


def typed_answer(prompt: str) -> str:
    """Numbers and truth values in many forms, made of the size that the prompt speaks of."""
    n = int(re.search(r"size (\d+)", prompt)[1])
    return json.dumps({"mileage": [n, str(n), n + 0.5, f"about {n}"][n % 4], "convertible": [True, "Yes", "no", 1][n % 3]})


def typed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers and truth values as their type allows them. Parts of one size ask the same and are answered once."""
    rows = read(spark, sf_dir, "part").select(
        "p_partkey", F.lit(None).cast("int").alias("mileage"), F.lit(None).cast("boolean").alias("convertible"),
        F.array(F.concat(F.lit("size "), F.col("p_size").cast("string"))).alias("listing_details"), F.array().cast("array<string>").alias("excerpt"),
    )
    found = infer.infer(rows, typed_answer, ["mileage", "convertible"])
    return found.select("p_partkey", *(F.try_element_at("inferred", F.lit(c)).alias(c) for c in ("mileage", "convertible")), "attempts")


TYPED_SQL = """
SELECT p_partkey, CASE WHEN p_size % 4 <> 3 THEN p_size::VARCHAR END AS mileage, CASE WHEN p_size % 3 = 2 THEN 'false' ELSE 'true' END AS convertible, 1 AS attempts FROM part
"""


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _orders(spark, sf_dir, "o_orderkey % 3 <> 0", 0)
    incoming = _orders(spark, sf_dir, "o_orderkey % 4 = 1 OR o_orderkey % 3 = 0", 7).withColumn("url", F.when(F.col("_pos") % 50 != 0, F.col("url")))
    sound, failed = load.quarantine(incoming)
    return load.load_counts(sound, current, failed)


COUNTS_SQL = """
WITH j AS (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey), c AS (SELECT DISTINCT o_orderkey // 6 AS u FROM j WHERE o_orderkey % 3 <> 0),
i AS (SELECT o_orderkey // 6 AS u, o_orderkey FROM j WHERE o_orderkey % 4 = 1 OR o_orderkey % 3 = 0), s AS (SELECT * FROM i WHERE o_orderkey % 50 <> 0),
f AS (SELECT count(DISTINCT u) AS inserted FROM s WHERE u NOT IN (SELECT u FROM c))
SELECT inserted, (SELECT count(*) FROM s) - inserted AS updated, (SELECT count(*) FROM i) - (SELECT count(*) FROM s) AS errors, (SELECT count(*) FROM i) AS total FROM f
"""

QUERIES = {
    "union_keep_first": (union_keep_first, KEEP_FIRST_SQL),
    "dedupe_counts": (dedupe_counts, DEDUPE_SQL),
    "limit_per_source": (limit_per_source, LIMIT_SQL),
    "stable_sort": (stable_sort, SORT_SQL),
    "sort_ascending": (sorted_up, SORT_UP_SQL),
    "sort_strict": (sorted_strictly, STRICT_SQL),
    "append_until_known": (append_until_known, UNTIL_SQL),
    "append_stream": (append_stream, UNTIL_SQL),
    "rank_parts": (rank_parts, RANK_SQL),
    "append_first_slug": (first_slug_with_yield, FIRST_SLUG_SQL),
    "join_targets": (targets_join, TARGETS_SQL),
    "filter_value": (value_filter, VALUE_SQL),
    "profile_missing": (missing_summary, MISSING_SQL),
    "profile_values": (value_summary, VALUES_SQL),
    "profile_prices": (price_summary, PRICES_SQL),
    "profile_frequencies": (frequencies, FREQUENCY_SQL),
    "normalize_fields": (normalized, NORMALIZED_SQL),
    "normalize_saved_rules": (normalized_by_saved_rules, NORMALIZED_SQL),
    "normalize_reduction": (reduction, REDUCTION_SQL),
    "normalize_candidates": (rule_candidates, CANDIDATES_SQL),
    "normalize_details": (reduction_details, DETAILS_SQL),
    "infer_samples": (dry_run_samples, SAMPLES_SQL),
    "infer_prompts": (inference_prompts, PROMPTS_SQL),
    "infer_need": (inference_need, NEED_SQL),
    "infer_dry_run": (dry_run, DRY_SQL),
    "infer_merge": (inferred, MERGED_SQL),
    "infer_stats": (inference_stats, STATS_SQL),
    "load_dimensions": (dimension_rows, DIMENSIONS_SQL),
    "load_upsert": (upserted, UPSERT_SQL),
    "load_snapshot": (snapshot, SNAPSHOT_SQL),
    "load_dense_ids": (dense_ids, DENSE_SQL),
    "load_first_make_and_model": (first_make_and_model, FIRST_SQL),
    "infer_typed": (typed_answers, TYPED_SQL),
    "load_counts": (load_counts, COUNTS_SQL),
}
