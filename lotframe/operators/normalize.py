"""Value normalisation by rules (field, from_value, to_value): a lookup per field, a miss leaves the value as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotframe.schema import NA

#: Rules up to this many are compiled into the plan as literal maps; more are joined.
LITERAL_RULES = 200


def _guard(field: str, value: Column) -> tuple[Column, Column]:
    """(the key to look up, whether the value may be mapped at all). Variants ignore case, and their N/A may be mapped."""
    if field == "variant":
        return F.upper(value), value.isNotNull() & (value != "")
    return value, value.isNotNull() & ~value.isin("", NA)


def _keyed(rules: DataFrame) -> DataFrame:
    """(field, key, value), one row a key: the last rule by ``_pos`` counts where there is such a column, as in a file read
    in order, else that of the greatest to_value. Keys of variant are compared in capitals."""
    key = F.when(F.col("field") == "variant", F.upper("from_value")).otherwise(F.col("from_value"))
    value = F.max_by("to_value", "_pos") if "_pos" in rules.columns else F.max("to_value")
    return rules.where(F.col("from_value").isNotNull()).groupBy("field", key.alias("key")).agg(value.alias("value"))


def normalize(df: DataFrame, rules: DataFrame, fields: tuple[str, ...] = ("engine", "transmission", "variant")) -> DataFrame:
    """All fields of all records; without rules, or for fields that are not there, nothing changes. Rules of equal keys are
    made one first. Then a small set becomes literal maps in the projection, and a large one is joined once per field
    (each key is unique, so rows never multiply), by broadcast or shuffle as its size tells Spark; both give the same."""
    fields = tuple(f for f in fields if f in df.columns)
    keyed = _keyed(rules.where(F.col("field").isin(*fields)) if fields else rules.limit(0))
    some = keyed.limit(LITERAL_RULES + 1).collect()
    small = len(some) <= LITERAL_RULES
    for f in fields:
        key, may = _guard(f, F.col(f))
        if small:
            pairs = [F.lit(x) for r in some if r["field"] == f for x in (r["key"], r["value"])]
            if pairs:
                df = df.withColumn(f, F.when(may, F.coalesce(F.try_element_at(F.create_map(*pairs), key), f)).otherwise(F.col(f)))
            continue
        mine = keyed.where(F.col("field") == f).select(F.col("key").alias("_from"), F.col("value").alias("_to"))
        df = df.withColumn("_look", F.when(may, key)).join(mine, F.col("_look") == F.col("_from"), "left")
        df = df.withColumn(f, F.coalesce("_to", f)).drop("_look", "_from", "_to")
    return df


def candidates(df: DataFrame, fields: tuple[str, ...] = ("engine", "transmission", "variant"), pos: str = "_pos") -> DataFrame:
    """(field, value, n, first_seen): what a person edits into rules, most frequent first and ties by first occurrence."""
    items = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields)))
    rows = df.select(items.alias("x"), F.col(pos).alias("p")).select("x.field", "x.value", "p").where("value is not null and value <> ''")
    return rows.groupBy("field", "value").agg(F.count("*").alias("n"), F.min("p").alias("first_seen")).orderBy("field", F.desc("n"), "first_seen")


def save_rules(rules: DataFrame, path: str) -> None:
    """Rules as JSON lines, with their positions where they have them, so that they mean the same when read back."""
    rules.select("field", "from_value", "to_value", *[c for c in ("_pos",) if c in rules.columns]).write.mode("overwrite").json(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules as ``save_rules`` wrote them."""
    found = spark.read.json(path)
    kind = "field string, from_value string, to_value string" + (", _pos " + found.schema["_pos"].dataType.simpleString() if "_pos" in found.columns else "")
    return spark.read.schema(kind).json(path)
