"""From raw documents to token ids in five stages. Each takes (spark, docs, sf_dir) and works on all that the one before
kept; its result is written as Parquet and read again as the next one's docs. Null texts and empty ones are rejected by
the first stage, long ones are processed whole, empty tables give empty tables, and columns besides doc_id, text and
source are carried along to the end, whatever their names (but for those that the encoding makes: ids, n_tokens and
lossless). Tables that a stage writes for itself are deleted when its result is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotframe.llm import mixing, near_duplicates, quality_rules, repeats, sentencepiece
from lotframe.sources.shared import fresh_path, scratch, written

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go."""
    return quality_rules.passing_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, similarity 0.8) stays: that of the smallest doc_id, null last.
    Rows are told apart by what all their columns hold, so different texts under one doc_id are judged each on their own;
    of rows that are equal throughout one stays. Where different rows share a key by chance, they share their fate too."""
    plain = [F.col(f"`{c}`") for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64(*plain).alias("key"), F.xxhash64(F.lit(1), *plain).alias("check"))
    found = near_duplicates.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"), k=5, hundredths=80)
    named = rows.groupBy("key").agg(F.min("row.doc_id").alias("id")).join(found.select(F.col("doc_id").alias("key"), "component_id").distinct(), "key")
    first = named.groupBy("component_id").agg(F.min_by("key", F.struct(F.col("id").isNull(), "id", "key")).alias("key"))
    return rows.join(first, "key", "left_semi").dropDuplicates(["key", "check"]).select("row.*")


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that an earlier document holds are cut out; documents of which nothing is left go.
    A column n_chars, where there is one, follows the text."""
    cut = repeats.without_repeats(docs)
    spans = next(c for c in cut.columns if c not in docs.columns)
    cut = cut.where((F.size(spans) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size(spans) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*(F.col(f"`{c}`") for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target serves them."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, sampled anew for each time it is served, and whether they decode to its text."""
    return sentencepiece.encode(docs, PIECES, carry=True, servings=True)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", repeat_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL expresses neither the components of near duplicates nor the sampled segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        with scratch(spark, *filter(None, [before])):
            docs = written(stage(spark, docs, sf_dir), path)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
