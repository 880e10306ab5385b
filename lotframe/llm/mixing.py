"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source gets a target of words (``source_targets``). Its documents are shuffled by a hash of doc_id and served one
after another, the whole source up to ``repeats`` times. Each serving of a document gets its virtual finish time: the
cumulative words of its source, over the source's target. The servings of all sources are range-sorted by that time, a
running total of their words is made by range, and the mix is what lies within the total budget: ranges below it are
taken whole, ranges above it are left, and only in the one that holds the cut are servings added up one by one. A
document that its source would be serving at virtual time 1, when all targets are met, is queued in up to ``PIECES``
pieces, so that a long one moves no source far from its target; there is one such document a source.

The cumulative sums need no window over a whole source: documents are ranked inside (source, bucket of the hash), and
the sums of earlier buckets come from a table of bucket totals.

Defined results: a null text has size 0 and takes 0; a source without words has target 0; null sources are one source,
after all others; rows without a doc_id are shuffled by their text; ties of the hash are only rows of the same doc_id,
served in order of size, and ties of the finish time go by source and hash; long texts count whole; an empty table gives
an empty result; extra columns are ignored by ``mix_sources`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotframe.llm._store import materialize, partitions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SEED = "mix"
#: Hash digits that make a bucket: 16 ** DIGITS buckets a source.
DIGITS = 3
SOURCE = ["no_source", "source_key"]
#: Pieces of the document in service when all targets are met.
PIECES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Targets of sources. sizes: no_source, source_key, source_size. Weights repeat over the sources by code point, null
    last; no target passes ``repeats`` times its source's size, and the excess is dealt again by weight. The table has
    one row a source, which is what its single-partition windows sort."""
    ranked = sizes.withColumn("at", F.row_number().over(Window.orderBy(*SOURCE)) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumns({"limit": F.col("source_size") * repeats, "fill": F.col("source_size") * repeats / F.col("weight")})
    every = Window.orderBy("fill", "at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("fill", "at").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    leveled = ranked.withColumn("level", level)
    water = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "at", "level"))).over(every)["level"]
    budget = F.floor(F.sum("source_size").over(every) * float(min(share, repeats)))
    return leveled.withColumns({"water": water, "budget": budget}).select(
        *SOURCE, "source_size", "budget", F.least(F.col("limit").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("limit").cast("double"))).alias("target")
    )


def _queued(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, size, and the document's place in the shuffle, without the text but for a hash of it."""
    queue = docs.select(
        "doc_id",
        "source",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))), F.lit(f":{seed}")).cast("binary")).alias("order"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),  # fixed by being written
    )
    return materialize(queue.withColumn("bucket", F.substring("order", 1, DIGITS)), "mix")


def _servings(queue: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """The queue: a row for each serving, or piece of one, with its words and virtual finish time."""
    totals = queue.groupBy(*SOURCE, "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy(*SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(*SOURCE, "bucket", "offset")
    targets = source_targets(totals.groupBy(*SOURCE).agg(F.sum("n").alias("source_size")), weights, share, repeats)
    inside = Window.partitionBy(*SOURCE, "bucket").orderBy("order", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = queue.withColumn("within", F.sum("size").over(inside)).join(offsets, [*SOURCE, "bucket"]).join(targets, SOURCE)
    served = placed.withColumn("pass", F.explode(F.array(*map(F.lit, range(repeats)))))
    begin = F.col("pass") * F.col("source_size") + F.col("offset") + F.col("within") - F.col("size")
    served = served.withColumn("begin", begin)
    cut = (F.col("begin") < F.col("target")) & (F.col("begin") + F.col("size") > F.col("target"))
    served = served.withColumn("pieces", F.when(cut, F.least("size", F.lit(PIECES))).otherwise(1).cast("long"))
    pieces = served.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    until = F.expr("size * (piece + 1) div pieces")
    return pieces.select(
        "row", "doc_id", "source", *SOURCE, "size", "source_size", "target", "budget", "text_hash", "order", "pass", "piece",
        (until - F.expr("size * piece div pieces")).alias("words"),
        F.when(F.col("target") > 0, (F.col("begin") + until) / F.col("target")).alias("finish"),
    )


def _served(queue: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """One row of the queue each: what is taken of it, and the virtual finish time of its first serving."""
    by = [F.asc_nulls_last("finish"), *SOURCE, "order", "row", "pass", "piece"]
    n = partitions(queue.sparkSession)
    ranged = _servings(queue, weights, share, repeats).repartitionByRange(n, *by).withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "queue")
    # one row a range: what earlier ranges hold
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("range").agg(F.sum("words").alias("held")).withColumn("ahead", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    ranged = ranged.join(F.broadcast(ranges), "range")
    left = F.col("budget") - F.col("ahead")
    clear = ranged.where((left <= 0) | (F.col("held") <= left)).withColumn("taken", F.when(left > 0, F.col("words")).otherwise(0))
    so_far = F.sum("words").over(Window.partitionBy("range").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    split = ranged.where((left > 0) & (F.col("held") > left)).withColumn("taken", F.greatest(F.lit(0), F.least(F.col("words"), left - so_far)))
    keys = ["row", "doc_id", "source", "size", "source_size", "target", "text_hash"]
    first = F.max(F.when(F.col("pass") == 0, F.col("finish"))).alias("virtual_finish")
    return clear.unionByName(split).groupBy(*keys).agg(F.sum("taken").cast("long").alias("taken"), first)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and the virtual finish time of the first serving, one row a document.
    The mix is served in order of that time."""
    served = _served(_queued(docs, seed), weights, share, repeats)
    return served.select("doc_id", "size", "source_size", "target", "taken", "source", "virtual_finish")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix serves, with all their columns: once for each whole time a document is taken, and
    once more if at least half of it is served when the budget ends. Texts are streamed past a hash table of what is
    taken and never sorted; equal rows share what they take."""
    served = _served(_queued(docs, seed), weights, share, repeats).where("taken > 0")
    times = F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int")
    keys = served.groupBy("doc_id", "text_hash").agg(times.alias("times")).where("times > 0")
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "times")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("text").alias("_text"))
    found = rows.join(keys.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
    return found.select("row", F.explode(F.sequence(F.lit(1), "times")).alias("time")).select("row.*")
