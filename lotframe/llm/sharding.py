"""Sharding as vector bin packing: bytes, tokens and rows are balanced jointly.

Documents of equal text form a group that stays together. Groups are dealt into cells by hash; in each cell, the
largest first, a group goes to the bin with the highest dot product of its (bytes, tokens, rows) and the bin's residual
capacity. The bins of all cells are then placed on the shards by the same rule, on the driver: their number is
``MAX_CELLS`` times the number of shards at most, whatever the input. Only a group above ``1 / shards`` of any total,
which no shard can hold in its share, is split, into pieces of a part of a shard by a hash of doc_id, or of the row where
one doc_id alone makes a piece. The rows of a group
above ``1 / (HOT * shards)`` of any total are dealt to several tasks by the same hash, whether they stay together or not;
at most ``3 * HOT * shards`` groups are so large, which bounds what is broadcast.

Defined results: a null text has the size of an empty one; long texts count whole; repeated rows each get a slot of their
own; equal groups are placed in order of their hash; an empty table gives an empty result; extra columns are ignored.
Reruns over the same files give the same shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotframe.llm._store import materialize

WORD = r"[^\x20\x09-\x0D]+"
HOT = 4
MAX_CELLS = 10_000
GROUPS_A_CELL = 4096
DIMENSIONS = ("bytes", "tokens", "rows")
#: How much each dimension counts in the dot product.
WEIGHTS = np.array([4.0, 1.0, 1.0])


def pack(items: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each item. items: one row of non-negative sizes each."""
    total = items.sum(axis=0, dtype=float)
    share = items / np.where(total > 0, total, 1.0) * bins
    residual = np.ones((bins, items.shape[1]))
    least = np.array([-np.inf, *[0.0] * (items.shape[1] - 1)])  # a bin too full of tokens or rows is filled with bytes all the same
    out = np.zeros(len(items), np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable") if len(items) else []:
        best = int(np.argmax(np.maximum(residual, least) @ (share[i] * WEIGHTS)))
        residual[best] -= share[i]
        out[i] = best
    return out


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is ``bytes``), and the tokens counted."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),  # fixed by being written
        ),
        "sizes",
    )
    same = ["text_hash", "text_crc32", "size"]
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = narrow.groupBy(same).agg(*sums)
    totals = groups.agg(F.count("*").alias("n"), *(F.sum(d).alias(d) for d in DIMENSIONS)).first()
    cells = max(1, min(MAX_CELLS, totals["n"] // GROUPS_A_CELL))
    share = F.greatest(*(F.col(d) * float(HOT * shards) / float(totals[d] or 1) for d in DIMENSIONS))
    hot = groups.where(share > 1).select(*same, F.ceil(share).cast("int").alias("pieces"), (share > HOT).alias("split"))
    # doc_ids on so many rows of a hot group that they must be dealt row by row; no more than hot pieces
    many = narrow.join(F.broadcast(hot), same).groupBy(*same, "doc_id").agg(F.count("*").alias("times"), F.sum(F.col("size")).alias("_bytes"), F.sum("tokens").alias("_tokens"))
    own = F.greatest(F.col("_bytes") / float(totals["bytes"] or 1), F.col("_tokens") / float(totals["tokens"] or 1), F.col("times") / float(totals["rows"] or 1))
    many = many.where(own * (HOT * shards) > 0.5).select(*(F.col(c).alias(f"_{c}") for c in [*same, "doc_id"]))
    found = [F.col(c) == F.col(f"_{c}") for c in same] + [F.col("doc_id").eqNullSafe(F.col("_doc_id"))]
    spread = F.xxhash64("doc_id", F.when(F.col("_size").isNotNull(), F.col("row"))).alias("spread")
    salted = narrow.join(F.broadcast(many), found, "left").select(*narrow.columns, spread)
    dealt = (
        salted.join(F.broadcast(hot), same, "left")
        .withColumn("part", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.col("spread"), F.col("pieces"))).cast("int"))
        .withColumn("piece", F.when(F.col("split"), F.col("part")).otherwise(0))
        .withColumn("cell", F.pmod(F.xxhash64(*same, "piece"), F.lit(cells)).cast("int"))
    )
    item = [*same, "piece"]

    def place(key, pdf):
        pdf = pdf.sort_values([*item, "part"], ignore_index=True)
        whole = pdf.groupby(item)
        bins = pack(whole[list(DIMENSIONS)].sum().to_numpy(np.float64), shards)
        return pdf[[*item, "part"]].assign(cell=key[0], bin=bins[whole.ngroup().to_numpy()], **{d: pdf[d] for d in DIMENSIONS})

    placed = materialize(
        dealt.groupBy("cell", *item, "part").agg(*sums).groupBy("cell").applyInPandas(place, "text_hash long, text_crc32 long, size long, piece int, part int, cell int, bin int, bytes long, tokens long, rows long"),
        "bins",
    )
    loads = placed.groupBy("cell", "bin").agg(*(F.sum(d).alias(d) for d in DIMENSIONS)).toPandas().sort_values(["cell", "bin"], ignore_index=True)
    where = pd.DataFrame({"cell": loads["cell"], "bin": loads["bin"], "shard": pack(loads[list(DIMENSIONS)].to_numpy(np.float64), shards)})
    where = docs.sparkSession.createDataFrame(where.astype("int32"), "cell int, bin int, shard int")
    homes = placed.join(F.broadcast(where), ["cell", "bin"])
    # slots: the rank inside (cell, part, shard), after the rows of earlier cells and parts in that shard
    offsets = (
        homes.groupBy("shard", "cell", "part")
        .agg(F.sum("rows").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("shard", "cell", "part", "before")
    )
    rank = F.row_number().over(Window.partitionBy("cell", "part", "shard").orderBy("doc_id"))
    return (
        dealt.join(homes.select(*item, "part", "cell", "shard"), [*item, "part", "cell"])
        .withColumn("rank", rank)
        .join(offsets, ["cell", "part", "shard"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("rank") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "tokens",
        )
    )
