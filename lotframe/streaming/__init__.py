"""Arriving pages and cards: the batch jobs run on each micro-batch, and ``until_known`` keeps, for each group, the place of
its first known row from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lotframe.operators import curate
from lotframe.operators.extract import SiteProfile, extract_pages, quarantine
from lotframe.schema import NA


def extract_batch(pages: DataFrame, targets: DataFrame, profile: SiteProfile | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept listings, quarantined rows) of a table of pages (url, html, slug, ...)."""
    read, unread = quarantine(extract_pages(curate.attach_targets(pages, targets), profile))
    good, bad = quarantine(curate.skip_reason(read))
    return good.where("skip_reason is null").drop("skip_reason"), unread.select("url", "_error").union(bad.select("url", "_error"))


def extract_stream(pages: DataFrame, targets: DataFrame, out: str, checkpoint: str, profile: SiteProfile | None = None) -> StreamingQuery:
    """Appends kept listings of each micro-batch to ``{out}/listings`` and bad rows to ``{out}/quarantine``, in a folder for
    each batch that a rerun of the batch overwrites, so that a restart repeats nothing."""

    def write(batch: DataFrame, number: int) -> None:
        kept, bad = extract_batch(batch, targets, profile)
        kept.write.mode("overwrite").parquet(f"{out}/listings/batch={number}")
        bad.write.mode("overwrite").parquet(f"{out}/quarantine/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Buckets of groups, each with one state; 2 ** 20 groups make about a thousand places in each.
BUCKETS = 1024
_LAST = (1 << 63) - 1


def until_known(rows: DataFrame, group: str = "slug", pos: str = "_pos", known: str = "known", buckets: int = BUCKETS) -> DataFrame:
    """``curate.until_known`` on a stream (append mode): the rows of each group before its first known row. Groups are dealt to
    ``buckets`` by hash, and the state of a bucket is the places of those rows in its groups, so that Python is called for
    buckets and not for groups; a checkpoint keeps the number it began with. Micro-batches give what one batch gives if a
    group's rows come in order of ``pos`` from batch to batch; inside one they may come in any order. A row that came too early
    cannot be taken back. A null place is after all others and is kept only while nothing known has come; a null ``known`` is
    false. What is held in memory at a time is what a bucket gets in one micro-batch and its state; bound the first by the
    source's limits per trigger and the second by more buckets."""
    kind = rows.schema[pos].dataType
    if kind.simpleString() not in ("int", "bigint", "smallint", "tinyint"):
        raise ValueError(f"{pos} must be a whole number, not {kind.simpleString()}")
    # whole numbers travel as text, as pandas makes floats of a column with a null
    whole = {f.name: f.dataType for f in rows.schema if isinstance(f.dataType, T.IntegralType)}
    dealt = rows.withColumns({"_group": F.col(group).cast("string"), "_at": F.coalesce(F.col(pos).cast("bigint"), F.lit(_LAST)), **{c: F.col(c).cast("string") for c in whole}})
    dealt = dealt.withColumn("_bucket", F.pmod(F.xxhash64("_group"), F.lit(buckets)))
    out = T.StructType([T.StructField(f.name, T.StringType()) if f.name in whole else f for f in rows.schema])

    def cut_off(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(frames), ignore_index=True)
        names, places = state.get if state.exists else ([], [])
        codes, groups = pd.factorize(np.concatenate([np.array(names, object), held["_group"].to_numpy(object)]), use_na_sentinel=False)
        old, codes = codes[: len(names)], codes[len(names) :]
        cut, there = np.full(len(groups), _LAST), np.zeros(len(groups), bool)
        cut[old], there[old] = np.array(places, np.int64), True
        at, is_known = held["_at"].to_numpy(np.int64), held[known].eq(True).to_numpy(bool)
        if is_known.any():
            np.minimum.at(cut, codes[is_known], at[is_known])
            there[codes[is_known]] = True
            state.update(([None if pd.isna(g) else g for g in groups[there]], cut[there].tolist()))
        yield held.loc[~there[codes] | (at < cut[codes]), out.names]

    kept = dealt.groupBy("_bucket").applyInPandasWithState(cut_off, out, "names array<string>, cuts array<bigint>", "append", GroupStateTimeout.NoTimeout)
    return kept.withColumns({c: F.col(c).cast(t) for c, t in whole.items()})


def append_stream(cards: DataFrame, known: DataFrame, out: str, checkpoint: str, key: str = "lot_number") -> StreamingQuery:
    """Appends the cards of each slug before its first known one to ``out``. cards: a stream with slug, _pos and the key;
    known: the table of known keys, as it is when a micro-batch begins."""
    found = known.select(F.col(key).alias("_known_key")).where(F.col(key).isNotNull() & (F.col(key).cast("string") != NA)).distinct()
    marked = cards.join(found, F.col(key) == F.col("_known_key"), "left").withColumn("known", F.col("_known_key").isNotNull()).drop("_known_key")
    return until_known(marked).drop("known").writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
