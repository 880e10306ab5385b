"""The prefix trie of conversations, by ROLLUP over columns of turn ids.

A node is a distinct sequence of first turns (role and text); its members are the conversations that begin with it. Turns
become ids of fixed size (128 bits of SHA-256, and the length of the text), so that the first ``WIDTH`` turns of a
conversation are as many columns t1, t2, ... of one row. ROLLUP over these columns aggregates all prefixes together, and
grouping_id tells how deep a group is. Conversations that go on, and whose node at the end of the block has other members
too, continue in a further block of columns, keyed by that node; a conversation that is alone in its node has a chain of
nodes of its own below it, which needs no grouping.

A second ROLLUP, over the distinct nodes of a block from the last block to the first, sums what subtrees hold; a block's
totals are added to the node that it is keyed by.

A node is named by its smallest member and its depth. No group is gathered: counts, minima and sums are aggregated before
they are shuffled, turns are numbered by ranges of the sorted table (one conversation may span many of them), and the
members that end at a node are brought to text by 256 ids at a time and hashed as a stream.

Defined results: turns are ordered by number, null first, ties by role and a digest of role and text; null role or text is
empty; repeated rows are turns of their own; rows without conv_id take no part; a conversation of one turn, or of none
after its turns have been exchanged, is a member of the root; long conversations and texts count whole; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotframe.llm._store import materialize, partitions

#: Turn columns of the first block, and of further ones.
WIDTH, DEEP = 8, 32
#: Bytes of a turn id: digest and code points of the text.
ID, DIGEST = 20, 16


def _turn_id() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.char_length(text)), 2 * (ID - DIGEST), "0")))


def _chars(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, DIGEST + 1, ID - DIGEST)), 16, 10).cast("long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, id, part, n) of sorted rows (conv_id, id): n counts the rows of a conversation in this partition."""
    part, last, before = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        at = np.arange(len(conv))
        n = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        if conv[0] == last:
            n[: np.append(np.flatnonzero(new)[1:], len(conv))[0]] += before
        last, before = conv[-1], int(n[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(conv), part, np.int32)), pa.array(n)], names=["conv_id", "id", "part", "n"])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, id and place (from 1) of every turn. The table is sorted by ranges and counted inside each; a conversation
    that spans several ranges goes on counting by a table of two rows a range."""
    by = ["conv_id", F.asc_nulls_first("turn"), "role", "id"]
    turns = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), _turn_id().alias("id"))
    turns = turns.repartitionByRange(partitions(conversations.sparkSession), *by).sortWithinPartitions(*by)
    turns = materialize(turns.select("conv_id", "id").mapInArrow(_counted, "conv_id long, id binary, part int, n long"), "turns")
    ends = turns.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "n")).alias("last"))
    ends = ends.select("part", F.explode(F.array(F.struct(F.col("first").alias("conv_id"), F.lit(0).cast("long").alias("n")), "last")).alias("x")).select("part", "x.*")
    ends = ends.groupBy("conv_id", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ends.select("conv_id", "part", F.sum("n").over(earlier).alias("ahead")).where("ahead > 0")
    return turns.join(F.broadcast(ahead), ["conv_id", "part"], "left").select("conv_id", "id", (F.col("n") + F.coalesce("ahead", F.lit(0))).alias("place"))


def _columns(ids: Column, width: int) -> list[Column]:
    return [F.get(ids, F.lit(j)).alias(f"t{j + 1}") for j in range(width)]


def _listed(frame: DataFrame, keys: list[str], kept: Column, *more: Column) -> DataFrame:
    """Ids of the turns for which ``kept`` is true, in order of place, as an array."""
    pairs = F.sort_array(F.collect_list(F.when(kept, F.struct("place", "id"))))
    return frame.groupBy(*keys).agg(F.transform(pairs, lambda x: x["id"]).alias("ids"), *more)


def exchanged(turns: DataFrame, every: int, most: int, width: int) -> DataFrame:
    """conv_id, n_turns, shift and t1.. of conversations whose first h turns are those of conversation c - c % ``every``, with
    h = crc32(c) % (``most`` + 1); the turn at place p after them has place p - shift then."""
    first = materialize(_listed(turns, ["conv_id"], F.col("place") <= width + most, F.count("*").alias("own")), "first-turns")
    heads = first.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, most).alias("head"))
    both = first.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("base"), "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), h)
    both = both.select("conv_id", "own", h.alias("h"), F.size(head).alias("k"), F.concat(head, F.slice("ids", h + 1, F.lit(width + most))).alias("ids"))
    n_turns = F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return both.select("conv_id", n_turns.cast("long").alias("n_turns"), (F.col("h") - F.col("k")).alias("shift"), *_columns(F.col("ids"), width))


def as_they_are(turns: DataFrame, width: int) -> DataFrame:
    first = _listed(turns, ["conv_id"], F.col("place") <= width, F.count("*").alias("n_turns"))
    return first.select("conv_id", "n_turns", F.lit(0).alias("shift"), *_columns(F.col("ids"), width))


class _Block:
    """One block of turn columns: the turns base + 1 to base + width of conversations that share the node ``prior``."""

    def __init__(self, convs: DataFrame, base: int, width: int):
        """convs: conv_id, prior, n_turns, shift, t1..t<width>."""
        self.base, self.width = base, width
        self.t = [f"t{j}" for j in range(1, width + 1)]
        convs = materialize(convs, "conversations")
        grouped = self._rolled(convs, F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n_turns").alias("longest"))
        self.nodes = materialize(grouped.where((F.col("level") > 0) | F.lit(base == 0)), "nodes")
        place = self.nodes.select("prior", self._key().alias("key"), F.col("conv_id").alias("node"), F.col("n_convs").alias("beside"))
        at = convs.withColumn("key", self._key()).select("conv_id", "prior", "n_turns", "shift", "key")
        self.placed = materialize(at.join(place, ["prior", "key"]).drop("prior", "key"), "places")

    def _rolled(self, frame: DataFrame, *sums: Column) -> DataFrame:
        """ROLLUP over the prior node and the turn columns, without groups that go beyond the end of a conversation."""
        rolled = frame.rollup("prior", *self.t).agg(F.grouping_id().alias("g"), *sums)
        rolled = rolled.withColumn("level", F.lit(self.width) - F.bit_count("g")).drop("g")
        return rolled.where((F.col("level") == 0) | (F.col("level") > 0) & self._last().isNotNull())

    def _last(self) -> Column:
        return F.get(F.array(*self.t), F.col("level").cast("int") - 1)

    def _key(self) -> Column:
        """The turn ids end to end: a node's name below its prior one."""
        return F.concat(*(F.coalesce(t, F.lit(b"")) for t in self.t))

    def subtrees(self, deeper: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """(all nodes with what their subtrees hold, totals by prior node). deeper: totals of the next block."""
        end, own = self.base + self.width, self.nodes
        goes_on = (F.col("level") == self.width) & (F.col("longest") > end)
        alone = goes_on & (F.col("n_convs") == 1)
        if deeper is None:
            own = own.withColumns({k: F.lit(0).cast("long") for k in ("d_leaves", "d_saved", "d_children")})
        else:
            below = deeper.withColumnRenamed("prior", "conv_id").withColumn("level", F.lit(self.width))
            own = own.join(below, ["conv_id", "level"], "left")
        value = lambda name, chain: F.when(alone, chain).when(goes_on, F.coalesce(name, F.lit(0))).otherwise(0).cast("long")
        leaf = (F.col("longest") == self.base + F.col("level")).cast("long")
        saved = F.when(F.col("level") > 0, (F.col("n_convs") - 1) * _chars(self._last())).otherwise(0)
        own = own.select("prior", *self.t, "conv_id", "n_convs", F.col("level").alias("at"), (leaf + value("d_leaves", 1)).alias("leaves"), (saved + value("d_saved", 0)).alias("saved"), value("d_children", 1).alias("children"))
        # the top of a subtree has its smallest member and its most members
        sums = [F.min("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max(F.when(F.col("at") == self.width, F.col("children"))).alias("below")]
        sums += [F.sum((F.col("at") == j).cast("long")).alias(f"n{j}") for j in range(1, self.width + 1)]
        children = F.when(F.col("level") == self.width, F.col("below")).otherwise(F.get(F.array(*(f"n{j}" for j in range(1, self.width + 1))), F.col("level").cast("int")))
        found = self._rolled(own, *sums).select("prior", "level", self._key().alias("key"), "conv_id", "n_convs", children.alias("n_children"), "n_leaves", "saved_tokens")
        found = materialize(found, "subtrees")
        totals = found.where("level = 0").select("prior", F.col("n_leaves").alias("d_leaves"), F.col("saved_tokens").alias("d_saved"), F.col("n_children").alias("d_children"))
        return found, totals

    def rows(self, found: DataFrame) -> DataFrame:
        """The block's nodes with their parents."""
        parents = found.select("prior", F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
        nodes = found.where((F.col("level") > 0) | F.lit(self.base == 0))
        above = F.when(F.col("level") > 0, F.substring("key", F.lit(1), (ID * (F.col("level") - 1)).cast("int")))
        nodes = nodes.withColumn("above", above).join(parents, ["prior", "above"], "left")
        if self.base:  # members of the prior node that ended there are not in this block
            nodes = nodes.withColumn("parent_conv_id", F.when(F.col("level") == 1, F.col("prior")).otherwise(F.col("parent_conv_id")))
        return nodes.select("conv_id", (self.base + F.col("level")).cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, depth, sha256) of rows (conv_id, depth, ids) sorted by node: the texts of a node are hashed one after another."""
    now, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([total.hexdigest()])], names=["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        out = []
        for node, depth, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (node, depth) != now:
                if now is not None:
                    out.append(row())
                now, total = (node, depth), hashlib.sha256()
            else:
                total.update(b",")
            total.update(ids.encode())
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if now is not None:
        yield row()


def _ends(ends: DataFrame) -> DataFrame:
    """conv_id, depth and the hash of the members that end there. ends: node, depth, conv_id."""
    some = ends.groupBy("node", "depth", F.shiftright("conv_id", 8).alias("bucket")).agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))
    dealt = some.repartition(partitions(ends.sparkSession), "node", "depth").sortWithinPartitions("node", "depth", "bucket")
    return dealt.select("node", "depth", "ids").mapInArrow(_digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, exchange: tuple[int, int] | None = None, width: int = WIDTH, deep: int = DEEP) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    ``exchange`` = (every, most) first gives conversations common beginnings (``exchanged``)."""
    turns = materialize(numbered_turns(conversations), "places")
    convs = exchanged(turns, *exchange, width) if exchange else as_they_are(turns, width)
    block = _Block(convs.withColumn("prior", F.lit(0).cast("long")), 0, width)
    blocks, ends, chains = [block], [], []
    while True:
        to = block.base + block.width
        ends.append(block.placed.where(F.col("n_turns") <= to).select("node", F.col("n_turns").alias("depth"), "conv_id"))
        more = block.placed.where(F.col("n_turns") > to).select("conv_id", F.col("node").alias("prior"), "n_turns", "shift", "beside", F.lit(to).alias("base"))
        chains.append(more.where("beside = 1").drop("beside", "prior"))
        going = more.where("beside > 1").drop("beside", "base")
        if going.isEmpty():
            break
        part = turns.where((F.col("place") > to) & (F.col("place") <= to + deep + (exchange[1] if exchange else 0))).join(going, "conv_id")
        part = part.where((F.col("place") - F.col("shift") > to) & (F.col("place") - F.col("shift") <= to + deep))
        listed = _listed(part, ["conv_id", "prior", "n_turns", "shift"], F.lit(True))
        block = _Block(listed.select("conv_id", "prior", "n_turns", "shift", *_columns(F.col("ids"), deep)), to, deep)
        blocks.append(block)
    rows, deeper = [], None
    for block in reversed(blocks):
        found, deeper = block.subtrees(deeper)
        rows.append(block.rows(found))
    together = lambda frames: reduce(DataFrame.unionByName, frames)
    ended = together(rows).join(_ends(together(ends)), ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)))
    return ended.unionByName(_chains(turns, together(chains)))


def _chains(turns: DataFrame, chains: DataFrame) -> DataFrame:
    """The nodes below the last block of conversations that are alone there."""
    depth = F.col("place") - F.col("shift")
    last = depth == F.col("n_turns")
    own = turns.join(chains, "conv_id").where(depth > F.col("base"))
    one = F.lit(1).cast("long")
    return own.select("conv_id", depth.cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.sha2(F.when(last, F.col("conv_id").cast("string").cast("binary")).otherwise(F.lit(b"")), 256).alias("ends_sha256"))
