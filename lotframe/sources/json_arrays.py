"""Large JSON arrays, read by byte ranges.

A file that holds one array has no lines to split at, but its objects end in ``}``. Spark's text source with that
separator reads a file by ranges, as many tasks as it has splits, and gives fragments between two such signs. Whether a
sign ends a record depends on what stands before it: is it inside a string, and how deep? So a first pass sums up each
range: the parity of its quotes, and by how much it changes the depth if it begins outside a string or inside one. A prefix
sum over these few rows (one a range) gives the state in which every range begins. A second pass, beginning in that
state, cuts each range into segments: what follows the last end of a top-level object up to the next. Segments that cross
a border of ranges are joined by their pieces, two a range at most. Each segment is parsed by itself, and positions are
again a prefix sum over ranges.

A file counts only as a whole: if any of its segments is no list of JSON values, or its brackets do not close, it is no
array. Bytes that are no UTF-8 are read as replacement characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotframe.sources.shared import fresh_path, written

RANGE = ["path", "start"]
_ESCAPE = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],]', re.S)
#: Characters of segments in one Arrow batch, about.
_BATCH = 4 << 20


def _change(fragment: str, closed: bool) -> tuple[int, int, int]:
    """(parity of quotes, change of depth if it begins outside a string, and if inside) of a fragment and the sign behind it."""
    parts = (_ESCAPE.sub("", fragment) if "\\" in fragment else fragment).split('"')
    odd = 1 - len(parts) % 2
    change = [sum(p.count("{") + p.count("[") - p.count("]") for p in parts[k::2]) for k in (0, 1)]
    change[odd] -= closed
    return odd, *change


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, odd, outside, inside): the change of each range, as if the sign stood behind all of its fragments."""
    now, total, out = None, (0, 0, 0), []
    for batch in batches:
        for path, start, fragment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (path, start) != now:
                if now is not None:
                    out.append((*now, *total))
                now, total = (path, start), (0, 0, 0)
            odd, *change = _change(fragment or "", True)
            total = total[0] ^ odd, total[1] + change[total[0]], total[2] + change[1 - total[0]]
    if now is not None:
        out.append((*now, *total))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["path", "start", "odd", "outside", "inside"])


def _items(text: str) -> int:
    """How many values a segment holds, a comma before them not counted."""
    body = text.strip()
    if body[:1] == ",":
        body = body[1:].lstrip()
    if not body:
        return 0
    depth, n, first = 0, 1, True
    for m in _TOKEN.finditer(body):
        c = m[0][0]
        if first and c == "{":  # it ends with this object
            return 1
        first = False
        depth += (c in "{[") - (c in "}]")
        n += c == "," and depth == 0
    return n


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (path, start, no, closed, text, n, at) of ranges; n values, at values of the range before it. Piece 0 may go on
    from an earlier range, and the one that is not closed may go on in a later one; of these n is 0."""
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["path", "start", "no", "closed", "text", "n", "at"])
        out.clear()
        return made

    now, parts, size = None, [], 0
    inside = depth = no = at = 0
    for rows in batches:
        for path, start, fragment, in_string, begins in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if (path, start) != now:
                if now is not None:
                    out.append((*now, no, False, "".join(parts), 0, at))
                now, parts, no, at, inside, depth = (path, start), [], 0, 0, in_string, begins
            change = _change(fragment or "", True)
            depth += change[1 + inside]
            inside ^= change[0]
            parts.append(f"{fragment or ''}}}")
            size += len(parts[-1])
            if not inside and depth == 1:
                text = "".join(parts)
                n = _items(text) if no else 0
                out.append((*now, no, True, text, n, at))
                parts, no, at = [], no + 1, at + n
            if size > _BATCH and out:
                yield batch()
                size = 0
    if now is not None:
        out.append((*now, no, False, "".join(parts), 0, at))
        yield batch()


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def _without(sign: str, text: Column, end: bool = False) -> Column:
    """The text without its first or last sign; null if that is another."""
    there = F.endswith(text, F.lit(sign)) if end else F.startswith(text, F.lit(sign))
    return F.when(there, _stripped(F.substring(text, F.lit(1 if end else 2), F.length(text) - 1)))


def _segments(pieces: DataFrame, groups: DataFrame) -> DataFrame:
    """(path, start, at, body) of all segments: the values between the brackets of the array and the commas of segments, as
    text, null if these are not where they should be. start: the range in which a segment ends, null for the end of the file;
    at: -1 for a segment that began in an earlier range."""
    touching = pieces.where("no = 0 OR NOT closed").join(groups, RANGE)
    group = F.col("group") + F.when((F.col("no") > 0) & ~F.col("closed"), 1).otherwise(0)
    joined = touching.groupBy("path", group.alias("group")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "no", "text"))), lambda p: p["text"]), "").alias("text"),
        F.max(F.when(F.col("closed"), F.col("start"))).alias("start"),
    )
    first, last = F.col("group") == 0, F.col("start").isNull()
    text = _stripped(F.col("text"))
    text = F.when(last, _without("]", _stripped(F.substring(text, F.lit(1), F.length(text) - 1)), True)).otherwise(text)  # without the sign that is not there
    text = F.when(first, _without("[", text)).otherwise(text)
    joined = joined.select("path", "start", F.lit(-1).cast("long").alias("at"), F.when(first | last & (text == ""), text).otherwise(_values(text)).alias("body"))
    inner = pieces.where("no > 0 AND closed").select("path", "start", "at", _values(_stripped(F.col("text"))).alias("body"))
    return inner.unionByName(joined)


def _values(text: Column) -> Column:
    """The values of a segment that stands behind another: there are some, and a comma before them."""
    return F.nullif(_without(",", text), F.lit(""))


def read_arrays(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(path, _pos, record) of the values of all files that hold one array, and (path, is_array) of all files that are not
    empty. Both tables have paths as ``_metadata.file_path`` gives them."""
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(paths).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), "value", meta["file_size"].alias("file_size"))
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # what the ranges hold, and the state in which each begins
    sizes = rows.groupBy(*RANGE).agg(F.sum(F.octet_length("value") + 1).alias("bytes"), F.first("file_size").alias("file_size"))
    rows = rows.withColumn("value", F.make_valid_utf8("value"))
    ranges = rows.select(*RANGE, "value").mapInArrow(_summary, "path string, start long, odd int, outside long, inside long").join(sizes, RANGE)
    ranges = ranges.withColumn("in_string", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    ranges = ranges.withColumn("change", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside")))
    ranges = written(ranges.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0))), fresh_path(spark, "ranges"))
    placed = rows.drop("file_size").join(F.broadcast(ranges.select(*RANGE, "in_string", "depth")), RANGE)  # one row a range
    pieces = placed.select(*RANGE, "value", "in_string", "depth").mapInArrow(_pieces, "path string, start long, no long, closed boolean, text string, n long, at long")
    pieces = written(pieces, fresh_path(spark, "pieces"))
    # segments that cross borders: ranges without an end go on
    ends = pieces.groupBy(*RANGE).agg(F.max("closed").cast("int").alias("ends"), F.sum("n").alias("n"))
    ends = ends.withColumn("group", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    parsed = F.expr("try_cast(try_parse_json(concat('[', body, ']')) AS array<variant>)")
    segments = _segments(pieces, ends.select(*RANGE, "group")).withColumn("values", parsed)
    segments = written(segments.select("path", "start", "at", "body", F.size("values").alias("m"), F.col("values").isNotNull().alias("sound")), fresh_path(spark, "segments"))
    # behind the last fragment the sign is not there: one byte too many (a byte order mark, which is not read, makes three less), one level too few
    size = ranges.groupBy("path").agg(F.sum("change").alias("depth"), (F.sum("odd") % 2).alias("odd"), (F.sum("bytes") - F.max("file_size")).alias("over"))
    sound = segments.groupBy("path").agg(F.min("sound").alias("sound"))
    files = size.join(sound, "path").select("path", (F.col("sound") & (F.col("depth") == -1) & (F.col("odd") == 0) & F.col("over").isin(1, -2)).alias("is_array"))
    # positions: values of earlier ranges, of the segment that ends in this one, of its own
    crossing = segments.where("at < 0 AND start IS NOT NULL").select(*RANGE, F.col("m").alias("crossing"))
    totals = ends.select(*RANGE, "n").join(crossing, RANGE, "left").withColumn("all", F.col("n") + F.coalesce("crossing", F.lit(0)))
    ahead = totals.select(*RANGE, F.coalesce(F.sum("all").over(before), F.lit(0)).alias("ahead"), F.coalesce("crossing", F.lit(0)).alias("crossing"))
    full = totals.groupBy("path").agg(F.sum("all").alias("full"))
    kept = segments.where("m > 0").join(F.broadcast(files.where("is_array").select("path")), "path")
    mine = kept.join(F.broadcast(ahead), RANGE).withColumn("base", F.col("ahead") + F.when(F.col("at") < 0, 0).otherwise(F.col("at") + F.col("crossing")))
    last = kept.where("start IS NULL").join(F.broadcast(full), "path").withColumn("base", F.col("full"))
    both = mine.select("path", "base", "body").unionByName(last.select("path", "base", "body"))
    found = both.select("path", "base", F.posexplode(parsed).alias("k", "record"))
    return found.select("path", (F.col("base") + F.col("k")).alias("_pos"), "record"), files
