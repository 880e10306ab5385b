"""Near-duplicate documents: MinHash bands find candidates, odd sketches sift them, full sets confirm them.

1. ``signatures``: a map over whole texts gives the set size, a 128-bit fingerprint of the shingle set, the hashes of
   the MinHash bands, and two odd sketches. A sketch folds bottom MinHash samples, the shingles of smallest hash, into a
   bitmap: each flips one bit. All shingles are samples in a set of up to ``SAMPLES``; in larger ones those below a bound
   that halves with each doubling of the size, so that the samples of two sets can be compared. The bits in which two
   sketches differ count the samples that only one set has, exactly for sets without a bound and with small error for
   others. The second sketch has half the bound, for sets on both sides of a doubling. (One sample from each of 1024
   ranges of hashes was tried and is too coarse: on groups of near copies it let so many pairs through that confirmed
   pairs grew with the square of the group.)
2. Documents of equal sets form a class; its smallest doc_id stands for it from here on, so copies cost nothing more.
3. Representatives meet in band buckets. A bucket above ``BLOCK`` members is dealt into blocks, and each pair of blocks
   is a group of its own. Groups of the same members are one. In a group, pairs whose sketches differ by more than chance
   allows at the threshold (``SIGMAS`` standard deviations) are out. Of the others each document names the partners that
   have most partners themselves, ``FIRST`` in the first round and eight times as many more in each later one; after the first
   round only partners of another component count. The rounds end when no group has such a partner left, so all
   candidates are covered without listing all pairs.
4. Named pairs are confirmed on the full sets, which are computed again from the texts of the documents concerned.
   Components are smallest labels, spread along links with pointer jumping.

The number of bands makes a linked pair share one with a probability of at least ``1 - MISS``.

Defined results: null and empty texts have no shingles, a set size of 0, and are linked with nothing; a text of fewer
words than a shingle has one shingle, the whole; long texts count whole; rows with a null key are linked with nothing and
not kept; repeated rows each get the same result; rows of one doc_id with different texts are versions of one document,
which is linked to what any of them is linked to, and each row has its own set size; sets whose similarity equals the
threshold are linked; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotframe.llm import _text
from lotframe.llm._store import materialize, partitions
from lotframe.llm.repeats import _opened, _squeeze

ROWS = 4
MISS = 1e-7
#: Bits of a sketch, and the most samples that are folded into it, about.
BITS = 1024
SAMPLES = 2048
SIGMAS = 5.0
BLOCK = 2048
FIRST = 1


def bands_for(threshold: float, rows: int = ROWS) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**rows))


def _level(n: np.ndarray) -> np.ndarray:
    """How often the bound on hashes is halved in the first sketch of a set of n shingles."""
    return np.maximum(np.ceil(np.log2(np.maximum(n, 1) / SAMPLES)), 0).astype(np.int64)


def _sketches(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The two odd sketches of each document, as bytes: its bottom samples, each flipping the bit that its hash names."""
    place = _text.mix(h + np.uint64(0x8CB92BA72F3D8DD7))
    bit = (place >> np.uint64(54)).astype(np.int64)  # BITS places
    level = _level(n)[doc]
    out = []
    for extra in (0, 1):
        below = (h >> (np.uint64(64) - np.minimum(level + extra, 63).astype(np.uint64))) == 0
        below |= level + extra == 0
        flips = np.bincount(doc[below] * BITS + bit[below], minlength=len(n) * BITS) & 1
        out.append(np.packbits(flips.astype(bool).reshape(len(n), BITS), axis=1))
    return np.concatenate(out, axis=1)


def _signatures(chunk: _text.Chunk, k: int, bands: int) -> tuple[np.ndarray, ...]:
    """Set sizes, fingerprints, band hashes (documents x bands) and sketches (documents x bytes)."""
    doc, h = _text.shingles(chunk, k)
    n = np.bincount(doc, minlength=chunk.n)
    out1, out2 = np.zeros(chunk.n, np.uint64), np.zeros(chunk.n, np.uint64)
    band = np.zeros((chunk.n, bands), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        head = (np.cumsum(n) - n)[full]
        out1[full] = np.add.reduceat(_text.mix(h), head)
        out2[full] = np.bitwise_xor.reduceat(_text.mix(h + np.uint64(0xA0761D6478BD642F)), head)
        seeds = _text.mix(np.arange(1, 2 * bands * ROWS + 1, dtype=np.uint64))
        scratch = np.empty_like(h)
        for b in range(bands):
            mixed = np.full(len(full), np.uint64(b), np.uint64)
            for r in range(ROWS):
                i = b * ROWS + r
                np.bitwise_xor(h, seeds[2 * i], out=scratch)
                np.multiply(scratch, seeds[2 * i + 1] | np.uint64(1), out=scratch)
                mixed = _text.mix(mixed * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(scratch, head))
            band[full, b] = mixed
    sketch = np.concatenate([_sketches(doc[x:y] - a, h[x:y], n[a:c]) for a, c, x, y in _parts(doc, chunk.n)]) if chunk.n else np.zeros((0, BITS // 4), np.uint8)
    return n, out1.view(np.int64), out2.view(np.int64), band.view(np.int64), sketch


def _parts(doc: np.ndarray, n: int, size: int = 512):
    """(first document, end, first shingle, end) of slices of documents."""
    for a in range(0, n, size):
        c = min(a + size, n)
        x, y = np.searchsorted(doc, (a, c))
        yield a, c, x, y


def signatures(docs: DataFrame, k: int, bands: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column(1), lower=True):
                n, f1, f2, band, sketch = _signatures(chunk, k, bands)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, bands, dtype=np.int32)), pa.array(band.ravel()))
                bits = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 4), chunk.n, [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[chunk.rows], pa.array(n), pa.array(f1), pa.array(f2), lists, bits], ["doc_id", "n", "f1", "f2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, f1 long, f2 long, bands array<long>, sketch binary")


def _limits(n: np.ndarray, m: np.ndarray, level: int, threshold: float) -> np.ndarray:
    """The most bits in which sketches of linked sets of n and m shingles differ, but for chance."""
    sampled = (n + m) * (1 - threshold) / (1 + threshold) * 0.5**level
    if level:
        sampled = sampled + SIGMAS * np.sqrt(sampled)
    # the parities of d flips over BITS places: at most d are odd; mean and variance are those of d balls in BITS bins
    one, two = (1 - 2 / BITS) ** sampled, (1 - 4 / BITS) ** sampled
    spread = np.sqrt(np.maximum(BITS + BITS * (BITS - 1) * two - (BITS * one) ** 2, 0)) / 2
    return np.minimum(BITS * (1 - one) / 2 + SIGMAS * spread, sampled) + 1e-6


def _fits(sizes: np.ndarray, bits: np.ndarray, threshold: float) -> np.ndarray:
    """Which members of a group may be linked, as a matrix."""
    m = len(sizes)
    out = np.zeros((m, m), bool)
    level, half = _level(sizes), bits.shape[1] // 2
    for at in np.unique(level):
        own, lower = np.flatnonzero(level == at), np.flatnonzero(level == at - 1)
        some = np.concatenate([own, lower])
        sketch = np.concatenate([bits[own, :half], bits[lower, half:]])
        for a in range(0, len(own), 256):
            row = own[a : a + 256]
            differ = np.zeros((len(row), len(some)), np.int32)
            for w in range(half):
                differ += np.bitwise_count(sketch[a : a + len(row), w, None] ^ sketch[None, :, w])
            x, y = sizes[row][:, None].astype(float), sizes[some][None].astype(float)
            near = (np.minimum(x, y) >= threshold * np.maximum(x, y) - 1e-9) & (differ <= _limits(x, y, int(at), threshold))
            out[np.ix_(row, some)] |= near
            out[np.ix_(some, row)] |= near.T
    return out


def _partners(ids: np.ndarray, fits: np.ndarray, comp: np.ndarray, lo: int, hi: int):
    """(u, v) pairs named in a group, and whether partners are left for later rounds. Members stand in order of doc_id."""
    fits = fits & (ids[:, None] != ids[None, :])
    number = fits.sum(1)
    hubs = np.argsort(-number, kind="stable")  # those with most partners first
    us, vs, left = [], [], False
    for i in np.flatnonzero(number > lo):
        at = hubs[fits[i, hubs]]
        chosen = at[lo:hi]
        chosen = chosen[comp[chosen] != comp[i]]
        us.append(np.full(len(chosen), ids[i]))
        vs.append(ids[chosen])
        left = left or bool((comp[at[hi:]] != comp[i]).any())
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    return np.minimum(u, v), np.maximum(u, v), left


def _whole(batches):
    """(table, edges of its groups) of whole groups (g1, g2): the last group of a batch waits for the next batch."""
    rest: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        g1, g2 = (table.column(c).to_numpy() for c in ("g1", "g2"))
        new = np.flatnonzero((g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])) + 1
        if rest and (rest[-1].column("g1")[0].as_py(), rest[-1].column("g2")[0].as_py()) != (g1[0], g2[0]):
            new = np.append(0, new)
        if not len(new):
            rest.append(table)
            continue
        ready = pa.concat_tables([*rest, table.slice(0, new[-1])])
        rest = [table.slice(new[-1])]
        if ready.num_rows:
            yield ready.combine_chunks(), _edges(ready)
    if rest:
        ready = pa.concat_tables(rest)
        yield ready.combine_chunks(), _edges(ready)
    _text.release()


def _edges(table: pa.Table) -> np.ndarray:
    g1, g2 = (table.column(c).to_numpy() for c in ("g1", "g2"))
    return np.concatenate([[0], np.flatnonzero((g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])) + 1, [len(g1)]])


PAIR_ROWS = "u long, v long, g1 long, g2 long, doc_id long, n long, sketch binary"


def _named(groups: DataFrame, lo: int, hi: int, threshold: float) -> DataFrame:
    """Rows (u, v) of named pairs, and all rows of the groups that have partners left. groups: g1, g2, doc_id, n, sketch, comp."""

    def run(batches):
        for table, edges in _whole(batches):
            ids, sizes, comp = (table.column(c).to_numpy() for c in ("doc_id", "n", "comp"))
            us, vs, kept = [], [], []
            for a, b in zip(edges, edges[1:], strict=False):
                if (comp[a:b] == comp[a]).all():
                    continue
                bits = np.frombuffer(b"".join(table.column("sketch").slice(a, b - a).to_pylist()), np.uint64).reshape(b - a, -1)
                u, v, left = _partners(ids[a:b], _fits(sizes[a:b], bits, threshold), comp[a:b], lo, hi)
                us.append(u)
                vs.append(v)
                if left:
                    kept.append(table.slice(a, b - a))
            pair = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)], 1), axis=0) if us else np.zeros((0, 2), np.int64)
            if len(pair):
                none = [pa.nulls(len(pair), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), *none], ["u", "v", "g1", "g2", "doc_id", "n", "sketch"])
            for t in kept:
                columns = [t.column(c).combine_chunks() for c in ("g1", "g2", "doc_id", "n", "sketch")]
                yield pa.RecordBatch.from_arrays([pa.nulls(t.num_rows, pa.int64()), pa.nulls(t.num_rows, pa.int64()), *columns], ["u", "v", "g1", "g2", "doc_id", "n", "sketch"])

    n = partitions(groups.sparkSession)
    dealt = groups.select("g1", "g2", "doc_id", "n", "sketch", "comp").repartition(n, "g1", "g2").sortWithinPartitions("g1", "g2", "doc_id")
    return dealt.mapInArrow(run, PAIR_ROWS)


def _groups(reps: DataFrame) -> DataFrame:
    """(g1, g2, doc_id): distinct groups of two or more representatives that share a band. A bucket above BLOCK members
    makes one group for each pair of its blocks."""
    rows = reps.select("doc_id", F.explode("bands").alias("g1"))
    hot = rows.groupBy("g1").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK).select("g1", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = rows.join(hot, "g1", "left").withColumn("own", F.coalesce(own, F.lit(0))).select("*", other.alias("other"))
    dealt = dealt.withColumn("g2", (F.least("own", "other") * F.coalesce("blocks", F.lit(1)) + F.greatest("own", "other")).cast("long")).select("g1", "g2", "doc_id")

    def distinct(batches):
        seen: set = set()
        for table, edges in _whole(batches):
            ids = table.column("doc_id").to_numpy()
            size = np.diff(edges)
            h = _text.mix(ids.view(np.uint64))
            a = np.add.reduceat(h, edges[:-1]).view(np.int64)
            b = np.bitwise_xor.reduceat(_text.mix(h + np.uint64(1)), edges[:-1]).view(np.int64)
            take = [i for i in np.flatnonzero(size > 1) if (a[i], b[i]) not in seen and not seen.add((a[i], b[i]))]
            if len(seen) > 1_000_000:
                seen.clear()
            if take:
                at = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in take])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(a[take], size[take])), pa.array(np.repeat(b[take], size[take])), pa.array(ids[at])], ["g1", "g2", "doc_id"])

    n = partitions(reps.sparkSession)
    found = dealt.repartition(n, "g1", "g2").sortWithinPartitions("g1", "g2", "doc_id").mapInArrow(distinct, "g1 long, g2 long, doc_id long")
    return found.distinct()


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, s): the sorted shingle hashes of the documents named, one row a version. Texts travel compressed, once."""

    def run(batches):
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 256):
                texts = pa.array(_opened(batch.column(1).slice(at, 256)), pa.binary()).cast(pa.large_string())
                for chunk in _text.chunks(texts, lower=True):
                    doc, h = _text.shingles(chunk, k)
                    edge = np.searchsorted(doc, np.arange(chunk.n + 1))
                    found += [h[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "s"])

    texts = _squeeze(docs.where("doc_id is not null")).join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "z"])
    return materialize(texts.select("doc_id", "z").mapInArrow(run, "id long, s binary"), "sets")


def _confirm(sets: DataFrame, pairs: DataFrame, hundredths: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= hundredths * union."""

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= hundredths * (len(a) + len(b) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        _text.release()

    left = pairs.join(sets.select(F.col("id").alias("u"), F.col("s").alias("a")), "u")
    return left.join(sets.select(F.col("id").alias("v"), F.col("s").alias("b")), "v").select("u", "v", "a", "b").mapInArrow(linked, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id that each id of the links (u, v) reaches."""
    both = materialize(links.select("u", "v").union(links.select("v", "u")).distinct(), "links")
    files = both.count() // 200_000 + 1  # links are few; so are the files that each round writes
    edges = both.select("u", "v")
    labels = materialize(edges.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("id")).alias("comp")).coalesce(files), "labels")
    total = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        near = edges.join(labels.select(F.col("id").alias("v"), "comp"), "v").select(F.col("u").alias("id"), "comp").union(labels)
        near = near.groupBy("id").agg(F.min("comp").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        labels = materialize(near.join(jump, "comp").select("id", F.least("comp", "further").alias("comp")).coalesce(files), "labels")
        before, total = total, labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if total == before:
            break
    return labels


def _versions(full: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): classes that rows of one doc_id are in, linked to the first of them."""
    own = full.groupBy("doc_id").agg(F.collect_set(F.struct("f1", "f2", "n")).alias("sets")).where(F.size("sets") > 1)
    found = own.select("doc_id", F.explode("sets").alias("set")).select("doc_id", "set.*").join(classes, ["f1", "f2", "n"])
    first = found.groupBy("doc_id").agg(F.min("class_id").alias("u"))
    return found.join(first, "doc_id").where("u <> class_id").select("u", F.col("class_id").alias("v"))


def near_duplicates(docs: DataFrame, k: int = 3, hundredths: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id (the smallest doc_id of an equal set), one row a document."""
    threshold = hundredths / 100
    bands = bands_for(threshold)
    signed = materialize(signatures(docs, k, bands), "signatures")
    full = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    same = ["f1", "f2", "n"]
    classes = materialize(full.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")), "classes")
    # a class's representative is found by its doc_id, so that the copies of a text do not meet in one task
    mine = classes.select("class_id", *(F.col(c).alias(f"_{c}") for c in same)).withColumnRenamed("class_id", "doc_id")
    reps = full.join(mine, "doc_id").where("f1 = _f1 and f2 = _f2 and n = _n").drop("_f1", "_f2", "_n").dropDuplicates(["doc_id", *same])
    groups = _groups(reps).join(reps.select("doc_id", "n", "sketch"), "doc_id").withColumn("comp", F.col("doc_id"))
    links = materialize(_versions(full.select("doc_id", *same), classes), "versions")
    lo, hi, labels, sets = 0, FIRST, None, None
    while True:
        found = materialize(_named(groups, lo, hi, threshold), "pairs")
        pairs = found.where("u is not null").select("u", "v").distinct()
        if sets is None:  # whoever has a partner names one in the first round
            sets = _sets(docs, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), k)
        confirmed = materialize(_confirm(sets, pairs, hundredths), "confirmed")
        if labels is None or not confirmed.isEmpty():
            links = links.union(confirmed)
            labels = components(links)
        left = found.where("u is null").select("g1", "g2", "doc_id", "n", "sketch")
        if left.isEmpty():
            break
        groups = left.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
        lo, hi = hi, hi + 8 * (hi - lo)
    of_class = classes.join(labels.select(F.col("id").alias("class_id"), "comp"), "class_id", "left").select(*same, "class_id", F.coalesce("comp", "class_id").alias("comp"), "copies")
    rows = signed.select("doc_id", *same)
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("comp"), F.col("doc_id").alias("class_id"))
    others = rows.where("n > 0 and doc_id is not null")
    # classes that hold a large share of all rows are few: they are broadcast, and only the rows of others are shuffled
    least = (classes.agg(F.sum("copies")).first()[0] or 0) / (4 * partitions(docs.sparkSession))
    hot = F.broadcast(of_class.where(F.col("copies") > least).drop("copies"))
    common = others.join(hot, same).select("doc_id", "n", "comp", "class_id")
    rare = others.join(hot, same, "left_anti").join(of_class.where(F.col("copies") <= least), same).select("doc_id", "n", "comp", "class_id")
    return alone.union(common).union(rare).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("comp"), F.lit(False)).alias("kept"), "class_id"
    )
