"""Exact top-k inner products by a pivot-distance index.

Components become integers floor(scale * x). Adding the component sqrt(M^2 - |x|^2), where M is the largest norm, makes
the largest inner products the smallest distances. Every vector is keyed by its nearest pivot and its distance to it;
quantiles of a pivot's distances cut its vectors into rings, sorted annuli of about equal numbers. Of each annulus the
directory holds the least and greatest distance to its pivot and to the first ``GUIDES`` pivots. A query first visits the
annuli nearest to it until they hold enough vectors. Its k-th best score then bounds the search: by the triangle
inequality no vector of an annulus is nearer than the gap between the query's distance to any of those pivots and the
annulus, so annuli that cannot hold a score as high are never visited, and all others are. Results are exact; pivots only
decide how much is visited (``visited_share`` tells; data without clusters let little be passed over).

Queries are dealt into sets by their nearest pivot (pivots with few queries share a set), so that those of a set visit
much the same annuli. Small annuli that follow each other on one pivot travel together, as cells of about ``CHUNK`` vectors:
a query that visits one of them is sent to the cell. Work is dealt by
(cell, part of it, set of queries), each of at most about ``CHUNK`` rows, so neither a crowded annulus nor many queries
make a large task; vectors are sent only to sets of which a query visits their cell. The number of pivots grows with
the square root of the number of vectors, up to ``MOST_PIVOTS``; pivots (rows of smallest hash) and the directory
(pivots * RINGS rows at most) are all that is broadcast.

Defined results: vectors that are null or hold null or non-finite components, and rows of null vec_id, take no part; of
rows sharing a vec_id the smallest vector counts; vectors of fewer dimensions are filled with zeros, and empty ones are
zero throughout; vectors of any length count whole; ties go to the smaller vec_id; scores are exact, and those beyond the
range of a long are its ends, as are components; without vectors the result is empty; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotframe.llm._store import materialize

MOST_PIVOTS = 1024
RINGS = 16
GUIDES = 16
CHUNK = 2048
LONG = np.iinfo(np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), n)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = column.flatten().to_numpy()
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows: exact in doubles below 2 ** 53, in 64-bit integers below 2 ** 63, else in integers of
    any size, which end at those of a long."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LONG.min, LONG.max).astype(np.int64)


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    a, b = x.astype(np.float64), pivots.astype(np.float64)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T + (extra[:, None] - pivot_extra[None]) ** 2
    return np.sqrt(np.maximum(squared, 0))


class Directory:
    """Pivots, the largest squared norm, and the annuli: pivot, ring, number of vectors, and the least and greatest distance
    to the pivot and to each guide."""

    def __init__(self, pivots: np.ndarray, largest: float, annuli: pd.DataFrame):
        self.pivots, self.largest = pivots, largest
        self.extra = np.sqrt(np.maximum(largest - (pivots.astype(np.float64) ** 2).sum(1), 0))
        self.annuli, self.guides = annuli, min(GUIDES, len(pivots))

    def distances(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        extra = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.largest - (x.astype(np.float64) ** 2).sum(1), 0))
        return _distances(x, extra, self.pivots, self.extra)

    def gaps(self, q: np.ndarray) -> np.ndarray:
        """Lower bounds of the distance from each query to anything in each annulus."""
        d, t = self.distances(q, True), self.annuli
        own = d[:, t["pivot"].to_numpy()]
        out = np.maximum(np.maximum(own - t["hi"].to_numpy(), t["lo"].to_numpy() - own), 0)
        for g in range(self.guides):
            np.maximum(out, np.maximum(d[:, g, None] - t[f"hi{g}"].to_numpy(), t[f"lo{g}"].to_numpy() - d[:, g, None]), out=out)
        return out

    def highest(self, q: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, raised by more than the rounding of doubles."""
        scale = (q.astype(np.float64) ** 2).sum(1)[:, None] + self.largest
        return (scale - gaps**2) / 2 + 1e-7 * scale + 0.5

    def nearest(self, gaps: np.ndarray, enough: int) -> np.ndarray:
        """The annuli each query visits first: by gap, until they hold ``enough`` vectors."""
        order = np.argsort(gaps, axis=1, kind="stable")
        held = np.cumsum(self.annuli["n"].to_numpy()[order], axis=1)
        out = np.zeros(gaps.shape, bool)
        np.put_along_axis(out, order, np.concatenate([np.ones((len(gaps), 1), bool), held[:, :-1] < enough], axis=1), axis=1)
        return out


def pivots_for(n: int) -> int:
    return min(MOST_PIVOTS, max(16, math.isqrt(n) // 4))


class Index:
    """The index of a table of vectors: ``rows`` (vec_id, v, annulus) and the directory."""

    def __init__(self, vectors: DataFrame, scale: int, pivots: int | None, rings: int, chunk: int, id_col: str, vector_col: str):
        spark = vectors.sparkSession
        whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
        sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
        rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
        rows = materialize(rows.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
        norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        self.n, largest, dims = rows.agg(F.count("*"), F.max(norm), F.max(F.size("v"))).first()
        if not self.n:
            return
        self.dims = dims = max(dims, 1)
        some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots or pivots_for(self.n)).select("v").collect()
        rng = np.random.default_rng(0)
        chosen = np.unique(np.array([list(r[0]) + [0] * (dims - len(r[0])) for r in some], np.int64), axis=0)
        chosen = chosen[rng.permutation(len(chosen))]
        frame = spark.sparkContext.broadcast((chosen, largest, pd.DataFrame()))  # parts of a Directory, as executors may lack this module
        guides = Directory(*frame.value).guides

        def key(batches):
            d = Directory(*frame.value)
            for batch in batches:
                far = d.distances(_matrix(batch.column(1), dims))
                near = far.argmin(1).astype(np.int32) if len(far) else np.zeros(0, np.int32)
                towards = pa.FixedSizeListArray.from_arrays(pa.array(far[:, :guides].ravel()), guides).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near), pa.array(far[np.arange(len(far)), near]), towards], ["vec_id", "v", "pivot", "distance", "towards"])

        keyed = materialize(rows.mapInArrow(key, "vec_id long, v array<long>, pivot int, distance double, towards array<double>"), "index")
        cuts = keyed.groupBy("pivot").agg(F.percentile_approx("distance", [i / rings for i in range(1, rings)], 1000).alias("cuts"))
        ring = F.size(F.filter("cuts", lambda c: c < F.col("distance"))).alias("ring")
        placed = keyed.join(F.broadcast(cuts), "pivot").select("vec_id", "v", "pivot", ring, "distance", "towards")  # a row a pivot
        bounds = [f(F.col("towards")[g]).alias(f"{name}{g}") for g in range(guides) for f, name in ((F.min, "lo"), (F.max, "hi"))]
        annuli = placed.groupBy("pivot", "ring").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.count("*").alias("n"), *bounds).toPandas()
        annuli = annuli.sort_values(["pivot", "ring"], ignore_index=True)
        inside = (annuli.groupby("pivot")["n"].cumsum() - annuli["n"]) // chunk
        annuli["cell"] = pd.factorize(annuli["pivot"].astype("int64") * (1 << 40) + inside)[0]
        annuli["chunks"] = (annuli.groupby("cell")["n"].transform("sum") + chunk - 1) // chunk
        self.directory = spark.sparkContext.broadcast((chosen, largest, annuli))
        known = spark.createDataFrame(annuli[["pivot", "ring", "cell", "chunks"]].astype("int32"), "pivot int, ring int, cell int, chunks int")
        part = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("part")
        self.rows = placed.join(F.broadcast(known), ["pivot", "ring"]).select("vec_id", "v", "pivot", "cell", part)


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, pivots: int | None = None, rings: int = RINGS, chunk: int = CHUNK, id_col: str = "vec_id", vector_col: str = "embedding", visited: list | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose id is divisible by ``every``. A list
    given as ``visited`` gets the share of all (query, vector) pairs that were computed, at the cost of one more job."""
    spark = vectors.sparkSession
    index = Index(vectors, scale, pivots, rings, chunk, id_col, vector_col)
    if not index.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    directory, dims = index.directory, index.dims
    asking = index.rows.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v", "pivot")
    sets = asking.groupBy("pivot").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sets = sets.select("pivot", F.floor(before / chunk).alias("before"), F.ceil(F.col("n") / chunk).alias("sets"))  # a row a pivot
    of_set = (F.col("before") + F.pmod(F.xxhash64("query_id"), F.col("sets"))).cast("int").alias("questions")
    asking = materialize(asking.join(F.broadcast(sets), "pivot").select("query_id", "v", of_set), "questions")
    keys = ["cell", "part", "questions"]

    def visits(first: bool):
        def run(batches):
            d = Directory(*directory.value)
            for batch in batches:
                q = _matrix(batch.column(1), dims)
                gaps = d.gaps(q)
                begin = np.flatnonzero(np.diff(d.annuli["cell"].to_numpy(), prepend=-1))
                go = np.logical_or.reduceat(d.nearest(gaps, 4 * k + 1), begin, axis=1)
                if not first:
                    least = batch.column(3).fill_null(LONG.min).to_numpy(zero_copy_only=False)
                    go = ~go & np.logical_or.reduceat(d.highest(q, gaps) >= least[:, None].astype(np.float64), begin, axis=1)
                row, at = np.nonzero(go)
                parts = d.annuli["chunks"].to_numpy()[begin[at]]
                row, at = np.repeat(row, parts), np.repeat(at, parts)
                part = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in (0, 1, 2)), pa.array(at.astype(np.int32)), pa.array(part.astype(np.int32))], ["query_id", "v", "questions", "cell", "part"])

        return run

    def best(left, right):
        ids, queries = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        out: list[tuple] = []
        if len(ids) and len(queries):
            score = _products(_matrix(right.column("v"), dims), _matrix(left.column("v"), dims))
            order = np.argsort(ids)
            ids, score = ids[order], score[:, order]
            for q, row in zip(queries, score, strict=True):
                at = np.flatnonzero(ids != q)
                if len(at) > k:  # the k best and all that tie with the last
                    at = at[row[at] >= np.partition(row[at], -k)[-k]]
                at = at[np.argsort(-row[at], kind="stable")][:k]
                out += [(q, i, s) for i, s in zip(ids[at], row[at], strict=True)]
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    def search(asked: DataFrame, first: bool, name: str) -> DataFrame:
        visit = asked.mapInArrow(visits(first), "query_id long, v array<long>, questions int, cell int, part int")
        visit = materialize(visit, f"visits-{name}")
        wanted = visit.select(*(F.col(c).alias(c) for c in keys)).distinct()
        sent = index.rows.select("cell", "part", "vec_id", "v").join(wanted, ["cell", "part"])
        if visited is not None:
            sizes = spark.createDataFrame(Directory(*directory.value).annuli.groupby("cell", as_index=False)["n"].sum().astype("int64"), "cell int, n long")
            visited.append((visit.select("query_id", "cell").distinct().join(sizes, "cell").agg(F.sum("n")).first()[0] or 0) / (asking.count() * index.n))
        found = sent.groupBy(keys).cogroup(visit.groupBy(keys)).applyInArrow(best, "query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
        return materialize(ranked.where(F.col("rank") <= k), name)

    near = search(asking, True, "near")
    bound = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    far = search(asking.join(bound, "query_id", "left").select("query_id", "v", "questions", "least"), False, "far")
    both = near.union(far).select("query_id", "vec_id", "score")
    final = both.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return final.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
