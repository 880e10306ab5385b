"""A quality classifier: a linear support vector machine on n-gram indicators scaled by Naive Bayes log-count ratios.

Indicators: byte pairs, hashed byte triples, and ranges of the shares of words in repeated 8-word windows, of repeated
lines and of words equal to the one before, and of the number of words. r = log of the ratio of an indicator's smoothed
shares in the classes; the hinge loss of r-scaled indicators is minimised by dual coordinate descent. A logistic link fitted on labelled rows that the
machine has not seen turns margins into scores from 0 to 1.

The model is fitted in one task on at most ``SAMPLE`` labelled rows, those with the smallest hash of doc_id; that bound
and the fixed number of indicators bound its memory, the model (about a megabyte) is all that passes through the driver.
Scoring reads every whole text once, map-only.

Defined results: null and empty texts get the score of a text without n-grams; without rows of both labels every score
is the share of label 1 in the sample (0.5 without rows); labels other than 0 and 1 and null keys are no training rows; of
contradicting labels of a key 1 counts; of rows of one doc_id one teaches, all are scored; long texts are read whole; a
score at the threshold is predicted as 1; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotframe.llm import _text
from lotframe.llm.quality_rules import _measure

SAMPLE = 8000
PAIRS, TRIPLES = 1 << 16, 1 << 16
EDGES = (np.array([0.001, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7, 0.9]), np.array([0.001, 0.1, 0.2, 0.3, 0.5, 0.7]), np.array([1, 3, 8, 20, 50, 100, 300, 1000, 3000]), np.array([0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6]))
SIZE = PAIRS + TRIPLES + sum(len(e) + 1 for e in EDGES)
DOCS_AT_ONCE = 64


def _stutter(chunk: _text.Chunk) -> np.ndarray:
    """Words that equal the word before them, for each document."""
    w = _text.words(chunk)
    h, doc = _text.span_hash(chunk.prefix(), w.starts, w.ends), w.doc
    return np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=chunk.n)


def indicators(chunk: _text.Chunk):
    """(documents, boolean matrix of their indicators), a few documents at a time."""
    m = _measure(chunk, 8)
    extra, base = [], PAIRS + TRIPLES
    for edges, value in zip(EDGES, (m[4] / np.maximum(m[0], 1), m[3] / np.maximum(m[5], 1), m[0], _stutter(chunk) / np.maximum(m[0], 1)), strict=True):
        extra.append(base + np.searchsorted(edges, value, side="right"))
        base += len(edges) + 1
    data, offsets = chunk.data.astype(np.uint32), chunk.offsets
    doc = np.repeat(np.arange(chunk.n), np.diff(offsets))
    pair = data[:-1] << np.uint32(8) | data[1:]
    triple = (((pair[:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)) >> np.uint32(16)) + np.uint32(PAIRS)
    for a in range(0, chunk.n, DOCS_AT_ONCE):
        b = min(a + DOCS_AT_ONCE, chunk.n)
        flags = np.zeros((b - a, SIZE), bool)
        lo, hi = offsets[a], offsets[b]
        flat = flags.reshape(-1)
        for codes, k in ((pair, 1), (triple, 2)):
            end = max(lo, hi - k)
            same = doc[lo:end] == doc[lo + k : end + k]
            flat[(doc[lo:end][same] - a) * SIZE + codes[lo:end][same]] = True
        for e in extra:
            flags[np.arange(b - a), e[a:b]] = True
        yield slice(a, b), flags


def fit(rows: list[np.ndarray], y: np.ndarray, penalty: float = 0.02, epochs: int = 12, alpha: float = 1.0) -> tuple[np.ndarray, float, float]:
    """(weights of the indicators, slope, intercept): score = logistic(slope * margin + intercept)."""
    share = float(np.mean(y)) if len(y) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 1e-4), 1 - 1e-4)
        return np.zeros(SIZE, np.float32), 0.0, float(np.log(share / (1 - share)))
    rng = np.random.default_rng(0)
    held = rng.random(len(y)) < 0.25
    if min(np.sum(y[~held] == 1), np.sum(y[~held] == 0), np.sum(y[held] == 1), np.sum(y[held] == 0)) == 0:
        held[:] = False
    learn = np.flatnonzero(~held)
    count = np.full((2, SIZE), alpha)
    for i in learn:
        count[int(y[i]), rows[i]] += 1
    r = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    w, bias, dual = np.zeros(SIZE), 0.0, np.zeros(len(y))
    sign = np.where(y == 1, 1.0, -1.0)
    # each row in the unit ball; the rarer class weighs as much as the other
    norm = np.array([1 / np.sqrt(np.square(r[x]).sum() + 1) for x in rows])
    upper = penalty * len(y) / (2 * np.where(y == 1, share, 1 - share) * len(y)) * 50
    for _ in range(epochs):
        for i in rng.permutation(learn):
            x = rows[i]
            rx = r[x] * norm[i]
            gradient = sign[i] * (w[x] @ rx + bias * norm[i]) - 1
            step = min(max(dual[i] - gradient, 0.0), upper[i]) - dual[i]  # rows have unit length
            if step:
                dual[i] += step
                w[x] += step * sign[i] * rx
                bias += step * sign[i] * norm[i]
    weights = w * r
    look = np.flatnonzero(held) if held.any() else learn
    margin = np.array([(weights[rows[i]].sum() + bias) * norm[i] for i in look])
    slope, intercept = _logistic(margin, y[look].astype(float))
    return np.append(np.stack([weights, np.square(r)]).ravel(), bias).astype(np.float32), slope, intercept


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's link, by Newton's method on smoothed targets."""
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    theta, x = np.zeros(2), np.stack([m, np.ones_like(m)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-6 * theta)
        theta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def scores(flags: np.ndarray, model: tuple[np.ndarray, float, float]) -> np.ndarray:
    table, slope, intercept = model
    if len(table) == SIZE:
        margin = np.zeros(len(flags))
    else:
        weights, squares, bias = table[:SIZE].astype(np.float32), table[SIZE : 2 * SIZE], table[-1]
        x = flags.astype(np.float32)
        margin = (x @ weights + bias) / np.sqrt(x @ squares + 1)
    return 1 / (1 + np.exp(-np.clip(slope * margin.astype(np.float64) + intercept, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> tuple[np.ndarray, float, float]:
    """Fits on labelled rows; both frames have doc_id, ``docs`` has text. Held-out rows must be taken out before."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def features(batches):
        for batch in batches:
            found = [None] * batch.num_rows
            for chunk in _text.chunks(batch.column(1)):
                for part, flags in indicators(chunk):
                    for i in range(part.start, part.stop):
                        found[chunk.rows.start + i] = np.flatnonzero(flags[i - part.start]).astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "y", "x"])

    def learn(pdf):
        pdf = pdf.sort_values("doc_id")
        table, slope, intercept = fit([np.frombuffer(x, np.int32) for x in pdf["x"]], pdf["y"].to_numpy())
        return pd.DataFrame({"table": [table.tobytes()], "slope": [slope], "intercept": [intercept]})

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")  # at most ``sample`` keys
    # of rows of one doc_id that of the least indicators teaches; repeats are combined where they are read
    rows = rows.mapInArrow(features, "doc_id long, y int, x binary").groupBy("doc_id", "y").agg(F.min("x").alias("x"))
    found = rows.groupBy().applyInPandas(learn, "table binary, slope double, intercept double").first()
    if found is None:
        return fit([], np.zeros(0))
    return np.frombuffer(found["table"], np.float32), found["slope"], found["intercept"]


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, one row a document. Rows of fold 0 of crc32(doc_id) are never learned from."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels.where(~held), sample))

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for chunk in _text.chunks(batch.column(1)):
                for part, flags in indicators(chunk):
                    out[chunk.rows.start + part.start : chunk.rows.start + part.stop] = scores(flags, model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
