"""Scores of the quality classifier by plain dictionaries and sums."""

import bisect
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotframe.llm import quality_model as q


def indicators(text):
    text = text or ""
    b, words = text.encode(), re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {b[i] << 8 | b[i + 1] for i in range(len(b) - 1)}
    found |= {q.PAIRS + ((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % (1 << 32) >> 16) for i in range(len(b) - 2)}
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    n, base = max(len(words), 1), q.PAIRS + q.TRIPLES
    for edges, value in zip(q.EDGES, (len(repeated) / n, (len(lines) - len(set(lines))) / max(len(lines), 1), len(words), stutter / n), strict=True):
        found.add(base + bisect.bisect_right(edges.tolist(), value))
        base += len(edges) + 1
    return found


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    good = lambda: " ".join(rng.choice(["river", "stone", "über", "light", "and", "the"]) for _ in range(rng.randint(5, 60)))
    bad = lambda: " ".join([rng.choice(["BUY", "now!!", "$$$", "click", "the"])] * rng.randint(2, 5) + [rng.choice(["BUY", "x"]) for _ in range(30)])
    rows = {i: (good() if i % 2 else bad()) + rng.choice(["", "\nline\nline", "\n"]) for i in range(160)}
    return rows | {200: "", 201: None, 202: "a", 203: rows[1], 204: "many words " * 40}


def test_scores_are_those_of_the_formula(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, quality int")
    table, slope, intercept = q.train(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    weights, squares, bias = table[: q.SIZE], table[q.SIZE : 2 * q.SIZE], table[-1]
    for r in q.score_documents(docs, labels).collect():
        x = indicators(texts[r["doc_id"]])
        margin = (sum(float(weights[k]) for k in x) + float(bias)) / math.sqrt(sum(float(squares[k]) for k in x) + 1)
        want = 1 / (1 + math.exp(-min(max(slope * margin + intercept, -30), 30)))
        assert r["score"] == pytest.approx(want, abs=1e-4) and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_ratios_and_the_dual(texts):
    """Log-count ratios by plain counts, and weights that no single dual variable could better."""
    rows = [np.array(sorted(indicators(texts[i])), np.int32) for i in range(120)]
    y = np.array([i % 2 for i in range(120)])
    table, slope, _ = q.fit(rows, y, epochs=200)
    held = np.random.default_rng(0).random(len(y)) < 0.25
    counts = [Counter(k for i in np.flatnonzero(~held) if y[i] == c for k in rows[i].tolist()) for c in (0, 1)]
    total = [sum(c.values()) + q.SIZE for c in counts]
    r = {k: math.log((counts[1][k] + 1) / total[1]) - math.log((counts[0][k] + 1) / total[0]) for x in rows for k in x.tolist()}
    assert all(table[q.SIZE + k] == pytest.approx(v * v, rel=1e-4, abs=1e-7) for k, v in r.items())
    margins = []
    for i in np.flatnonzero(~held):
        norm = 1 / math.sqrt(sum(r[k] ** 2 for k in rows[i].tolist()) + 1)
        margins.append((1 if y[i] else -1) * norm * (sum(float(table[k]) for k in rows[i].tolist()) + float(table[-1])))
    assert slope > 0 and min(margins) > 0.9  # the classes can be told apart: every row reaches its margin, but for rounding
