"""Periodic runs of words: stretches that repeat one block of words, and texts with all but the first block dropped.

A diagonal is a lag d; its match length at word i is one more than at word i - 1 if word i equals word i - d, and else 0.
A run of period q is a stretch in which the diagonal of lag q stays active, together with the q words before it. The
program walks the words of a text in order, lets earlier occurrences of what ends at a word extend the diagonals that are
active or open new ones, and emits a run when a diagonal that is long enough ends.

Letting every earlier occurrence of a word open a diagonal takes quadratic work for frequent words. So the diagonals are
kept sparse by scale: on scale g = 1, 2, 4, ... a word stands for the g words that end at it, only their nearest earlier
occurrence counts, and only lags above g / 2 and up to g are followed. No run is lost and none is invented: inside a run
whose smallest period q is at most g, a nearer occurrence of g words, at a lag d, would give the stretch the periods q and d
over g + d >= q + d words, and by the theorem of Fine and Wilf a period below q. So on each scale at most one diagonal is
active at a time, its lag is the smallest period of its stretch, and a text of n words takes n log n steps. A text leaves
the scales when it has no stretch of repeated contexts that is long enough for a longer period.

Words are numbered by their bytes and contexts by pairs of numbers; nothing is matched by a hash. A task works on chunks of
whole texts and holds a few numbers a word of one chunk.

Defined results: a null or blank text has no words and no runs; stretches may overlap, and a word is dropped if any run
holds it after the run's first period; ties of the highest exponent go to the smallest start, then the smallest period;
repeated rows get equal results; a row without doc_id is taken as it stands; long texts are processed whole; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lotframe.llm import _text

#: A run has so many words at least, and so many periods.
LEAST, TIMES = 6, 4
#: Words whose bytes are put together at a time.
_BLOCK = 1 << 16


def periodic_runs(word: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start in the document, length, period) of all runs of ``least`` words and ``times`` periods, at least 3,
    ordered by document, start and period. word: numbers of words; document i has ``word[first[i]:first[i + 1]]``."""
    size = np.diff(first)
    found = []
    docs = np.flatnonzero(size >= max(least, times))
    scale, rank = 1, None
    while len(docs):
        count = size[docs]
        edge = np.append(0, np.cumsum(count))
        n = edge[-1]
        doc = np.repeat(np.arange(len(docs)), count)
        at = np.arange(n)
        place = at - edge[doc]
        if rank is None:
            own = word[np.repeat(first[docs], count) + place].astype(np.int64)
            key = doc * (int(own.max()) + 1) + own
            valid = at
        else:
            valid = np.flatnonzero(place >= scale - 1)
            half = scale // 2
            key = rank[valid - half] * (int(rank.max()) + 1) + rank[valid]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        same = np.zeros(len(order), bool)
        same[1:] = ordered[1:] == ordered[:-1]
        rank = np.full(n, -1, np.int64)
        rank[valid[order]] = np.cumsum(~same)
        lag = np.zeros(n, np.int64)  # to the nearest earlier occurrence of the scale's words that end here
        order = valid[order]
        lag[order[1:]] = np.where(same[1:], order[1:] - order[:-1], 0)
        # an active diagonal grows by a word for each step with its lag
        follow = np.where((lag > scale // 2) & (lag <= scale), lag, 0)
        opened = np.flatnonzero((follow > 0) & (np.append(0, follow[:-1]) != follow))
        closed = np.flatnonzero((follow > 0) & (np.append(follow[1:], 0) != follow))
        period = follow[opened]
        length = closed - opened + scale + period
        long = (length >= least) & (length >= times * period)
        start = opened + 1 - scale - period
        d = doc[opened]
        found.append(np.stack([docs[d], start - edge[d], length, period], axis=1)[long])
        # a longer period, q > scale, needs (times - 1) * q - scale + 1 repeated contexts one after another
        stretch = np.flatnonzero((lag > 0) & (np.append(0, lag[:-1]) == 0))
        ends = np.flatnonzero((lag > 0) & (np.append(lag[1:], 0) == 0)) + 1
        need = (times - 1) * (scale + 1) - scale + 1
        some = np.zeros(len(docs), bool)
        some[doc[stretch[ends - stretch >= need]]] = True
        some &= count >= times * (scale + 1)
        rank = rank[some[doc]]
        docs = docs[some]
        scale *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """The words that a text of n words is made of: its own, or, for one doc_id in ten, those up to a place and then a
    block of words over and over."""
    source = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[a:] = a + (source[a:] - a) % p
    return source


def _numbered(chunk: _text.Chunk, w: _text.Words, solid: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal bytes."""
    offsets = np.append(0, np.cumsum(w.ends - w.starts))
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(offsets), pa.py_buffer(chunk.data[solid])])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _hashed(chunk: _text.Chunk, starts: np.ndarray, ends: np.ndarray) -> str:
    """sha256 of words joined by one space."""
    total = hashlib.sha256()
    for at in range(0, len(starts), _BLOCK):
        s, e = starts[at : at + _BLOCK], ends[at : at + _BLOCK]
        size = e - s + 1
        to = np.cumsum(size)
        text = chunk.data[np.minimum(np.repeat(s - to + size, size) + np.arange(to[-1]), len(chunk.data) - 1)]
        text[to - 1] = 0x20
        total.update(text[: -1 if at + _BLOCK >= len(starts) else None])
    return total.hexdigest()


DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _sources(chunk_ids: list, w: _text.Words, plant: bool) -> np.ndarray:
    parts = [a + (planted(i, b - a) if plant else np.arange(b - a)) for i, a, b in zip(chunk_ids, w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _analysed(batch: pa.RecordBatch, plant: bool, least: int, times: int) -> Iterator[tuple]:
    """(doc_id, chunk, starts and ends of its words, rows (start, length, period) of its runs) of each document."""
    ids = batch.column(0).to_pylist()
    for chunk in _text.chunks(batch.column(1)):
        solid = _text.inside(chunk)
        w = _text.words(chunk, solid)
        number = _numbered(chunk, w, solid)
        source = _sources(ids[chunk.rows], w, plant)
        found = periodic_runs(number[source], w.first, least, times)
        at = np.searchsorted(found[:, 0], np.arange(len(w.first)))
        for k, doc_id in enumerate(ids[chunk.rows]):
            own = source[w.first[k] : w.first[k + 1]]
            yield doc_id, chunk, w.starts[own], w.ends[own], found[at[k] : at[k + 1], 1:]


def _kept(n: int, found: np.ndarray) -> np.ndarray:
    """True for words that no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.subtract.at(depth, found[:, 0] + found[:, 1], 1)
    return np.cumsum(depth)[:n] == 0


def _digest(doc_id, chunk, starts, ends, found) -> tuple:
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
    best = max(found.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    if len(found):
        kept = _kept(len(starts), found)
        starts, ends = starts[kept], ends[kept]
    peak = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *peak, hashlib.sha256(lines.encode()).hexdigest(), _hashed(chunk, starts, ends)


def run_digests(docs: DataFrame, plant: bool = True, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, the number of runs, the run of the highest exponent, and digests of all runs and of the words that are kept.
    ``plant`` first makes one text in ten periodic (``planted``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_digest(*x) for x in _analysed(batch, plant, least, times)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)] if rows else [pa.array([], t) for t in _SCHEMA.types], schema=_SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)


def without_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, the text with only the first period of each run, its words joined by one space, and the runs as an array of
    (start, length, period)."""
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, runs = [], [], []
            for doc_id, chunk, starts, ends, found in _analysed(batch, False, least, times):
                kept = _kept(len(starts), found)
                ids.append(doc_id)
                texts.append(b" ".join(bytes(chunk.data[a:b]) for a, b in zip(starts[kept].tolist(), ends[kept].tolist(), strict=True)).decode())
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(runs, kind)], names=["doc_id", "text", "runs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, runs array<struct<start: long, length: long, period: long>>")
