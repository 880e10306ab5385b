"""Vectorised text kernels shared by the operators: numpy over the bytes of an Arrow string column.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D, as ``[^\\x20\\x09-\\x0D]+`` matches on UTF-8 text.
Every function works on a chunk of whole documents (about ``CHUNK_BYTES``; one larger document makes a chunk of its
own), so memory follows the longest document and not the partition. Hashes depend on content alone: they are polynomials
over the bytes modulo the prime 2 ** 61 - 1, so that two different spans of n bytes have one hash with a probability of
about n / 2 ** 61, however regular they are.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)
_R = 0x9E3779B97F4A7C15 % _PRIME
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)
#: Elements computed at a time, so that intermediate arrays stay in the processor's cache.
_BLOCK = 1 << 15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit integers."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, by halves of 31 bits (2 ** 61 is 1, so 2 ** 62 is 2)."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced((a1 * b1 << np.uint64(1)) + (middle >> _30) + ((middle & _LOW30) << _31) + a0 * b0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, and more, of the base and of its inverse."""
    if not _POWERS or len(_POWERS["r"]) < n:
        m = max(n, CHUNK_BYTES + (1 << 18))
        for name, r in (("r", _R), ("inv", pow(_R, -1, _PRIME))):
            p = np.ones(1, np.uint64)
            while len(p) < m:
                p = np.concatenate([p, _times(p[: m - len(p)], np.uint64(pow(r, len(p), _PRIME)))])
            _POWERS[name] = p
    return _POWERS["r"], _POWERS["inv"]


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of small non-negative numbers (below 2 ** 16), for ``span_hash``."""
    n = len(values)
    power, out, carry = _powers(n + 1)[0], np.zeros(n + 1, np.uint64), np.uint64(0)
    for a in range(0, n, _BLOCK):
        v, p = values[a : a + _BLOCK].astype(np.uint64) + np.uint64(1), power[a : min(a + _BLOCK, n)]
        high, low = np.cumsum(v * (p >> _31)), np.cumsum(v * (p & _LOW31))  # below 2 ** 63
        high = _reduced(high)
        part = _reduced((high >> _30) + ((high & _LOW30) << _31) + _reduced(low) + carry)
        out[a + 1 : a + 1 + len(v)] = part
        carry = part[-1]
    return out


def release() -> None:
    """Gives freed memory back to the system, so that a worker that waits for its next task holds little."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@dataclass
class Chunk:
    """Bytes of some documents end to end; document i has ``data[offsets[i]:offsets[i + 1]]``."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def prefix(self) -> np.ndarray:
        """Running polynomial sums, for ``span_hash``."""
        return running(self.data)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hashes of ``data[start:end]``."""
    inv, out = _powers(len(prefix))[1], np.empty(len(starts), np.uint64)
    for a in range(0, len(out), _BLOCK):
        s, e = starts[a : a + _BLOCK], ends[a : a + _BLOCK]
        out[a : a + _BLOCK] = mix(_times(_reduced(prefix[e] + (_P - prefix[s])), inv[s]) + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def chunks(column: pa.Array | pa.ChunkedArray, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column in row order; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        part = data[offsets[at] : offsets[to]]
        yield Chunk(slice(at, to), _LOWER[part] if lower else part, offsets[at : to + 1] - offsets[at])
        at = to
    release()


@dataclass
class Words:
    """Words of a chunk: byte spans, and ``first[i]:first[i + 1]`` as the words of document i."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def inside(chunk: Chunk) -> np.ndarray:
    """True for each byte that belongs to a word."""
    return ~_SPACE[chunk.data]


def words(chunk: Chunk, solid: np.ndarray | None = None) -> Words:
    solid = inside(chunk) if solid is None else solid
    n = len(solid)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = solid[:-1], solid[1:]
        full = chunk.offsets[:-1] < chunk.offsets[1:]
        before[chunk.offsets[:-1][full]] = False
        after[chunk.offsets[1:][full] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.offsets))


def runs(n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, position among all items) of every window of k items inside groups of n items each."""
    count = np.maximum(n - k + 1, 0)
    group = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(np.cumsum(n) - n, count)
    return group, at


def window_hash(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hashes of ``h[a:a + k]`` for each a in ``at``."""
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + h[at + j]) if k <= 3 else out * np.uint64(0x9FB21C651E98DF25) + h[at + j]
    return out if k <= 3 else mix(out)


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def shingles(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each distinct k-word shingle, ordered by document and hash; the whole sequence is the one
    shingle of a document of 1 to k - 1 words, and a document without words has none."""
    w = words(chunk)
    h = span_hash(chunk.prefix(), w.starts, w.ends)
    doc, at = runs(w.counts, k)
    hashes = [window_hash(h, at, k)]
    docs = [doc]
    for size in range(1, k):
        short = np.flatnonzero(w.counts == size)
        docs.append(short)
        hashes.append(mix(window_hash(h, w.first[short], size) + np.uint64(size)))
    doc, hashed = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    return doc[new], hashed[new]
