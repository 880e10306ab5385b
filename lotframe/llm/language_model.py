"""Scoring texts by a bigram language model held in Elias-Fano tries.

Documents are dealt into blocks of about ``BLOCK_BYTES``. A block sends every shard its distinct words and word pairs
with their counts in training documents; a shard merges what all blocks sent into a trie, answers each block's pairs
from it, and the block scores its texts with the answers. So the counts and the model grow with the corpus, no task
holds more than a shard or a block, and a word that is everywhere costs one row per block.

A shard's trie has a level of contexts and a level of successors. Keys and pointers are Elias-Fano sequences; the
successors of a context are stored relative to what precedes its range, which keeps the level monotone, and are found by
successor search inside the range that two pointers give. Each node has a smoothed probability of 8 bits. The levels
are written to a file, memory-mapped, and searched as they are: high parts are read from the packed unary bits with the
help of a sample of their places, one in ``EVERY``.

A block sends a row only to shards that hold something of it, so there are never more rows than the blocks have distinct
words and pairs, and their number stays linear in the corpus however many blocks and shards there are.

The successors of a context are spread by their hash over ``BRANCHES`` shards, or more for contexts that are so frequent
that a branch would hold more than the average of ``HOT`` shards (found by a pass over all texts), so that no context is too
large for one:

    p(w | v) = P(branch of w | v) * (p(w | v, branch) + left(v, branch) * p(w) / P(branch))

with Witten-Bell estimates p and left in a branch (those in the trie), Dirichlet-smoothed P(branch | v), and p(w) by
absolute discounting, whose discount goes to all unknown words together. Quantised probabilities are rounded down.
Words are known by 64-bit hashes, successors of a context by 40 bits of them. Counts of the corpus have 64 bits.

Defined results: null text counts as empty and holds only the end; rows with a null doc_id are scored, but neither held
out nor learned from; without training rows every probability is 1; long texts are scored whole (a block holds one at
least); repeated rows get equal results, count in training as often as they occur and are dealt to blocks row by row;
there are no ties to break; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotframe.llm import _text
from lotframe.llm._store import materialize
from lotframe.llm.repeats import _opened, _squeeze

BLOCK_BYTES = 10 << 20
SHARD_BYTES = 10 << 20
BRANCHES = 16
HOT = 8
BRANCH_WEIGHT = 8.0
DISCOUNT = 0.5
END = np.uint64(0x5851F42D4C957F2D)  # the end of a text, as a word
START = np.uint64(0x14057B7EF767814F)  # the context of a text's first word
PRINT = np.uint64((1 << 40) - 1)
LOWEST, CODES = -8.0, 254


# Elias-Fano sequences


EVERY = 8  # one high part in so many has its place in the sample


def _elias_fano(values: np.ndarray) -> list[np.ndarray]:
    """Byte arrays of a sequence of sorted 64-bit integers: low bits (in whole bytes), high parts in unary with eight empty
    bytes behind, the places of every EVERY-th one, and (length, low bits)."""
    n = len(values)
    top = int(values[-1]) if n else 0
    bits = max(0, (top // max(n, 1)).bit_length() - 1)
    low = np.ascontiguousarray(values & np.uint64((1 << bits) - 1)).view(np.uint8).reshape(n, 8)[:, : -(-bits // 8)]
    ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros((top >> bits) + n + 65, bool)
    unary[ones] = True
    return [np.ascontiguousarray(low).ravel(), np.packbits(unary, bitorder="little"), np.ascontiguousarray(ones[::EVERY]).view(np.uint8), np.array([n, bits], np.int64).view(np.uint8)]


class Sequence:
    """A stored Elias-Fano sequence; nothing of it is unpacked but what is asked for."""

    def __init__(self, low: np.ndarray, unary: np.ndarray, sample: np.ndarray, shape: np.ndarray):
        self.n, self.bits = np.frombuffer(shape.tobytes(), np.int64).tolist()
        self.low = low.reshape(self.n, -1) if len(low) else np.zeros((self.n, 0), np.uint8)
        self.unary, self.sample = unary, sample.view(np.int64) if not sample.ctypes.data % 8 else np.frombuffer(sample.tobytes(), np.int64)

    def _window(self, at: np.ndarray) -> np.ndarray:
        """57 bits or more of the unary part from bit ``at`` on."""
        byte = at >> 3
        out = self.unary[byte].astype(np.uint64)
        for k in range(1, 8):
            out |= self.unary[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return out >> (at & 7).astype(np.uint64)

    def get(self, i: np.ndarray) -> np.ndarray:
        at, skip = self.sample[i // EVERY], i % EVERY
        window = self._window(at)
        # pass over the ones before; windows with too few are moved on
        have = np.bitwise_count(window).astype(np.int64)
        short = np.flatnonzero(have <= skip)
        while len(short):
            skip[short] -= have[short]
            at[short] += 64 - (at[short] & 7)
            last = len(self.unary) * 8 - 64
            inside = at[short] <= last
            short = short[inside]
            window[short] = self._window(at[short])
            have[short] = np.bitwise_count(window[short])
            short = short[have[short] <= skip[short]]
        for k in range(EVERY - 1):
            window = np.where(skip > k, window & (window - np.uint64(1)), window)
        place = at + np.bitwise_count((window & (~window + np.uint64(1))) - np.uint64(1))
        out = (place - i).astype(np.uint64) << np.uint64(self.bits)
        for b in range(self.low.shape[1]):
            out |= self.low[i, b].astype(np.uint64) << np.uint64(8 * b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The first index in lo..hi - 1 whose value is x or more, else hi."""
        lo, hi = lo.copy(), hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.get(mid) < x[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        return lo


def _code(p: np.ndarray) -> np.ndarray:
    """8-bit codes of probabilities, rounded down; 0 is none."""
    scaled = np.floor((np.log10(np.maximum(p, 1e-300)) - LOWEST) / -LOWEST * CODES + 1e-9)
    return np.where(p > 0, 1 + np.clip(scaled, 0, CODES), 0).astype(np.uint8)


def _value(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (LOWEST + (code.astype(np.float64) - 1) / CODES * -LOWEST), 0.0)


class Trie:
    """Contexts and their successors, mapped from a file."""

    def __init__(self, folder: str, context: np.ndarray, word: np.ndarray, count: np.ndarray):
        """context, word, count: distinct pairs with positive counts, sorted."""
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(new)
        ends = np.append(first[1:], len(context)) if len(first) else first
        total = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
        kinds = ends - first
        # a range's values start above the last of the range before
        last = word[ends - 1] + np.uint64(1)
        base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(last)[:-1]]) if len(first) else np.zeros(0, np.uint64)
        parts = [
            *_elias_fano(context[first]),
            *_elias_fano(np.append(first, len(context)).astype(np.uint64)),
            *_elias_fano(word + np.repeat(base, kinds)),
            _code(count / np.repeat(total + kinds, kinds)),
            _code(kinds / (total + kinds)),
            total.astype(np.int64).view(np.uint8),
        ]
        path = os.path.join(folder, "levels")
        with open(path, "wb") as f:
            for p in parts:
                f.write(p.tobytes())
        at = np.append(0, np.cumsum([p.nbytes for p in parts]))
        levels = np.memmap(path, np.uint8, "r") if at[-1] else np.zeros(0, np.uint8)
        mapped = [levels[a:b] for a, b in zip(at, at[1:], strict=False)]
        self.contexts, self.pointers, self.words = (Sequence(*mapped[k : k + 4]) for k in (0, 4, 8))
        self.seen, self.left, self.total = mapped[12], mapped[13], np.frombuffer(mapped[14].tobytes(), np.int64)
        self.bytes = int(at[-1])

    def look_up(self, context: np.ndarray, owner: np.ndarray, word: np.ndarray):
        """(total, left) of each context and the code of each word after context[owner]."""
        n = self.contexts.n
        total, left, seen = np.zeros(len(context), np.int64), np.zeros(len(context), np.uint8), np.zeros(len(word), np.uint8)
        if not n:
            return total, left, seen
        i = self.contexts.successor(np.zeros(len(context), np.int64), np.full(len(context), n), context)
        found = (i < n) & (self.contexts.get(np.minimum(i, n - 1)) == context)
        at = i[found]
        total[found], left[found] = self.total[at], self.left[at]
        lo, hi, base = (np.zeros(len(context), np.int64) for _ in range(3))
        base = base.astype(np.uint64)
        lo[found], hi[found] = self.pointers.get(at).astype(np.int64), self.pointers.get(at + 1).astype(np.int64)
        after = found & (lo > 0)
        base[after] = self.words.get(lo[after] - 1) + np.uint64(1)
        lo, hi, x = lo[owner], hi[owner], word + base[owner]
        j = self.words.successor(lo, hi, x)
        hit = np.flatnonzero(j < hi)
        hit = hit[self.words.get(j[hit]) == x[hit]]
        seen[hit] = self.seen[j[hit]]
        return total, left, seen


# what blocks and shards send each other


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        turned = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T) if len(a) else a
        body = z.compress(turned.tobytes())
        out.append(len(a).to_bytes(4, "little") + len(body).to_bytes(4, "little") + body)
    return b"".join(out)


def _unpack(data: bytes, *types) -> list[np.ndarray]:
    import zstandard

    z, out, at = zstandard.ZstdDecompressor(), [], 0
    for t in types:
        n, size = int.from_bytes(data[at : at + 4], "little"), int.from_bytes(data[at + 4 : at + 8], "little")
        raw = np.frombuffer(z.decompress(data[at + 8 : at + 8 + size]), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(-1, n).T).view(t).ravel() if n else np.zeros(0, t))
        at += 8 + size
    return out


def _narrow(prints: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(prints.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :5]


def _pack_prints(prints: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(_narrow(prints).T).tobytes())


def _unpack_prints(data: bytes, n: int) -> np.ndarray:
    import zstandard

    wide = np.zeros((n, 8), np.uint8)
    if n:
        wide[:, :5] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(5, n).T
    return wide.view(np.uint64).ravel()


def is_held_out(doc_id: int | None, folds: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


def _order(context: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The order by context and print, by two sorts of single integers."""
    order = np.argsort(context)
    by = context[order]
    rank = np.cumsum(np.append(False, by[1:] != by[:-1])[: len(by)])
    if len(rank) and rank[-1] >= 1 << 24:
        return np.lexsort((prints, context))
    return order[np.argsort(rank.astype(np.uint64) << np.uint64(40) | prints[order])]


Hot = tuple[np.ndarray, np.ndarray]
#: Frequent words, sorted, and the number of branches of each as a context.
NONE_HOT: Hot = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _branches(token: np.ndarray, before: np.ndarray, hot: Hot) -> np.ndarray:
    """The branch that holds each token after the one before it: a number among those of all contexts with as many branches,
    behind the numbers of contexts with fewer."""
    many = np.full(len(token), BRANCHES, np.int64)
    if len(hot[0]):
        word = np.where(before == START, END, before)  # as many starts as ends
        at = np.minimum(np.searchsorted(hot[0], word), len(hot[0]) - 1)
        many = np.where(hot[0][at] == word, hot[1][at], many)
    return ((token % many.astype(np.uint64)).astype(np.int64) + many - BRANCHES).astype(np.int32)


class Block:
    """The words and pairs of some documents. ``word`` and ``pair`` are the tokens' numbers among the distinct ones."""

    def __init__(self, table: pa.Table, folds: int, shards: int, hot: Hot = NONE_HOT):
        self.ids = table.column("doc_id").to_pylist()
        self.held = np.array([is_held_out(i, folds) for i in self.ids], bool)
        learn = np.array([i is not None and not h for i, h in zip(self.ids, self.held, strict=True)], bool)
        tokens, sizes = [], []
        table = table.select(["z"])
        for piece in table.column("z").chunks:
            for chunk in (c for at in range(0, len(piece), 512) for c in _text.chunks(pa.array(_opened(piece.slice(at, 512)), pa.binary()).cast(pa.large_string()), lower=True)):
                w = _text.words(chunk)
                h = _text.span_hash(chunk.prefix(), w.starts, w.ends)
                tokens.append(np.insert(h, w.first[1:], END))
                sizes.append(w.counts + 1)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = START
        weight = np.repeat(learn, self.sizes)
        self.words, word = np.unique(token, return_inverse=True)
        self.word = word.astype(np.int32)
        if len(token) >= 1 << 32:
            raise OverflowError("a block of 2 ** 32 tokens")  # its own counts have 32 bits
        self.word_count = np.bincount(self.word, weights=weight, minlength=len(self.words)).astype(np.uint32)
        self.word_shard = (_text.mix(self.words) % np.uint64(shards)).astype(np.int64)
        # distinct pairs in the order of context (with branch) and print of the word; shards are ranges of contexts
        self.branch = _branches(token, before, hot)
        key = _text.mix(before + self.branch.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))  # a context's branch is a context of its own
        prints = token >> np.uint64(24)
        both = _text.mix(key + _text.mix(prints))
        order = np.argsort(both)
        new = np.ones(len(order), bool)
        new[1:] = both[order[1:]] != both[order[:-1]]
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new) - 1
        some = order[new]
        key, prints = key[some], prints[some]
        del both, order, new, before, token
        by_context = _order(key, prints)
        rank = np.empty(len(some), np.int32)
        rank[by_context] = np.arange(len(some), dtype=np.int32)
        self.pair = rank[number]
        self.pair_count = np.bincount(self.pair, weights=weight, minlength=len(some)).astype(np.uint32)
        self.prints, key = prints[by_context], key[by_context]
        head = np.ones(len(some), bool)
        head[1:] = key[1:] != key[:-1]
        self.owner = np.cumsum(head) - 1  # the context of each pair
        self.contexts = key[head]
        self.context_shard = (((self.contexts >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)

    def parts(self):
        """(shard, words, contexts, pairs) as index arrays or slices, for every shard concerned."""
        by_shard = np.argsort(self.word_shard, kind="stable")
        some = np.union1d(self.word_shard, self.context_shard)
        w = np.searchsorted(self.word_shard[by_shard], np.append(some, 1 << 40))
        c = np.searchsorted(self.context_shard, np.append(some, 1 << 40))
        first = np.append(np.searchsorted(self.owner, np.arange(len(self.contexts))), len(self.owner))
        for k, s in enumerate(some.tolist()):
            yield s, by_shard[w[k] : w[k + 1]], slice(c[k], c[k + 1]), slice(first[c[k]], first[c[k + 1]])


def _binary(column: list[bytes]) -> pa.Array:
    return pa.array(column, pa.binary())


def _asked(folds: int, shards: int, hot: Hot):
    """A block's rows (shard, block, words, pairs) for the shards."""

    def run(key, table):
        block, number = Block(table, folds, shards, hot), key[0].as_py()
        rows = []
        for s, w, c, p in block.parts():
            kinds = np.bincount(block.owner[p] - c.start, minlength=c.stop - c.start).astype(np.uint32)
            rows.append(
                (s, number, _pack(block.words[w], block.word_count[w]), _pack(block.contexts[c], kinds, block.pair_count[p]), _pack_prints(block.prints[p]))
            )
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *map(_binary, columns[2:])], names=["shard", "block", "words", "pairs", "prints"])

    return run


def _answered(most: int):
    """A shard's rows (block, shard, words, pairs) for the blocks, and one row of its totals by branch (block -1), of ``most``
    branches."""

    def run(key, table):
        shard = key[0].as_py()
        asked = [_unpack(x.as_py(), np.uint64, np.uint32) for x in table.column("words")]
        pairs = [_unpack(x.as_py(), np.uint64, np.uint32, np.uint32) for x in table.column("pairs")]
        prints = [_unpack_prints(x.as_py(), len(p[2])) for x, p in zip(table.column("prints"), pairs, strict=True)]
        words, of = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([a[1] for a in asked]), minlength=len(words)).astype(np.int64)  # exact below 2 ** 53
        branch = (words % np.uint64(most)).astype(np.int64)
        totals = np.stack([np.bincount(branch, weights=x, minlength=most).astype(np.int64) for x in (count, count > 0)])
        v = np.concatenate([np.repeat(p[0], p[1]) for p in pairs])
        p, n = np.concatenate(prints), np.concatenate([x[2] for x in pairs]).astype(np.int64)
        learned = n > 0
        v, p, n = v[learned], p[learned], n[learned]
        order = _order(v, p)
        v, p, n = v[order], p[order], n[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (p[1:] != p[:-1])
        n = np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n
        rows = [(-1, shard, _pack(totals.ravel()), b"")]
        with tempfile.TemporaryDirectory() as folder:
            trie, at = Trie(folder, v[new], p[new], n), 0
            for block, a, x, y in zip(table.column("block").to_pylist(), asked, pairs, prints, strict=True):
                total, left, seen = trie.look_up(x[0], np.repeat(np.arange(len(x[0])), x[1]), y)
                rows.append((block, shard, _pack(count[of[at : at + len(a[0])]]), _pack(total, left, seen)))
                at += len(a[0])
            del trie
        columns = list(zip(*rows, strict=True))
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *map(_binary, columns[2:])], names=["block", "shard", "words", "pairs"])

    return run


def _added(batches):
    """The sum of packed vectors of one length."""
    total = None
    for batch in batches:
        for x in batch.column(0):
            numbers = _unpack(x.as_py(), np.int64)[0]
            total = numbers if total is None else total + numbers
    if total is not None:
        yield pa.RecordBatch.from_arrays([_binary([_pack(total)])], names=["sum"])


def _frequent(least: float):
    """(word, n, tokens) of words that make ``least`` of a chunk's tokens or more, and of each chunk's tokens (word null): a
    word that makes as much of the corpus does so in some chunk, and is missed in others only where it is rarer."""

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(pa.array(_opened(batch.column(0)), pa.binary()).cast(pa.large_string()), lower=True):
                w = _text.words(chunk)
                words, n = np.unique(_text.span_hash(chunk.prefix(), w.starts, w.ends), return_counts=True)
                words, n = np.append(words, END), np.append(n, chunk.n)
                some = n >= least * n.sum()
                word = pa.concat_arrays([pa.array(words[some].view(np.int64)), pa.nulls(1, pa.int64())])
                yield pa.RecordBatch.from_arrays([word, pa.array(np.append(n[some], n.sum()).astype(np.int64))], names=["word", "n"])

    return run


def hot_words(dealt: DataFrame, shards: int) -> Hot:
    """Words that are so frequent that a branch of theirs would hold more than the average of ``HOT`` shards, and branches
    enough for each. There are at most shards / (HOT * BRANCHES) of them."""
    least = HOT * BRANCHES / shards
    if least >= 1:  # no word can be
        return NONE_HOT
    found = dealt.select("z").mapInArrow(_frequent(least), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    tokens = found.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    rows = found.where((F.col("word").isNotNull()) & (F.col("n") >= least * tokens)).collect()
    many = {int(np.int64(r["word"]).view(np.uint64)): BRANCHES << max(0, math.ceil(math.log2(r["n"] / tokens / least))) for r in rows}
    return np.array(sorted(many), np.uint64), np.array([many[w] for w in sorted(many)], np.int64)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(folds: int, shards: int, hot: Hot, tokens: np.ndarray, kinds: np.ndarray):
    """tokens, kinds: training tokens and distinct ones by branch, of as many branches as any context has."""
    n, v = int(tokens.sum()), int(kinds.sum())
    unknown = DISCOUNT * v / n if n else 1.0
    branch_p, many = [], BRANCHES
    while many <= len(tokens):
        t, k = (x.reshape(-1, many).sum(axis=0) for x in (tokens, kinds))
        branch_p.append((t - DISCOUNT * k) / n + unknown / many if n else np.full(many, 1.0))
        many *= 2
    branch_p = np.concatenate(branch_p)
    floor = 0.1 / (n + 0.1 * (v + 1))

    def run(left, right):
        block = Block(left, folds, shards, hot)
        given = {s: (w.as_py(), p.as_py()) for s, w, p in zip(right.column("shard").to_pylist(), right.column("words"), right.column("pairs"), strict=True)}
        count = np.zeros(len(block.words), np.int64)
        total, rest, seen = np.zeros(len(block.contexts), np.int64), np.zeros(len(block.contexts), np.uint8), np.zeros(len(block.prints), np.uint8)
        for s, w, c, p in block.parts():
            count[w] = _unpack(given[s][0], np.int64)[0]
            total[c], rest[c], seen[p] = _unpack(given[s][1], np.int64, np.uint8, np.uint8)
        c = count[block.word]
        p1 = np.where(c > 0, (c - DISCOUNT) / max(n, 1), unknown)
        # training tokens after each token's context: those of all branches together
        context, before = block.owner[block.pair], np.append(0, c)[:-1]
        starts = np.cumsum(block.sizes) - block.sizes
        before[starts] = count[np.searchsorted(block.words, END)] if len(block.words) else 0  # as many starts as ends
        pb = branch_p[block.branch]
        in_branch = (total[context] + BRANCH_WEIGHT * pb) / (before + BRANCH_WEIGHT)
        lower = np.where(total[context] > 0, _value(rest[context]), 1.0)
        p = in_branch * (_value(seen[block.pair]) + lower * p1 / pb) if n else np.ones(len(c))
        edge = np.append(starts, len(c))
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1))) if n else np.full(len(c), math.log10(floor * 1.0) if floor > 0 else 0.0)
        sums = [np.add.reduceat(x, edge[:-1]) if len(x) else x for x in (np.log10(p), base)]
        known = np.add.reduceat((c > 0).astype(np.int64), edge[:-1]) if len(c) else c
        size = len(block.ids)
        return pa.table(
            [
                pa.array(block.ids, pa.int64()),
                pa.array(block.held),
                pa.array(block.sizes.astype(np.int64)),
                pa.array(known),
                pa.array(np.full(size, n, np.int64)),
                pa.array(sums[1]),
                pa.array(sums[0]),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def score_documents(docs: DataFrame, folds: int = 10, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row a document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, shards = size // block_bytes + 1, size // shard_bytes + 1
    squeezed = _squeeze(docs).withColumn("block", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    dealt = materialize(squeezed, "blocks")  # which fixes the rows of each block
    hot = hot_words(dealt, shards)
    most = int(max([BRANCHES, *hot[1]]))
    asked = dealt.groupBy("block").applyInArrow(_asked(folds, shards, hot), "shard int, block int, words binary, pairs binary, prints binary")
    answers = materialize(asked.groupBy("shard").applyInArrow(_answered(most), "block int, shard int, words binary, pairs binary"), "answers")
    totals = np.zeros(2 * most, np.int64)
    for row in answers.where("block = -1").select("words").mapInArrow(_added, "sum binary").toLocalIterator():  # one a partition
        totals = totals + _unpack(bytes(row[0]), np.int64)[0]
    tokens, kinds = totals.reshape(2, most)
    return dealt.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(_scored(folds, shards, hot, tokens, kinds), SCORED)
