"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding.

The model file is a public vocabulary, shipped to the executors as part of the job; its path is a parameter. A BPE
model scores pieces by merge rank only, so a piece of rank r gets the Zipf-Mandelbrot probability ``1 / (r + 2.7)``,
normalised and raised to ``alpha``. Text is escaped as the model does it (a space in front, spaces as U+2581). Cutting
it wherever no piece holds the two neighbouring characters gives segments whose lattices are independent. For each
distinct segment of a chunk (known by its hash and compared by its characters) the forward pass sums path weights per node; every occurrence then walks backwards from
the last node and draws one incoming piece a step. The draws are hashes of (seed, row key, segment number, step): a
row is segmented alike wherever and whenever it is processed. Characters without a piece become byte pieces, as does a
literal U+2581, so ``decode_ids(encode(text)) == text`` for every text.

Defined results: null text gives null ids and null decoded text; an empty text gives no ids; long texts are segmented
whole, alone in their chunk; repeated rows of the same key get the same ids, and rows of one key with different texts
share their draws; between pieces of equal weight the draw alone decides; an empty table gives an empty result; extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.llm import _text

SPACE = 0x2581
CHUNK = 1 << 20
COMPARED = 1 << 16  # characters compared at a time
_CLASSES = 1 << 12


@dataclass
class Vocabulary:
    """Arrays that describe a model's pieces."""

    log_p: np.ndarray
    classes: np.ndarray  # character -> class, 0 without a one-character piece
    pairs: np.ndarray  # may two classes stand side by side in a piece?
    edges: np.ndarray  # sorted (trie node * _CLASSES + class)
    child: np.ndarray  # node below each edge
    piece: np.ndarray  # piece that ends at a node, or -1
    byte_id: np.ndarray
    text: np.ndarray  # bytes of all pieces, decoded, end to end
    text_at: np.ndarray


def load(model_file: str, alpha: float = 1.0) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    byte_id, texts, plain = np.full(256, -1, np.int32), [], {}
    rank = np.full(n, float(n))
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_id[int(p[3:5], 16)] = i
            texts.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(b"")
        else:
            plain[p] = i
            rank[i] = min(max(-sp.get_score(i), 0.0), n)
            texts.append(p.replace("▁", " ").encode())
    weight = 1 / (rank + 2.7)
    log_p = alpha * np.log(weight / weight[list(plain.values())].sum())
    classes = np.zeros(0x110002, np.int64)
    for c in sorted(p for p in plain if len(p) == 1):
        classes[ord(c)] = classes.max() + 1
    if classes.max() >= _CLASSES:
        raise ValueError("too many one-character pieces")
    pairs = np.zeros(_CLASSES * _CLASSES, bool)
    nodes, piece = {}, [-1]
    for p, i in plain.items():
        at, cs = 0, [int(classes[ord(c)]) for c in p]
        if 0 in cs:
            continue
        for a, b in zip(cs, cs[1:], strict=False):
            pairs[a * _CLASSES + b] = True
        for c in cs:
            at = nodes.setdefault(at * _CLASSES + c, len(nodes) + 1)
            if at == len(piece):
                piece.append(-1)
        piece[at] = i
    edges = np.array(sorted(nodes), np.int64)
    text_at = np.zeros(n + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=text_at[1:])
    return Vocabulary(log_p, classes, pairs, edges, np.array([nodes[e] for e in edges.tolist()]), np.array(piece, np.int64), byte_id, np.frombuffer(b"".join(texts), np.uint8), text_at)


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the documents' offsets among them."""
    lead = (data & 0xC0) != 0x80
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=count[1:])
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64), count[offsets]


def _lattice(v: Vocabulary, cls: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Lattices of segments ``cls[s:s + n]``: for each node the range of its incoming pieces, and of each piece the node
    it leaves, its id, and the cumulative probability of it and those before. Nodes are numbered segment by segment."""
    base = np.cumsum(lengths + 1) - (lengths + 1)
    seg = np.repeat(np.arange(len(starts)), lengths)
    inner = np.arange(len(seg)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at, left, node, state = starts[seg] + inner, lengths[seg] - inner, base[seg] + inner, np.zeros(len(seg), np.int64)
    origin, depth, froms, tos, ids = node, 0, [], [], []
    while len(at):
        key = state * _CLASSES + cls[at + depth]
        j = np.minimum(np.searchsorted(v.edges, key), len(v.edges) - 1)
        keep = v.edges[j] == key
        at, left, origin, state = at[keep], left[keep], origin[keep], v.child[j[keep]]
        depth += 1
        ends = v.piece[state] >= 0
        froms.append(origin[ends])
        tos.append(origin[ends] + depth)
        ids.append(v.piece[state[ends]])
        more = left > depth
        at, left, origin, state = at[more], left[more], origin[more], state[more]
    src, dst, piece = np.concatenate(froms), np.concatenate(tos), np.concatenate(ids)
    order = np.lexsort((src, dst))
    src, dst, piece = src[order], dst[order], piece[order]
    n_nodes = int(base[-1] + lengths[-1] + 1)
    first = np.searchsorted(dst, np.arange(n_nodes + 1))
    log_a = np.full(n_nodes, -np.inf)
    log_a[base] = 0.0
    # nodes at the same place in their segments are filtered together
    place = np.arange(n_nodes) - np.repeat(base, lengths + 1)
    by_place = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[by_place], np.arange(1, int(lengths.max()) + 2))
    share = np.empty(len(src))
    for a, b in zip(bounds, bounds[1:], strict=False):
        nodes = by_place[a:b]
        n = first[nodes + 1] - first[nodes]
        head = np.cumsum(n) - n
        e = np.arange(n.sum()) - np.repeat(head, n) + np.repeat(first[nodes], n)
        score = log_a[src[e]] + v.log_p[piece[e]]
        top = np.maximum.reduceat(score, head)
        w = np.exp(score - np.repeat(top, n))
        total = np.add.reduceat(w, head)
        log_a[nodes] = top + np.log(total)
        share[e] = w / np.repeat(total, n)
    # node by node, so that no sum depends on the segments around it
    at = first[:-1][np.diff(first) > 1] + 1
    end = first[1:][np.diff(first) > 1]
    while len(at):
        share[at] += share[at - 1]
        more = at + 1 < end
        at, end = at[more] + 1, end[more]
    return base, first, src, piece, share


def _uniform(key: np.ndarray, seg: np.ndarray, step: int, seed: int) -> np.ndarray:
    h = _text.mix(key + seg.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9) % (1 << 64)))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _exact(cls: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray, some: np.ndarray, of: np.ndarray):
    """Corrects the distinct segments ``some`` and the one of each of ``which``, found by hash, where characters differ."""
    n, model = lengths[which], some[of]
    odd = n != lengths[model]
    place = np.minimum(starts[model], len(cls) - n)  # if of another length, any place will do
    ends = np.cumsum(n)
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + COMPARED)))
        size = n[a:b]
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        differ = cls[np.repeat(starts[which[a:b]], size) + step] != cls[np.repeat(place[a:b], size) + step]
        odd[a:b] |= np.logical_or.reduceat(differ, first)
        a = b
    if odd.any():
        number: dict[bytes, int] = {}
        for i in np.flatnonzero(odd):
            own = cls[starts[which[i]] : starts[which[i]] + n[i]].tobytes()
            if own not in number:
                number[own] = len(some)
                some = np.append(some, which[i])
            of[i] = number[own]
    return some, of


def encode_chunk(v: Vocabulary, chunk: _text.Chunk, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a chunk's documents."""
    points, doc_at = _points(chunk.data, chunk.offsets)
    points = np.where(points == SPACE, 0x110001, np.where(points == 0x20, SPACE, points))
    full = np.flatnonzero(np.diff(doc_at))
    points = np.insert(points, doc_at[full], SPACE)
    sizes = np.diff(doc_at)
    sizes[full] += 1
    doc_at = np.concatenate([[0], np.cumsum(sizes)])
    if not len(points):
        return np.zeros(0, np.int32), doc_at
    cls = v.classes[points]
    cut = np.ones(len(points), bool)
    cut[1:] = ~v.pairs[cls[:-1] * _CLASSES + cls[1:]]
    cut[doc_at[:-1][sizes > 0]] = True
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.append(starts, len(points)))
    known = cls[starts] > 0
    doc = np.searchsorted(doc_at, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, doc_at)[doc]
    # distinct segments of this chunk
    prefix = _text.running(cls)
    which = np.flatnonzero(known)
    counts = np.ones(len(starts), np.int64)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    if len(which):
        _, some, of = np.unique(_text.span_hash(prefix, starts[which], starts[which] + lengths[which]), return_index=True, return_inverse=True)
        some = which[some]
        some, of = _exact(cls, starts, lengths, which, some, of)
        base, first, src, piece, cum = _lattice(v, cls, starts[some], lengths[some])
        root, node = base[of], base[of] + lengths[some][of]
        key, active, counts[which] = keys[doc[which]], np.arange(len(which)), 0
        step = 0
        while len(active):
            u = _uniform(key[active], number[which[active]], step, seed)
            at, last = first[node], first[node + 1] - 1
            while True:  # the first incoming piece whose cumulative probability passes u
                go = (at < last) & (cum[at] <= u)
                if not go.any():
                    break
                at += go
            steps.append((which[active], piece[at]))
            node = src[at]
            counts[which[active]] += 1
            more = node != root[active]
            active, node = active[more], node[more]
            step += 1
    lone = points[starts[~known]]
    raw = np.where(lone == 0x110001, SPACE, lone)
    width = 1 + (raw >= 0x80) + (raw >= 0x800) + (raw >= 0x10000)
    counts[~known] = width
    out_at = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(out_at[-1], np.int32)
    for step, (segment, chosen) in enumerate(steps):
        ids[out_at[segment + 1] - 1 - step] = chosen
    head = out_at[:-1][~known]
    for w in range(1, 5):
        of = width == w
        c = raw[of]
        for j in range(w):
            shift = 6 * (w - 1 - j)
            byte = (c >> shift) & 0x3F | 0x80 if j else (c if w == 1 else (c >> shift) | (0xF00 >> w & 0xFF))
            ids[head[of] + j] = v.byte_id[byte]
    return ids, out_at[np.searchsorted(starts, doc_at)]


def decode_ids(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of documents given by their ids; the first byte, the space in front, is dropped."""
    n = v.text_at[ids + 1] - v.text_at[ids]
    ends = np.concatenate([[0], np.cumsum(n)])
    data = v.text[np.arange(ends[-1]) - np.repeat(ends[:-1] - v.text_at[ids], n)]
    at = ends[offsets]
    full = np.diff(at) > 0
    drop = np.ones(len(data), bool)
    drop[at[:-1][full]] = False
    return data[drop], at - np.concatenate([[0], np.cumsum(full)])


def row_keys(column: pa.Array) -> np.ndarray:
    """64-bit keys of rows; null keys are one key."""
    if pa.types.is_integer(column.type):
        return _text.mix(column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64))
    out = []
    for c in _text.chunks(column.cast(pa.string())):
        out.append(_text.span_hash(c.prefix(), c.offsets[:-1], c.offsets[1:]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _kind(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _servings(keys: np.ndarray, last: tuple[int, int]) -> tuple[np.ndarray, tuple[int, int]]:
    """How many rows of the same key stand directly before each row, and (key, number) of the last. last: that of the rows
    before."""
    if not len(keys):
        return keys, last
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.arange(len(keys))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    if int(keys[0]) == last[0]:
        number[: np.append(np.flatnonzero(new)[1:], len(keys))[0]] += last[1] + 1
    return number.astype(np.uint64), (int(keys[-1]), int(number[-1]))


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", seed: int = 0, alpha: float = 1.0, carry: bool = False, servings: bool = False) -> DataFrame:
    """(key, ids, n_tokens, lossless): sampled ids of each text and whether decoding them gave the text again. Map-only.
    ``carry``: the other columns come along, but for those of these names. ``servings``: rows of one key that stand directly
    behind each other, as documents that a mix serves more than once, are sampled anew each time."""
    arrays = docs.sparkSession.sparkContext.broadcast(vars(load(model_file, alpha)))  # of the vocabulary's size, whatever the input

    def run(batches):
        v, last = Vocabulary(**arrays.value), (-1, 0)
        for batch in batches:
            keys, column = row_keys(batch.column(0)), batch.column(1)
            if servings:
                number, last = _servings(keys, last)
                keys = np.where(number > 0, _text.mix(keys + number * np.uint64(0xD6E8FEB86659FD93)), keys)
            for chunk in _text.chunks(column, limit=CHUNK):
                ids, at = encode_chunk(v, chunk, keys[chunk.rows], seed)
                data, back = decode_ids(v, ids, at)
                if np.array_equal(back, chunk.offsets) and np.array_equal(data, chunk.data):
                    same = np.ones(chunk.n, bool)
                else:
                    same = np.array([np.array_equal(data[back[i] : back[i + 1]], chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]]) for i in range(chunk.n)])
                part = slice(chunk.rows.start, chunk.rows.stop)
                null = column[part].is_null().to_numpy(zero_copy_only=False) if column.null_count else np.zeros(chunk.n, bool)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=pa.array(null) if null.any() else None)
                found = [batch.column(0)[part], lists, pa.array(np.diff(at), mask=null), pa.array(same, mask=null)]
                yield pa.RecordBatch.from_arrays([*found, *(c[part] for c in batch.columns[2:])], [*names, *others])

    names = [key, "ids", "n_tokens", "lossless"]
    others = [c for c in docs.columns if c != text and c not in names] if carry else []
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("lossless", T.BooleanType()), *(docs.schema[c] for c in others)])
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string"), *(F.col(f"`{c}`") for c in others)).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids; null ids give null text."""
    arrays = encoded.sparkSession.sparkContext.broadcast(vars(load(model_file)))

    def run(batches):
        v = Vocabulary(**arrays.value)
        for batch in batches:
            column = batch.column(1)
            null = column.is_null().to_numpy(zero_copy_only=False)
            sizes = np.where(null, 0, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            at = np.concatenate([[0], np.cumsum(sizes)])
            data, back = decode_ids(v, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at)
            texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(back.astype(np.int64)), pa.py_buffer(data.tobytes())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.compute.if_else(pa.array(~null), texts, pa.scalar(None, pa.string()))], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {_kind(encoded, key)}, text string")
