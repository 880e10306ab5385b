"""Exact repeats of long byte strings by prefix-free parsing, and their removal.

The strings of ``LENGTH`` bytes (windows) of all texts are to be matched without listing them.

* Parse. A rolling hash over ``K`` bytes triggers phrases: the trigger of a window is its ``K``-gram of smallest hash
  (the first, if several). A phrase is a run of windows of one trigger; neighbouring phrases overlap by LENGTH - 1 bytes,
  so that every window lies in exactly one phrase, and equal windows have equal triggers at equal places.
* Dictionary and parse order. A map task keeps the earliest occurrence of each distinct phrase it meets; later ones are
  repeats on the spot. What is kept is shuffled by trigger and sorted by (phrase, doc_id, start): the suffixes of the
  parse in order of their first phrase, ties in corpus order. No window passes the end of its phrase, so no further
  phrase of a parse suffix could decide anything, and the array is sorted to that depth. Occurrences of a phrase after
  its first are repeats whole. A trigger in two or more distinct phrases sends these phrases on; all others hold no
  repeated window.
* Dictionary suffixes. The contents of those phrases, first thinned of windows that the same task holds earlier, are
  shuffled by trigger. Each block of a task's dictionary is suffix-sorted to depth LENGTH by prefix doubling; suffixes
  equal to that depth are one window.
* Both combined give the windows in order of content, and of equal content in corpus order (``_later``): all but the
  first of a content are repeats.
* Hot triggers. A trigger with more than ``HOT_TASK`` distinct phrases in one flush of a map task has them dealt by
  (trigger, content), and a mark tells the others of that trigger; one with more than ``HOT`` in all is found by their
  task. The windows of such phrases, first thinned like the others, are dealt by their own hash and matched by two.

A passage shared by any number of documents sends at most one row per map task; no task gathers more phrases of a
trigger than ``HOT_TASK`` from each flush, nor sorts the contents of more than ``HOT``.

Defined results: null text counts as empty; texts below LENGTH bytes lose nothing; long texts are matched whole; of equal
strings the first by doc_id and start stays, so there are no ties; rows with a null doc_id take no
part and lose nothing; rows of one doc_id are versions of one document and an interval found in one applies to all,
as far as they reach (equal rows so get equal results); an empty table gives an empty result; extra columns are ignored
by ``repeat_digests`` and kept by ``without_repeats``, which names its own column so that it clashes with none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.llm import _text
from lotframe.llm._store import materialize, partitions

LENGTH = 100
K = 32
FLUSH = 1_000_000
BLOCK_BYTES = 4 << 20
PHRASE = ["kind", "kh", "sh", "doc", "lo", "hi"]
PHRASE_KIND = "kind byte, kh long, sh long, doc long, lo int, hi int"
HOT_TASK, HOT = 256, 4096
ONCE, REPEAT, LOOK, WIDE, MARK, SPREAD = 0, 1, 2, 3, 4, 5


def phrases(chunk: _text.Chunk) -> tuple[np.ndarray, ...]:
    """(trigger hash, content hash, document, first window, last window) of each phrase; windows are starts inside the document."""
    n = len(chunk.data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    prefix = chunk.prefix()
    at = np.arange(n - K + 1)
    h = _text.span_hash(prefix, at, at + K)
    low, pos, width, most = h, at.astype(np.int32), 1, LENGTH - K + 1
    while width < most:
        step = min(width, most - width)
        right = low[step:] < low[:-step]
        low, pos = np.where(right, low[step:], low[:-step]), np.where(right, pos[step:], pos[:-step])
        width += step
    edge = np.zeros(n + 1, np.int64)  # windows that would pass a document's end
    ends = chunk.offsets[1:]
    np.add.at(edge, np.maximum(chunk.offsets[:-1], ends - LENGTH + 1), 1)
    np.subtract.at(edge, ends, 1)
    whole = (np.cumsum(edge) == 0)[: len(pos)]
    change = np.ones(len(pos) + 1, bool)
    change[1:-1] = (pos[1:] != pos[:-1]) | (whole[1:] != whole[:-1])
    lo = np.flatnonzero(change[:-1] & whole)
    hi = np.flatnonzero(change[1:] & whole)
    doc = chunk.doc_of(lo)
    content = _text.mix(_text.span_hash(prefix, lo, hi + LENGTH) + (pos[lo] - lo).astype(np.uint64))
    base = chunk.offsets[doc]
    return h[pos[lo]], content, doc, lo - base, hi - base


def _runs(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, last) of the maximal runs of positions."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return (doc[first], at[first], at[last]) if len(doc) else (doc, at, at)


def _later(new: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of rows sorted by content, then corpus order: those that stand elsewhere than the first of their content, which
    ``new`` marks."""
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return ~new & ((doc != doc[first]) | (at != at[first]))


def _merge(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of windows, joined where they touch."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    number = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    reach = np.maximum.accumulate(hi + number * (1 << 40)) - number * (1 << 40)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1] + 1)
    first = np.flatnonzero(new)
    return doc[first], lo[first], reach[np.append(first[1:], len(doc)) - 1]


def _rows(kind: int | np.ndarray, kh, sh, doc, lo, hi) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int8)),
            pa.array(np.ascontiguousarray(kh).view(np.int64)),
            pa.array(np.ascontiguousarray(sh).view(np.int64)),
            pa.array(doc),
            pa.array(lo.astype(np.int32)),
            pa.array(hi.astype(np.int32)),
        ],
        PHRASE,
    )


def _repeat_rows(doc, lo, hi):
    spread = _text.mix(doc.view(np.uint64))
    return _rows(REPEAT, spread, np.zeros(len(doc), np.uint64), doc, lo, hi)


def _parse(batches):
    """The map side: phrases that are first in this task, and intervals that are not."""
    held: list[tuple] = []
    size = 0

    def flush():
        kh, sh, doc, lo, hi = (np.concatenate(x) for x in zip(*held, strict=True))
        if (doc[1:] < doc[:-1]).any():
            order = np.lexsort((lo, doc))
            kh, sh, doc, lo, hi = kh[order], sh[order], doc[order], lo[order], hi[order]
        order = np.argsort(_text.mix(kh) + sh, kind="stable")
        kh, sh, doc, lo, hi = kh[order], sh[order], doc[order], lo[order], hi[order]
        new = np.ones(len(kh), bool)
        new[1:] = (kh[1:] != kh[:-1]) | (sh[1:] != sh[:-1])
        again = _later(new, doc, lo)
        once = kh[new]
        run = np.sort(once)
        hot = np.unique(run[HOT_TASK:][run[HOT_TASK:] == run[:-HOT_TASK]])
        kind = np.where(np.isin(once, hot), SPREAD, ONCE) if len(hot) else ONCE
        yield _rows(kind, once, sh[new], doc[new], lo[new], hi[new])
        if len(hot):
            none = np.zeros(len(hot), np.int64)
            yield _rows(MARK, hot, none, none, none, none)
        if again.any():
            yield _repeat_rows(*_merge(doc[again], lo[again], hi[again]))

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for chunk in _text.chunks(batch.column(1)):
            kh, sh, doc, lo, hi = phrases(chunk)
            held.append((kh, sh, ids[chunk.rows][doc], lo, hi))
            size += len(kh)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()
    held.clear()
    _text.release()


def _whole_groups(batches, key: str):
    """Tables in which all rows of a key are together; batches come sorted by key."""
    rest: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        k = table.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1]))  # the last key may go on
        if cut == 0 and rest and rest[-1].column(key)[0].as_py() == k[-1]:
            rest.append(table)
            continue
        if rest or cut:
            yield pa.concat_tables([*rest, table.slice(0, cut)]).combine_chunks()
        rest = [table.slice(cut)]
    if rest:
        yield pa.concat_tables(rest).combine_chunks()
    _text.release()


def _dictionary(batches):
    """The reduce side of the parse: repeats of whole phrases, and phrases that share a trigger with another."""
    for table in _whole_groups(batches, "kh"):
        kind, kh, sh, doc, lo, hi = (table.column(c).to_numpy() for c in PHRASE)
        passed = kind == REPEAT
        if passed.any():
            yield _rows(REPEAT, kh[passed], sh[passed], doc[passed], lo[passed], hi[passed])
        marks = np.unique(kh[(kind == MARK) | (kind == SPREAD)])
        passed |= kind == MARK
        kh, sh, doc, lo, hi = (x[~passed] for x in (kh, sh, doc, lo, hi))
        if not len(kh):
            continue
        group = np.ones(len(kh), bool)
        group[1:] = kh[1:] != kh[:-1]
        new = group.copy()
        new[1:] |= sh[1:] != sh[:-1]
        again = _later(new, doc, lo)
        if again.any():
            yield _repeat_rows(*_merge(doc[again], lo[again].astype(np.int64), hi[again].astype(np.int64)))
        number = np.cumsum(group) - 1
        distinct = np.bincount(number, weights=new)[number]
        wide = distinct > HOT
        if len(marks):
            wide |= np.isin(kh, marks)
        shared = new & (wide | (distinct > 1))
        if shared.any():
            yield _rows(np.where(wide[shared], WIDE, LOOK), kh[shared], sh[shared], doc[shared], lo[shared], hi[shared])


def _squeeze(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, z): texts as zstandard frames, which make less to shuffle, and all other columns in ``row`` if they are to
    be carried along. Null keys stay."""

    def run(batches):
        import zstandard

        for batch in batches:
            z = zstandard.ZstdCompressor(level=1)
            frames = pa.array([z.compress(x.as_buffer()) for x in batch.column(1).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), frames, *batch.columns[2:]], ["doc_id", "z", "row"][: batch.num_columns])
            _text.release()

    columns = [F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))
    some = docs.select(*columns)
    return some.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("z", T.BinaryType()), *some.schema.fields[2:]]))


def _opened(column: pa.Array) -> list[bytes]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    return [z.decompress(x.as_buffer()) for x in column]


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Are the windows that begin at a and at b equal, byte by byte?"""
    out = np.empty(len(a), bool)
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH) if len(data) >= LENGTH else np.zeros((0, LENGTH), np.uint8)
    for k in range(0, len(a), 1 << 15):
        out[k : k + (1 << 15)] = (windows[a[k : k + (1 << 15)]] == windows[b[k : k + (1 << 15)]]).all(axis=1)
    return out


def _contents(batches):
    """Contents of phrases to look into, without the windows that this batch holds earlier; those are repeats. Of a wide
    trigger every window is a row: its hash as the key, the hash of its first half as the bytes."""
    for batch in batches:
        ids, lists = batch.column(0).to_numpy(), batch.column(2)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        kh, lo, hi, wide = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("kh", "lo", "hi", "wide"))
        first = np.append(0, np.cumsum(size))
        texts = batch.column(1)
        a = 0
        while a < len(ids):
            b, held, some = a, 0, []
            while b < len(ids) and (b == a or held < BLOCK_BYTES):
                some += _opened(texts.slice(b, 1))
                held += len(some[-1])
                b += 1
            data = np.frombuffer(b"".join(some), np.uint8)
            offsets = np.append(0, np.cumsum([len(t) for t in some]))
            chunk = _text.Chunk(slice(a, b), data, offsets)
            part = slice(first[a], first[b])
            owner = np.repeat(np.arange(a, b), size[a:b]) - a
            l, r, trigger, single = lo[part].astype(np.int64), hi[part].astype(np.int64), kh[part], wide[part]
            fits = r + LENGTH <= np.diff(offsets)[owner]  # another version of the document may be shorter
            l, r, trigger, single, owner = l[fits], r[fits], trigger[fits], single[fits], owner[fits]
            n = r - l + 1
            phrase = np.repeat(np.arange(len(l)), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + l[phrase]
            doc = ids[a:b][owner[phrase]]
            if len(phrase):
                at = offsets[owner[phrase]] + inside
                prefix = chunk.prefix()
                h = _text.span_hash(prefix, at, at + LENGTH)
                order = np.lexsort((inside, doc, h))
                new = np.ones(len(h), bool)
                new[1:] = h[order][1:] != h[order][:-1]
                again = np.flatnonzero(_later(new, doc[order], inside[order]))
                first_of = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                again = again[_same_bytes(data, at[order[again]], at[order[first_of[again]]])]  # a hash alone removes nothing
                gone = np.zeros(len(h), bool)
                gone[order[again]] = True
                dup = _runs(doc[gone], inside[gone])
                keep = ~gone & ~single[phrase]
                begin = keep.copy()
                begin[1:] &= gone[:-1] | (phrase[1:] != phrase[:-1])
                close = keep.copy()
                close[:-1] &= gone[1:] | (phrase[1:] != phrase[:-1])
                begin, close = np.flatnonzero(begin), np.flatnonzero(close)
                raw = data.tobytes()
                alone = np.flatnonzero(~gone & single[phrase])
                if len(alone):
                    half = np.ascontiguousarray(_text.span_hash(prefix, at[alone], at[alone] + LENGTH // 2))
                    start = pa.array(inside[alone].astype(np.int32))
                    halves = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(alone), [None, pa.py_buffer(half)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(h[alone].view(np.int64)), pa.array(doc[alone]), start, start, halves], ["kh", "doc", "lo", "hi", "bytes"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([trigger[phrase[begin]], _text.mix(dup[0].view(np.uint64)).view(np.int64)])),
                        pa.array(np.concatenate([doc[begin], dup[0]])),
                        pa.array(np.concatenate([inside[begin], dup[1]]).astype(np.int32)),
                        pa.array(np.concatenate([inside[close], dup[2]]).astype(np.int32)),
                        pa.array([raw[x : y + LENGTH] for x, y in zip(at[begin], at[close], strict=True)] + [None] * len(dup[0]), pa.binary()),
                    ],
                    ["kh", "doc", "lo", "hi", "bytes"],
                )
            a = b
        _text.release()


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of ``data`` by their first ``depth`` (8 or more) bytes, equal for equal ones; by prefix doubling.
    The last depth - 1 positions have no rank."""
    n = len(data) - 7
    word = np.zeros(n, np.uint64)
    for j in range(8):
        word = word << np.uint64(8) | data[j : j + n].astype(np.uint64)
    rank, width = np.unique(word, return_inverse=True)[1].astype(np.uint64), 8
    while width < depth:
        step = min(width, depth - width)
        rank = np.unique(rank[:-step] << np.uint64(32) | rank[step:], return_inverse=True)[1].astype(np.uint64)
        width += step
    return rank


def _suffixes(batches):
    """Repeated windows among the contents of phrases with equal triggers, and among the windows of wide ones."""
    for table in _whole_groups(batches, "kh"):
        empty = table.column("bytes").is_null().to_numpy()
        doc, lo, hi, kh = (table.column(c).to_numpy() for c in ("doc", "lo", "hi", "kh"))
        if empty.any():
            yield _repeat_rows(doc[empty], lo[empty], hi[empty])
        contents = table.column("bytes").combine_chunks()
        alone = pc.fill_null(pc.equal(pc.binary_length(contents), 8), False).to_numpy(zero_copy_only=False)
        if alone.any():
            some = contents.filter(pa.array(alone))
            half = np.frombuffer(b"".join(some.to_pylist()), np.int64)
            h, d, at = kh[alone], doc[alone], lo[alone].astype(np.int64)
            order = np.lexsort((at, d, half, h))
            h, half, d, at = h[order], half[order], d[order], at[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (half[1:] != half[:-1])
            again = _later(new, d, at)
            if again.any():
                yield _repeat_rows(*_runs(d[again], at[again]))
        parts = ~empty & ~alone
        number = np.cumsum(np.append(0, kh[1:] != kh[:-1]))
        use = np.flatnonzero(parts & (np.bincount(number, weights=parts)[number] > 1))
        sizes = (hi - lo + LENGTH).astype(np.int64)
        total, a = np.append(0, np.cumsum(sizes[use])), 0
        while a < len(use):
            b = max(a + 1, int(np.searchsorted(total, total[a] + BLOCK_BYTES)) - 1)
            while b < len(use) and kh[use[b]] == kh[use[b - 1]]:  # a trigger's phrases stay together
                b += 1
            block = use[a:b]
            data = np.frombuffer(b"".join(contents.take(pa.array(block)).to_pylist()), np.uint8)
            n = (hi - lo + 1)[block].astype(np.int64)
            phrase = np.repeat(np.arange(len(block)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rank = suffix_ranks(data, LENGTH)[(np.cumsum(sizes[block]) - sizes[block])[phrase] + step]
            d, at = doc[block][phrase], lo[block][phrase] + step
            order = np.lexsort((at, d, rank))
            new = np.ones(len(order), bool)
            new[1:] = rank[order][1:] != rank[order][:-1]
            d, at = d[order], at[order]
            again = _later(new, d, at)
            if again.any():
                yield _repeat_rows(*_runs(d[again], at[again]))
            a = b


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, lo, hi): intervals of window starts whose windows also start earlier in the corpus; they may overlap."""
    n = partitions(docs.sparkSession)
    some = docs.where("doc_id is not null")
    parsed = some.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_parse, PHRASE_KIND)
    place = F.when(F.col("kind") == SPREAD, F.col("kh").bitwiseXOR(F.col("sh"))).otherwise(F.col("kh"))
    dealt = parsed.repartition(n, place).sortWithinPartitions("kh", "sh", "doc", "lo")
    known = materialize(dealt.mapInArrow(_dictionary, PHRASE_KIND), "phrases")
    look = F.struct("kh", "lo", "hi", (F.col("kind") == WIDE).alias("wide"))
    looks = known.where(F.col("kind").isin(LOOK, WIDE)).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(look).alias("looks"))
    contents = _squeeze(some).join(looks, "doc_id").select("doc_id", "z", "looks").mapInArrow(_contents, "kh long, doc long, lo int, hi int, bytes binary")
    sorted_out = contents.repartition(n, "kh").sortWithinPartitions("kh").mapInArrow(_suffixes, PHRASE_KIND)
    return known.where(F.col("kind") == REPEAT).select("doc", "lo", "hi").union(sorted_out.select("doc", "lo", "hi"))


def _with_repeats(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, z, found[, row]): every row with its document's intervals."""
    found = repeated_windows(docs).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    return _squeeze(docs, carry).join(found, "doc_id", "left").select("doc_id", "z", "found", *["row"] * carry)


def removed_spans(size: int, found: list | None) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes of a text."""
    out: list[list[int]] = []
    for lo, hi in sorted(found or ()):
        end = min(hi + LENGTH, size)
        if lo >= end:
            continue
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [tuple(x) for x in out]


def _each(batch: pa.RecordBatch):
    for text, found in zip(_opened(batch.column(1)), batch.column(2), strict=True):
        spans = removed_spans(len(text), [(x["lo"], x["hi"]) for x in found.as_py()] if found.is_valid else None)
        kept, at = [], 0
        for a, b in spans:
            kept.append(text[at:a])
            at = b
        yield text, spans, b"".join([*kept, text[at:]]) if spans else text


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256, one row a document."""

    def run(batches):
        for batch in batches:
            rows = [(len(t), len(t) - len(k), len(s), hashlib.sha256(k).hexdigest()) for t, s, k in _each(batch)]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    return _with_repeats(docs).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes cut out of ``text``, and ``removed_spans`` (byte offsets). Bytes of a
    character cut in two go with it. All other columns stay as they are."""
    columns = [c for c in docs.columns if c != "text"]
    name = "removed_spans"
    while name in columns:
        name = f"_{name}"

    def run(batches):
        for batch in batches:
            rows = [(k.decode("utf-8", "ignore"), [{"start": a, "end": b} for a, b in s]) for _, s, k in _each(batch)]
            texts, spans = zip(*rows, strict=True) if rows else ((), ())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(texts, pa.string()), pa.array(spans, kind)], ["row", "text", "spans"])

    found = _with_repeats(docs, carry=True)
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = found.mapInArrow(run, T.StructType([found.schema["row"], T.StructField("text", T.StringType()), T.StructField("spans", spans)]))
    return out.select(*(F.col(f"row.`{c}`") if c != "text" else F.col("text") for c in docs.columns), F.col("spans").alias(name))
