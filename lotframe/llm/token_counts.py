"""Token counts of texts, made from counts of their pre-tokens.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its pre-tokens have pieces. Each task
cuts its texts into pre-tokens and writes, for every ``CHUNK_BYTES`` of text, the frequencies of each document as numbers
into the distinct pre-tokens of the chunk, and these in packets by shard of their hash. A shard brings together what all
chunks hold of its pre-tokens, so that the pieces of each distinct one are counted once in the whole corpus; the counts
are joined to the chunks, where a document's tokens are the sum of pieces times frequency. No list of token ids is ever
made of a text.

A pre-token that is everywhere is sent once a chunk, not once a document, so no shard is hot; their number follows the
corpus (``SHARD_BYTES``), and a chunk sends packets only to shards of which it holds something, so there are never more of
them than distinct pre-tokens of all chunks. Texts are cut at a space between two ASCII letters every ``SPAN`` characters,
which is always a border of pre-tokens.

Which characters are letters, numbers and white space is asked of the tokenizer itself, once a worker, for the first
65,536 code points; sections with characters beyond them are cut by the tokenizer's own pre-tokenizer.

Defined results: a null text counts as empty and has 0 bytes and 0 tokens; strings of special tokens inside a text are one
token each, as is the library's default; no begin, end or padding token is counted, and nothing is truncated, whatever
the file says; repeated rows get equal results; there are no ties to break; rows with a null doc_id are counted like
others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotframe.llm import _text
from lotframe.llm._store import materialize
from lotframe.llm.language_model import _pack, _unpack

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 32 << 20
SPAN = 1 << 20
LIMIT = 1024
#: Distinct pre-tokens whose pieces are counted in one call of the library.
BATCH = 2048
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
_OPEN: dict = {}


class PreTokens:
    """A tokenizer file of byte-level BPE, with a pattern that cuts texts as its pre-tokenizer does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.cut = self.tokenizer.pre_tokenizer
        special = self.tokenizer.get_added_tokens_decoder().values()
        if not isinstance(self.cut, ByteLevel) or not self.cut.use_regex or self.cut.add_prefix_space or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path}: a byte-level tokenizer without normalizer and prefix space is needed")
        if any(t.lstrip or t.rstrip or t.single_word for t in special):
            raise ValueError(f"{path}: added tokens that take neighbours with them are not supported")
        longest_first = sorted((t.content for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.pattern = self._pattern()
        self.known = re.compile("[\\u0000-\\uffff]*").fullmatch

    def _pattern(self) -> re.Pattern:
        """The pre-tokenizer's rule with its character classes as it shows them: a character of a class shows no border
        behind a letter, a digit or a mark."""
        points = [c for c in range(1 << 16) if not 0xD800 <= c < 0xE000]
        probe = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}\n\n" for c in points)
        borders = {b for _, (_, b) in self.cut.pre_tokenize_str(probe)}
        ranges: dict[str, list[list[int]]] = {"letter": [], "number": [], "mark": [], "space": []}
        for i, c in enumerate(points):
            at = 8 * i
            kind = "letter" if at + 1 not in borders else "number" if at + 3 not in borders else "mark" if at + 5 not in borders else "space"
            if ranges[kind] and ranges[kind][-1][1] == c - 1:
                ranges[kind][-1][1] = c
            else:
                ranges[kind].append([c, c])
        letter, number, mark, space = ("".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in r) for r in ranges.values())
        return re.compile(f"'(?:[sdmt]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[{mark}]+|[{space}]+(?![^{space}])|[{space}]+")

    def frequencies(self, text: str) -> Counter:
        """How often each pre-token occurs; a special token counts as one."""
        found: Counter = Counter()
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            found[m[0]] += 1
            self._count(text, at, m.start(), found)
            at = m.end()
        self._count(text, at, len(text), found)
        return found

    def _count(self, text: str, at: int, end: int, found: Counter) -> None:
        while at < end:
            cut = _CUT.search(text, at + SPAN, end) if end - at > SPAN else None
            to = cut.start() if cut else end
            part = text[at:to]
            if self.known(part):
                found.update(self.pattern.findall(part))
            else:
                found.update(part[a:b] for _, (a, b) in self.cut.pre_tokenize_str(part))
            at = to

    def pieces(self, tokens: list[str]) -> np.ndarray:
        """How many pieces each pre-token has."""
        out = [len(e) for at in range(0, len(tokens), BATCH) for e in self.tokenizer.encode_batch_fast(tokens[at : at + BATCH], add_special_tokens=False)]
        return np.array(out, np.int32)


def _opened(path: str) -> PreTokens:
    if path not in _OPEN:
        _OPEN[path] = PreTokens(path)
    return _OPEN[path]


CHUNKS = "chunk long, shard int, tokens binary, documents binary, entries binary"


def _packet(tokens: list[str]) -> bytes:
    import zstandard

    raw = [t.encode() for t in tokens]
    sizes = _pack(np.array([len(t) for t in raw], np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level=1).compress(b"".join(raw))


def _unpacked(packet: bytes) -> list[str]:
    import zstandard

    at = 4 + int.from_bytes(packet[:4], "little")
    ends = np.cumsum(_unpack(packet[4:at], np.uint32)[0], dtype=np.int64)
    raw = zstandard.ZstdDecompressor().decompress(packet[at:])
    return [raw[a:b].decode() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class _Chunk:
    """The distinct pre-tokens of some documents and how often each document holds them."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.index: defaultdict = defaultdict()
        self.index.default_factory = self.index.__len__
        self.rows, self.at, self.often = [array("q") for _ in range(4)], array("i"), array("i")

    def add(self, doc_id: int | None, n_bytes: int, found: Counter) -> None:
        self.at.extend([self.index[t] for t in found])
        self.often.extend(found.values())
        for column, x in zip(self.rows, (doc_id or 0, doc_id is None, n_bytes, len(found)), strict=True):
            column.append(x)
        self.size += n_bytes

    def written(self, shards: int) -> pa.RecordBatch:
        """A row of (doc_id, no id, bytes, entries) of each document and (pre-token, frequency) of each entry, and one of
        pre-tokens for each shard concerned. Pre-tokens are numbered by shard."""
        tokens = list(self.index)
        shard = np.array([zlib.crc32(t.encode()) % shards for t in tokens], np.int64)
        order = np.argsort(shard, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        entries = _pack(number[np.frombuffer(self.at, np.int32)] if len(order) else np.zeros(0, np.int32), np.frombuffer(self.often, np.int32))
        rows = [(self.number, -1, None, _pack(*(np.frombuffer(a, np.int64) for a in self.rows)), entries)]
        some, first = np.unique(shard[order], return_index=True)
        for s, a, b in zip(some.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
            rows.append((self.number, s, _packet([tokens[i] for i in order[a:b].tolist()]), None, None))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "shard", "tokens", "documents", "entries"])


def _chunked(path: str, chunk_bytes: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, chunk = _opened(path), _Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                n_bytes = len(text.as_buffer()) if text.is_valid else 0
                chunk.add(doc_id.as_py(), n_bytes, pre.frequencies(text.as_py() or ""))
                if chunk.size >= chunk_bytes:
                    yield chunk.written(shards)
                    chunk = _Chunk(chunk.number + 1)
        if len(chunk.rows[0]):
            yield chunk.written(shards)
        _text.release()

    return run


def _pieces(path: str):
    """A shard's rows (chunk, shard, pieces): each distinct pre-token is counted once, and every chunk gets its own."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        held = [_unpacked(x.as_py()) for x in table.column("tokens")]
        index: dict = {}
        for tokens in held:
            for t in tokens:
                index.setdefault(t, len(index))
        n = _opened(path).pieces(list(index))
        answers = [_pack(n[[index[t] for t in tokens]]) for tokens in held]
        return pa.table([table.column("chunk").combine_chunks(), pa.array([key[0].as_py()] * len(held), pa.int32()), pa.array(answers, pa.binary())], names=["chunk", "shard", "pieces"])

    return run


COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _summed(limit: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = sorted(zip(right.column("shard").to_pylist(), right.column("pieces").to_pylist(), strict=True))
        n = np.concatenate([np.zeros(0, np.int32), *(_unpack(x, np.int32)[0] for _, x in answers)]).astype(np.int64)
        doc_id, no_id, n_bytes, kinds = _unpack(left.column("documents")[0].as_py(), *[np.int64] * 4)
        at, often = _unpack(left.column("entries")[0].as_py(), np.int32, np.int32)
        total = _text.per_doc(n[at] * often, np.append(0, np.cumsum(kinds)))
        return pa.table([pa.array(doc_id, mask=no_id > 0), pa.array(n_bytes), pa.array(total), pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether they are more than ``limit``, one row a document. ``tokenizer``: the path of a
    byte-level tokenizer file, the same on all machines."""
    shards = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes + 1
    chunks = materialize(docs.select("doc_id", "text").mapInArrow(_chunked(tokenizer, chunk_bytes, shards), CHUNKS), "frequencies")
    counts = chunks.where("shard >= 0").select("chunk", "shard", "tokens").groupBy("shard").applyInArrow(_pieces(tokenizer), "chunk long, shard int, pieces binary")
    own = chunks.where("shard < 0").select("chunk", "documents", "entries")
    return own.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_summed(limit), COUNTED)
