"""Quality rules as a bitmask ledger.

``measure`` reads every text once and stores plain measurements; ``ledger`` evaluates every rule once on them and packs
the failures into one integer per document. Policies are versioned masks over that integer, so changing a policy,
comparing two of them or finding what one rule alone rejects (``ablation``) is bitwise aggregation of a narrow table
and reads no text again.

Defined results: a null text counts as empty (all measurements 0); long texts are measured whole; a measurement at a
rule's bound passes it, so there are no ties; an empty table gives an empty result; repeated rows
give repeated results; extra columns of the input are ignored, and a clash with a measurement's name is harmless
because only the key and the text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.llm import _text

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _MARK = _table(SYMBOLS), _table(MARKS)
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes([*range(65, 91), *range(97, 123)]))


def _repeated(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """True for items whose (document, hash) is found twice or more."""
    order = np.argsort(_text.mix(hashed + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), kind="stable")
    d, h = doc[order], hashed[order]
    same = np.zeros(len(d), bool)
    if len(d):
        equal = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
        same[1:] |= equal
        same[:-1] |= equal
    out = np.empty(len(d), bool)
    out[order] = same
    return out


def _measure(chunk: _text.Chunk, window: int) -> list[np.ndarray]:
    data, offsets = chunk.data, chunk.offsets
    solid, prefix = _text.inside(chunk), chunk.prefix()
    w = _text.words(chunk, solid)
    h = _text.span_hash(prefix, w.starts, w.ends)
    doc, at = _text.runs(w.counts, window)
    hit = at[_repeated(doc, _text.window_hash(h, at, window))]
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.subtract.at(cover, hit + window, 1)
    covered = np.cumsum(cover)[:-1] > 0
    # lines: between newlines and the ends of documents
    newline = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([newline, newline + 1, offsets]))
    start, end = edges[:-1], edges[1:]
    held = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=held[1:])
    line = held[end] > held[start]
    start, end = start[line], end[line]
    line_doc = chunk.doc_of(start)
    line_hash = _text.span_hash(prefix, start, end)
    order = np.lexsort((line_hash, line_doc))
    d, x = line_doc[order], line_hash[order]
    again = np.zeros(len(d), np.int64)
    again[1:] = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    n_lines = np.bincount(line_doc, minlength=chunk.n)
    return [
        w.counts,
        _text.per_doc(solid & ((data & 0xC0) != 0x80), offsets),
        _text.per_doc(_SYMBOL[data], offsets),
        np.bincount(d, weights=again, minlength=chunk.n).astype(np.int64),
        _text.per_doc(covered, w.first),
        n_lines,
        _text.per_doc(_UPPER[data], offsets),
        _text.per_doc(_LETTER[data], offsets),
        _text.per_doc(_MARK[data], offsets),
    ]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 8) -> DataFrame:
    """One row of ``MEASURES`` (all long) for each row of ``docs``; map-only, no shuffle."""

    def run(batches):
        for batch in batches:
            parts = [_measure(c, window) for c in _text.chunks(batch.column(1))]
            columns = [np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(len(MEASURES))] if parts else []
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], [key, *MEASURES])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A named rule: ``fails`` is a condition on the measurements."""

    name: str
    fails: str


#: In order of their bits. The first two are the base rules.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_heavy", "100 * n_symbols > 20 * n_words"),
    Rule("shouting", "n_letters >= 50 AND 100 * n_upper > 60 * n_letters"),
    Rule("mark_heavy", "100 * n_marks > 30 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("odd_word_length", "n_words > 0 AND (word_chars > 25 * n_words OR 2 * word_chars < 3 * n_words)"),
)

#: Policies by version: the rules whose failure rejects a document. Versions are never edited, only added.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "2024.1": ("too_few_words", "repeated_windows", "symbol_heavy", "shouting", "mark_heavy", "repeated_lines", "odd_word_length"),
}


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    at = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << at[n] for n in names)


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``fail_bits``: bit i is set where rule i fails."""
    bits: Column = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def apply_policy(table: DataFrame, policy: str = "2024.1", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds base_failed, policy and kept; kept is false wherever a base rule fails."""
    base, mask = mask_of(POLICIES["base"], rules), mask_of(POLICIES[policy], rules)
    return table.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(base)) != 0,
            "policy": F.lit(policy),
            "kept": F.col("fail_bits").bitwiseAND(F.lit(base | mask)) == 0,
        }
    )


def ablation(table: DataFrame, policy: str = "2024.1", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, and documents that only it rejects. One aggregation of
    distinct bit patterns (at most 2 ** rules rows), then bitwise arithmetic on those."""
    mask = mask_of(POLICIES[policy], rules)
    patterns = table.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    stats = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(rules) if mask >> i & 1)))
    return (
        patterns.select("bits", "n", stats.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def quality_ledger(docs: DataFrame, policy: str = "2024.1") -> DataFrame:
    return apply_policy(ledger(measure(docs)), policy)


def passing_documents(docs: DataFrame, policy: str = "2024.1") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns; map-only."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return apply_policy(ledger(measure(whole, key="row")), policy).where("kept").select("row.*")
