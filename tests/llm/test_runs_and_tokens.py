"""Periodic runs and token counts against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lotframe.llm import periodic_runs, token_counts

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


def brute_runs(words, least=6, times=4):
    found = []
    for q in range(1, len(words) // times + 1):
        at = q
        while at < len(words):
            if words[at] != words[at - q]:
                at += 1
                continue
            end = at
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            start, length = at - q, end - at + q
            part = words[start:end]
            smaller = any(all(part[k] == part[k - d] for k in range(d, length)) for d in range(1, q))
            if length >= max(least, times * q) and not smaller:
                found.append((start, length, q))
            at = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        len(runs),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest(),
    )


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        words = []
        while len(words) < rng.choice([0, 5, 6, 7, 30, 120]):
            block = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 12))]
            words += (block * rng.randint(1, 7))[: rng.randint(1, 60)]
        texts.append(words)
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    got = periodic_runs.periodic_runs(np.array([w for t in texts for w in t], np.int64), first)
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


def awkward(rng):
    word = lambda: "".join(rng.choice(["th", "er", "é", "漢", "😀", "'s", "1", "!", "x"]) for _ in range(rng.randint(1, 4)))
    texts = [None, "", " \n\t ", "one", "a b " * 40, "x " * 9, "l1\n" * 5 + "end", "ab cd   ²½ Ⅷ ٣ _ __ a_b can't we'll '’s", "   lead and trail   ", "<|endoftext|> in <|endoftext|><|endoftext|>text <|endoftext", "՘Ᲊ꟎ \U00010940 ₐ", "\x00\x1c\x1f\x85 a\x85b", "z" * 5000]
    for _ in range(60):
        words = [word() for _ in range(rng.choice([3, 40, 90]))]
        if rng.random() < 0.4:
            words = words[:7] * 9 + words
        texts.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    return texts


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = awkward(rng)
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[4]), (5, texts[4]), (None, texts[4]), (None, None)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, rows):
    wide = [(i, t, "clash", 1, "clash", 2) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, n_tokens string, chunk int, token string, start int").repartition(3)


def test_run_digests(frame, rows):
    got = periodic_runs.run_digests(frame).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *brute_digest(i, t))) for i, t in rows)


def test_runs_are_collapsed(frame, rows):
    got = {r["doc_id"]: r for r in periodic_runs.without_runs(frame.where("doc_id < 60")).collect()}
    for i, t in (r for r in rows[:60] if r[0] != 5):  # which other rows share
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute_runs(words)
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        assert got[i]["text"] == " ".join(w for k, w in enumerate(words) if k not in dropped)
        assert [tuple(r) for r in got[i]["runs"]] == runs


def test_a_text_of_one_word_and_a_long_one(spark):
    rng = random.Random(1)
    prose = " ".join(rng.choice(["a", "the", "of"]) + str(rng.randrange(500)) for _ in range(900_000))
    texts = ["w " * 3_000_000, prose, prose[:2_000_000] + " " + "p q r s " * 400_000]
    got = {r["doc_id"]: r for r in periodic_runs.run_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), plant=False).collect()}
    assert (got[0]["n_runs"], got[0]["start"], got[0]["length"], got[0]["period"]) == (1, 0, 3_000_000, 1)
    assert got[0]["collapsed_sha256"] == hashlib.sha256(b"w").hexdigest()
    assert got[1]["collapsed_sha256"] == hashlib.sha256(prose.encode()).hexdigest() and got[1]["n_runs"] == 0
    assert (got[2]["length"], got[2]["period"]) == (1_600_000, 4)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_runs int")
    assert periodic_runs.run_digests(none).collect() == []
    assert periodic_runs.without_runs(none).collect() == []
    assert token_counts.token_counts(none, BYTE_LEVEL).collect() == []


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_LEVEL)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize(("chunk_bytes", "shard_bytes"), [(1, 1000), (4000, 300), (1 << 25, 1 << 25)])
def test_token_counts(frame, rows, library, chunk_bytes, shard_bytes):
    got = token_counts.token_counts(frame, BYTE_LEVEL, limit=100, chunk_bytes=chunk_bytes, shard_bytes=shard_bytes).collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 100) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_pre_tokens_of_every_character(library):
    pre = token_counts.PreTokens(BYTE_LEVEL)
    points = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 512):
        text = "".join(f"a{c}1{c} {c}!{c}{c}\n{c} 's" for c in points[at : at + 512])
        cut = [text[a:b] for _, (a, b) in pre.cut.pre_tokenize_str(text)]
        assert pre.frequencies(text).total() == len(cut) and set(pre.frequencies(text)) == set(cut)


def test_long_texts_are_cut_at_borders(monkeypatch, library):
    monkeypatch.setattr(token_counts, "SPAN", 7)
    pre = token_counts.PreTokens(BYTE_LEVEL)
    rng = random.Random(5)
    for t in [t or "" for t in awkward(rng)] + ["a  b c d  e f 1 g\n\nh i " * 9]:
        found = pre.frequencies(t)
        assert sum(int(n) * c for n, c in zip(pre.pieces(list(found)), found.values(), strict=True)) == library(t)


def test_a_text_of_ten_megabytes(spark, library):
    text = ("Some words, again and 12 again. " * 40 + "\n") * 8000
    got = token_counts.token_counts(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"), BYTE_LEVEL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: library(text), 2: 2}


def test_each_distinct_pre_token_is_counted_once(monkeypatch):
    import pyarrow as pa

    asked = []

    class Fake:
        def pieces(self, tokens):
            asked.extend(tokens)
            return np.array([len(t) for t in tokens], np.int32)

    monkeypatch.setitem(token_counts._OPEN, "fake", Fake())
    packets = [["a", "bb"], ["bb", "", "ccc"], ["a"]]
    table = pa.table({"chunk": pa.array([5, 6, 7]), "shard": pa.array([2] * 3), "tokens": [token_counts._packet(p) for p in packets]})
    out = token_counts._pieces("fake")((pa.scalar(2),), table)
    assert [token_counts._unpack(x, np.int32)[0].tolist() for x in out.column("pieces").to_pylist()] == [[1, 2], [2, 0, 3], [1]] and asked == ["a", "bb", "", "ccc"]
