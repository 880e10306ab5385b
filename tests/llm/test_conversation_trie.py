"""The prefix trie of conversations against a trie built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lotframe.llm import conversation_trie

KIND = "conv_id long, turn long, role string, text string, depth string, id int, n_turns int"


def brute(rows, exchange=(100, 5)):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), role or "", digest, text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(turns)] for c, turns in own.items()}
    if exchange:
        h = {c: zlib.crc32(str(c).encode()) % (exchange[1] + 1) for c in own}
        base = {c: c - (abs(c) % exchange[0] if c >= 0 else -(abs(c) % exchange[0])) for c in own}
        rebuilt = {c: own.get(base[c], [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}
    else:
        rebuilt = own
    members, ends, children = defaultdict(set), defaultdict(set), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].add(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return {
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    }


def conversations(seed, n=260, longest=14, roles=("user", "assistant", None)):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        conv = rng.choice([c, c, c + 10_000, -c])
        for turn in range(rng.choice([1, 2, 5, longest])):
            rows.append((conv, rng.choice([turn, turn, turn, None, 1]), rng.choice(roles), rng.choice(["a", "a", "b", "ä漢", "", None])))
    return rows + rows[:5]


def built(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], KIND).repartition(3)
    return conversation_trie.prefix_trie(frame, **options)


NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


@pytest.mark.parametrize(("seed", "width", "deep", "exchange"), [(1, 8, 32, (100, 5)), (2, 3, 2, (100, 5)), (3, 2, 5, None)])
def test_nodes(spark, seed, width, deep, exchange):
    rows = conversations(seed)
    got = built(spark, rows, width=width, deep=deep, exchange=exchange).select(*NAMES).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows, exchange)


def test_copies_of_a_long_conversation(spark):
    """A third of the members share one long conversation, and one conversation has a third of all turns."""
    rng = random.Random(4)
    rows = [(c, t, "user", f"turn {t}") for c in range(30) for t in range(45 + c % 3)]
    rows += [(100 + c, t, "user", rng.choice("abc")) for c in range(60) for t in range(4)]
    rows += [(500, t, "user", f"turn {t}" if t < 41 else f"own {t}") for t in range(900)]
    got = built(spark, rows).select(*NAMES).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows, None)


def test_ends_of_many_buckets(spark):
    rows = [(c * 97 - 40_000, 0, "user", "same") for c in range(1500)]
    got = {tuple(r) for r in built(spark, rows, exchange=(100, 5)).select(*NAMES).collect()}
    assert got == brute(rows)


def test_turns_are_numbered_across_ranges(spark):
    rows = [(7 if k % 3 else k, k, "r", "x") for k in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = conversation_trie.numbered_turns(frame).groupBy("conv_id").agg({"place": "max", "id": "count"}).collect()
    want = {c: sum(r[0] == c for r in rows) for c, *_ in rows}
    assert {r[0]: (r[1], r[2]) for r in got} == {c: (n, n) for c, n in want.items()}


def test_empty_and_null(spark):
    assert built(spark, []).collect() == []
    rows = [(None, 0, "user", "x"), (1, None, None, None)]
    assert {tuple(r) for r in built(spark, rows).select(*NAMES).collect()} == brute(rows, None)
