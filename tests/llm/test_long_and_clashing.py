"""Texts of ten megabytes, ties, and columns whose names clash, through the operators at once."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lotframe.llm import language_model, near_duplicates, quality_rules, repeats, vector_search


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(40_000)]
    text = " ".join(rng.choice(words) for _ in range(1_500_000))
    assert len(text) > 10_000_000
    rows = [(1, text), (2, text + " end"), (3, "short one"), (4, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), text


def test_a_long_text_in_the_repeats(long_docs):
    docs, text = long_docs
    got = {r["doc_id"]: r for r in repeats.repeat_digests(docs).collect()}
    assert (got[1]["n_removed"], got[1]["kept_sha256"]) == (0, hashlib.sha256(text.encode()).hexdigest())
    assert (got[2]["n_removed"], got[2]["n_spans"], got[2]["kept_sha256"]) == (len(text), 1, hashlib.sha256(b" end").hexdigest())


def test_a_long_text_in_scores_links_and_rules(long_docs):
    docs, text = long_docs
    n = text.count(" ") + 1
    scores = {r["doc_id"]: r for r in language_model.score_documents(docs).collect()}
    assert (scores[1]["n_tokens"], scores[2]["n_tokens"], scores[4]["n_tokens"]) == (n + 1, n + 2, 1)
    links = {r["doc_id"]: r for r in near_duplicates.near_duplicates(docs).collect()}
    assert links[2]["component_id"] == 1 and links[1]["kept"] and not links[2]["kept"] and links[3]["kept"]
    rules = {r["doc_id"]: r for r in quality_rules.quality_ledger(docs).collect()}
    assert rules[1]["n_words"] == n and rules[1]["word_chars"] == len(text) - n + 1


def test_vectors_with_clashing_columns_and_ties(spark):
    names = "v cell part questions pivot ring annulus chunks score rank query_id least towards distance".split()
    rows = [(i, [float(i % 3), 1.0]) for i in range(120)] + [(7, [1.0, 1.0])] * 3
    plain = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    wide = plain.withColumns({n: F.lit("clash") for n in names})
    got = sorted(map(tuple, vector_search.top_k(wide, pivots=4, chunk=16).collect()))
    assert got == sorted(map(tuple, vector_search.top_k(plain).collect()))
    for q in {r[0] for r in got}:
        mine = [r for r in got if r[0] == q]
        vector = {i: [256 * int(x[0]), 256] for i, x in rows}
        best = sorted(((-sum(a * b for a, b in zip(vector[q], vector[i], strict=True)), i) for i in vector if i != q))[:5]
        assert [(r[2], r[3]) for r in mine] == [(i, -s) for s, i in best]
