"""The operators as queries over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotframe.llm import conversation_trie, html_text, language_model, mixing, near_duplicates, periodic_runs, quality_model, quality_rules, repeats, sentencepiece, sharding, token_counts, vector_search

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(_read(spark, sf_dir, "documents"), PIECES)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(_read(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(_read(spark, sf_dir, "documents"))


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(_read(spark, sf_dir, "embeddings"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_read(spark, sf_dir, "documents")).drop("class_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = quality_rules.quality_ledger(_read(spark, sf_dir, "documents"))
    return table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(_read(spark, sf_dir, "conversations"), exchange=(100, 5))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_read(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), BYTE_LEVEL)


def ablation_of_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy rejects, and what it alone does."""
    return quality_rules.ablation(quality_rules.quality_ledger(_read(spark, sf_dir, "documents")))


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
    SELECT doc_id, unnest(list_transform(range(0, len(h) // 2 - 99), lambda s: {'s': s, 'm': md5_number(substr(h, 2 * s + 1, 200))})) AS x FROM d WHERE len(h) >= 200
), k AS (
    SELECT doc_id, x.s AS s, row_number() OVER (PARTITION BY x.m ORDER BY doc_id, x.s) AS r FROM w
), p AS (
    SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM k WHERE r > 1
), g AS (
    SELECT doc_id, s, sum(CASE WHEN s <= p + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM p
), spans AS (
    SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY doc_id, g
), n AS (
    SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM spans
)
SELECT doc_id, (any_value(len(h)) // 2)::BIGINT AS n_bytes, coalesce(sum(b - a), 0)::BIGINT AS n_removed, count(a)::BIGINT AS n_spans,
    sha256(unhex(coalesce(substr(any_value(h), 1, 2 * min(a)) || string_agg(substr(h, 2 * b + 1, 2 * (coalesce(next, len(h) // 2) - b)), '' ORDER BY a), any_value(h)))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""

#: The article of the driver's pages, whose furniture stands outside of it.
OP6_SQL = r"""
WITH a AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) AS h FROM pages
), t AS (
    SELECT page_id, url, regexp_replace(regexp_replace(h, '(?s)<!--.*?-->', '', 'g'), '</?(b|i|a|em|strong|span|code)( [^>]*)?>', '', 'g') AS h FROM a
), p AS (
    SELECT page_id, url, regexp_replace(h, '<[^>]*>', ' ', 'g') AS h FROM t
), d AS (
    SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(replace(h, '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS h FROM p
), w AS (
    SELECT page_id, url, trim(regexp_replace(h, '\s+', ' ', 'g')) AS text FROM d
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM w
"""

OP7_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: md5_number(array_to_string(w[i:i + 2], ' '))) WHEN len(w) > 0 THEN [md5_number(array_to_string(w, ' '))] ELSE [] END) AS x FROM d
), n AS (
    SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM pairs JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * c >= 85 * (nu.n + nv.n - c)
), e AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, e.v FROM reach JOIN e ON e.u = reach.r
), comp AS (
    SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)
"""

OP9_SQL = r"""
WITH sized AS (
    SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source_key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':mix') AS o
    FROM documents
), sources AS (
    SELECT no_source, source_key, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL
), ranked AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY no_source, source_key) - 1) % 3 + 1)::INT] AS weight,
           row_number() OVER (ORDER BY no_source, source_key) AS pos
    FROM sources
), filled AS (
    SELECT *, source_size * 2 AS cap, (source_size * 2)::DOUBLE / weight AS fill FROM ranked
), leveled AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(cap) OVER (ORDER BY fill, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY fill, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
    FROM filled
), water AS (
    SELECT arg_min(level, (fill, pos)) FILTER (WHERE level <= fill) AS water FROM leveled
), targets AS (
    SELECT no_source, source_key, source_size, least(cap::DOUBLE, coalesce(water * weight, cap::DOUBLE)) AS target FROM leveled CROSS JOIN water
), served AS (
    SELECT *, sum(size) OVER (PARTITION BY no_source, source_key ORDER BY o, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS before,
        floor(sum(size) OVER () * 1.5)::BIGINT AS budget
    FROM sized JOIN targets USING (no_source, source_key)
), passes AS (
    SELECT *, r * source_size + before AS begin FROM served, range(0, 2) AS x(r)
), cut AS (
    SELECT *, CASE WHEN begin < target AND begin + size > target THEN least(size, 4096) ELSE 1 END AS pieces FROM passes
), pieces AS (
    SELECT *, unnest(range(0, pieces)) AS j FROM cut
), words AS (
    SELECT *, size * (j + 1) // pieces - size * j // pieces AS words, CASE WHEN target > 0 THEN (begin + size * (j + 1) // pieces)::DOUBLE / target END AS finish FROM pieces
), total AS (
    SELECT *, sum(words) OVER (ORDER BY finish NULLS LAST, no_source, source_key, o, size, r, j ROWS UNBOUNDED PRECEDING)::BIGINT - words AS so_far FROM words
)
SELECT doc_id, size, source_size, target, sum(greatest(0, least(words, budget - so_far)))::BIGINT AS taken, max(CASE WHEN r = 0 THEN finish END) AS virtual_finish
FROM total GROUP BY ALL
"""

OP10_SQL = r"""
WITH base AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), spots AS (
    SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8
), grams AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS n FROM spots
), covered AS (
    SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM grams, range(0, 8) AS x(j) WHERE n > 1 GROUP BY r
), lines AS (
    SELECT r, unnest(string_split(t, chr(10))) AS line FROM base
), dup AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
           length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
    FROM base LEFT JOIN covered USING (r) LEFT JOIN dup USING (r)
), bits AS (
    SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (100 * n_symbols > 20 * n_words)::INT
        + 8 * (n_letters >= 50 AND 100 * n_upper > 60 * n_letters)::INT + 16 * (100 * n_marks > 30 * n_words)::INT
        + 32 * (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)::INT
        + 64 * (n_words > 0 AND (word_chars > 25 * n_words OR 2 * word_chars < 3 * n_words))::INT)::BIGINT AS fail_bits
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM bits
"""

OP11_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, id, length(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id) AS place FROM t
), c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
            lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 6 AS h
    FROM own GROUP BY conv_id
), turns AS (
    SELECT c.conv_id, place, id, chars FROM c JOIN own ON own.conv_id = c.base AND place <= h
    UNION ALL
    SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + place - c.h, id, chars FROM c JOIN own USING (conv_id) LEFT JOIN c b ON b.conv_id = c.base WHERE place > c.h
), s AS (
    SELECT conv_id, coalesce(ids, []) AS ids, coalesce(chars, []) AS chars
    FROM c LEFT JOIN (SELECT conv_id, list(id ORDER BY place) AS ids, list(chars ORDER BY place) AS chars FROM turns GROUP BY conv_id) USING (conv_id)
), paths AS (
    SELECT conv_id, d, md5(array_to_string(ids[1:d], '')) AS node, d = len(ids) AS ends, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM s)
), nodes AS (
    SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, bool_and(ends) AS leaf,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM paths GROUP BY node, d
), inside AS (
    SELECT DISTINCT a.node AS top, a.d AS top_depth, b.node FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d >= a.d
), sums AS (
    SELECT top AS node, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens, count(*) FILTER (depth = top_depth + 1) AS n_children
    FROM inside JOIN nodes USING (node) GROUP BY top
), above AS (
    SELECT DISTINCT a.node, b.node AS parent FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d = a.d - 1
)
SELECT nodes.conv_id, nodes.depth, p.conv_id AS parent_conv_id, nodes.n_convs, n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN above USING (node) LEFT JOIN nodes p ON p.node = parent
"""

_RULES = ", ".join(f"('{r.name}', {1 << i})" for i, r in enumerate(quality_rules.RULES))
ABLATION_SQL = f"""
WITH l AS ({OP10_SQL}), r(rule, bit) AS (VALUES {_RULES})
SELECT rule, count(*) FILTER (WHERE fail_bits & bit <> 0) AS n_failed, count(*) FILTER (WHERE fail_bits = bit) AS n_only FROM l CROSS JOIN r GROUP BY rule
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_suffix_repeats": op4_suffix_repeats,
    "op5_top_k_search": op5_top_k_search,
    "op6_html_extraction": op6_html_extraction,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_counts": op13_token_counts,
    "ablation_of_quality_rules": ablation_of_quality_rules,
}
ORACLE_SQL: dict[str, str] = {"op4_suffix_repeats": OP4_SQL, "op5_top_k_search": OP5_SQL, "op6_html_extraction": OP6_SQL, "op7_near_duplicates": OP7_SQL, "op9_mixing": OP9_SQL, "op10_quality_rules": OP10_SQL, "op11_conversation_trie": OP11_SQL, "ablation_of_quality_rules": ABLATION_SQL}
