"""SQL for the queries that it can express, for DuckDB over the same tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, text, w, len(w) AS n_words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls,
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] AS g FROM t),
p AS (SELECT doc_id, unnest(g) AS g, unnest(range(1, len(g) + 1)) AS i FROM s),
q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM q WHERE c > 1) GROUP BY doc_id),
m AS (SELECT s.doc_id, n_words::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains({{stop}}, lower(x)))) AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{00C0}}-\x{{024F}}]')
        OR NOT regexp_matches(x, '\p{{L}}'))) AS n_latin_words
    FROM s LEFT JOIN r ON r.doc_id = s.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_repeat_words <= 0.5 * n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND n_symbols::DOUBLE / n_words <= 0.1
    AND (2 * n_latin_words < n_words OR n_stop_words::DOUBLE / n_words BETWEEN 0.02 AND 0.9)
    AND n_dup_lines::DOUBLE / n_lines <= 0.6 AS kept FROM b
"""

TOP_K = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

SUBSTRINGS = rf"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM t WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM h JOIN f USING (h) WHERE first < doc_id),
g AS (SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id),
o AS (SELECT t.doc_id, w, coalesce(gone, []) AS gone FROM t LEFT JOIN g ON g.doc_id = t.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
    sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(gone, i)], ' ')) AS kept_sha256 FROM o
"""

JACCARD = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
    list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS g FROM t),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, p.y FROM r JOIN p ON p.x = r.y)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, c.component_id FROM s
JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = s.doc_id
"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('20240607|' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
u AS (SELECT *, floor(('0x' || k[1:8])::BIGINT / 4294967296.0::DOUBLE * 4096)::INT AS slice,
    ('0x' || k[9:16])::BIGINT / 4294967296.0::DOUBLE AS v FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM u GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS n FROM w),
l AS (SELECT n, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
        ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    3 * source_size / weight AS cap FROM o),
b AS (SELECT level FROM l WHERE level <= cap ORDER BY n LIMIT 1),
g AS (SELECT source, source_size, least(weight * level, 3.0::DOUBLE * source_size) AS target FROM w, b),
x AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM g),
y AS (SELECT *, target - whole * source_size AS extra FROM x),
z AS (SELECT source, slice, sum(size) AS part FROM u GROUP BY source, slice),
c AS (SELECT *, sum(part) OVER (PARTITION BY source ORDER BY slice) AS upto FROM z),
e AS (SELECT c.source, min(slice) AS last, arg_min((extra - (upto - part)) / part, slice) AS share
    FROM c JOIN y ON c.source IS NOT DISTINCT FROM y.source WHERE upto > extra GROUP BY c.source)
SELECT u.doc_id, u.size, y.source_size, y.target, (u.size * CASE WHEN y.source_size = 0 THEN 0 ELSE whole + CASE
    WHEN u.slice < coalesce(e.last, 4096) OR (u.slice = e.last AND u.v < e.share) THEN 1 ELSE 0 END END)::BIGINT AS taken
FROM u JOIN y ON u.source IS NOT DISTINCT FROM y.source LEFT JOIN e ON e.source IS NOT DISTINCT FROM y.source
"""


def _quality() -> str:
    from dealscope.llm.quality_rules import STOP_WORDS
    return QUALITY.replace("{stop}", "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]")


ORACLE: dict[str, str] = {
    "op2_ngram_jaccard": JACCARD,
    "op4_quality_rules": _quality(),
    "op5_substring_dedup": SUBSTRINGS,
    "op6_exact_topk": TOP_K,
    "op7_mixing": MIXING,
}
