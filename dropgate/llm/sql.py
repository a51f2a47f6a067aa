"""DuckDB SQL of the queries that SQL can express."""

from .quality_rules import CUTOFFS, ERROR, RISK, RULES

_RULE_SHARES = {"symbol_share": "symbol_share", "repeat_share": "repeat_share", "dup_line_share": "dup_line_share"}
_STEPS = ", ".join(f"('{r}', {i}, {c / 100})" for r in RULES for i, c in enumerate(CUTOFFS))
_HITS = " ".join(f"WHEN '{r}' THEN f.{s} > x.cutoff" for r, s in _RULE_SHARES.items())
_FAILED = ", ".join(f"CASE WHEN f.{s} > (SELECT cutoff FROM chosen c WHERE c.stratum = f.stratum AND c.rule = '{r}') THEN '{r}' END" for r, s in _RULE_SHARES.items())

_VECTORS = """e AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

ORACLES = {
    "op4_quality_rules": rf"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) > 7),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM h),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, unnest(range(0, 8)) AS u(k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
b AS (
    SELECT d.doc_id, stratum, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(lines) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
f AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_share,
        CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_share,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share FROM b),
a AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
x(rule, step, cutoff) AS (VALUES {_STEPS}),
c AS (
    SELECT stratum, rule, step, any_value(cutoff) AS cutoff, count(*) FILTER (quality = 1) AS good,
        count(*) FILTER (quality = 1 AND CASE rule {_HITS} END) AS rejected, count(*) FILTER (quality = 0 AND CASE rule {_HITS} END) AS caught
    FROM f JOIN a USING (doc_id), x WHERE NOT base_failed GROUP BY stratum, rule, step),
k AS (SELECT count(DISTINCT stratum) AS strata FROM c),
v AS (
    SELECT c.*, CASE WHEN good > 0 AND rejected <= good * {RISK / len(RULES)} THEN list_sum(list_transform(range(0, rejected + 1),
        lambda i: exp(lgamma(good + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - CASE WHEN good > i THEN lgamma(good - i + 1) ELSE 0 END
            + i * ln({RISK / len(RULES)}) + (good - i) * ln(1 - {RISK / len(RULES)})))) ELSE 1 END <= {ERROR / len(RULES)} / strata AS certified
    FROM c, k),
s AS (SELECT v.*, coalesce(bool_and(certified) OVER (PARTITION BY stratum, rule ORDER BY step), false) AS passed FROM v),
m AS (SELECT *, max(caught) OVER (PARTITION BY stratum, rule) AS most FROM s WHERE passed),
chosen AS (SELECT stratum, rule, max(cutoff) AS cutoff FROM m WHERE caught = most AND most > 0 GROUP BY stratum, rule),
j AS (SELECT f.*, concat_ws(',', {_FAILED}) AS failed_rules FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, stratum, failed_rules FROM j
""",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n, g FROM s),
x AS (SELECT doc_id, n, unnest(g) AS g FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
""",
    "op11_exact_topk_search": f"""
WITH {_VECTORS},
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
""",
    "op13_hard_negative_mining": f"""
WITH {_VECTORS},
l AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM e WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
    FROM l a JOIN l x ON a.vec_id % 50 = 0 AND a.vec_id <> x.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM p JOIN s USING (anchor_id) WHERE place <= 5 AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3
""",
}
