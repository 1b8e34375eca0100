"""DuckDB SQL for the queries that SQL can express on whole tables.

Learned scores, tokenizer ids and files (op6, op8-op11, the pipeline) are
tested against brute-force versions in tests/llm instead.
"""
from __future__ import annotations

from .quality import RULES, STOP_WORDS

_SEP = r"'[\x20\x09-\x0D]+'"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), {_SEP}), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, {_SEP}), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""

OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(role) + 2 + length(regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g')) + 9)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL),
ok AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT v.vec_id, coalesce(any_value(k.n), 0) AS n_links, min(reach.b) AS component_id, v.vec_id = min(reach.b) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) k ON k.a = v.vec_id JOIN reach ON reach.a = v.vec_id
GROUP BY v.vec_id
"""

_STOPS = ", ".join(f"'{v}'" for s in sorted(set(STOP_WORDS)) for v in (s, s.capitalize()))
_METRIC = {"mean_word_chars": "word_chars / greatest(n_words, 1)", "symbol_ratio": "n_symbols / greatest(n_words, 1)",
           "stop_word_ratio": "n_stop / greatest(n_words, 1)", "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)"}
_RULES = " AND ".join([f"{_METRIC[r.metric]} >= {r.low}" for r in RULES if r.low is not None]
                      + [f"{_METRIC[r.metric]} <= {r.high}" for r in RULES if r.high is not None])

OP4 = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
rep AS (
  SELECT r, count(DISTINCT i + j) AS n FROM (
    SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1), range(8) t(j) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {_RULES} AS kept
FROM m
"""

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d))
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, range(20) t(j)),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.x, ' ' ORDER BY p.i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) p
  ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, len({_WORDS})::BIGINT AS n_tokens,
    ('0x' || substr(md5(concat_ws('|', '7', coalesce(source, ''), coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS order_key
  FROM documents),
t AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
u AS (SELECT sum(tokens)::DOUBLE AS total, min(tokens)::DOUBLE AS least, count(*) AS k,
    ln(sum(tokens)) - sum(tokens * ln(tokens)) / sum(tokens) AS own FROM t WHERE tokens > 0),
b AS (
  SELECT 0::BIGINT AS lo, 1048576::BIGINT AS hi
  UNION ALL
  SELECT CASE WHEN good THEN lo ELSE mid + 1 END, CASE WHEN good THEN mid ELSE hi END FROM (
    SELECT lo, hi, mid, ln(z) - a * zl / z <= own + 0.5 * (ln(k) - own) + 1e-9 AND pow(least / total, a - 1) / z <= 4 + 1e-9 AS good FROM (
      SELECT lo, hi, (lo + hi) // 2 AS mid, ((lo + hi) // 2) / 1048576.0::DOUBLE AS a, u.*,
        (SELECT sum(pow(tokens / (SELECT total FROM u), ((lo + hi) // 2) / 1048576.0::DOUBLE)) FROM t WHERE tokens > 0) AS z,
        (SELECT sum(pow(tokens / (SELECT total FROM u), ((lo + hi) // 2) / 1048576.0::DOUBLE) * ln(tokens / (SELECT total FROM u))) FROM t WHERE tokens > 0) AS zl
      FROM b, u WHERE lo < hi))),
e AS (SELECT max(lo) / 1048576.0::DOUBLE AS a FROM b WHERE lo = hi),
w AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE, a) / sum(pow(tokens::DOUBLE, a)) FILTER (tokens > 0) OVER () ELSE 0 END AS weight FROM t, e),
q AS (SELECT source, tokens, weight, floor(round(weight * total, 3))::BIGINT AS quota FROM w, u),
f AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS epochs, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest FROM q),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY order_key RANGE UNBOUNDED PRECEDING) AS used,
    sum(n_tokens) OVER (PARTITION BY source, order_key) AS entry, row_number() OVER (PARTITION BY source, order_key) AS nth FROM d)
SELECT doc_id, r.source, n_tokens, order_key, (order_key >> 50)::BIGINT AS block, round(weight, 6) AS weight,
  (epochs + CASE WHEN rest > 0 AND (used <= rest OR nth * n_tokens <= rest - (used - entry)) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM r JOIN f ON f.source = r.source
"""

def _clusters(rounds: int) -> str:
    """Assignments and floored means, one pair of tables a round."""
    sql = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) - 1 AS cluster, e AS c
  FROM v QUALIFY cluster < 16),
"""
    for i in range(rounds + 1):
        sql += f"""
a{i} AS (
  SELECT vec_id, r, e, c, cluster, d FROM (
    SELECT *, list_sum(list_transform(list_zip(e, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1),"""
        if i < rounds:
            sql += f"""
m{i} AS (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
    SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(e) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY cluster, i)
  GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster)),"""
    return sql.rstrip(",") + f"""
SELECT vec_id, cluster::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds}
"""


OP12 = _clusters(3)

OP13 = """
WITH rules(rule_host, rule_path, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, row_number() OVER () AS r, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, r, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
"""

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1, "op2_chat_format": OP2, "op3_vector_dedup": OP3, "op4_quality_rules": OP4,
    "op5_substring_dedup": OP5, "op7_mix_sources": OP7,
    "op12_centroid_clusters": OP12, "op13_url_filter": OP13,
}
