"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), {_LOWER}) AS key FROM lines),
held AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT k.doc_id, k.pos, k.line, h.first IS NOT NULL AND h.first <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN held h USING (key))
"""

ORACLE: dict[str, str] = {}

ORACLE["op5_line_dedup"] = _LINES + """
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op10_url_filter"] = f"""
WITH cut AS (
    SELECT page_id,
           CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}) AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
    SELECT page_id, rule_host || rule_path AS rule, verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM parts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.place = 1
"""

_ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
sizes AS (
    SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS run
    FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sizes)),
lengths AS (SELECT DISTINCT k FROM sizes),
places AS (
    SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS run
    FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, lengths WHERE len(w) >= k)),
met AS (SELECT p.doc_id, p.k, p.i, x.item_id FROM places p JOIN windows x ON p.k = x.k AND p.run = x.run),
hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM (SELECT DISTINCT doc_id, k, i FROM met))
    GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE["op8_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS run
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY run),
gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i
    FROM windows JOIN firsts USING (run) WHERE first < doc_id),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE g.i IS NULL) AS words,
           count(*) AS n_words, count(g.i) AS n_removed
    FROM places p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE["op7_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT vec_id, generate_subscripts(x, 1) AS i, unnest(x) AS c FROM v),
scores AS (
    SELECT q.vec_id AS query_id, o.vec_id, CAST(sum(q.c * o.c) AS BIGINT) AS score
    FROM long q JOIN long o ON q.i = o.i AND q.vec_id <> o.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
"""

ORACLE["op4_near_dedup"] = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + k - 1), ' ')) AS s
    FROM (
        SELECT doc_id, w, least(5, len(w)) AS k, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS i
        FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, min(other) = d.doc_id AS kept
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id JOIN reach r ON d.doc_id = r.doc_id
GROUP BY d.doc_id
"""

ORACLE["op11_exact_dedup"] = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM (
    SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
           count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents)
"""
