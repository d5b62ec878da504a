"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

#: The judging of urls, the ranked search and the contaminated words are plain SQL; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN split_part(split_part(substr(url, instr(url, '://') + 3), '?', 1), '#', 1) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)
), rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
         ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), fits AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
""",
    "op12_lexical_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM lengths
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(N_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, totals GROUP BY term
), parts AS (
  SELECT c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * N_docs) // L))) AS part
  FROM counts c JOIN weights USING (term) JOIN lengths USING (doc_id), totals
), scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts JOIN item_terms USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    "op13_decontamination": r"""
WITH texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)
), spots AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM texts, (SELECT DISTINCT size FROM windows))
), found AS (
  SELECT DISTINCT doc_id, size, k, item_id FROM spots JOIN windows USING (size, words)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM found)) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)
""",
}
