"""DuckDB SQL of the operators that SQL can express, for their queries' digest columns."""

from __future__ import annotations

from .secrets import RULES, Rule

_WORD = r"[^\x20\x09-\x0D]+"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS k, w FROM d WHERE len(w) >= 20),
s AS (SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS seq FROM p),
r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY seq ORDER BY doc_id, k) AS nth FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS pos FROM r WHERE nth > 1),
g AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         [w[x] FOR x IN range(1, len(w) + 1) IF NOT list_contains(gone, x)], ' ') END)
         AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), {_FOLD}),
  '{_LETTERS}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
  translate(coalesce(text, ''), {_FOLD}),
  '{_LETTERS}') AS w FROM benchmark),
k AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM i WHERE len(w) > 0),
v AS (SELECT DISTINCT item, len(w[pos:pos + 12]) AS n, array_to_string(w[pos:pos + 12], ' ') AS seq
      FROM k),
n AS (SELECT DISTINCT n FROM v),
p AS (SELECT doc_id, n.n, unnest(range(1, len(w) - n.n + 2)) AS pos, w
      FROM d JOIN n ON len(w) >= n.n),
h AS (SELECT p.doc_id, p.pos, p.n, v.item
      FROM p JOIN v ON p.n = v.n AND array_to_string(p.w[p.pos:p.pos + p.n - 1], ' ') = v.seq),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit
      FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items
      FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""


FILL_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS d,
  regexp_extract_all(coalesce(text, ''),
    '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, text, w, len(w) AS n,
  CAST('0x' || d[1:8] AS UBIGINT) % (len(w) + 1) AS x,
  CAST('0x' || d[9:16] AS UBIGINT) % (len(w) + 1) AS y,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
         OR CAST('0x' || d[17:24] AS UBIGINT) % 100 >= 50 THEN 'plain'
       WHEN CAST('0x' || d[25:32] AS UBIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (SELECT doc_id, text, n, form, array_to_string(w[1:CAST(least(x, y) AS BIGINT)], '') AS p,
  array_to_string(w[CAST(least(x, y) AS BIGINT) + 1:CAST(greatest(x, y) AS BIGINT)], '') AS m,
  array_to_string(w[CAST(greatest(x, y) AS BIGINT) + 1:], '') AS s FROM h)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""


def _rule_spans(rank: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, hits[j] AS hit,
  list_sum([length(x) FOR x IN gaps[1:j]])
  + coalesce(list_sum([length(x) FOR x IN hits[1:j - 1]]), 0) AS a
FROM (SELECT doc_id, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS j FROM (
  SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS hits,
         regexp_extract_all(text, '{pattern}', {rule.value}) AS vals,
         string_split_regex(text, '{pattern}') AS gaps FROM d))
WHERE length(vals[j]) >= {rule.min_value}"""


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_rule_spans(k, r) for k, r in enumerate(RULES))}),
t AS (SELECT doc_id, rank, a, kind || ':' || CAST(a AS BIGINT) || ':'
        || CAST(a + length(hit) AS BIGINT) AS span FROM s)
SELECT d.doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
       count(*) FILTER (rank = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3), ''))
         AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY a, rank), '') AS spans
FROM d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id
"""

ORACLES = {"op3_decontaminate": DECONTAMINATE, "op9_secrets": SECRETS,
           "op10_substring_dedup": SUBSTRING_DEDUP, "op11_fill_middle": FILL_MIDDLE}
