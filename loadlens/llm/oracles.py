"""DuckDB SQL that gives the same rows as the registered queries, where SQL can."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}

_ORACLES["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""

_ORACLES["op5_source_mixing"] = r"""
WITH RECURSIVE
c AS (SELECT source, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
w AS (SELECT round(sum(round(sqrt(chars), 6)), 6) AS wants, sum(chars) AS total FROM c),
r AS (
  SELECT source, CASE WHEN chars > 0 THEN sqrt(chars) * (1.0::DOUBLE * total::DOUBLE) / (wants * chars) ELSE 1.0::DOUBLE END AS rate
  FROM c, w),
f AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cum FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cum + p * rate / (k + 1) FROM f
  WHERE k < ceil(rate + 10 * sqrt(rate) + 20)),
d AS (
  SELECT *, ('0x' || substr(sha256('mix-1|' || doc_id || '|0'), 1, 13))::UBIGINT::DOUBLE / 4503599627370496 AS u
  FROM documents),
n AS (
  SELECT d.doc_id, count(*) AS copies
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source AND f.cum <= d.u
  GROUP BY d.doc_id)
SELECT d.* EXCLUDE (u), n.copies::INT AS copies, i.copy::INT AS copy,
       sha256('mix-1|order|' || d.doc_id || '|' || i.copy) AS mix_key
FROM d JOIN n USING (doc_id), LATERAL (SELECT unnest(generate_series(1, n.copies)) AS copy) i
"""

_ORACLES["op8_decontamination"] = r"""
WITH
plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM plain),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
placed AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, i, placed.size, item_id FROM placed JOIN win ON placed.words = win.words AND placed.size = win.size),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
