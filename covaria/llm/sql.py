"""The package's queries once more as SQL, where SQL can express them."""

from __future__ import annotations

from covaria.llm.licenses import TEMPLATES
from covaria.llm.quality import STOP_WORDS

_SPACE = r"[\x20\x09-\x0D]"

OP4 = rf"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS body
  FROM documents),
best AS (
  SELECT body, count(*) AS group_size,
         (list(doc_id ORDER BY n DESC, doc_id))[1] AS keep_id
  FROM normal GROUP BY body)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256
FROM normal JOIN best USING (body)
"""

OP10 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 7, 0) + 1)) AS i FROM split),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w FROM places),
found AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM found, range(8) AS offsets(k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(words, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop
  FROM split LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND word_chars / greatest(n_words, 1) BETWEEN 1.5 AND 25.0
         AND n_symbols / greatest(n_words, 1) <= 1.0
         AND n_stop / greatest(n_words, 1) >= 0.005
         AND n_dup_lines / greatest(n_lines, 1) <= 0.6 AS kept
FROM counted
"""

_VALUES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
_WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+(?:\\.[0-9]+)*')"
_PAIRS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

OP8 = rf"""
WITH templates AS (
  SELECT k, name, {_PAIRS} AS b
  FROM (SELECT k, name, {_WORDS.format("body")} AS w FROM (VALUES {_VALUES}) t(k, name, body))),
segments AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s FROM documents
  UNION ALL
  SELECT doc_id, s FROM (
    SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\n[\x20\x09\x0B-\x0D]*(?:\n|$)')) AS s
    FROM documents) WHERE contains(s, chr(10))),
bigrams AS (
  SELECT doc_id, {_PAIRS} AS a FROM (SELECT doc_id, {_WORDS.format("s")} AS w FROM segments) WHERE len(w) > 1),
scored AS (
  SELECT doc_id, a, name, k, 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
  FROM (SELECT doc_id, a, row_number() OVER () AS n FROM bigrams), templates
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY dice DESC, k) = 1)
SELECT doc_id, coalesce(list_aggregate(list_sort(list_distinct(list(name) FILTER (dice >= 0.8))), 'string_agg', ','), '') AS licences,
       count(*) FILTER (dice >= 0.8) AS n_matches,
       CAST(coalesce(max(dice) FILTER (dice >= 0.8), 0) AS DOUBLE) AS dice
FROM documents LEFT JOIN scored USING (doc_id)
GROUP BY doc_id
"""

_VECTORS = """
  SELECT CAST(vec_id AS BIGINT) AS vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

_DOT = "list_sum(list_transform(range(1, least(len({a}), len({b})) + 1), lambda i: {a}[i] * {b}[i]))"

OP12 = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
  FROM ({_VECTORS}) WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(coalesce({_DOT.format(a="a.v", b="r.v")}, 0) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM negatives
QUALIFY rank <= 10
"""

OP13 = f"""
WITH rows AS ({_VECTORS}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce({_DOT.format(a="q.v", b="c.v")}, 0) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 5
"""

ORACLES = {
    "op4_exact_dedup": OP4, "op8_license_scans": OP8, "op10_quality_rules": OP10,
    "op12_hard_negatives": OP12, "op13_exact_topk": OP13,
}
