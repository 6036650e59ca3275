"""SQL for DuckDB of the queries that SQL can express.

The others have none: language-model and quality scores and the randomness tests are
models of their own, the tokenizers and XXH64 are not in SQL, nearest neighbours are
approximate, and a packing is one of many. Tests hold these against plain versions.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda line: regexp_matches(line, '{_WORD}')) AS lines
  FROM documents
),
runs AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d)
),
again AS (
  SELECT row, i FROM runs QUALIFY count(*) OVER (PARTITION BY row, run) > 1
),
marked AS (
  SELECT row, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS shift (k)
  GROUP BY row
),
m AS (
  SELECT d.row, doc_id, t, words, list_mode(words) AS top, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(marked.n, 0) AS n_repeat_words
  FROM d LEFT JOIN marked ON marked.row = d.row
),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 100 * n_symbols > 10 * word_chars
    OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
    OR 10 * (length(t) - length(replace(t, '!', ''))) > 3 * n_words
    OR 10 * ((length(t) - length(replace(t, ' | ', ''))) // 3) > 2 * n_words
    OR 10 * n_dup_lines > 5 * n_lines
    OR 100 * len(list_filter(words, lambda w: w = top)) > 30 * n_words
    OR 2 * length(regexp_replace(t, '[^\pL]', '', 'g')) < word_chars) AS kept
FROM f
"""

REPEATED_PASSAGES = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h,
    CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes
  FROM documents
),
passages AS MATERIALIZED (
  SELECT row, i, md5_number(substr(h, 2 * i + 1, 400)) AS passage
  FROM (SELECT row, h, unnest(range(0, n_bytes - 199)) AS i FROM d)
),
again AS (
  SELECT passage FROM passages GROUP BY passage HAVING count(*) > 1
),
starts AS (
  SELECT row, i FROM passages SEMI JOIN again ON again.passage = passages.passage
),
numbered AS (
  SELECT row, i, sum(new) OVER (PARTITION BY row ORDER BY i) AS run
  FROM (SELECT row, i,
      CASE WHEN i <= lag(i) OVER (PARTITION BY row ORDER BY i) + 200 THEN 0 ELSE 1 END AS new
    FROM starts)
),
spans AS (
  SELECT row, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY row, run
),
pieces AS (
  SELECT row, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans
  WINDOW w AS (PARTITION BY row ORDER BY a)
  UNION ALL
  SELECT d.row, coalesce(max(spans.b), 0), any_value(n_bytes) FROM d
  LEFT JOIN spans ON spans.row = d.row GROUP BY d.row
),
kept AS (
  SELECT d.row, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
  FROM d JOIN pieces ON pieces.row = d.row GROUP BY d.row
),
sums AS (
  SELECT row, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept ON kept.row = d.row LEFT JOIN sums ON sums.row = d.row
"""

HARD_NEGATIVES = """
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS row, CAST(vec_id AS BIGINT) AS id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS MATERIALIZED (
  SELECT a.row, a.id AS anchor_id, c.id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON c.row <> a.row WHERE a.id % 50 = 0
),
positives AS (
  SELECT row, anchor_id, id, score, row_number() OVER (PARTITION BY row ORDER BY score DESC, id) AS place
  FROM scored WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.row, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.row = p.row AND NOT n.same
  AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""

CHAT_FORMATTING = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v (n, r)
),
lengths AS (
  SELECT *, length(role) + length(text) + length('### : </turn>') + 1
    + len(regexp_extract_all(role, ': ')) + len(regexp_extract_all(text, '### |</turn>'))
    + CASE WHEN regexp_matches(role, '\\(\\|: |\z)') OR regexp_matches(text, '\\(\\|### |</turn>|\z)')
      THEN len(regexp_extract_all(role || text, '\\')) ELSE 0 END AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_suffix_array_dedup": REPEATED_PASSAGES.strip(),
        "op4_quality_rules": QUALITY_RULES.strip(),
        "op11_hard_negatives": HARD_NEGATIVES.strip(),
        "op12_chat_formatting": CHAT_FORMATTING.strip(),
    }
