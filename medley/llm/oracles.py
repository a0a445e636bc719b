"""DuckDB statements for the training-data queries that SQL can express. The
others (trained models, tokenizers, sketches, engine-specific hashes) are held
against brute force in tests/llm."""

from __future__ import annotations

from medley.llm.secrets import BASE_RULES, RULES

# The word separators and the letters that are lowered.
_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
tokens AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
same AS (SELECT list_sort(s) AS s, min(doc_id) AS class_id FROM sets WHERE len(s) > 0 GROUP BY 1)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, coalesce(c.class_id, s.doc_id) AS class_id
FROM sets s JOIN least l ON l.a = s.doc_id LEFT JOIN same c ON c.s = list_sort(s.s)"""


def _spans(rank: int, rule) -> str:
    """(doc_id, rank, kind, a, z) of one rule's kept matches: positions are sums of
    the lengths of gaps and matches before them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, unnest(list_transform(
    list_filter(range(1, len(m) + 1), lambda i: length(k[i]) >= {rule.least}), lambda i: {{
      'a': coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
      'z': coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0)}})) AS s
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m,
               regexp_extract_all(text, '{pattern}', {rule.group}) AS k,
               string_split_regex(text, '{pattern}') AS g
        FROM texts WHERE regexp_matches(text, '{pattern}'))"""


_KINDS = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
_JOINED = "string_agg(kind || ':' || s.a::BIGINT || ':' || s.z::BIGINT, ',' ORDER BY s.a, rank)"

SECRET_SCANS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({"  UNION ALL".join(_spans(k, r) for k, r in enumerate(RULES))}),
per AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)},
         {_JOINED} FILTER (kind IN ({_KINDS})) AS base, {_JOINED} AS spans
  FROM spans GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN per USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH words AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS n FROM windows) WHERE n > 1),
placed AS (
  SELECT p.doc_id, p.i, p.word, max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END) OVER (
      PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words) p
  LEFT JOIN repeated r ON r.doc_id = p.doc_id AND r.i = p.i),
kept AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS t
  FROM placed GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)"""

HARD_NEGATIVES = """
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS r
  FROM scored WHERE same QUALIFY r <= 5),
found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.uid, p.r ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.uid = p.uid AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3"""


def license_scans(phrases, templates, percent: int) -> str:
    """Every block against every template, and every place against every phrase."""
    def quoted(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    notices = ",\n    ".join(f"('{t.label}', {t.step}, {quoted(dict.fromkeys(t.words))}, {t.need(percent)})"
                             for t in templates)
    places = "\n  UNION ALL ".join(
        f"SELECT uid, '{p.label}' AS label, unnest(list_filter(range(len(w)), lambda i: "
        f"w[i + 1:i + {len(p.text.split())}] = {quoted(p.text.split())})) AS place FROM words" for p in phrases)
    steps = sorted({t.step for t in templates})
    blocks = "\n  UNION ALL ".join(
        f"SELECT uid, {c} AS step, list_distinct(w[s + 1:s + {2 * c}]) AS b "
        f"FROM (SELECT uid, w, unnest(range(0, len(w), {c})) AS s FROM words)" for c in steps)
    return f"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS ({places}),
base AS (SELECT uid, count(*) AS n, min(place) AS a, max(place) AS z, list(DISTINCT label) AS labels
         FROM places GROUP BY uid),
notices(label, step, words, need) AS (VALUES {notices}),
blocks AS ({blocks}),
held AS (
  SELECT uid, n.label, len(list_intersect(n.words, b)) / len(n.words) AS part
  FROM blocks JOIN notices n USING (step) WHERE len(list_intersect(n.words, b)) >= n.need),
found AS (SELECT uid, list(DISTINCT label) AS labels, max(part) AS most FROM held GROUP BY uid)
SELECT doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.a AS first_word, b.z AS last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(f.labels, []))), ',') AS labels,
       CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(f.most, 0.0) END::DOUBLE AS score
FROM words LEFT JOIN base b USING (uid) LEFT JOIN found f USING (uid)"""


__all__ = ["NGRAM_JOIN", "SECRET_SCANS", "SUBSTRING_DEDUP", "HARD_NEGATIVES", "license_scans"]
