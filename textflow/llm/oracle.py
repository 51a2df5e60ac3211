"""DuckDB SQL for queries that SQL expresses; the tests hold the others against plain versions."""

from __future__ import annotations

from textflow.llm import licenses
from textflow.llm.mixing import BLOCK, REST
from textflow.llm.queries import REST as REST_WEIGHT
from textflow.llm.queries import TARGETS

_NAMED = ", ".join(f"({k}, '{lane}', {w})" for k, (lane, w) in enumerate(TARGETS.items()))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TEMPLATES = ", ".join(
    f"({k}, '{t.label}', {t.phrase}, {t.need}, {t.stride}, {_list(sorted(set(t.words)))}, {_list(t.words)})"
    for k, t in enumerate((*licenses.PHRASES, *licenses.NOTICES))
)

SQL: dict[str, str] = {
    "op6_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p""",
    "op8_mixing": f"""
WITH RECURSIVE named(k, lane, w) AS (VALUES {_NAMED}),
others AS (
  SELECT lane, row_number() OVER (ORDER BY lane = '{REST}', lane) - 1 AS i FROM (
    SELECT DISTINCT coalesce(source, '{REST}') AS lane FROM documents) WHERE lane NOT IN (SELECT lane FROM named)),
lanes AS (
  SELECT k, lane, w * (SELECT greatest(count(*), 1) FROM others) AS w FROM named
  UNION ALL SELECT {len(TARGETS)} + i, lane, {REST_WEIGHT} FROM others),
sums AS (SELECT CAST(sum(w) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS lanes FROM lanes),
steps(slot, turns, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(range(lanes), lambda x: CAST(0 AS BIGINT)), CAST(-1 AS BIGINT) FROM sums
  UNION ALL
  SELECT slot + 1, list_transform(turns, lambda t, i: t + CASE WHEN i - 1 = next THEN 1 ELSE 0 END), next
  FROM (
    SELECT slot, turns, arg_min(k, CAST(ceil((t + 1) * total / w) AS BIGINT) * 1000 + k) AS next
    FROM (SELECT s.slot, s.turns, l.k, l.w, total, s.turns[l.k + 1] AS t FROM steps s, lanes l, sums WHERE s.slot < total - 1)
    WHERE t < w AND t * total // w <= slot + 1 GROUP BY slot, turns)),
period AS (
  SELECT l.lane, l.w, steps.slot, steps.turns[l.k + 1] - 1 AS j FROM steps JOIN lanes l ON l.k = steps.pick),
numbered AS (
  SELECT doc_id, source, coalesce(source, '{REST}') AS lane,
    row_number() OVER (PARTITION BY coalesce(source, '{REST}')
      ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(text), '')), doc_id, text) - 1 AS n
  FROM documents)
SELECT d.doc_id, d.source, d.lane, d.n // {BLOCK} AS turn,
  (d.n // {BLOCK} // p.w) * total + p.j * total // p.w AS release,
  (d.n // {BLOCK} // p.w) * total + CAST(ceil((p.j + 1) * total / p.w) AS BIGINT) AS deadline,
  (d.n // {BLOCK} // p.w) * total + p.slot AS slot,
  ((d.n // {BLOCK} // p.w) * total + p.slot) * {BLOCK} + d.n % {BLOCK} AS position
FROM numbered d JOIN period p ON p.lane = d.lane AND p.j = (d.n // {BLOCK}) % p.w, sums""",
    "op11_licenses": f"""
WITH t(k, label, phrase, need, stride, tokens, seq) AS (VALUES {_TEMPLATES}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws FROM documents),
spread AS (SELECT d.r, t.*, d.ws, unnest(range(0, (len(ws) + stride - 1) // stride)) AS block
  FROM d JOIN t ON len(list_intersect(tokens, ws)) >= need),
held AS (
  SELECT r, k, label, phrase, shared / len(tokens) AS containment FROM (
    SELECT *, len(list_intersect(tokens, ws[block * stride + 1 : (block + 2) * stride])) AS shared FROM spread)
  WHERE shared >= need),
places AS (
  SELECT r, label, start FROM (
    SELECT d.r, t.label, t.seq, d.ws, unnest(range(0, len(d.ws) - len(t.seq) + 1)) AS start FROM d, t WHERE t.phrase)
  WHERE ws[start + 1 : start + len(seq)] = seq),
based AS (
  SELECT r, count(*) AS n, min(start) AS lo, max(start) AS hi, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY r),
blocks AS (
  SELECT r, count(*) AS n, max(containment) FILTER (NOT phrase) AS best, list(DISTINCT label) FILTER (NOT phrase) AS labels
  FROM held GROUP BY r)
SELECT d.doc_id, len(ws) AS n_words, coalesce(based.n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(array_to_string(based.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(based.labels, []), coalesce(blocks.labels, [])))), ',') AS labels,
  CASE WHEN based.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score, coalesce(blocks.n, 0) AS n_blocks
FROM d LEFT JOIN based ON based.r = d.r LEFT JOIN blocks ON blocks.r = d.r""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3""",
    "op13_spelling": r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
spelled AS (SELECT *, hex(encode(id || ':' || run)) AS bytes FROM counted),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(len(bytes) // 2),
    lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h FROM spelled, tab),
seen AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, unnest(range(length(word))) AS i FROM words),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
met AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = cut.rest
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = cut.rest),
near AS (
  SELECT met.word, w.n, count(*) AS n_near, max(o.n) AS form_n, arg_min(o.word, (-o.n, o.word)) AS form
  FROM met JOIN words w ON w.word = met.word JOIN words o ON o.word = met.other GROUP BY met.word, w.n),
forms AS (SELECT word, form, form_n FROM near WHERE form_n >= 2 * n),
chains(word, goal) AS (SELECT word, form FROM forms UNION SELECT chains.word, forms.form FROM chains JOIN forms ON forms.word = goal)
SELECT words.word, forms.form, coalesce(roots.goal, words.word) AS root, words.n, coalesce(n_near, 0) AS n_near, forms.form_n
FROM words LEFT JOIN near ON near.word = words.word LEFT JOIN forms ON forms.word = words.word
LEFT JOIN (SELECT word, goal FROM chains WHERE goal NOT IN (SELECT word FROM forms)) roots ON roots.word = words.word""",
}
