"""DuckDB SQL of the operators that SQL can express by plain enumeration."""

from __future__ import annotations

from .licenses import PHRASES, TEMPLATES, THRESHOLD

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(rows))


def _spelled(text: str) -> str:
    return rf"regexp_extract_all(translate({text}, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Every block of every size against every template of the size.
LICENSES = f"""
WITH tw AS (SELECT i, label, {_spelled('txt')} AS w FROM (VALUES {_values(TEMPLATES)}) v(i, label, txt)),
template AS (
  SELECT i, label, list_distinct(w) AS s, greatest(8, CAST(pow(2, ceil(log2(len(w)))) AS BIGINT)) AS size FROM tw),
phrase AS (SELECT label, {_spelled('txt')} AS p FROM (VALUES {_values(PHRASES)}) v(i, txt, label)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_spelled("coalesce(text, '')")} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM template),
starts AS (SELECT r, size, w, unnest(range(0, len(w), size)) AS start FROM d CROSS JOIN sizes),
block AS (SELECT r, size, start, list_distinct(w[start + 1:start + 2 * size]) AS b FROM starts),
hit AS (
  SELECT r, i, label, start, size, s, len(list_intersect(b, s)) AS shared FROM block JOIN template USING (size)
  WHERE 100 * len(list_intersect(b, s)) >= {THRESHOLD} * len(s)),
own AS (
  SELECT r, label FROM hit h WHERE NOT EXISTS (
    SELECT 1 FROM hit o WHERE o.r = h.r AND len(o.s) > len(h.s) AND len(list_intersect(o.s, h.s)) = len(h.s)
      AND o.start < h.start + 2 * h.size AND h.start < o.start + 2 * o.size)),
spot AS (SELECT r, w, unnest(range(0, len(w))) AS pos FROM d WHERE list_contains(w, 'license')),
place AS (SELECT r, label, pos FROM spot CROSS JOIN phrase WHERE w[pos + 1:pos + len(p)] = p),
base AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM place GROUP BY r),
joint AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM place UNION SELECT r, label FROM own) GROUP BY r),
best AS (SELECT r, max(shared / len(s)) AS score FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(joint.labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN joint USING (r) LEFT JOIN best USING (r)
"""

#: Each of the 120 orders applied left to right.
AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
mark AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
fail AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
  FROM w LEFT JOIN mark USING (doc_id)),
kind AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM fail GROUP BY part, f),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
run AS (
  SELECT part, filter_order, step, substr(filter_order, step::INT, 1) AS l, n, g, x, f,
    f[instr('ABCDE', substr(filter_order, step::INT, 1))] AS here,
    len(list_filter(range(1, step), lambda i: f[instr('ABCDE', substr(filter_order, i::INT, 1))])) > 0 AS before
  FROM kind CROSS JOIN steps),
counted AS (
  SELECT part, filter_order, step, l,
    sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN here AND before THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN here AND len(list_filter(f, lambda b: b)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND NOT before THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND NOT before THEN x ELSE 0 END) AS toxic_lost
  FROM run GROUP BY part, filter_order, step, l)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted
"""

#: The cuts are made on lists of lines.
FILL_IN_MIDDLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
k AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || x[9:16])::BIGINT % (len(u) + 1) AS c2,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || x[17:24])::BIGINT % 100 >= 100 AS plain,
    ('0x' || x[25:32])::BIGINT % 100 < 50 AS spm FROM h),
cut AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""
