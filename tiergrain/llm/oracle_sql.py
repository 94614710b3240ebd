"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import math

from tiergrain.llm.license_scan import CONTAINMENT, PHRASES, SLACK, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def licences() -> str:
    """op7: places by list slices; every run of words of a text that could hold a template at all."""
    phrases = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in PHRASES)
    rows = []
    for label, text, must, never in TEMPLATES:
        spoken = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        words = sorted(set(spoken))
        rows.append(f"('{label}', {_list(words)}, {math.ceil(CONTAINMENT * len(words) - 1e-9)}, {len(spoken) + SLACK}, "
                    f"{_list(must.split())}, {_list(never.split())}::VARCHAR[])")
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_LOWER} AS t FROM documents),
w AS (SELECT doc_id, r, t, regexp_extract_all(t, {_WORD}) AS ws FROM d),
p(ph, label) AS (VALUES {phrases}),
place AS (SELECT r, label, unnest(list_filter(generate_series(1, len(ws) - len(ph) + 1),
              lambda i: ws[i:i + len(ph) - 1] = ph)) - 1 AS i FROM w, p),
base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, list_distinct(list(label)) AS ls FROM place GROUP BY r),
m(label, words, need, run, must, never) AS (VALUES {', '.join(rows)}),
able AS (SELECT r, label, ws, words, need, run, must, never FROM w, m
         WHERE list_has_all(ws, must) AND len(list_intersect(list_distinct(ws), words)) >= need),
runs AS (SELECT r, label, words, need, must, never, ws[i:i + run - 1] AS b
         FROM (SELECT *, unnest(generate_series(1, greatest(len(ws) - run + 1, 1))) AS i FROM able)),
hit AS (SELECT r, label, len(list_intersect(list_distinct(b), words)) / len(words) AS c FROM runs
        WHERE list_has_all(b, must) AND NOT list_has_any(b, never)
          AND len(list_intersect(list_distinct(b), words)) >= need),
found AS (SELECT r, list_distinct(list(label)) AS ls, max(c) AS c FROM hit GROUP BY r)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(base.ls, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(found.ls, [])))), ',') AS labels,
       CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(c, 0) END AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
win AS (SELECT doc_id, r, i, array_to_string(w[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, r, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT r, list(p) AS ps FROM (
           SELECT DISTINCT r, unnest(generate_series(i, i + 12)) AS p FROM win JOIN first USING (k) WHERE m < doc_id)
         GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, j: NOT list_contains(coalesce(ps, []), j)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)"""

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
               max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x:
        CASE x WHEN 'A' THEN len(w) < 100 WHEN 'B' THEN 100 * len(list_distinct(w)) < 80 * len(w)
               WHEN 'C' THEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t)
               WHEN 'D' THEN regexp_matches(t, '[#$%&*|]') ELSE coalesce(doc_id > m, false) END) AS fails
      FROM d JOIN least USING (t) LEFT JOIN lab USING (doc_id)),
g AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS before,
             string_split(filter_order[1:step], '') AS done FROM o, range(1, 6) r(step)),
c AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
        sum(CASE WHEN NOT list_has_any(fails, done) THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN list_contains(fails, letter) AND NOT list_has_any(fails, before) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN list_contains(fails, letter) AND list_has_any(fails, before) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = [letter] THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN list_contains(fails, letter) AND NOT list_has_any(fails, before) THEN n * good ELSE 0 END) AS good_lost,
        sum(CASE WHEN list_contains(fails, letter) AND NOT list_has_any(fails, before) THEN n * toxic ELSE 0 END) AS toxic_lost
      FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM c"""

HARD_NEGATIVES = """
WITH ok AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
              list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
             CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
      FROM ok a JOIN ok r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""

ORACLE = {"op7_licences": licences(), "op8_substring_dedup": SUBSTRING_DEDUP, "op13_filter_audit": FILTER_AUDIT,
          "op11_hard_negatives": HARD_NEGATIVES}
