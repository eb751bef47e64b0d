"""DuckDB SQL of the queries whose whole result SQL can express.

The others depend on a tokenizer, a trained model, random rounding or an
approximate search; they are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

REACH = """
ends AS (SELECT a, b FROM links UNION SELECT b AS a, a AS b FROM links),
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

OP2 = """
WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT id, label, v, sqrt(list_dot_product(v, v)) AS n FROM nodes
  WHERE v IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.label = q.label AND p.id < q.id
  WHERE list_dot_product(p.v, q.v) / (p.n * q.n) >= 0.93),""" + REACH + """
SELECT c.id AS vec_id, (SELECT count(*) FROM ends e WHERE e.a = c.id) AS n_links, c.component_id, c.id = c.component_id AS kept
FROM comp c"""

OP7 = r"""
WITH RECURSIVE cut AS (SELECT doc_id AS id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
nodes AS (SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM cut),
sh AS (SELECT id, len(s) AS n, unnest(s) AS s FROM nodes),
shared AS (SELECT p.id AS a, q.id AS b, p.n AS na, q.n AS nb, count(*) AS i FROM sh p JOIN sh q ON p.s = q.s AND p.id < q.id
  GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * i >= 85 * (na + nb - i)),""" + REACH + """
SELECT c.id AS doc_id, len(n.s) AS n_shingles, c.component_id, c.id = c.component_id AS kept
FROM comp c JOIN nodes n ON n.id = c.id"""


def _kind(order: int, name: str, pattern: str, keep: str) -> str:
    """Spans of one kind: the lengths of the pieces and matches before a match add up
    to its start."""
    return f"""
SELECT doc_id, {order} AS k, '{name}' AS kind, m, st, st + length(m) AS en,
       regexp_replace(m, '[^0-9]', '', 'g') AS d
FROM (SELECT doc_id, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{
        'm': ms[i], 'st': CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0) AS BIGINT)}}), recursive := true)
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM txt))
WHERE {keep}"""


LUHN = """list_sum(list_transform(string_split(reverse(d), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT)
   WHEN CAST(c AS INT) > 4 THEN CAST(c AS INT) * 2 - 9 ELSE CAST(c AS INT) * 2 END)) % 10 = 0"""

OP9 = r"""
WITH txt AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS (""" + "\nUNION ALL".join([
    _kind(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    _kind(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
          "len(list_filter(string_split(m, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0"),
    _kind(2, "card", r"[0-9](?:[\x20-]?[0-9])+", f"length(d) BETWEEN 14 AND 19 AND {LUHN}"),
    _kind(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
]) + """),
per AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, k) AS s FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans
FROM txt t LEFT JOIN per ON per.doc_id = t.doc_id"""

# the pages of the tables hold one article element each, whose blocks are h1 and p and
# whose references are &amp; (some without the semicolon) and &quot;
OP11 = r"""
WITH art AS (SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS h FROM pages),
txt AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split_regex(h, '</?(?:h1|p)>'), lambda x:
    trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"'),
      '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM art)
SELECT page_id, url, text, length(text) AS n_chars FROM txt"""

OP12 = r"""
WITH txt AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  min(doc_id) OVER (PARTITION BY t) AS first_id FROM txt),
masks AS (SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN first_id < doc_id THEN 16 ELSE 0 END AS mask FROM cut),
said AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks LEFT JOIN said USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, b)),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
    AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
res AS (SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM res"""

# op9's added kinds (IBAN, social security number) are not in the SQL: the tables it
# runs on hold none, so spans are the base spans there.
ORACLE_SQL = {"op2_rp_forest": OP2, "op7_setsketch": OP7, "op9_pii": OP9, "op11_block_labeller": OP11, "op12_filter_audit": OP12}
