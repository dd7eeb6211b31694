"""The results of the text operators in SQL, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM t),
 pos AS (SELECT doc_id, i, w[i:i+7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
 twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM pos) WHERE n > 1),
 covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
 m AS (
  SELECT w.doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
   CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
   coalesce(covered.n, 0) AS n_repeat_words, len(string_split(t, chr(10))) AS n_lines,
   length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS capitals
  FROM w LEFT JOIN covered USING (doc_id)),
 k AS (SELECT *, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
   n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.3 AND n_dup_lines / n_lines <= 0.5
  AND NOT coalesce(capitals / nullif(letters, 0) > 0.4, false) AND letters / word_chars >= 0.6 AS kept
FROM k
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
 b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i:i+least(len(w), 10)-1] AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT size FROM bw),
 dw AS (SELECT doc_id, size, i, w[i:i+size-1] AS g
  FROM (SELECT d.doc_id, d.w, s.size, unnest(range(1, len(d.w) - s.size + 2)) AS i FROM d JOIN sizes s ON len(d.w) >= s.size)),
 m AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.g = bw.g),
 h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
 t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
 sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


OP12 = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
 g AS (SELECT DISTINCT lang, source FROM d),
 k AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
 kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM k GROUP BY ALL HAVING sum(df) >= 3),
 v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
 c AS (SELECT k.lang, k.source, k.term, CAST(k.n AS HUGEINT) AS n FROM k JOIN kept USING (lang, term)),
 s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
 p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
   1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + v.v) AS p, 1 + (1000000000 * (kept.n + 1)) // (v.n + v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
 sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
 pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sums.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""

OP13 = r"""
WITH RECURSIVE bits AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(
   [CAST(i AS BIGINT)] || list_transform(range(8), lambda z: CAST(z AS BIGINT)),
   lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
 named AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
 f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
   [4294967295] || list_transform(string_split(name, ''), lambda z: CAST(ascii(z) AS BIGINT)),
   lambda c, z: xor(c >> 8, t[(xor(c, z) & 255) + 1]))) % 20 AS f FROM named, bits),
 d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
   CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
   unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
 o AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
 x AS (SELECT *, substr(role, 1, 1) AS c, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
   lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
 facts AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
   count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
   count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM x GROUP BY conv_id),
 ins(s, t, cost, letters, lines) AS (VALUES (0, 0, 0, '', CAST([] AS VARCHAR[])), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
   (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
   (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])),
 steps AS (
  SELECT x.conv_id, x.i, ins.s, ins.t AS t, ins.cost + 2 AS cost, ins.letters || 'D' AS letters, ins.lines AS lines FROM x, ins
  UNION ALL SELECT x.conv_id, x.i, ins.s, CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, ins.cost + CASE WHEN cut THEN 5 ELSE 0 END,
   ins.letters || 'K', list_append(ins.lines, role || ':' || text) FROM x, ins
   WHERE NOT blank AND NOT again AND (c = 's' AND t = 0 OR c = 'u' AND t <> 2 OR c = 'a' AND t = 2)
  UNION ALL SELECT x.conv_id, x.i, ins.s, CASE t WHEN 2 THEN 3 ELSE 2 END, ins.cost + 1 + CASE WHEN cut THEN 5 ELSE 0 END,
   ins.letters || 'R', list_append(ins.lines, CASE t WHEN 2 THEN 'assistant:' ELSE 'user:' END || text) FROM x, ins WHERE NOT blank AND NOT again),
 best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS b FROM conversations
  UNION ALL
  SELECT best.conv_id, steps.i, steps.t, min({'cost': b.cost + steps.cost, 'audit': b.audit || steps.letters, 'lines': b.lines || steps.lines})
  FROM best JOIN steps ON best.conv_id IS NOT DISTINCT FROM steps.conv_id AND steps.i = best.i + 1 AND steps.s = best.s
  GROUP BY best.conv_id, steps.i, steps.t),
 ended AS (
  SELECT best.conv_id, min({'cost': b.cost + ins.cost, 'audit': b.audit || ins.letters, 'lines': b.lines || ins.lines}) AS b
  FROM best LEFT JOIN facts ON best.conv_id IS NOT DISTINCT FROM facts.conv_id JOIN ins ON ins.s = best.s AND (ins.t = 3 OR ins.t = 0)
  WHERE best.i = coalesce(facts.n, 0) GROUP BY best.conv_id)
SELECT ended.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
 coalesce(illegal, 0) AS illegal, CAST(b.cost AS BIGINT) AS cost, b.audit AS audit, sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM ended LEFT JOIN facts ON ended.conv_id IS NOT DISTINCT FROM facts.conv_id
"""

def oracle_sql() -> dict[str, str]:
    return {"op7_quality_rules": OP7, "op10_decontamination": OP10, "op12_divergence_audit": OP12, "op13_conversation_repair": OP13}
