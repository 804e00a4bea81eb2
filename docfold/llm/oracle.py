"""DuckDB SQL for the operators that SQL can express."""

from docfold.llm.templates import ALIKE, COMMON, DOCUMENTS, FIXED, LEAD, SHARE, SHINGLE
from docfold.llm.quality import MAX_REPEAT, MIN_WORDS, RULES, STOP_WORDS

_RULES = " AND ".join(
    f"100 * {r.measure} {op} {bound} * {r.of}" for r in RULES for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None
)
_STOP = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
twice AS (SELECT doc_id, g FROM win GROUP BY 1, 2 HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win SEMI JOIN twice USING (doc_id, g)) GROUP BY 1),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letter_words
  FROM d LEFT JOIN rep USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AND {_RULES} AS kept
FROM m
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (
  SELECT source, source_size, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         2.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, cap / weight AS full_at FROM w),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
  FROM f WINDOW o AS (ORDER BY full_at, source ASC NULLS LAST)),
t AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT arg_min(level, full_at) FROM l WHERE level <= full_at)), cap) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT doc_id, size, source_size, target,
       (floor(rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
          < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""

OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM documents),
all_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < {SHINGLE} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {SHINGLE - 1}], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM all_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {ALIKE} * (x.n + y.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS reached FROM sizes UNION SELECT reach.id, b FROM reach JOIN e ON a = reach.reached),
class AS (SELECT id AS doc_id, min(reached) AS class FROM reach GROUP BY 1),
m AS (
  SELECT doc_id, list_transform(w, lambda x: list_transform(x, lambda y: CASE WHEN regexp_matches(y, '[0-9]') THEN '<*>' ELSE y END)) AS w FROM d),
l AS (
  SELECT doc_id, pos, t, len(t) AS n, CASE len(t) WHEN 3 THEN 2 ELSE least(len(t), {LEAD}) END AS lead
  FROM (SELECT doc_id, pos, w[pos] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM m)) WHERE len(t) > 0),
f AS (SELECT l.*, class, n || '|' || array_to_string(t[1:lead], ' ') AS leaf FROM l JOIN class USING (doc_id)),
leaves AS (SELECT leaf, count(DISTINCT class) AS m FROM f GROUP BY 1 HAVING m >= {DOCUMENTS}),
c AS (SELECT f.*, m FROM f JOIN leaves USING (leaf)),
tok AS (SELECT doc_id, pos, class, leaf, m, i, t[i] AS token FROM (SELECT *, unnest(range(lead + 1, n + 1)) AS i FROM c)),
common AS (SELECT leaf, i, token FROM tok GROUP BY leaf, i, token, m HAVING count(DISTINCT class) >= {DOCUMENTS} AND {COMMON} * count(DISTINCT class) >= m),
fixed AS (SELECT doc_id, pos, count(*) AS k, string_agg(i || ':' || token, ' ' ORDER BY i) AS x FROM tok JOIN common USING (leaf, i, token) GROUP BY 1, 2),
k AS (SELECT doc_id, pos, class, leaf || '#' || coalesce(x, '') AS template FROM c LEFT JOIN fixed USING (doc_id, pos) WHERE 100 * (lead + coalesce(k, 0)) >= {FIXED} * n
  UNION ALL SELECT doc_id, pos, class, leaf || '##' || array_to_string(t, ' ') FROM c),
by_class AS (SELECT template, class, max(n) AS n FROM (SELECT template, class, doc_id, count(*) AS n FROM k GROUP BY 1, 2, 3) GROUP BY 1, 2),
r AS (SELECT template FROM by_class GROUP BY 1 HAVING count(*) >= {DOCUMENTS} AND {SHARE} * count(*) >= sum(n)),
g AS (SELECT DISTINCT doc_id, pos FROM k SEMI JOIN r USING (template)),
kept AS (
  SELECT doc_id, string_agg(x, chr(10) ORDER BY pos) AS kept_text
  FROM (SELECT doc_id, s[pos] AS x, pos FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)))
  ANTI JOIN g USING (doc_id, pos) GROUP BY 1)
SELECT d.doc_id, len(list_filter(d.w, lambda x: len(x) > 0))::BIGINT AS n_lines, (SELECT count(*) FROM g WHERE g.doc_id = d.doc_id)::BIGINT AS n_dropped,
       CASE WHEN documents.text IS NOT NULL THEN md5(coalesce(kept_text, '')) END AS kept_md5
FROM d JOIN documents USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))

OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 1, 2) END)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS h FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS reached FROM documents UNION SELECT r.id, b FROM r JOIN both_ways ON a = r.reached),
m AS (SELECT id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT id AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept, coalesce(min(id) OVER (PARTITION BY n.h), id) AS class_id
FROM m JOIN n ON n.doc_id = id
UNION ALL SELECT doc_id, 0, doc_id, true, doc_id FROM documents ANTI JOIN n USING (doc_id)
"""

OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - 199, 0))) AS i FROM d)),
q AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM p) WHERE n > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM q),
k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM g),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY doc_id, k),
f AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
t AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS last FROM f JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

#: crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"

OP13 = rf"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, leaf, CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 3 = 0 THEN tampered ELSE leaf END AS tampered,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_LEAF} AS leaf, {_LEAF.replace("text", f"translate(text, '{_UPPER}', '{_LOWER}')")} AS tampered FROM documents)),
nodes(lang, lvl, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM l
  UNION ALL SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 8, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS places FROM nodes WHERE n = 1),
tops(lvl, pos, n, h) AS (
  SELECT 0, place, places, subroot FROM subroots
  UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 8, n),
low AS (
  SELECT l.lang, l.pos AS leaf_pos, string_agg(x.h, '' ORDER BY x.lvl, x.pos) AS siblings
  FROM l JOIN nodes x ON x.lang IS NOT DISTINCT FROM l.lang AND x.n > 1 AND x.pos // 8 = l.pos // (8 ** (x.lvl + 1))::BIGINT AND x.pos <> l.pos // (8 ** x.lvl)::BIGINT GROUP BY 1, 2),
high AS (
  SELECT s.place, string_agg(x.h, '' ORDER BY x.lvl, x.pos) AS siblings
  FROM subroots s JOIN tops x ON x.n > 1 AND x.pos // 8 = s.place // (8 ** (x.lvl + 1))::BIGINT AND x.pos <> s.place // (8 ** x.lvl)::BIGINT GROUP BY 1),
up(lang, leaf_pos, lvl, pos, n, h) AS (
  SELECT lang, pos, 0, pos, n, tampered FROM l
  UNION ALL
  SELECT u.lang, leaf_pos, u.lvl + 1, u.pos // 8, (u.n + 7) // 8, sha256(string_agg(CASE WHEN x.pos = u.pos THEN u.h ELSE x.h END, '' ORDER BY x.pos))
  FROM up u JOIN nodes x ON x.lang IS NOT DISTINCT FROM u.lang AND x.lvl = u.lvl AND x.pos // 8 = u.pos // 8 WHERE u.n > 1 GROUP BY u.lang, leaf_pos, u.lvl, u.pos // 8, u.n),
over(lang, leaf_pos, lvl, pos, n, h) AS (
  SELECT u.lang, leaf_pos, 0, place, places, h FROM up u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.lang WHERE n = 1
  UNION ALL
  SELECT u.lang, leaf_pos, u.lvl + 1, u.pos // 8, (u.n + 7) // 8, sha256(string_agg(CASE WHEN x.pos = u.pos THEN u.h ELSE x.h END, '' ORDER BY x.pos))
  FROM over u JOIN tops x ON x.lvl = u.lvl AND x.pos // 8 = u.pos // 8 WHERE u.n > 1 GROUP BY u.lang, leaf_pos, u.lvl, u.pos // 8, u.n)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(coalesce(low.siblings, '') || coalesce(high.siblings, '')) AS proof_sha256, o.h AS folded_root, o.h = t.h AS verified
FROM l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN tops t ON t.n = 1
JOIN over o ON o.lang IS NOT DISTINCT FROM l.lang AND o.leaf_pos = l.pos AND o.n = 1
LEFT JOIN low ON low.lang IS NOT DISTINCT FROM l.lang AND low.leaf_pos = l.pos LEFT JOIN high USING (place)
"""

OP11 = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS first, {_CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.first AND pos < h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h),
q AS (SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS s FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d AS depth, s[1:d] AS s, len(s) = d AS ends FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM q)),
n AS (SELECT s, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends) AS ends FROM p GROUP BY s),
k AS (SELECT s[1:depth - 1] AS s, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (s)),
u AS (SELECT s[1:d] AS s, n_children, (n_convs - 1) * CASE WHEN depth > 0 THEN length(s[depth].text) ELSE 0 END AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m)),
v AS (SELECT s, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM u GROUP BY 1)
SELECT m.conv_id, m.depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN v USING (s) LEFT JOIN n o ON m.depth > 0 AND o.s = m.s[1:m.depth - 1]
"""

OP12 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.w, v.w)::BIGINT AS score FROM v q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""

ORACLE = {"op12_max_score": OP12, "op11_prefix_trie": OP11, "op13_merkle_manifest": OP13, "op1_near_dedup": OP1, "op6_remove_repeats": OP6, "op3_line_templates": OP3, "op7_quality_rules": OP7, "op9_mix_sources": OP9}
