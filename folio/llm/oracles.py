"""DuckDB SQL with the rows of those queries that SQL can express."""

from __future__ import annotations

from folio.llm.quality_rules import BASE, POLICIES, PRODUCTION, RULES, mask

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
least AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (k) WHERE doc_id > first_doc),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS said, count(*) AS n FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p
  WHERE gone.p IS NULL GROUP BY word.doc_id),
span AS (SELECT g.doc_id, count(*) AS n FROM gone g LEFT JOIN gone b ON b.doc_id = g.doc_id AND b.p = g.p - 1 WHERE b.p IS NULL GROUP BY g.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256,
  CAST(coalesce(span.n, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN span USING (doc_id)
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values()))

OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (doc_id, k)) GROUP BY doc_id),
line AS (SELECT doc_id, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(again.n, 0) AS n_repeat_words, len(list_distinct(w)) AS n_distinct_words,
    length(regexp_replace(t, '[^A-Za-z\x{{C0}}-\x{{10FFFF}}]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM d JOIN line USING (doc_id) LEFT JOIN again USING (doc_id)),
b AS (SELECT *, {_BITS} AS bits FROM m)
SELECT doc_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in ('n_words', 'word_chars', 'n_symbols', 'n_lines', 'n_dup_lines', 'n_repeat_words', 'n_distinct_words', 'n_letters', 'n_upper', 'bits'))},
  bits & {mask(BASE)} <> 0 AS base_failed, bits & {mask(BASE) | mask(POLICIES[PRODUCTION])} = 0 AS kept
FROM b
"""

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(k) AS k FROM (
  SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edge.b, reach.r FROM reach JOIN edge ON edge.a = reach.doc_id)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

ORACLES = {"op2_fast_similarity_dedup": OP2, "op5_rule_ledger": OP5, "op8_block_anchors": OP8}

OP12 = """
WITH raw AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM raw a JOIN raw b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""
ORACLES["op12_inverted_multi_index"] = OP12

OP13 = r"""
WITH t AS (SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(w ORDER BY turn NULLS FIRST, k) AS ws FROM t GROUP BY conv_id),
h AS (SELECT conv_id, ks, ws, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_concat([4294967295], flatten([[ascii(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(conv_id AS VARCHAR), '')])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 4 AS n FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(b.ks[1:h.n], []), h.ks[h.n + 1:]) AS ks, list_concat(coalesce(b.ws[1:h.n], []), h.ws[h.n + 1:]) AS ws FROM h LEFT JOIN c b ON b.conv_id = h.base),
p AS (SELECT conv_id, d, len(ks) AS n, md5(array_to_string(ks[1:d], ',')) AS k, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM (SELECT conv_id, ks, ws, unnest(range(0, len(ks) + 1)) AS d FROM r)),
node AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n) AS ends FROM p GROUP BY k, d),
up AS (SELECT node.k, node.d, q.k AS pk, parent.conv_id AS parent_id FROM node JOIN p q ON q.conv_id = node.conv_id AND q.d = node.d - 1 JOIN node parent ON parent.k = q.k AND parent.d = q.d),
kids AS (SELECT pk, d - 1 AS d, count(*) AS n FROM up GROUP BY ALL),
below AS (SELECT q.k, q.d, sum((node.n_convs - 1) * node.w) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM node LEFT JOIN kids ON kids.pk = node.k AND kids.d = node.d JOIN p q ON q.conv_id = node.conv_id AND q.d <= node.d GROUP BY q.k, q.d)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, up.parent_id AS parent_conv_id, CAST(node.n_convs AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
  CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN below ON below.k = node.k AND below.d = node.d LEFT JOIN up ON up.k = node.k AND up.d = node.d LEFT JOIN kids ON kids.pk = node.k AND kids.d = node.d
"""
ORACLES["op13_zfast_trie"] = OP13
