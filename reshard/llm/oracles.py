"""The same results in DuckDB SQL, where SQL can express them."""

OP1 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, i, list_aggregate(w[i:i + 49], 'string_agg', ' ') AS win
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT win, min(doc_id) AS first FROM p GROUP BY win HAVING count(DISTINCT doc_id) > 1),
s AS (SELECT r, i FROM p JOIN f USING (win) WHERE first < doc_id),
g AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS x FROM s),
a AS (SELECT r, list(x) AS gone FROM g GROUP BY r),
k AS (
  SELECT r, string_agg(word, ' ' ORDER BY x) AS kept
  FROM (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS x FROM d) t ANTI JOIN g USING (r, x) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (r) LEFT JOIN k USING (r)
"""

OP3 = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
n AS (SELECT DISTINCT item, w[i:least(i + 12, len(w))] AS win FROM (
  SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM d),
m AS (SELECT DISTINCT p.r, p.i, len(win) AS l, item
  FROM p JOIN (SELECT DISTINCT len(win) AS l FROM n) k ON i + l - 1 <= len(w) JOIN n ON n.win = w[i:i + l - 1]),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + l - 1)) AS x FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

OP4 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT r, hex(b) AS x, octet_length(b)::BIGINT AS n FROM d),
p AS (SELECT r, i, md5(substr(x, (2 * i - 1)::BIGINT, 800)) AS win
  FROM (SELECT r, x, unnest(generate_series(1, n - 399)) AS i FROM h WHERE n >= 400)),
f AS (SELECT win FROM p GROUP BY win HAVING count(*) > 1),
s AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400, TRUE) AS opens FROM p SEMI JOIN f USING (win)),
g AS (SELECT r, i, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
u AS (SELECT r, run, min(i) AS a, max(i) + 400 AS z FROM g GROUP BY r, run),
k AS (SELECT r, count(*) AS spans, sum(z - a) AS gone FROM u GROUP BY r),
e AS (SELECT r, coalesce(lag(z) OVER w, 1) AS a, u.a AS z, row_number() OVER w AS o FROM u WINDOW w AS (PARTITION BY r ORDER BY u.a)
  UNION ALL SELECT u.r, max(z), any_value(n) + 1, 1000000000 FROM u JOIN h USING (r) GROUP BY u.r),
t AS (SELECT r, string_agg(substr(x, (2 * a - 1)::BIGINT, (2 * (z - a))::BIGINT), '' ORDER BY o) AS kept FROM e JOIN h USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d JOIN h USING (r) LEFT JOIN k USING (r) LEFT JOIN t USING (r)
"""

OP5 = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS most FROM s),
l AS (
  SELECT *, most / weight AS ratio,
    row_number() OVER o AS place,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
t AS (
  SELECT source, source_size,
    least(most::DOUBLE, (SELECT level FROM l WHERE level <= ratio ORDER BY place LIMIT 1) * weight) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT *, floor(target - whole * source_size)::BIGINT AS rest FROM p),
e AS (
  SELECT d.*, r.source_size, r.target, r.whole, r.rest,
    size > 0 AND coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size <= rest AS x0
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
g1 AS (SELECT source, any_value(rest) - coalesce(sum(size) FILTER (x0), 0) AS gap FROM e GROUP BY source),
b1 AS (SELECT e.source, max({'size': size, 'k': k}).k AS best FROM e JOIN g1 ON e.source IS NOT DISTINCT FROM g1.source
  WHERE NOT x0 AND size > 0 AND size <= gap GROUP BY e.source),
e1 AS (SELECT e.*, x0 OR coalesce(k = best, FALSE) AS x1 FROM e LEFT JOIN b1 ON e.source IS NOT DISTINCT FROM b1.source),
g2 AS (SELECT source, any_value(rest) - coalesce(sum(size) FILTER (x1), 0) AS gap FROM e1 GROUP BY source),
b2 AS (SELECT e1.source, max({'size': size, 'k': k}).k AS best FROM e1 JOIN g2 ON e1.source IS NOT DISTINCT FROM g2.source
  WHERE NOT x1 AND size > 0 AND size <= gap GROUP BY e1.source),
e2 AS (SELECT e1.*, x1 OR coalesce(k = best, FALSE) AS x2 FROM e1 LEFT JOIN b2 ON e1.source IS NOT DISTINCT FROM b2.source),
g3 AS (SELECT source, any_value(rest) - coalesce(sum(size) FILTER (x2), 0) AS gap FROM e2 GROUP BY source),
l3 AS (SELECT e2.source, k, size, gap::BIGINT AS gap FROM e2 JOIN g3 ON e2.source IS NOT DISTINCT FROM g3.source
  WHERE NOT x2 AND size > 0 AND size <= gap),
f AS (
  SELECT source, k, size, gap, FALSE AS more FROM l3
  UNION ALL
  SELECT source, k, size, gap, more FROM (
    SELECT source, k, size, more, (gap - sum(CASE WHEN more THEN size ELSE 0 END) OVER (PARTITION BY source))::BIGINT AS gap
    FROM (
      SELECT source, k, size, gap,
        size + coalesce(sum(size) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= gap AS more
      FROM f WHERE NOT more) i) j
  WHERE more OR size <= gap),
m AS (SELECT DISTINCT source, k FROM f WHERE more)
SELECT doc_id, size, source_size, target, (size * (whole + (x2 OR m.k IS NOT NULL)::BIGINT))::BIGINT AS taken
FROM e2 LEFT JOIN m ON e2.source IS NOT DISTINCT FROM m.source AND e2.k = m.k
"""

OP6 = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""

OP8 = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
p AS (SELECT DISTINCT r, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM p GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM p a JOIN p b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON a = x.r JOIN n y ON b = y.r WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT r, r AS z FROM d UNION SELECT c.r, e.b FROM c JOIN e ON c.z = e.a),
k AS (SELECT c.r, min(t.doc_id) AS component_id FROM c JOIN d t ON c.z = t.r GROUP BY c.r),
g AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM d JOIN k USING (r) LEFT JOIN n USING (r) LEFT JOIN g USING (r)
"""

OP12 = """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
o AS (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM p, generate_series(1, 5) s(k) WHERE len(w) >= k),
c AS (SELECT lang, k, w[i:i + k - 1] AS ph, count(*) AS f FROM o GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
f AS (SELECT * FROM c WHERE f >= 100),
x AS (SELECT lang, ph, f AS a, k, unnest(generate_series(1, k - 1)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT x.lang, x.ph, x.a, x.k, cut, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * x.a * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.ph = x.ph[1:cut] JOIN f r ON r.lang = x.lang AND r.ph = x.ph[cut + 1:x.k] JOIN n ON n.lang = x.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) = 1),
u AS (
  SELECT lang, ph[i:i + m - 1] AS ph, max(a) AS longer
  FROM (SELECT lang, ph, a, k, m, unnest(generate_series(1, k - m + 1)) AS i FROM b, generate_series(2, 4) g(m) WHERE m < k)
  GROUP BY 1, 2),
k AS (
  SELECT b.lang, array_to_string(b.ph, ' ') AS phrase, a, l, r, n, score
  FROM b LEFT JOIN u ON u.lang = b.lang AND u.ph = b.ph WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM k QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_substring_dedup": OP1,
    "op3_decontamination": OP3,
    "op4_suffix_dedup": OP4,
    "op5_mixing": OP5,
    "op6_exact_dedup": OP6,
    "op8_jaccard_join": OP8,
    "op12_collocations": OP12,
}
