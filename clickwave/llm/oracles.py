"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::UBIGINT::DOUBLE / 281474976710656.0 AS u
  FROM documents),
per AS (SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos, source_size * 3 AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM per),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS lvl
  FROM w WINDOW b AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap / weight <= lvl AS is_full FROM l),
t AS (
  SELECT *, CASE WHEN is_full THEN cap::DOUBLE
                 ELSE least((max(CASE WHEN NOT is_full THEN lvl END) OVER ()) * weight, cap::DOUBLE) END AS target FROM f),
k AS (
  SELECT t.source, t.n_docs, t.source_size, t.target, length(bin(size)) AS grade, sum(size)::BIGINT AS words
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
kl AS (
  SELECT *, (target - coalesce(sum(words * 3) OVER b, 0))
            / nullif((sum(grade * words) OVER (PARTITION BY source) - coalesce(sum(grade * words) OVER b, 0))::DOUBLE, 0) AS lvl
  FROM k WINDOW b AS (PARTITION BY source ORDER BY grade DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ke AS (
  SELECT *, CASE WHEN words = 0 THEN 0.0 ELSE least(coalesce(
              (max(CASE WHEN lvl * grade < 3 THEN lvl END) OVER (PARTITION BY source)) * grade, 3.0::DOUBLE), 3.0::DOUBLE) END AS times
  FROM kl),
p AS (
  SELECT source, grade, source_size, target, floor(times + 1e-12)::BIGINT AS whole,
         greatest(times - floor(times + 1e-12)::BIGINT, 0.0::DOUBLE) AS p,
         greatest(target - sum(floor(times + 1e-12)::BIGINT * words) OVER (PARTITION BY source), 0.0::DOUBLE) AS rest,
         greatest(1, least(ceil(n_docs / 200.0), 1048576))::BIGINT AS buckets
  FROM ke),
d AS (
  SELECT *, floor(v * buckets)::BIGINT AS bucket FROM (
    SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, p.rest, p.buckets,
           CASE WHEN p > 0 THEN u * (1 - p) / (u * (1 - p) + (1 - u) * p) END AS v
    FROM s JOIN p ON s.source IS NOT DISTINCT FROM p.source AND length(bin(s.size)) = p.grade)),
sums AS (SELECT source, target, rest, bucket, sum(size) AS words FROM d WHERE v IS NOT NULL GROUP BY ALL),
upto AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS upto FROM sums),
cuts AS (
  SELECT source, min(bucket) AS cut, min(target) * 0.001::DOUBLE AS near, min_by(rest - upto + words, bucket) AS gap
  FROM upto WHERE upto > rest GROUP BY source),
cut0 AS (
  SELECT d.source, gap, near, doc_id, size, v, count(*) * size AS words
  FROM d JOIN cuts ON d.source IS NOT DISTINCT FROM cuts.source AND d.bucket = cuts.cut
  GROUP BY d.source, gap, near, doc_id, size, v),
cut1 AS (
  SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY v, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)) <= gap AS x FROM cut0),
cut2 AS (SELECT *, gap - coalesce(sum(words) FILTER (x) OVER (PARTITION BY source), 0) AS g FROM cut1),
cut3 AS (
  SELECT * EXCLUDE (x, g), x OR (words <= g AND coalesce(sum(words) FILTER (NOT x AND words <= g) OVER turn, 0) <= g
    AND g - coalesce(sum(words) FILTER (NOT x AND words <= g) OVER turn, 0) + words > near) AS x FROM cut2 WINDOW turn AS (PARTITION BY source ORDER BY v, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
cut4 AS (SELECT *, gap - coalesce(sum(words) FILTER (x) OVER (PARTITION BY source), 0) AS g FROM cut3),
cut5 AS (
  SELECT * EXCLUDE (x, g), x OR (words <= g AND coalesce(sum(words) FILTER (NOT x AND words <= g) OVER turn, 0) <= g
    AND g - coalesce(sum(words) FILTER (NOT x AND words <= g) OVER turn, 0) + words > near) AS x FROM cut4 WINDOW turn AS (PARTITION BY source ORDER BY v, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
cut6 AS (
  SELECT *, gap - coalesce(sum(words) FILTER (x) OVER (PARTITION BY source), 0) AS g,
         row_number() OVER (PARTITION BY source ORDER BY x, words, v, doc_id NULLS FIRST) AS least FROM cut5),
chosen AS (SELECT source, doc_id, size FROM cut6 WHERE x OR (least = 1 AND g > near AND words - g < g)),
r AS (
  SELECT d.doc_id, d.source, d.size, d.source_size, d.target,
         least(d.whole + CASE WHEN (cuts.cut IS NULL AND d.v IS NOT NULL AND d.rest > 0) OR d.bucket < cuts.cut OR chosen.size IS NOT NULL
                              THEN 1 ELSE 0 END, 3)::INTEGER AS copies
  FROM d LEFT JOIN cuts ON d.source IS NOT DISTINCT FROM cuts.source
  LEFT JOIN chosen ON d.bucket = cuts.cut AND d.source IS NOT DISTINCT FROM chosen.source
                  AND d.doc_id IS NOT DISTINCT FROM chosen.doc_id AND d.size = chosen.size)
SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM r
"""

#: Vectors of like class are linked by every member; components by recursion.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e,
         coalesce(vec_id IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS fine
  FROM embeddings),
g AS MATERIALIZED (SELECT vec_id, e FROM v WHERE fine),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, least(min(b), a) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, coalesce(c.component_id, v.vec_id) AS component_id,
       coalesce(coalesce(c.component_id, v.vec_id) = v.vec_id, TRUE) AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a
"""

TOPK_SEARCH = """
WITH v AS MATERIALIZED (
  SELECT DISTINCT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(x * 1024)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

#: Pairs of different texts that share a shingle, by their counts of it.
MINHASH_DEDUP = r"""
WITH RECURSIVE t AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT text, min(doc_id) AS rep FROM t GROUP BY text),
w AS (SELECT rep, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM c WHERE rep IS NOT NULL),
g AS (
  SELECT rep, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                          ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM w WHERE len(w) > 0),
k AS (SELECT rep, shingle, count(*) AS n FROM g GROUP BY ALL),
z AS (SELECT rep, sum(n) AS size FROM k GROUP BY rep),
o AS (SELECT a.rep AS a, b.rep AS b, sum(least(a.n, b.n)) AS common FROM k a JOIN k b ON a.shingle = b.shingle AND a.rep < b.rep GROUP BY ALL),
e AS (
  SELECT a, b FROM o JOIN z x ON x.rep = a JOIN z y ON y.rep = b WHERE common / (x.size + y.size - common) >= 0.8 - 1e-12
  UNION SELECT x.rep, y.rep FROM t s JOIN t q ON s.doc_id = q.doc_id JOIN c x ON x.text = s.text JOIN c y ON y.text = q.text WHERE x.rep <> y.rep),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
m AS (SELECT a, least(min(b), a) AS component FROM reach GROUP BY a)
SELECT t.doc_id, c.rep AS class_id, coalesce(m.component, c.rep) AS component_id,
       coalesce(t.doc_id = coalesce(m.component, c.rep), coalesce(m.component, c.rep) IS NULL) AS kept
FROM t JOIN c ON c.text = t.text LEFT JOIN m ON m.a = c.rep
"""

#: Lines around leaders, then short and long lines that recur as they are.
#: (Texts of the same or of no id are told apart by a hash that SQL lacks: the
#: tables must have distinct ids.)
LINE_DEDUP = r"""
WITH x AS MATERIALIZED (SELECT text, min(doc_id) AS id FROM documents WHERE length(text) > 0 GROUP BY text),
a AS (SELECT text, id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM x),
b AS (
  SELECT text, id, pos, trim(regexp_replace(line, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS raw FROM a),
w AS (
  SELECT *, array_to_string(list_transform(string_split(raw, ' '), lambda v: CASE WHEN regexp_matches(v, '[0-9]') THEN '<*>' ELSE v END), ' ') AS wild
  FROM b WHERE raw <> ''),
v AS (
  SELECT *, CASE WHEN regexp_matches(raw, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]')
                 THEN regexp_replace(raw, '[0-9]+', '<*>', 'g') ELSE wild END AS short FROM w),
k AS (
  SELECT *, CASE WHEN len(string_split(raw, ' ')) > 3 THEN wild WHEN regexp_matches(short, '[^<*> ]') THEN short ELSE raw END AS line FROM v),
l AS MATERIALIZED (
  SELECT text, id, pos, string_split(line, ' ') AS tokens, len(string_split(line, ' ')) AS n, string_split(line, ' ')[1:3] AS lead,
         CASE WHEN len(string_split(line, ' ')) >= 50 AND 2 * len(list_filter(string_split(line, ' '), lambda v: v = '<*>')) > len(string_split(line, ' '))
              THEN raw ELSE line END AS ident FROM k),
leaf AS (
  SELECT n, lead, count(DISTINCT text) >= 5 AS many FROM l GROUP BY n, lead
  HAVING count(DISTINCT text) >= CASE WHEN n >= 50 THEN 2 ELSE 5 END),
seen AS MATERIALIZED (SELECT l.*, leaf.many FROM l JOIN leaf ON l.n = leaf.n AND l.lead = leaf.lead),
lines AS MATERIALIZED (
  SELECT n, lead, many, ident, any_value(tokens) AS tokens, count(DISTINCT text) AS docs,
         CAST('0x' || substr(md5(ident), 1, 15) AS BIGINT) AS f, n - 3 AS m, CAST((7 * (n - 3) + 9) // 10 AS BIGINT) AS least
  FROM seen GROUP BY n, lead, many, ident),
p AS (SELECT *, unnest(range(m - least + 1)) AS s FROM lines WHERE many AND n > 3),
cuts AS MATERIALIZED (
  SELECT n, lead, ident, docs, f, s, tokens[CAST(4 + (s * m) // (m - least + 1) AS BIGINT):CAST(3 + ((s + 1) * m) // (m - least + 1) AS BIGINT)] AS part FROM p),
leads AS (
  SELECT n, lead, s, part, ident AS leader FROM cuts
  QUALIFY row_number() OVER (PARTITION BY n, lead, s, part ORDER BY docs DESC, f DESC) = 1),
meets AS (
  SELECT DISTINCT cuts.n, cuts.lead, cuts.ident, leads.leader
  FROM cuts JOIN leads ON cuts.n = leads.n AND cuts.lead = leads.lead AND cuts.s = leads.s AND cuts.part = leads.part),
fits AS (
  SELECT meets.n, meets.lead, meets.ident, meets.leader, t.docs, t.f
  FROM meets JOIN lines AS o ON o.n = meets.n AND o.lead = meets.lead AND o.ident = meets.ident
       JOIN lines AS t ON t.n = meets.n AND t.lead = meets.lead AND t.ident = meets.leader
  WHERE meets.ident <> meets.leader AND len(list_filter(range(4, o.n + 1), lambda i: o.tokens[i] = t.tokens[i])) >= o.least),
best AS (
  SELECT n, lead, ident, leader FROM fits QUALIFY row_number() OVER (PARTITION BY n, lead, ident ORDER BY docs DESC, f DESC) = 1),
kinds AS (
  SELECT lines.n, lines.lead, lines.ident, ['family', coalesce(best.leader, lines.ident)] AS kind, 5 AS needed
  FROM lines LEFT JOIN best ON lines.n = best.n AND lines.lead = best.lead AND lines.ident = best.ident WHERE many AND lines.n > 3
  UNION ALL SELECT n, lead, ident, ['own', ident], CASE WHEN n >= 50 THEN 2 ELSE 5 END FROM lines
  WHERE (NOT many OR n <= 3 OR n >= 50) AND docs >= CASE WHEN n >= 50 THEN 2 ELSE 5 END),
o AS MATERIALIZED (
  SELECT seen.text, seen.id, seen.pos, kinds.n, kinds.lead, kinds.kind, kinds.needed
  FROM seen JOIN kinds ON seen.n = kinds.n AND seen.lead = kinds.lead AND seen.ident = kinds.ident),
r AS (SELECT n, lead, kind, arg_min(text, id) AS kept FROM o GROUP BY n, lead, kind, needed HAVING count(DISTINCT text) >= needed),
g AS (
  SELECT o.text, list(DISTINCT o.pos) AS gone FROM o JOIN r ON o.n = r.n AND o.lead = r.lead AND o.kind = r.kind
  WHERE o.text <> r.kept GROUP BY o.text)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(g.gone), 0)::BIGINT AS n_dropped,
       CASE WHEN g.gone IS NULL THEN d.text
            ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda w, i: NOT list_contains(g.gone, i - 1)), chr(10)) END AS text
FROM documents d LEFT JOIN g ON d.text = g.text
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""

# the CRC-32 of a word: eight shifts of the polynomial for each of its bytes
IMPORTANCE_RESAMPLING = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT r, unnest(words) AS word FROM d),
bytes AS (
  SELECT word, list_transform(range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1),
                              lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)) AS v
  FROM (SELECT word FROM dw UNION SELECT word FROM b)),
hashed AS (
  SELECT word, (4294967295 - list_reduce(v, lambda c, x: list_reduce(range(8),
      lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, xor(c, x)), 4294967295)) % 10000 AS bucket
  FROM bytes),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (word) GROUP BY bucket),
alls AS (SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) AS n FROM s),
allt AS (SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) AS n FROM t),
g AS (
  SELECT s.bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (alls.n + 10000)
                                        / ((CAST(s.n AS DOUBLE) + 1) * (allt.n + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), alls, allt),
w AS (SELECT r, sum(gain) AS weight FROM dw JOIN hashed USING (word) JOIN g USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
              AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (r)),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN
         row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed"""

FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
o AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o"""
