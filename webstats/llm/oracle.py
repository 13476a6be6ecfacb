"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS place FROM windows),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM placed, range(0, 20) AS r(j) WHERE place > 1),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

# the 256-entry table of the CRC-32 checksum, as a list
CRC_TABLE = r"""
bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)"""

MERKLE_MANIFEST = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
d AS (
  SELECT doc_id, text, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                         lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents d, crc),
l AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN h % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS altered
  FROM d),
up(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM l
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1
  GROUP BY tree, level, pos // 3, n),
tops AS (SELECT tree, level, digest FROM up WHERE n = 1),
up2(level, pos, n, digest) AS (
  SELECT 0, tree, count(*) OVER (), digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM up2 WHERE n > 1
  GROUP BY level, pos // 3, n),
root AS (SELECT digest FROM up2 WHERE n = 1),
nodes AS (SELECT tree, level, pos, pos // 3 AS run, digest FROM up UNION ALL SELECT -1, level, pos, pos // 3, digest FROM up2),
way(doc_id, tree, top, total, level, pos, digest, proof) AS (
  SELECT doc_id, tree, level, level + (SELECT max(level) FROM up2), 0, CASE WHEN level = 0 THEN tree ELSE pos END, altered, ''
  FROM (SELECT l.*, t.level FROM l JOIN tops t USING (tree))
  UNION ALL
  SELECT doc_id, tree, top, total, level + 1, CASE WHEN level + 1 = top THEN tree ELSE pos // 3 END,
         sha256(pre || digest || post), proof || pre || post
  FROM (
    SELECT w.*, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < w.pos), '') AS pre,
           coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > w.pos), '') AS post
    FROM way w JOIN nodes s ON s.tree = CASE WHEN w.level < top THEN w.tree ELSE -1 END
         AND s.level = CASE WHEN w.level < top THEN w.level ELSE w.level - top END AND s.run = w.pos // 3
    WHERE w.level < total GROUP BY ALL))
SELECT l.doc_id, l.leaf, t.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, w.digest AS folded_root,
       w.digest = r.digest AS verified
FROM l JOIN tops t USING (tree) JOIN way w ON w.doc_id = l.doc_id AND w.level = w.total, root r
"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
r AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM r),
h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
                     lambda c, v: xor(c >> 8, crc.t[(xor(c, v) & 255) + 1])), 4294967295) AS h
  FROM b, crc),
w AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
c AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(0, length(word))) AS i FROM w)),
p AS (
  SELECT a.word AS a, b.word AS b FROM c a JOIN c b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM c JOIN w ON w.word = c.cut
  UNION SELECT w.word, c.word FROM c JOIN w ON w.word = c.cut),
best AS (
  SELECT a, count(*) AS n_near, arg_max(b, (m, -place)) AS form, max(m) AS form_n
  FROM (SELECT p.*, w.n AS m, row_number() OVER (ORDER BY w.word) AS place FROM p JOIN w ON w.word = p.b) GROUP BY a),
f AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
         CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM w LEFT JOIN best ON best.a = w.word),
way(word, last, form) AS (
  SELECT word, word, form FROM f
  UNION ALL
  SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.form)
SELECT f.word, f.form, way.last AS root, f.n, f.n_near, f.form_n FROM f JOIN way ON way.word = f.word AND way.form IS NULL
"""

ORACLE_SQL = {"op2_superkmer_dedup": SUBSTRING_DEDUP, "op7_signature_tree_join": JACCARD_JOIN,
              "op11_merkle_manifest": MERKLE_MANIFEST, "op13_spelling_kdtree": SPELLING}
