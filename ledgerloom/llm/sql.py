"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}


def _crc32(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal text, bit by bit: a byte is mixed in, then eight shifts follow."""
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    string_split(CAST({number} AS VARCHAR), ''), lambda c: list_concat([CAST(ascii(c) AS BIGINT)], [CAST(-1 AS BIGINT), -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS BIGINT)) ELSE a // 2 END), CAST(4294967295 AS BIGINT))"""

SQL["op10_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
    lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS words FROM iw WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM win), cand AS (
  SELECT doc_id, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, w FROM dw, sizes s WHERE len(w) >= s.n
), occ AS (
  SELECT c.doc_id, c.i, c.n, x.item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words FROM cand) c JOIN win x ON x.words = c.words AND x.n = c.n
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN its i USING (doc_id)
"""

SQL["op2_substring_dedup"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM dw WHERE len(w) >= 35)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM runs) WHERE n > 1
), word AS (
  SELECT d.doc_id, d.p, d.word, g.p IS NOT NULL AS removed
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM dw) d
  LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.p = d.p
), per AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed) AS kept
  FROM word GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(p.kept, '')) AS kept_sha256
FROM dw d LEFT JOIN per p USING (doc_id)
"""

SQL["op4_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, unnest(range(1, len(a) + 1)) AS pos, unnest(a) AS own
  FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)
), solid AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, len(regexp_extract_all(own, '[^\x20\x09-\x0D]+')) AS words
  FROM line WHERE regexp_matches(own, '[^\x20\x09-\x0D]')
), whole AS (
  SELECT doc_id, list(md5(own) ORDER BY n) AS ids, list(words ORDER BY n) AS words FROM solid GROUP BY doc_id
), runs AS (
  SELECT doc_id, n, width, words[n] AS words, md5(array_to_string(ids[n : n + width - 1], '')) AS run
  FROM (SELECT doc_id, ids, words, width, unnest(range(1, len(ids) - width + 2)) AS n
    FROM whole, (SELECT CAST(pow(2, unnest(range(0, 16))) AS BIGINT) AS width) WHERE width <= len(ids))
), shared AS (
  SELECT *, row_number() OVER (PARTITION BY width, run ORDER BY doc_id, n) AS copy, count(*) OVER (PARTITION BY width, run) AS copies FROM runs
), gone AS (
  SELECT DISTINCT s.doc_id, s.pos FROM solid s JOIN (
    SELECT doc_id, unnest(range(n, n + width)) AS n FROM shared WHERE copy > 1 AND (width > 1 OR words >= 5)) g USING (doc_id, n)
), kept AS (
  SELECT l.doc_id, string_agg(l.own, chr(10) ORDER BY l.pos) AS text FROM line l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
  GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(w.deepest, 0) AS deepest,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM solid GROUP BY doc_id) s USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT doc_id, max(width) AS deepest FROM shared WHERE copies > 1 GROUP BY doc_id) w USING (doc_id)
"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


SQL["op11_merkle_manifest"] = rf"""
WITH RECURSIVE leafs AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS given
  FROM documents
), pos AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM leafs
), node AS (
  SELECT lang, 0 AS level, k, leaf AS h, n FROM pos
  UNION ALL
  SELECT lang, level + 1, k // 2, sha256(string_agg(h, '' ORDER BY k)), (max(n) + 1) // 2 FROM node WHERE n > 1 GROUP BY lang, level, k // 2
), subs AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
  SELECT 0 AS level, k, subroot AS h, n FROM subs
  UNION ALL
  SELECT level + 1, k // 2, sha256(string_agg(h, '' ORDER BY k)), (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY level, k // 2
), walk AS (
  SELECT doc_id, lang, p.k AS start, 0 AS part, 0 AS level, p.k, p.n, '' AS sibs, given AS h FROM pos p
  UNION ALL
  SELECT w.doc_id, w.lang, w.start, CASE WHEN w.n > 1 THEN w.part ELSE 1 END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
    CASE WHEN w.n > 1 THEN w.k // 2 ELSE s.k END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE s.n END,
    CASE WHEN w.n > 1 THEN w.sibs || coalesce(a.h, t.h, '') ELSE w.sibs END,
    CASE WHEN w.n = 1 THEN w.h WHEN w.k % 2 = 1 THEN sha256(coalesce(a.h, t.h) || w.h) ELSE sha256(w.h || coalesce(a.h, t.h, '')) END
  FROM walk w JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang
  LEFT JOIN node a ON w.part = 0 AND a.lang IS NOT DISTINCT FROM w.lang AND a.level = w.level AND a.k = xor(w.k, 1)
  LEFT JOIN top t ON w.part = 1 AND t.level = w.level AND t.k = xor(w.k, 1)
  WHERE w.n > 1 OR w.part = 0
)
SELECT w.doc_id, p.leaf, s.subroot, t.h AS root, sha256(w.sibs) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
FROM walk w JOIN pos p ON p.lang IS NOT DISTINCT FROM w.lang AND p.k = w.start
JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang JOIN top t ON t.n = 1
WHERE w.part = 1 AND w.n = 1
"""

SQL["op12_conversation_trie"] = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS rn FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, c - c % 5 AS base, {_crc32("c")} % 9 AS h FROM (SELECT DISTINCT c FROM t)
), said AS (
  SELECT i.c, 0 AS part, rn, r, x FROM ids i JOIN t ON t.c = i.base AND rn <= h
  UNION ALL SELECT i.c, 1, rn, r, x FROM ids i JOIN t ON t.c = i.c AND rn > h
), turn AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, rn) AS d, strlen(x) AS b, sha256(strlen(r) || ':' || r || x) AS m FROM said
), member AS (
  SELECT c, d, b, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS k FROM turn UNION ALL SELECT c, 0, 0, '' FROM ids
), node AS (
  SELECT k, d, min(c) AS conv, count(*) AS n, max(b) AS b FROM member GROUP BY k, d
), ends AS (
  SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, max(d) AS d FROM member GROUP BY c) JOIN member USING (c, d) GROUP BY k
), kids AS (
  SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), sub AS (
  SELECT left(u.k, 64 * u.i) AS k, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((u.n - 1) * u.b) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM node) u LEFT JOIN kids c ON c.k = u.k GROUP BY 1
)
SELECT a.conv AS conv_id, a.d AS depth, p.conv AS parent_conv_id, a.n AS n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node a JOIN sub s ON s.k = a.k LEFT JOIN kids c ON c.k = a.k LEFT JOIN ends e ON e.k = a.k
LEFT JOIN node p ON a.d > 0 AND p.d = a.d - 1 AND p.k = left(a.k, 64 * (a.d - 1))
"""
