"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP3 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
s AS (
  SELECT k.doc_id, k.line, k.pos, r.key IS NULL OR k.doc_id = r.holder AS stays
  FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('20:' || doc_id), 1, 15))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER lower_ones, 0) AS cut_size, sum(weight) OVER upper_ones AS open_weight
  FROM s
  WINDOW lower_ones AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         upper_ones AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
rate AS (
  SELECT arg_min((total - cut_size * 3.0) / open_weight, 3.0 * source_size / weight) AS rate FROM o
  WHERE 3.0 * source_size >= weight * (total - cut_size * 3.0) / open_weight),
t AS (
  SELECT source, source_size, least(source_size * 3.0, weight * rate)::DOUBLE AS target FROM s, rate),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, d.source, b.source_size, b.target, b.epochs,
         round(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size::BIGINT AS size, source, source_size, target,
       (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken
FROM p
"""

OP8 = r"""
WITH r AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
s AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST) AS no,
         string_agg(role || chr(1) || text, chr(2) ORDER BY role, text) AS step,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY role, text) AS part
  FROM r GROUP BY conv_id, turn),
p AS (
  SELECT conv_id, no, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(step, chr(3)) OVER (PARTITION BY conv_id ORDER BY no) AS prefix FROM s),
e AS (
  SELECT conv_id, n_turns, prefix, conv_id = min(conv_id) OVER (PARTITION BY n_turns, prefix) AS first
  FROM p WHERE no = n_turns),
i AS (SELECT DISTINCT no, prefix FROM p WHERE no < n_turns),
k AS (
  SELECT conv_id, n_turns, first AND i.prefix IS NULL AS kept
  FROM e LEFT JOIN i ON i.no = e.n_turns AND i.prefix = e.prefix),
c AS (SELECT conv_id, string_agg(part, '' ORDER BY no) AS chat FROM s GROUP BY conv_id)
SELECT k.conv_id, n_turns, kept, CASE WHEN kept THEN length(chat) END AS n_chars,
       CASE WHEN kept THEN sha256(chat) END AS chat_sha256
FROM k JOIN c ON k.conv_id = c.conv_id
"""

# Unsigned CRC-32 of an ASCII string: each byte, then eight shifts.
CRC32 = """xor(list_reduce(flatten([[4294967295::BIGINT], flatten(list_transform(string_split({text}, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

OP11 = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         %(crc)s %% 20 AS code
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM c WHERE code <> 0),
o AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                 WHEN pos > min(pos) OVER (PARTITION BY conv_id, role, text) THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
         left(role, 1) AS init, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM o),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || init NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
-- up to two inserts, then one edit of the row; the end takes inserts alone
ins(q, q1, pre, cost, lines) AS (VALUES
  (0, 0, '', 0, ''), (0, 2, 'I', 3, 'user:'), (0, 3, 'II', 6, 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', 0, ''), (1, 2, 'I', 3, 'user:'), (1, 3, 'II', 6, 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', 0, ''), (2, 3, 'I', 3, 'assistant:'), (3, 3, '', 0, ''), (3, 2, 'I', 3, 'user:')),
step(q1, edit, init, q2, cost, role) AS (VALUES
  (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
  (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'),
  (3, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant'),
  (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL)),
r AS (
  SELECT conv_id, n AS pos, q, struct_pack(cost := cost, audit := pre, out := CASE WHEN lines = '' THEN '' ELSE lines || chr(10) END) AS best
  FROM (SELECT DISTINCT conv_id, n FROM o), ins WHERE (q1 = 3) OR (q = 0 AND q1 = 0)
  UNION ALL
  SELECT conv_id, pos, q, min(best) FROM (
    SELECT f.conv_id, f.pos - 1 AS pos, ins.q,
           struct_pack(cost := ins.cost + step.cost + CASE WHEN edit <> 'D' AND fault = 3 THEN 3 ELSE 0 END + r.best.cost,
                       audit := pre || edit || r.best.audit,
                       out := CASE WHEN lines = '' THEN '' ELSE lines || chr(10) END
                              || CASE WHEN edit = 'D' THEN '' ELSE coalesce(step.role, f.role) || ':' || f.text || chr(10) END
                              || r.best.out) AS best
    FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.pos
    JOIN step ON step.q2 = r.q AND (edit <> 'K' OR step.init = f.init) AND (edit = 'D' OR fault NOT IN (1, 2))
    JOIN ins ON ins.q1 = step.q1)
  GROUP BY conv_id, pos, q),
b AS (SELECT conv_id, min(best) AS best FROM r WHERE pos = 0 AND q = 0 GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(best.out[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
""" % {"crc": CRC32.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}

OP12 = r"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN %(crc)s %% 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS told FROM documents),
h AS (
  SELECT doc_id, source, sha256(%(head)s || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(%(head)s || coalesce(strlen(told) || ':' || told, '-')) AS claimed
  FROM d),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j,
         count(*) OVER (PARTITION BY source) AS n
  FROM h),
t(source, level, j, n, hash) AS (
  SELECT source, 0, j, n, leaf FROM l
  UNION ALL
  SELECT source, level + 1, j // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY j)) FROM t
  WHERE n > 1 GROUP BY source, level, j // 3, n),
s AS (
  SELECT source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, j, n, hash) AS (
  SELECT 0, j, n, hash FROM s
  UNION ALL
  SELECT level + 1, j // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY j)) FROM u
  WHERE n > 1 GROUP BY level, j // 3, n),
p(doc_id, source, leaf, j, n, level, proof, folded) AS (
  SELECT doc_id, source, leaf, j, n, 0, '', claimed FROM l
  UNION ALL
  SELECT doc_id, p.source, leaf, p.j // 3, (p.n + 2) // 3, p.level + 1,
         proof || coalesce(string_agg(t.hash, '' ORDER BY t.j) FILTER (t.j <> p.j), ''),
         sha256(string_agg(CASE WHEN t.j = p.j THEN folded ELSE t.hash END, '' ORDER BY t.j))
  FROM p JOIN t ON t.source IS NOT DISTINCT FROM p.source AND t.level = p.level AND t.j // 3 = p.j // 3
  WHERE p.n > 1 GROUP BY doc_id, p.source, leaf, p.j, p.n, p.level, proof, folded),
q(doc_id, leaf, subroot, j, n, level, proof, folded) AS (
  SELECT doc_id, leaf, s.hash, s.j, s.n, 0, proof, folded FROM p JOIN s ON s.source IS NOT DISTINCT FROM p.source WHERE p.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, q.j // 3, (q.n + 2) // 3, q.level + 1,
         proof || coalesce(string_agg(u.hash, '' ORDER BY u.j) FILTER (u.j <> q.j), ''),
         sha256(string_agg(CASE WHEN u.j = q.j THEN folded ELSE u.hash END, '' ORDER BY u.j))
  FROM q JOIN u ON u.level = q.level AND u.j // 3 = q.j // 3
  WHERE q.n > 1 GROUP BY doc_id, leaf, subroot, q.j, q.n, q.level, proof, folded)
SELECT doc_id, leaf, subroot, u.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.hash AS verified
FROM q JOIN u ON u.n = 1 WHERE q.n = 1
""" % {"crc": CRC32.format(text="doc_id::VARCHAR"),
       "head": " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))}
