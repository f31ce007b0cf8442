"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

SQL = {}

SQL["op5_host_rules"] = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM t),
g AS (SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS gram
      FROM w, unnest(range(1, greatest(1, len(ws) - 1))) AS u(i)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM d, range(0, 3) AS x(k) GROUP BY r),
s AS (SELECT w.r, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN c ON w.r = c.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
f AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_words AS failed FROM b),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k FROM f GROUP BY source),
m AS (SELECT count(*) AS hosts, (sum(k) + 0.5) / (sum(n) + 1.0) AS mean, coalesce(var_samp(k / n), 0) AS spread,
             avg(1 / n) AS inv FROM h),
p AS (SELECT *, CASE WHEN hosts > 1 THEN greatest(0.0, spread - mean * (1 - mean) * inv) ELSE 0.0 END AS gap FROM m),
q AS (SELECT mean, CASE WHEN gap > 0 THEN greatest(2.0, mean * (1 - mean) / gap - 1) WHEN hosts > 1 THEN 2000.0 ELSE 2.0 END
             AS strength FROM p),
j AS (SELECT source, (mean * strength + k) / (strength + n) AS rate, strength + n AS weight FROM h, q),
v AS (SELECT source, rate, rate - 2.0 * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5 AS bad FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept,
       floor(rate * 1048576.0 + 0.5) / 1048576.0 AS host_rate
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""

SQL["op10_vector_graph"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
c(id, reach) AS (SELECT vec_id, vec_id FROM v UNION SELECT c.id, l.b FROM c JOIN l ON c.reach = l.a),
m AS (SELECT id, min(reach) AS component_id FROM c GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept, 1.0::DOUBLE AS recall
FROM v JOIN m ON v.vec_id = m.id LEFT JOIN n ON v.vec_id = n.a"""

#: Each byte of an ASCII text enters a CRC-32 register that then takes eight single-bit steps.
def _crc(value: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({value}, ''),
    lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

SQL["op11_merkle"] = f"""
WITH RECURSIVE a AS (SELECT *, {_crc('CAST(doc_id AS VARCHAR)')} AS crc FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, 'n') AS tree, sha256({_HEAD} || {_field("text")}) AS leaf,
             CASE WHEN crc % 2 = 0 THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")})
                  ELSE sha256({_HEAD} || {_field("text")}) END AS other FROM a),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i,
             count(*) OVER (PARTITION BY tree) AS n, dense_rank() OVER (ORDER BY tree) - 1 AS place FROM d),
t(tree, place, lvl, i, n, h) AS (
    SELECT tree, place, 0, i, n, leaf FROM l
    UNION ALL SELECT tree, place, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1
    GROUP BY tree, place, lvl, n, i // 3),
s AS (SELECT tree, place, lvl AS height, h AS subroot FROM t WHERE n = 1),
u(lvl, i, n, h) AS (
    SELECT 0, place, (SELECT count(*) FROM s), subroot FROM s
    UNION ALL SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, n, i // 3),
b AS (SELECT r, t.lvl AS step, t.i < l.i // CAST(3 ** t.lvl AS BIGINT) AS ahead, t.i, h
      FROM l JOIN t ON l.tree = t.tree AND t.n > 1 AND t.i // 3 = l.i // CAST(3 ** (t.lvl + 1) AS BIGINT) AND t.i <> l.i // CAST(3 ** t.lvl AS BIGINT)
      UNION ALL
      SELECT r, s.height + u.lvl, u.i < l.place // CAST(3 ** u.lvl AS BIGINT), u.i, h
      FROM l JOIN s ON l.tree = s.tree JOIN u ON u.n > 1 AND u.i // 3 = l.place // CAST(3 ** (u.lvl + 1) AS BIGINT)
           AND u.i <> l.place // CAST(3 ** u.lvl AS BIGINT)),
p AS (SELECT r, sha256(string_agg(h, '' ORDER BY step, i)) AS proof FROM b GROUP BY r),
e AS (SELECT r, step, coalesce(string_agg(h, '' ORDER BY i) FILTER (ahead), '') AS before,
             coalesce(string_agg(h, '' ORDER BY i) FILTER (NOT ahead), '') AS after FROM b GROUP BY r, step),
m AS (SELECT l.r, s.height + (SELECT max(lvl) FROM u) AS steps FROM l JOIN s ON l.tree = s.tree),
f(r, step, h) AS (
    SELECT r, 0, other FROM l
    UNION ALL SELECT f.r, f.step + 1, sha256(coalesce(e.before, '') || f.h || coalesce(e.after, ''))
    FROM f JOIN m ON f.r = m.r AND f.step < m.steps LEFT JOIN e ON f.r = e.r AND f.step = e.step)
SELECT doc_id, leaf, subroot, u.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM l JOIN s ON l.tree = s.tree JOIN u ON u.n = 1 JOIN m ON l.r = m.r JOIN f ON f.r = l.r AND f.step = m.steps LEFT JOIN p ON l.r = p.r"""

#: States: 0 no turn yet, 1 after system, 2 after user, 3 after assistant. ``ins``: where inserted turns lead and what they
#: write; ``turn``: the next turn's role and the state after it. Strings of edits up to a row are never prefixes of one
#: another, so the least (cost, edits) of each state is all that is kept from row to row.
SQL["op13_turns"] = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
             CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM k, unnest(range(0, CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS u(x) WHERE hit <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said, left(role, 1) AS initial FROM p),
f AS (SELECT *, said = '' AS blank, said <> '' AND seen > 1 AS duplicate,
             said <> '' AND seen = 1 AND right(said, 1) NOT IN ('.', '!', '?') AS cut,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM o),
t AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated,
             count(*) FILTER (illegal) AS illegal FROM f GROUP BY conv_id),
turn(state, role, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
ins(state, n, mid, written) AS (SELECT state, 0, state, '' FROM turn
    UNION ALL SELECT state, 1, after, CASE WHEN state = 0 THEN '' ELSE chr(10) END || role || ':' FROM turn
    UNION ALL SELECT a.state, 2, b.after, CASE WHEN a.state = 0 THEN '' ELSE chr(10) END || a.role || ':' || chr(10) || b.role || ':'
              FROM turn a JOIN turn b ON a.after = b.state),
way(state, n, edit, initial, price, after, written, role) AS (
    SELECT ins.state, n, 'D', NULL, 3 + 2 * n, mid, written, NULL FROM ins
    UNION ALL SELECT ins.state, n, 'R', NULL, 2 + 2 * n, after, written || CASE WHEN mid = 0 THEN '' ELSE chr(10) END, role
              FROM ins JOIN turn ON mid = turn.state
    UNION ALL SELECT ins.state, n, 'K', left(role, 1), 2 * n, after, written || CASE WHEN mid = 0 THEN '' ELSE chr(10) END, NULL
              FROM ins JOIN turn ON mid = turn.state
    UNION ALL SELECT state, 0, 'K', 's', 0, 1, '', NULL FROM ins WHERE mid = 0 AND n = 0),
r(conv_id, i, state, cost, audit, done) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', '' FROM k
    UNION ALL
    SELECT conv_id, i, after, min(cost), substr(min(lpad(CAST(cost AS VARCHAR), 9, '0') || audit), 10),
           arg_min(done, lpad(CAST(cost AS VARCHAR), 9, '0') || audit)
    FROM (SELECT r.conv_id, f.i, w.after, r.cost + w.price + CAST(w.edit <> 'D' AND f.cut AS INTEGER) AS cost,
                 r.audit || repeat('I', w.n) || w.edit AS audit,
                 r.done || w.written || CASE WHEN w.edit = 'D' THEN '' ELSE coalesce(w.role, f.role) || ':' || f.text END AS done
          FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1 JOIN way w ON w.state = r.state
          WHERE w.edit = 'D' OR NOT f.blank AND NOT f.duplicate AND (w.edit = 'R' OR w.initial = f.initial))
    GROUP BY conv_id, i, after),
e AS (SELECT r.conv_id, r.cost + 2 * ins.n AS cost, r.audit || repeat('I', ins.n) AS audit, r.done || ins.written AS done
      FROM r LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM r.conv_id
      JOIN ins ON ins.state = r.state AND ins.mid = CASE WHEN r.state = 0 AND ins.n = 0 THEN 0 ELSE 3 END
      WHERE r.i = coalesce(t.n, 0))
SELECT e.conv_id, CAST(coalesce(any_value(gaps), 0) AS BIGINT) AS gaps, coalesce(any_value(blank), 0) AS blank,
       coalesce(any_value(duplicate), 0) AS duplicate, coalesce(any_value(truncated), 0) AS truncated,
       coalesce(any_value(illegal), 0) AS illegal, CAST(min(cost) AS BIGINT) AS cost,
       arg_min(audit, lpad(CAST(cost AS VARCHAR), 9, '0') || audit) AS audit,
       sha256(arg_min(done, lpad(CAST(cost AS VARCHAR), 9, '0') || audit)) AS repaired_sha256
FROM e LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM e.conv_id GROUP BY e.conv_id"""
