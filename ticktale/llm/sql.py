"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

W = r"[^\x20\x09-\x0D]+"

#: The stop words and thresholds of the quality rules.
QUALITY = rf"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{W}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
             regexp_replace(t, '[^\p{{L}}]+', ' ', 'g') AS le FROM d),
g AS (SELECT doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS win
      FROM w, range(1, len(ws) - 1) r(i)),
rep AS (SELECT doc_id, win FROM g GROUP BY ALL HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM g JOIN rep USING (doc_id, win), range(0, 3) r(o) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        COALESCE(cov.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(string_split(lower(le), ' '), lambda x: x IN ({{stop}}))) AS n_stop,
        length(replace(le, ' ', '')) AS n_letters,
        length(le) - length(regexp_replace(le, '\p{{Lu}}', '', 'g')) AS n_upper
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {{checks}} AS kept FROM f
"""


def _quality() -> str:
    from ticktale.llm.quality import RULES, STOP_WORDS
    value = {"n_words": "n_words", "repeat_ratio": "n_repeat_words / n_words", "symbol_ratio": "n_symbols / n_words",
             "dup_line_ratio": "n_dup_lines / n_lines", "mean_word_length": "word_chars / n_words",
             "stop_word_ratio": "n_stop / n_words", "letter_ratio": "n_letters / word_chars",
             "upper_ratio": "n_upper / n_letters"}
    checks = []
    for r in RULES:
        v = f"({value[r.measure]})::DOUBLE"
        low = "TRUE" if r.low is None else f"{v} >= {r.low}::DOUBLE"
        high = "TRUE" if r.high is None else f"{v} <= {r.high}::DOUBLE"
        checks.append(f"COALESCE({low} AND {high}, TRUE)")
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return QUALITY.replace("{stop}", stop).replace("{checks}", " AND ".join(checks))


EXACT = """
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
      FROM w, range(1, greatest(len(ws) - 3, 2)) r(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * common >= 85 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
          SELECT r.a, t.b FROM reach r JOIN both_ways t ON t.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, COALESCE(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

WINDOWS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '{W}') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM w, range(1, len(ws) - 11) r(i)),
m AS (SELECT win, min(doc_id) AS low FROM g GROUP BY win),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM g JOIN m USING (win), range(0, 13) r(o) WHERE doc_id > low),
k AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, COALESCE(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE
    list_filter(ws, lambda x, j: NOT list_contains(ps, j)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""

#: Bytes are hexadecimal digit pairs here.
BYTES = """
WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS win FROM d, range(0, (length(h) // 2 - 49)) r(i)),
m AS (SELECT win, min(doc_id) AS low FROM g GROUP BY win HAVING count(*) > 1),
s AS (SELECT doc_id, i FROM g JOIN m USING (win) WHERE doc_id > low),
o AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM s),
r AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
x AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
y AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS kept_from FROM x),
k AS (SELECT y.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
        string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY run) AS kept
      FROM y JOIN d ON d.doc_id = y.doc_id GROUP BY y.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, COALESCE(n_removed, 0)::BIGINT AS n_removed,
  COALESCE(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

#: crc32 by its table: UTF-8 bytes come as hexadecimal digit pairs.
SPELLING = r"""
WITH RECURSIVE byte_table AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(0, 256) r(i))),
run AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY ALL),
hashed AS (SELECT w, k, xor(list_reduce(
    list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT w, k, hex(encode(COALESCE(doc_id::VARCHAR, '') || ':' || w)) AS x FROM run), byte_table),
v AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 199 = 0
    THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
  GROUP BY word HAVING length(word) >= 6 AND sum(k) >= 5),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM v, range(0, length(word)) r(i)),
pair AS (SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, v.word FROM less JOIN v ON v.word = less.rest
  UNION SELECT v.word, less.word FROM less JOIN v ON v.word = less.rest),
best AS (SELECT pair.word, count(*) AS n_near, arg_min(struct_pack(w := near, n := b.n), (-b.n, near)) AS top
  FROM pair JOIN v b ON b.word = near GROUP BY pair.word),
f AS (SELECT v.word, v.n, COALESCE(n_near, 0)::BIGINT AS n_near, CASE WHEN top.n >= 5 * v.n THEN top.w END AS form,
    CASE WHEN top.n >= 5 * v.n THEN top.n END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
walk AS (SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN walk ON walk.word = f.word JOIN f last ON last.word = walk.at AND last.form IS NULL
"""

LEAKS = r"""
WITH lower_docs AS (SELECT doc_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
item AS (SELECT item_id, ws, least(len(ws), 10) AS m FROM (SELECT item_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM item, range(1, len(ws) - m + 2) r(i)),
place AS (SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS win
  FROM lower_docs, (SELECT DISTINCT m FROM win) k, range(1, len(ws) - m + 2) r(i)),
met AS (SELECT doc_id, i, m, item_id FROM place JOIN win USING (m, win)),
hit AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT doc_id, i, m FROM met), range(0, m) r(o) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM lower_docs d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id
"""

ORACLES = {
    "op11_spelling": SPELLING,
    "op12_decontaminate": LEAKS,
    "op1_suffix_dedup": BYTES,
    "op9_substring_dedup": WINDOWS,
    "op5_quality": _quality(),
    "op6_minhash": NEAR,
    "op8_exact_dedup": EXACT,
}
