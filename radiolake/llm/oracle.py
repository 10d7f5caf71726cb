"""SQL for those queries of this package that SQL can express."""

from __future__ import annotations

from radiolake.llm.license_scan import PERCENT, SHINGLE, STRIDES, TEMPLATES
from radiolake.llm.quality_rules import FENCES, MEASURES, PRIOR

_MEASURE_SQL = {
    "word_length": "word_chars * 1000 // greatest(n_words, 1)",
    "symbols_per_word": "n_symbols * 1000 // greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words * 1000 // greatest(n_words, 1)",
}
assert set(_MEASURE_SQL) == set(MEASURES)


def quality_sql() -> str:
    def each(field: str) -> str:
        cases = [(f.measure, getattr(f, field)) for f in FENCES]
        return "CASE measure " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in cases if v is not None) + " END"

    def tails(name: str, table: str, *keys: str) -> str:
        by = ", ".join([*keys, "measure"])
        return f"""{name} AS (SELECT {by}, max(n) AS n, min(b) FILTER (100 * u >= {each("lower")} * n) AS lo,
  min(b) FILTER (100 * u >= {each("upper")} * n) AS hi FROM (SELECT *, sum(c) OVER (PARTITION BY {by} ORDER BY b) AS u,
  sum(c) OVER (PARTITION BY {by}) AS n FROM {table}) GROUP BY ALL)"""

    def drawn(q: str) -> str:
        lang = f"floor((q2.{q} * q2.n + q3.{q} * {PRIOR}) / (q2.n + {PRIOR}))"
        return f"CAST(floor((q1.{q} * q1.n + {lang} * {PRIOR}) / (q1.n + {PRIOR})) AS BIGINT)"

    values = " UNION ALL ".join(
        f"SELECT lang, source, doc_id, '{k}' AS measure, {v} AS v FROM counts" for k, v in _MEASURE_SQL.items()
    )
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY 1),
counts AS (SELECT s.doc_id, lang, source, len(ws) AS n_words,
  length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN rep ON rep.doc_id = s.doc_id),
vals AS ({values}),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
sk AS (SELECT lang, source, measure, v - v % CAST(pow(2, greatest(length(bin(v)) - 7, 0)) AS BIGINT) AS b, count(*) AS c
  FROM vals WHERE doc_id IN (SELECT doc_id FROM base WHERE NOT base_failed) GROUP BY ALL),
{tails("q1", "sk", "lang", "source")},
sk2 AS (SELECT lang, measure, b, sum(c) AS c FROM sk GROUP BY ALL),
{tails("q2", "sk2", "lang")},
sk3 AS (SELECT measure, b, sum(c) AS c FROM sk GROUP BY ALL),
{tails("q3", "sk3")},
lv AS (SELECT q1.lang, q1.source, q1.measure, {drawn("lo")} AS lo, {drawn("hi")} AS hi
  FROM q1 JOIN q2 ON q1.lang IS NOT DISTINCT FROM q2.lang AND q1.measure = q2.measure JOIN q3 ON q1.measure = q3.measure),
fence AS (SELECT lang, source, measure, hi + hi * {each("slack")} // 100 + {each("least")} AS high,
  lo - lo * {each("slack")} // 100 - {each("least")} AS low FROM lv),
out AS (SELECT DISTINCT v.doc_id FROM vals v JOIN fence f ON v.lang IS NOT DISTINCT FROM f.lang
  AND v.source IS NOT DISTINCT FROM f.source AND v.measure = f.measure WHERE v.v > f.high OR v.v < f.low)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM out) AS kept
FROM base"""


def decontamination_sql() -> str:
    words = (
        "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        " 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    )
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
b AS (SELECT item_id, {words} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i+9], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM win),
grams AS (SELECT doc_id, i, k, array_to_string(ws[i:i+k-1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
occ AS (SELECT DISTINCT doc_id, i, grams.k, item_id FROM grams JOIN win ON win.k = grams.k AND win.g = grams.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM occ GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
  sha256(coalesce(its.s, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""


def preference_sql() -> str:
    return """
WITH t AS (SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id,
  CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, role, text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.position, r.position) AS position,
  c.pair_id IS NOT NULL AND r.pair_id IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role
    AND c.text IS NOT DISTINCT FROM r.text AS same
  FROM (SELECT * FROM t WHERE side = 'chosen') c FULL JOIN (SELECT * FROM t WHERE side = 'rejected') r
    ON c.pair_id = r.pair_id AND c.position = r.position),
l AS (SELECT pair_id, coalesce(min(position) FILTER (NOT same), max(position) + 1) AS n FROM s GROUP BY 1)
SELECT t.pair_id, CASE WHEN position < n THEN 'prompt' ELSE side END AS part, position, role,
  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered,
  position >= n AND coalesce(role = 'assistant', false) AS trained
FROM t JOIN l ON t.pair_id = l.pair_id WHERE position >= n OR side = 'chosen'"""


def license_sql() -> str:
    words = (
        "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        " 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    )
    given = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in TEMPLATES)
    stride = " ".join(f"WHEN len(ws) <= {s} THEN {s}" for s in STRIDES)
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
t AS (SELECT license, {words} AS ws FROM (VALUES {given}) v(license, text)),
ts AS (SELECT DISTINCT license, stride, k, array_to_string(ws[i:i+k-1], ' ') AS g FROM (
  SELECT license, ws, least(len(ws), {SHINGLE}) AS k, CASE {stride} ELSE len(ws) END AS stride,
    unnest(range(1, len(ws) - least(len(ws), {SHINGLE}) + 2)) AS i FROM t)),
n AS (SELECT license, count(*) AS n FROM ts GROUP BY 1),
ks AS (SELECT DISTINCT k FROM ts),
grams AS (SELECT doc_id, i - 1 AS p, k, array_to_string(ws[i:i+k-1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
m AS (SELECT doc_id, license, p // stride AS w, g FROM grams JOIN ts USING (k, g)
  UNION SELECT doc_id, license, p // stride - 1, g FROM grams JOIN ts USING (k, g)),
f AS (SELECT doc_id, license FROM m JOIN n USING (license) GROUP BY doc_id, license, w, n HAVING 100 * count(*) >= {PERCENT} * n),
u AS (SELECT doc_id, count(DISTINCT license) AS c, string_agg(DISTINCT license, ',' ORDER BY license) AS s FROM f GROUP BY 1)
SELECT d.doc_id, coalesce(u.c, 0) AS n_licenses, coalesce(u.s, '') AS licenses FROM d LEFT JOIN u ON u.doc_id = d.doc_id"""


EXACT_SQL = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS same FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY same) AS keep_id, count(*) OVER (PARTITION BY same) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY same) AS kept, sha256(same) AS text_sha256
FROM t"""


COLLOCATION_SQL = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
c AS (SELECT lang, k, list_slice(ws, i, i + k - 1) AS p, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
often AS (SELECT * FROM c WHERE f >= 30 AND k > 1),
cut AS (SELECT lang, k, p, f AS a, unnest(range(1, k)) AS j FROM often),
s AS (SELECT cut.*, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f) AS BIGINT) AS score
  FROM cut JOIN c x ON x.lang = cut.lang AND x.p = list_slice(cut.p, 1, j)
  JOIN c y ON y.lang = cut.lang AND y.p = list_slice(cut.p, j + 1, cut.k)
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.p ORDER BY score, j) = 1),
inner_parts AS (SELECT lang, list_slice(p, i, i + m - 1) AS p, f FROM
  (SELECT *, unnest(range(1, k - m + 2)) AS i FROM often, (SELECT unnest([2, 3]) AS m) WHERE m < k)),
around AS (SELECT lang, p, max(f) AS f FROM inner_parts GROUP BY ALL),
r AS (SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.p, ' ')) AS rank,
    array_to_string(s.p, ' ') AS phrase, a, l, r, n.n, score
  FROM s JOIN n ON n.lang = s.lang LEFT JOIN around ON around.lang = s.lang AND around.p = s.p
  WHERE NOT coalesce(100 * around.f >= 80 * a, false))
SELECT * FROM r WHERE rank <= 2000"""


SQL: dict[str, str] = {
    "op6_license_scan": license_sql(),
    "op7_decontamination": decontamination_sql(),
    "op9_preference_formatting": preference_sql(),
    "op10_quality_rules": quality_sql(),
    "op11_phrase_collocations": COLLOCATION_SQL,
    "op12_exact_dedup": EXACT_SQL,
}
