"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import string

from tracequarry.llm import license_scan, quality, quote_linking


def _pattern(template: str) -> str:
    """A template as a regular expression over words with a blank behind each."""
    out = []
    for part in template.replace("<<", " <<").replace(">>", ">> ").split():
        if part == "<<optional>>":
            out.append("(")
        elif part == "<<end>>":
            out.append(")?")
        elif part.startswith("<<var:"):
            least, most = part[6:-2].split("-")
            out.append(f"([^ ]+ ){{{least},{most}}}")
        else:
            out.append(part + " ")
    return " " + "".join(out)


def license_sql() -> str:
    phrases = []
    for phrase, label in license_scan.PHRASES:
        words = phrase.split()
        same = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(words))
        phrases.append(f"list_transform(list_filter(range(0, len(ws)), lambda i: {same}), lambda i: {{'i': i, 'l': '{label}'}})")
    labels = ", ".join(f"CASE WHEN regexp_matches(norm, '{_pattern(t)}') THEN '{label}' END" for label, t in license_scan.TEMPLATES)
    return f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS norm FROM w),
p AS (
  SELECT doc_id, ws, CASE WHEN regexp_matches(norm, ' ({'|'.join(p for p, _ in license_scan.PHRASES)}) ')
      THEN flatten([{', '.join(phrases)}]) ELSE [] END AS found,
    list_filter([{labels}], lambda x: x IS NOT NULL) AS own
  FROM n)
SELECT doc_id, len(ws) AS n_words, len(found) AS n_base, list_min(list_transform(found, lambda x: x.i)) AS first_word,
  list_max(list_transform(found, lambda x: x.i)) AS last_word, array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.l))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(found, lambda x: x.l), own))), ',') AS labels,
  CASE WHEN len(own) > 0 THEN 1.0 WHEN len(found) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM p"""


def quality_sql() -> str:
    space = r"[ \t\n\x0b\f\r]"
    common = ", ".join(f"'{w}'" for w in quality.COMMON_WORDS)
    hits = ", ".join(f"len(list_filter(cw, lambda x: x = '{w}'))" for w in quality.COMMON_WORDS)
    lost = lambda p: f"(length(t) - length(regexp_replace(t, '{p}', '', 'g')))"
    punctuation = "[" + "".join("\\" + c for c in quality.PUNCTUATION).replace("'", "''") + "]"

    def nearest(kind: str) -> str:
        return f"""
{kind}_p AS (SELECT doc_id, generate_subscripts({kind}, 1) AS i, unnest({kind})::DOUBLE / list_sum({kind}) AS p FROM counted WHERE list_sum({kind}) > 0),
{kind}_s AS (
  SELECT l, i, sum(x)::DOUBLE AS x FROM (
    SELECT unnest(CASE WHEN lang IN (SELECT lang FROM owned) THEN [lang, NULL] ELSE [NULL] END) AS l, {kind} FROM counted WHERE NOT failed) q, LATERAL (
    SELECT generate_subscripts(q.{kind}, 1) AS i, unnest(q.{kind}) AS x) GROUP BY l, i),
{kind}_r AS (SELECT l, i, x / sum(x) OVER (PARTITION BY l) AS r FROM {kind}_s),
{kind}_a AS (
  SELECT doc_id, l, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + r) / 2)) ELSE 0 END + CASE WHEN r > 0 THEN r * log2(r / ((p + r) / 2)) ELSE 0 END) / 2), 0)) AS d
  FROM {kind}_p JOIN {kind}_r USING (i) GROUP BY doc_id, l),
{kind}_d AS (SELECT doc_id, min(d) AS d FROM {kind}_a GROUP BY doc_id)"""

    return f"""
WITH a AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS ws,
    list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+'), lambda x: x IN ({common})) AS cw,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS ls
  FROM documents),
wd AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM a),
tri AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM wd WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM tri WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 3) r(k) GROUP BY doc_id),
b AS (
  SELECT doc_id, lang, t, len(ws) AS nw, length(array_to_string(ws, '')) AS wc, {lost(r'[#*$%&|<>]')} AS sym,
    len(ls) - len(list_distinct(ls)) AS dup, coalesce(cov.n, 0) AS rep, cw,
    {lost('[a-z]')} AS lo, {lost(space)} AS sp, {lost(r'[\p{Lu}]')} AS up, {lost(r'[\p{L}]')} AS le, {lost(r'[\p{N}]')} AS di, {lost(punctuation)} AS pu
  FROM a LEFT JOIN cov USING (doc_id)),
counted AS (
  SELECT *, nw < 50 OR 100 * rep > 50 * nw AS failed, [lo, sp, up, le - up - lo, di, pu, sym, length(t) - le - sp - di - pu - sym] AS cl, list_concat([{hits}], [greatest(nw - len(cw), 0)]) AS wo FROM b),
owned AS (
  SELECT lang FROM counted WHERE NOT failed AND lang IS NOT NULL GROUP BY lang
  HAVING count(*) >= {quality.MIN_ROWS} AND sum(cl[1] + cl[3] + cl[4]) >= {quality.MIN_LETTERS} * sum(list_sum(cl) - cl[2])),
{nearest('cl')},
{nearest('wo')}
SELECT doc_id, nw AS n_words, wc AS word_chars, sym AS n_symbols, dup AS n_dup_lines, rep AS n_repeat_words, failed AS base_failed,
  NOT failed AND CASE WHEN owns THEN coalesce(c, 0) <= {quality.MAX_CLASS_DISTANCE} AND coalesce(w, 0) <= {quality.MAX_WORD_DISTANCE}
    ELSE cl[1] + cl[3] + cl[4] + cl[5] >= {quality.MIN_LETTERS} * (list_sum(cl) - cl[2]) END AS kept,
  round(c, 6) AS class_distance, round(w, 6) AS word_distance
FROM (
  SELECT counted.*, lang IS NOT NULL AND lang IN (SELECT lang FROM owned) AS owns, CASE WHEN length(t) >= {quality.MIN_CHARS} THEN cl_d.d END AS c, CASE WHEN nw >= {quality.MIN_WORDS} THEN wo_d.d END AS w
  FROM counted LEFT JOIN cl_d USING (doc_id) LEFT JOIN wo_d USING (doc_id))"""


#: Node keys are the joined digests of the turns; crc32 goes bit by bit.
TRIE = """
WITH base AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM base)),
turns AS (
  SELECT i.c, place, role, text FROM ids i JOIN base b ON b.c = i.c - i.c % 20 WHERE place < h
  UNION ALL SELECT b.c, place, role, text FROM base b JOIN ids i ON b.c = i.c WHERE place >= h),
mem AS (
  SELECT c, 0 AS d, '' AS k, 0 AS w FROM ids
  UNION ALL SELECT c, row_number() OVER (PARTITION BY c ORDER BY place),
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY place),
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) FROM turns),
nodes AS (SELECT k, d, min(c) AS conv, count(*) AS n, min(w) AS w FROM mem GROUP BY k, d),
kids AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
told AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
below AS (
  SELECT left(k, 64 * j) AS k, sum((n - 1) * w) AS saved, sum((n_children = 0)::INT) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM told) GROUP BY 1),
ends AS (
  SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(k, d) AS k FROM mem GROUP BY c) GROUP BY k)
SELECT t.conv AS conv_id, t.d::BIGINT AS depth, p.conv AS parent_conv_id, t.n::BIGINT AS n_convs, t.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM told t JOIN below USING (k) LEFT JOIN ends USING (k) LEFT JOIN nodes p ON t.d > 0 AND p.k = left(t.k, 64 * (t.d - 1))"""


def oracle_sql() -> dict[str, str]:
    return {"op13_prefix_trie": TRIE, "op5_quote_linking": quote_linking.ORACLE, "quoted_conversations": quote_linking.QUOTED_ORACLE, "op6_license_scan": license_sql(), "op10_quality_rules": quality_sql()}
