"""The queries that SQL can express, as DuckDB runs them over the same tables.

Constants are written out here, not taken from the operators, so that a wrong one shows.
"""

from __future__ import annotations

from newslens.llm.license_rules import RULES


def _fingerprint_of(numbers: str, everything: str) -> str:
    parts = []
    for r in range(7):
        for below in (64, 32, 16, 8, 4, 2, 1):
            kept = f"list_filter({numbers}, lambda x: ((x >> {8 * r}) & 255) < {below})"
            parts.append(f"CASE WHEN len({kept}) = 0 THEN '0000' ELSE md5({kept}::VARCHAR)[1:4] END")
    some = f"md5({numbers}::VARCHAR)[1:16] || " + " || ".join(parts)
    return f"CASE WHEN len({numbers}) > 0 THEN {some} ELSE {everything} || repeat('0', 196) END"


def _likeness(a: str, b: str) -> str:
    pieces = f"list_transform(range(49), lambda k: [{a}[17 + k * 4 : 20 + k * 4], {b}[17 + k * 4 : 20 + k * 4]])"
    used = f"len(list_filter({pieces}, lambda p: p[1] <> '0000' OR p[2] <> '0000'))"
    same = f"len(list_filter({pieces}, lambda p: p[1] = p[2] AND p[1] <> '0000'))"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {used} = 0 THEN 0.0::DOUBLE ELSE {same}::DOUBLE / {used} END"


IMATCH = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT doc_id, text, length(text)::BIGINT AS n_chars,
    coalesce(lead(doc_id) OVER w, max(doc_id) OVER ()) AS next_id,
    coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM d WINDOW w AS (ORDER BY doc_id DESC)
),
e AS (
  SELECT doc_id, next_id, n_chars, text,
    text[1 : n_chars - n_chars // 2] || CASE WHEN n_chars // 2 = 0 THEN '' ELSE following[1 : n_chars // 2] END AS edited
  FROM o
),
v AS (
  SELECT doc_id, 0 AS edit, list_sort(list_distinct(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'))) AS terms FROM e
  UNION ALL
  SELECT doc_id, 1, list_sort(list_distinct(regexp_split_to_array(lower(edited), '[^\p{{L}}\p{{N}}]+'))) FROM e
),
w AS (SELECT doc_id, edit, unnest(terms) AS term FROM v),
n AS (SELECT count(*) AS n FROM d),
lexicon AS (
  SELECT term, ('0x' || md5(term)[1:14])::BIGINT AS number
  FROM w, n WHERE edit = 0 AND term <> '' GROUP BY term, n
  HAVING count(*) >= greatest(2.0, 0.0005 * n)
    AND count(*) <= greatest(0.2 * n, greatest(2.0, 0.0005 * n))
),
k AS (SELECT doc_id, edit, list_sort(list(number)) AS numbers FROM w JOIN lexicon USING (term) GROUP BY ALL),
f AS (
  SELECT v.doc_id, v.edit, coalesce(numbers, []) AS numbers, md5(array_to_string(terms, ' '))[1:16] AS everything
  FROM v LEFT JOIN k ON v.doc_id = k.doc_id AND v.edit = k.edit
),
g AS (SELECT doc_id, edit, {_fingerprint_of("numbers", "everything")} AS fingerprint FROM f),
h AS (
  SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, a.fingerprint, b.fingerprint AS edited_fingerprint,
    c.fingerprint AS next_fingerprint
  FROM e JOIN g a ON e.doc_id = a.doc_id AND a.edit = 0
  JOIN g b ON e.doc_id = b.doc_id AND b.edit = 1
  JOIN g c ON e.next_id = c.doc_id AND c.edit = 0
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_likeness("fingerprint", "edited_fingerprint")} AS near_edited,
  {_likeness("fingerprint", "next_fingerprint")} AS near_next
FROM h
"""


def _signatures() -> str:
    """The signature rules are data of the scan; the base phrases are written out below."""
    return ", ".join(
        f"({r.rule}, {r.tier}, '{r.label}', '{r.keyword}', '{r.regex}')" for r in RULES if r.tier < 5
    )


def _tokens_in(piece: str) -> str:
    return f"(length({piece}) - length(replace({piece}, ' ', '')))"


LICENSES = rf"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
),
worded AS (
  SELECT r, doc_id, len(regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n_words,
    trim(regexp_replace(low, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' -', 'g'), ' -') AS inner_words
  FROM given
),
lined AS (SELECT r, doc_id, n_words, CASE WHEN inner_words = '' THEN '' ELSE '-' || inner_words || ' ' END AS words FROM worded),
rules(rule, tier, label, keyword, regex) AS (VALUES {_signatures()},
  (100000, 5, 'mit', '-license ', '-mit -license '), (100001, 5, 'apache', '-license ', '-apache -license '),
  (100002, 5, 'gpl', '-license ', '-general -public -license ')),
matched AS (
  SELECT r, rule, tier, label, string_split_regex(words, regex) AS parts, regexp_extract_all(words, regex) AS hits
  FROM lined JOIN rules ON contains(words, keyword) AND regexp_matches(words, regex)
),
placed AS (SELECT *, generate_subscripts(hits, 1) AS i FROM matched),
spans AS (
  SELECT r, rule, tier, label, {_tokens_in("hits[i]")} AS size,
    list_sum(list_transform(parts[1:i], lambda p: {_tokens_in("p")}))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda p: {_tokens_in("p")})), 0) AS first
  FROM placed
),
kept AS (
  SELECT * FROM spans s WHERE tier = 5 OR NOT EXISTS (
    SELECT 1 FROM spans e WHERE e.r = s.r AND e.first <= s.first AND e.first + e.size >= s.first + s.size
      AND (e.tier < s.tier OR (e.tier = s.tier AND (e.size > s.size OR (e.size = s.size AND e.rule < s.rule)))))
),
base AS (
  SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM spans WHERE tier = 5 GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_kept, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(CASE tier WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 WHEN 3 THEN 0.9 WHEN 4 THEN 0.6 ELSE 0.75 END)::DOUBLE AS score
  FROM kept GROUP BY r
),
counted AS (SELECT r, count(*) AS n_found FROM spans GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0::DOUBLE) AS score, coalesce(n_found, 0)::BIGINT AS n_found, coalesce(n_kept, 0)::BIGINT AS n_kept
FROM lined LEFT JOIN base USING (r) LEFT JOIN named USING (r) LEFT JOIN counted USING (r)
"""

SQL = {"op1_imatch": IMATCH, "op13_licenses": LICENSES}
