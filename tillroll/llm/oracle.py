"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from tillroll.llm.common import LOWER, UPPER
from tillroll.llm.mixing import BLOCK_DOCS, UNIT
from tillroll.llm.prefix_trie import HEADS, MODULUS
from tillroll.llm.quality import MAX_DOCS, MAX_REPEAT_PCT, MAX_SHARE, MIN_LEFT, MIN_WORDS
from tillroll.llm.spelling import EVERY, MIN_COUNT, MIN_LENGTH, RATIO

#: A line ``x`` in its normal form.
NORMAL = rf"""trim(regexp_replace(translate(x, '{UPPER}123456789', '{LOWER}000000000'),
      '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"""

#: Common table expressions over ``documents`` that end in ``judged``; ``gone`` has the rebuilt texts.
QUALITY_CTES = rf"""
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t
  FROM {{docs}}),
word AS (
  SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS x
  FROM (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM doc)),
gram AS (
  SELECT r, i, x AS a, lead(x, 1) OVER p AS b, lead(x, 2) OVER p AS c FROM word
  WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM gram WHERE c IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) s(d) GROUP BY r),
counted AS (SELECT r, count(*) AS n_words, sum(length(x)) AS word_chars FROM word GROUP BY r),
raw_line AS (
  SELECT r, x FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM doc)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM raw_line GROUP BY r),
line AS (
  SELECT r, ('0x' || substr(md5({NORMAL}), 1, 15))::BIGINT AS h FROM raw_line),
holder AS (SELECT DISTINCT host, h, md5(t) AS content FROM line JOIN doc USING (r)),
hosts AS (SELECT host, count(DISTINCT content) AS host_docs FROM holder GROUP BY host),
common AS (
  SELECT host, list(h) AS gone FROM (SELECT host, h, count(*) AS n_docs FROM holder GROUP BY host, h)
  JOIN hosts USING (host)
  WHERE n_docs > {MAX_DOCS} AND n_docs > {MAX_SHARE}::DOUBLE * host_docs GROUP BY host),
cleaned AS (
  SELECT r, array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT list_contains(gone,
    ('0x' || substr(md5({NORMAL}), 1, 15))::BIGINT)), chr(10)) AS clean_text FROM doc JOIN common USING (host)),
gone AS (
  SELECT r, clean_text, len(list_filter(regexp_split_to_array(clean_text, '[\x20\x09-\x0D]+'),
    lambda x: x <> '')) AS n_left FROM cleaned),
judged AS (
  SELECT r, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_words, 0) < {MIN_WORDS}
      OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEAT_PCT} * coalesce(n_words, 0) AS base_failed,
    coalesce(n_left < {MIN_LEFT}::DOUBLE * n_words, false) AS depleted
  FROM doc LEFT JOIN counted USING (r) LEFT JOIN covered USING (r) LEFT JOIN dup USING (r)
    LEFT JOIN gone USING (r))
"""

#: Common table expressions over ``documents`` that end in ``mixed``: the schedule slot by slot.
MIXING_CTES = f"""
src AS (SELECT coalesce(source, '') AS s, count(*) AS n, sqrt(count(*)) AS w FROM {{docs}} GROUP BY 1),
part AS (
  SELECT s, (n - 1) // {BLOCK_DOCS} + 1 AS blocks, row_number() OVER (ORDER BY s) AS i,
    greatest(1, round(w / max(w) OVER () * {UNIT})::HUGEINT) AS a
  FROM src),
tot AS (
  SELECT sum(a)::HUGEINT AS total, list(a ORDER BY s) AS a, list(blocks ORDER BY s) AS blocks,
    max((blocks * (SELECT sum(a)::HUGEINT FROM part) + a - 1) // a) AS last FROM part),
edf(t, c, pick) AS (
  SELECT -1::BIGINT, list_transform(a, lambda x: 0::BIGINT), 0::BIGINT FROM tot
  UNION ALL
  SELECT t + 1, list_transform(c, lambda x, i: x + coalesce(i = b, false)::BIGINT), b FROM (
    SELECT t, c, (list_min(list_transform(tot.a, lambda p, i: CASE
        WHEN c[i] < blocks[i] AND (c[i] * total) // p <= t + 1
        THEN (((c[i] + 1) * total + p - 1) // p) * 100000 + i END)) % 100000)::BIGINT AS b
    FROM edf, tot WHERE t + 1 < last)),
slot AS (
  SELECT s, t AS slot, row_number() OVER (PARTITION BY s ORDER BY t) - 1 AS block
  FROM edf JOIN part ON pick = part.i WHERE t >= 0),
ranked AS (
  SELECT *, coalesce(source, '') AS s, row_number() OVER (
    PARTITION BY coalesce(source, '') ORDER BY ('0x' || substr(md5(
      coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT, doc_id) - 1 AS rank
  FROM {{docs}}),
mixed AS (
  SELECT ranked.* EXCLUDE (s, rank), block AS mix_block, slot AS mix_slot, rank % {BLOCK_DOCS} AS mix_place
  FROM ranked JOIN slot ON ranked.s = slot.s AND rank // {BLOCK_DOCS} = block)
"""

#: The byte table of CRC-32, and the checksum of a list of bytes.
CRC_TABLE = """
crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), b))
    AS crc_t)"""


def crc32(codes: str) -> str:
    return (f"xor(list_reduce({codes}, lambda a, b: xor(a >> 8, crc_t[(xor(a, b) & 255) + 1]), "
            "4294967295), 4294967295)")


#: Near words by the texts that remain when one letter is left out.
SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
run AS (
  SELECT d, r, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS d,
      unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= {MIN_LENGTH} GROUP BY d, r),
hashed AS (
  SELECT r, k, {crc32("""flatten(list_transform(string_split(d || ':' || r, ''),
      lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195, ord(x)::BIGINT - 64] END))""")} AS h
  FROM run, crc_table),
counted AS (
  SELECT w, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % {EVERY} = 0 THEN substr(r, 1, (h % length(r))::BIGINT)
      || substr(r, (h % length(r))::BIGINT + 2) ELSE r END AS w FROM hashed)
  WHERE length(w) >= {MIN_LENGTH} GROUP BY w HAVING sum(k) >= {MIN_COUNT}),
less AS (
  SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS s
  FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM counted)),
near AS (
  SELECT DISTINCT a.w, b.w AS v, b.n FROM less a JOIN less b ON a.s = b.s AND a.i = b.i AND a.w <> b.w
  UNION SELECT DISTINCT a.w, b.w, b.n FROM less a JOIN counted b ON a.s = b.w
  UNION SELECT DISTINCT b.w, a.w, a.n FROM less a JOIN counted b ON a.s = b.w),
best AS (
  SELECT w, count(*) AS n_near, max(n) AS top, arg_min(v, (-n, hex(encode(v)))) AS v FROM near GROUP BY w),
formed AS (
  SELECT c.w, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {RATIO} * c.n THEN v END AS form,
    CASE WHEN top >= {RATIO} * c.n THEN top END AS form_n
  FROM counted c LEFT JOIN best USING (w)),
chain(w, root, form) AS (
  SELECT w, w, form FROM formed
  UNION ALL SELECT c.w, f.w, f.form FROM chain c JOIN formed f ON c.form = f.w)
SELECT f.w AS word, f.form, c.root, n, n_near, form_n FROM formed f JOIN chain c ON f.w = c.w AND c.form IS NULL"""

TRIE_SQL = f"""
WITH {CRC_TABLE},
own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, c - c % {MODULUS} AS b, ({crc32("list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)")}
    % {HEADS})::BIGINT AS h FROM (SELECT DISTINCT c FROM own), crc_table),
head AS (SELECT conv.c, p AS d, role, text FROM conv JOIN own ON own.c = b AND p <= h),
turn AS (
  SELECT * FROM head
  UNION ALL SELECT own.c, p - h + (SELECT count(*) FROM head WHERE head.c = own.c), role, text
  FROM own JOIN conv USING (c) WHERE p > h),
path AS (
  SELECT c, d, strlen(text) AS bytes, count(*) OVER (PARTITION BY c) AS len,
    string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS k FROM turn),
member AS (
  SELECT c, d, bytes, len, k FROM path
  UNION ALL SELECT conv.c, 0, 0, (SELECT count(*) FROM turn WHERE turn.c = conv.c), '' FROM conv),
node AS (
  SELECT k, any_value(d) AS d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(CASE WHEN len = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM member GROUP BY k),
kids AS (SELECT substr(k, 1, 32 * (d::BIGINT - 1)) AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
up AS (
  SELECT substr(k, 1, 32 * j) AS k, sum(saved) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM (SELECT node.*, n_children, unnest(range(d::BIGINT + 1)) AS j FROM node LEFT JOIN kids USING (k)) GROUP BY 1)
SELECT node.c AS conv_id, node.d::BIGINT AS depth, top.c AS parent_conv_id, node.n AS n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, up.saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN up USING (k) LEFT JOIN kids USING (k)
  LEFT JOIN node top ON node.d > 0 AND top.k = substr(node.k, 1, 32 * (node.d::BIGINT - 1))"""

ORACLE_SQL = {
    "op11_spelling_variants": SPELLING_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op8_mixing": f"""WITH RECURSIVE {MIXING_CTES.replace('{docs}', 'documents')}
SELECT * FROM mixed""",
    "op7_quality_rules": f"""WITH {QUALITY_CTES.replace('{docs}', 'documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT depleted AS kept
FROM judged""",
}
