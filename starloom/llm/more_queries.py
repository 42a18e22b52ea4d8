"""Queries of spelling variants, register sketches and the conversation trie, and the
comparison SQL that they and the n-gram join share."""

from __future__ import annotations

from starloom.llm import conversation_trie, hyperminhash, spelling

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: ``t``: the 256 steps of the CRC-32.
_CRC_STEPS = """
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
                 lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS i))
"""


def _crc(text: str) -> str:
    """SQL of the CRC-32 of the UTF-8 bytes of ``text``, beside ``t``."""
    steps = f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda k: CAST(concat('0x', substr(hex(encode({text})), k, 2)) AS UBIGINT))"
    reduced = f"list_reduce(list_prepend(4294967295::UBIGINT, {steps}), lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) AS BIGINT) + 1]))"
    return f"xor({reduced}, 4294967295::UBIGINT)"


@_query
def op13_conversation_trie(spark, sf_dir):
    return conversation_trie.conversation_trie(_table(spark, sf_dir, "conversations"), stride=20, most=4)


ORACLES["op13_conversation_trie"] = rf"""
WITH crc_steps AS ({_CRC_STEPS}),
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS p,
         struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, CAST({_crc("CAST(c AS VARCHAR)")} % 4 AS BIGINT) AS h
  FROM (SELECT DISTINCT c FROM turns), crc_steps),
lists AS (SELECT c, list(said ORDER BY p) AS l FROM turns GROUP BY c),
rebuilt AS (
  SELECT v.c, list_concat(coalesce(b.l[1:v.h], []), o.l[v.h + 1:]) AS l
  FROM convs v JOIN lists o USING (c) LEFT JOIN lists b ON b.c = v.c - v.c % 20),
prefixes AS (SELECT c, d, l[1:d] AS k, len(l) AS n FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT k, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends,
         max(CASE WHEN d > 0 THEN len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END) AS w
  FROM prefixes GROUP BY k),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
up AS (
  SELECT k[1:a] AS k, n_convs, w, n_children
  FROM (SELECT k, n_convs, w, coalesce(n_children, 0) AS n_children, unnest(range(d + 1)) AS a
        FROM nodes LEFT JOIN children USING (k))),
sums AS (
  SELECT k, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
         CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved_tokens
  FROM up GROUP BY k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN children USING (k)
LEFT JOIN nodes p ON n.d > 0 AND p.k = n.k[1:n.d - 1]
"""


@_query
def op12_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"), size=5, percent=85)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingle_components(percent: int, more: str = "") -> str:
    return rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM texts WHERE len(ws) > 0)),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y WHERE 100 * k >= {percent} * (a.n + b.n - k)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT r AS a, r AS b FROM sizes UNION SELECT a, y FROM reached JOIN sides ON x = b),
named AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN texts ON texts.r = b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id{more}
FROM texts LEFT JOIN sizes USING (r) LEFT JOIN named USING (r)
"""


ORACLES["op2_ngram_join"] = _shingle_components(80)
ORACLES["op12_hyperminhash"] = _shingle_components(85, ", doc_id = coalesce(component_id, doc_id) AS kept")

ORACLES["op7_substring_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT r, list(DISTINCT p) AS ps
  FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (w) WHERE first < doc_id) GROUP BY r),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM texts),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text
  FROM words LEFT JOIN gone USING (r) WHERE ps IS NULL OR NOT list_contains(ps, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""


@_query
def op11_spelling(spark, sf_dir):
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), damage=97)


ORACLES["op11_spelling"] = rf"""
WITH RECURSIVE crc_steps AS ({_CRC_STEPS}),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, CAST({_crc("concat(id, ':', run)")} AS BIGINT) AS h FROM runs, crc_steps),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
  GROUP BY word HAVING sum(n) >= 3 AND length(word) >= 5),
cuts AS (
  SELECT word, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS spot FROM words)),
longer AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON w.word = c.cut),
near AS (
  SELECT a, b FROM longer UNION ALL SELECT b, a FROM longer
  UNION ALL SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.spot = y.spot AND x.cut = y.cut AND x.word <> y.word),
ranked AS (
  SELECT a AS word, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k
  FROM near JOIN words ON words.word = b),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN r.n >= 2 * w.n THEN b END AS form, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1),
walked AS (
  SELECT word, word AS spot FROM formed
  UNION ALL SELECT v.word, f.form FROM walked v JOIN formed f ON f.word = v.spot WHERE f.form IS NOT NULL)
SELECT f.word, f.form, v.spot AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walked v USING (word) JOIN formed e ON e.word = v.spot AND e.form IS NULL
"""
