"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from starloom.context import scratch_path
from starloom.llm import (
    ann,
    bpe,
    decontaminate,
    line_dedup,
    more_queries,
    ngram_join,
    secrets,
    substring_dedup,
    token_counts,
    toxicity,
    warc,
)

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontaminate(spark, sf_dir):
    docs, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontaminate.find_contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(20).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws"
)
ORACLES["op1_decontaminate"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} FROM documents),
items AS (SELECT item_id, {_WORDS} FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i
        FROM items WHERE len(ws) > 0)),
places AS (
  SELECT rid, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM docs JOIN (SELECT DISTINCT k FROM windows) ON len(ws) >= k)),
hits AS (SELECT rid, i, k, item_id FROM places JOIN windows USING (k, w)),
hit_words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM hits)) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


@_query
def op3_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = bpe.encode(_table(spark, sf_dir, "documents"), path, decoded=True)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query
def op4_toxicity(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _of(*kinds):
    return F.filter("spans", lambda span: span["kind"].isin(*kinds))


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@_query
def op6_secrets(spark, sf_dir):
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(_of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base),
        F.sha2(_listed(_of(*base)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@_query
def op8_token_counts(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), model, limit=4096)


@_query
def op10_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, least_bytes=0)
    out = warc.index(warc.read_archives(spark, path))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT t, min(page_id) AS first FROM p GROUP BY t),
d AS (SELECT *, list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(h, i + 1, 1)) - 1) AS x FROM p)
SELECT page_id, CAST(strlen(d.t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((x[(5 * k) // 4 + 1] * 16 + x[(5 * k) // 4 + 2]) >> (3 - (5 * k) % 4)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d JOIN f USING (t)
"""


@_query
def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), size=5, percent=80)


@_query
def op7_substring_dedup(spark, sf_dir):
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=50)
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", kept)


@_query
def op9_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), edits=2)
    text = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", text)


@_query
def op5_ann(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


QUERIES |= more_queries.QUERIES
ORACLES |= more_queries.ORACLES
