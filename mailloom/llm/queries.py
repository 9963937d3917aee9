"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hard_negatives, langid, licenses, lm, minhash, mixing, packing, quality, runs, sharding,
               suffix_dedup, warc)
from .common import remainder, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


@_query
def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf, "documents"))


@_query
def op1_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf, "documents"))


@_query
def op7_flow_resharding(spark: SparkSession, sf: str) -> DataFrame:
    """From 12 old shards, dealt by the crc32 of the id, to 16 of equal bytes."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    folder, _, _ = sharding.reshard(docs, remainder("doc_id", 12), 12, 16)
    files = spark.read.schema("doc_id long, text string, _old int, _slot long, _shard int").parquet(folder)
    return files.select(
        "doc_id", sharding.document_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("_old").alias("old_shard"))


@_query
def op3_suffix_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


@_query
def op4_seekable_warc(spark: SparkSession, sf: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf, "pages"))
    return warc.read_archives(spark, index).select(
        F.col("record").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


@_query
def op6_reduced_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op5_viterbi_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = remainder("doc_id", 5) == 0
    scorer = langid.fit(docs.where(~out))
    found = langid.identify(docs.select("doc_id", "text"), scorer)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@_query
def op8_probminhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


@_query
def op9_gated_scores(spark: SparkSession, sf: str) -> DataFrame:
    out = remainder("doc_id", 5) == 1
    scored, known = lm.score_documents(table(spark, sf, "documents"), ~out)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@_query
def op2_repeat_removal(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))


@_query
def op11_word_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of every document; a tenth of the texts get a periodic tail first."""
    found = runs.collapse_runs(table(spark, sf, "documents").select("doc_id", "text"), change=runs.repeat_tail)
    best = F.get("runs", F.col("strongest"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * get(runs, strongest).length div get(runs, strongest).period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))


@_query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of a hundredth of the vectors, with a seventh of the labels moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, anchors=F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


@_query
def op13_entropy_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


# --- SQL counterparts, where SQL can express the whole result ----------------

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _sql_words(text: str) -> str:
    return _WORDS.format(_FOLD.format(f"coalesce({text}, '')"))


ORACLE_SQL["op3_suffix_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM (
  SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (
    SELECT item, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0))),
ks AS (SELECT DISTINCT k FROM bw),
hits AS (SELECT dw.doc_id, dw.p, bw.k, bw.item FROM (
    SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM (
      SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)) dw
  JOIN bw ON bw.s = dw.s AND bw.k = dw.k),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""

ORACLE_SQL["op4_seekable_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to FROM q"""

ORACLE_SQL["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5"""
