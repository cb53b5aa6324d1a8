"""Driver queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmarts.llm import (ann, bpe, centroids, chat, filter_audit, licenses, mixing, pii, quality, simhash, token_counts, topk,
                             word_bpe)
from marketmarts.llm.common import load


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, load(spark, sf_dir, "labels")))


#: A conversation that holds the template's own control strings.
ODD_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.expand(chat.pieces(turns.unionByName(odd))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(load(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(load(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, digests=True)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(load(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    counted = token_counts.with_prefix_counts(load(spark, sf_dir, "documents"), tokenizer, public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(load(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = word_bpe.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    return word_bpe.decode(word_bpe.encode(load(spark, sf_dir, "documents"), spec), spec, digests=True)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(load(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_chat": op2_chat,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_bpe": op5_bpe,
    "op6_licenses": op6_licenses,
    "op7_ann": op7_ann,
    "op8_mix": op8_mix,
    "op9_token_counts": op9_token_counts,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_word_bpe": op12_word_bpe,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL = {
    "op2_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/'))
    + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), chr(10), '\n')) + 13 AS size FROM c),
r AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS until FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN until END), 0)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id""",
    "op4_topk": """
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op6_licenses": licenses.oracle(),
    "op11_filter_audit": filter_audit.oracle(),
    "op13_centroids": centroids.oracle(),
}
