"""The registered queries of the training-data operators, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cap_filters, chat, divergence, licenses, packing, pii, quality, simhash, token_counts, topk, toxicity, vector_codes
from .common import read_table, text_or_empty


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    decoded = bpe.decode(encoded.select("doc_id", "ids", "n_tokens"))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(turns))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).select("doc_id", *quality.FEATURES, "base_failed", "kept")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda place: F.size(F.filter("base_spans", lambda s: s["kind"] == place)).cast("long")
    return found.select(
        "doc_id",
        *[count(place).alias(f"n_{kind}") for place, kind in enumerate(pii.KINDS[: pii.BASE_KINDS])],
        F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_bpe, op2_chat, op3_topk, op4_simhash, op5_token_counts, op6_licenses, op7_packing, op8_toxicity, op9_quality, op10_pii, op11_vector_codes, op12_near_vectors, op13_divergence]
    return {f.__name__: f for f in found}


OP3_SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, string_split(text, chr(10)) AS lines FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (SELECT doc_id, sum(n) AS n FROM (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n FROM twice) GROUP BY doc_id),
f AS (SELECT w.doc_id, text, words, lines, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines, len(words)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    10 * n_symbols > word_chars
    OR length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) > length(regexp_replace(text, '[^a-zß-öø-ÿ]', '', 'g'))
    OR word_chars > 25 * n_words
    OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words
    OR len(full_lines) >= 3 AND 10 * len(list_filter(full_lines, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) > 9 * len(full_lines)
    OR len(full_lines) >= 3 AND 10 * len(list_filter(full_lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t]*$'))) > 3 * len(full_lines)
    OR 2 * n_dup_lines > len(lines)) AS kept
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": OP3_SQL, "op6_licenses": licenses.oracle(), "op9_quality": OP9_SQL, "op11_vector_codes": vector_codes.oracle(), "op12_near_vectors": cap_filters.oracle(), "op13_divergence": divergence.oracle()}
