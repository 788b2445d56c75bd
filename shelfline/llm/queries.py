"""The operators applied to whole tables, by name, and the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    bloom_lm, bpe, exact_dedup, hard_negatives, line_rules, minhash, mixing, pairwise_quality, sharding, substrings, token_counts,
    toxicity, whitening)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("text_key")


def op2_minmax_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents")).drop("text_key")


def op3_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"), shards=8).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op4_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    return pairwise_quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"), folds=4, held_out=2)


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), VOCABULARY)


def op6_bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_lm.score(table(spark, folder, "documents"), folds=7, held_out=2)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_documents(table(spark, folder, "documents"), VOCABULARY)


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, folder, "documents"))


def op9_flow_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).drop("source", "digest")


def op10_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.judge(table(spark, folder, "documents")).drop("cleaned_text")


def op11_cholesky_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_tree_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings").withColumn("label", wrong))


def op13_suffix_tree_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_toxicity_chain, op2_minmax_near_dedup, op3_byte_shards, op4_pairwise_quality, op5_byte_bpe, op6_bloom_lm, op7_token_counts,
        op8_exact_dedup, op9_flow_mixing, op10_line_rules, op11_cholesky_whitening, op12_tree_hard_negatives, op13_suffix_tree_dedup)
}

ORACLES: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM texts WINDOW same AS (PARTITION BY text_sha256)""",
    "op12_tree_hard_negatives": """
        WITH given AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS y
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
        rows AS (SELECT * FROM given WHERE len(y) = (SELECT len(y) FROM given GROUP BY len(y) ORDER BY count(*) DESC, len(y) DESC LIMIT 1)),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_dot_product(a.y, b.y)::BIGINT AS score
            FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5""",
    "op13_suffix_tree_dedup": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        places AS (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM texts WHERE len(words) >= 50),
        windows AS (SELECT r, doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS passage FROM places),
        smallest AS (SELECT passage, min(doc_id) AS doc_id FROM windows GROUP BY passage HAVING min(doc_id) < max(doc_id)),
        repeated AS (SELECT r, pos FROM windows JOIN smallest USING (passage) WHERE smallest.doc_id < windows.doc_id),
        gone AS (SELECT DISTINCT r, unnest(range(pos, pos + 50)) AS pos FROM repeated),
        numbered AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM texts),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY pos) AS kept_text, count(*) AS n FROM numbered ANTI JOIN gone USING (r, pos) GROUP BY r)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (r)""",
}
