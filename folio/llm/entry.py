"""Queries of the training-data operators and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.capfilter import near_duplicates
from folio.llm.common import table
from folio.llm.lm import language_scores
from folio.llm.mixing import mix, sized_documents
from folio.llm.packing import pack
from folio.llm.pii import personal_data
from folio.llm.sharding import shard
from folio.llm.simhash import simhash_classes
from folio.llm.spans import dedup_spans
from folio.llm.topk import exact_topk
from folio.llm.toxicity import toxicity


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(sized_documents(table(spark, sf_dir, "documents")))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), *vocabulary_paths())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash_classes(table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"))


def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op8_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_personal_data": op2_personal_data,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_toxicity": op4_toxicity,
        "op5_simhash": op5_simhash,
        "op6_exact_topk": op6_exact_topk,
        "op7_extendible_sharding": op7_extendible_sharding,
        "op8_spherical_caps": op8_spherical_caps,
        "op9_log_bilinear": op9_log_bilinear,
        "op10_sentence_spans": op10_sentence_spans,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_topk": """
            WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings),
            s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
                  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
            r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
        "op8_spherical_caps": """
            WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
            link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                     WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
            reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
            SELECT v.vec_id, CAST((SELECT count(*) FROM link WHERE x = v.vec_id) AS BIGINT) AS n_links,
                   min(r.y) AS component_id, min(r.y) = v.vec_id AS kept
            FROM v JOIN reach r ON r.x = v.vec_id GROUP BY v.vec_id""",
    }
