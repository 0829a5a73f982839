"""Registered queries of the operators, and the SQL of those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm.embedding_join import NEAR_SQL, embedding_near_dedup
from claimloom.llm.exact_dedup import exact_dedup
from claimloom.llm.ngram_join import JOIN_SQL, ngram_jaccard_join
from claimloom.llm.language_id import language_id
from claimloom.llm.lexical_search import SEARCH_SQL, lexical_search
from claimloom.llm.merkle import MANIFEST_SQL, verified_manifest
from claimloom.llm.mixing import mix_sources
from claimloom.llm.packing import pack
from claimloom.llm.quality import quality
from claimloom.llm.quality_rules import quality_rules, rules_sql
from claimloom.llm.sharding import hilbert_shards
from claimloom.llm.substring_dedup import repeats_by_document
from claimloom.llm.toxicity import toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_documents(spark, sf_dir))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_documents(spark, sf_dir), words=3, share=(90, 100))


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(_documents(spark, sf_dir), shards=8)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir)).drop("n_chunks")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_by_document(_documents(spark, sf_dir))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(_documents(spark, sf_dir))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


ORACLE_SQL = {
    "op2_ngram_jaccard_join": JOIN_SQL,
    "op6_embedding_near_dedup": NEAR_SQL,
    "op4_exact_dedup": r"""
        WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM plain WINDOW same AS (PARTITION BY body)
    """,
    "op11_lexical_search": SEARCH_SQL,
    "op12_merkle_manifest": MANIFEST_SQL,
    "op13_quality_rules": rules_sql(),
}
