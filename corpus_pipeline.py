"""The corpus pipeline: documents that are not toxic, each text once, one of each group of near copies, mixed by source and packed.

Every stage reads all its predecessor kept, and is written as Parquet before the next one starts. All stages but the last return the columns
of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm.common import Stages
from claimloom.llm.exact_dedup import drop_copies
from claimloom.llm.mixing import mixed_documents
from claimloom.llm.ngram_join import keep_one_of_each
from claimloom.llm.packing import pack
from claimloom.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents scored 0.5 or more go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of equal texts the one with the least doc_id stays."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, shingles of five words and a similarity of 0.8: of each group the least doc_id stays."""
    return keep_one_of_each(docs, words=5, share=(8, 10))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: a document taken twice is two rows, one not taken is none."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of documents in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Hashing, learned weights and a tokenizer have no counterpart in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    stages = Stages(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stages.keep(name, stage(spark, docs, sf_dir))
        if before:
            stages.drop(before)
        before = name
    return docs
