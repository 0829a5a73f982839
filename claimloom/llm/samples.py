"""Bounded samples of labelled documents, from which the classifiers learn."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stages


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo the number of folds; null without doc_id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(stages: Stages, docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict]:
    """(doc_id, label, text) of at most `per_class` documents of each label, and the number of labelled rows of each.

    `labels` is (doc_id, label) and holds only rows that may be learned from; a doc_id with several labels is left out. The rows taken
    are those whose hashed doc_id is smallest, so the sample is the same in every run. It is bounded by `per_class` and is broadcast.
    """
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    labels = stages.keep("labels", labels.where("label = other").select("doc_id", "label"))
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    chosen = None
    for label in sorted(counts):
        part = labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        chosen = labels
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(stages.keep("chosen", chosen)), "doc_id").dropDuplicates(["doc_id"])
    return stages.keep("sample", sample.select("doc_id", "label", "text").repartition(12, "doc_id")), counts


def logistic(x, y, weight, rounds: int = 400, ridge: float = 1e-3):
    """Weights and intercept of a logistic regression by Newton steps."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
