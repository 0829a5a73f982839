"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by its own figures and those of the lines before and after it; the field adds transitions between the labels of
neighbouring lines. Forward-backward gives each line's probability to be good. The length-weighted mean over a document's lines, made a
probability by one logistic layer, is the document's score. Learned from documents with a quality label, whose lines take that label.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import LOWER, SPACE, Stages, blocks, mix, runs, span_hashes
from claimloom.llm.samples import fold, labelled_sample, logistic

PER_CLASS = 2000
#: Of the sample, documents with at most this many lines are learned from; scored are all.
LEARNED_LINES = 400
OWN = 19
FEATURES = 3 * OWN + 2


def _kinds() -> np.ndarray:
    """Class of each byte: 0 space, 1 lower letter, 2 upper letter, 3 digit, 4 sentence mark, 5 symbol, 6 part of a multi-byte character."""
    kinds = np.full(256, 5, np.int8)
    kinds[np.flatnonzero(SPACE)] = 0
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 1, 2, 3, 6
    kinds[[ord(c) for c in ".,;:?'\"()-"]] = 4
    return kinds


KINDS = _kinds()


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines between line feeds: starts, ends, document numbers. Every document has at least one, which may be empty."""
    feeds = np.flatnonzero(data == 10)
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    starts = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True)
    ends = np.where(last, offsets[doc + 1], np.append(starts[1:], 0) - 1)
    return starts, ends, doc


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with those of their neighbours, bytes of each line, document numbers."""
    starts, ends, doc = lines(data, offsets)
    size, n = ends - starts, len(starts)
    kind = KINDS[data]
    own = np.zeros((n, OWN))
    total = np.zeros((len(data) + 1, 7), np.int32)
    for k in range(7):
        np.cumsum(kind == k, out=total[1:, k])
    counts = (total[ends] - total[starts]).astype(float)
    long = np.maximum(size, 1)
    own[:, 0] = np.log1p(size) / 5
    own[:, 1:8] = counts / long[:, None]
    # Words: number, length, how many are distinct or repeat the one before, wholly upper case, or end in a symbol.
    begin, end, _ = runs(~SPACE[data], offsets)
    line = np.searchsorted(starts, begin, "right") - 1
    number = np.bincount(line, minlength=n).astype(float)
    some = np.maximum(number, 1)
    name = span_hashes(LOWER[data], begin, end)
    own[:, 8] = np.log1p(number) / 4
    own[:, 9] = np.bincount(line, end - begin, n) / some / 10
    pair = mix(name + line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(pair, return_index=True)
    own[:, 10] = np.bincount(line[at], minlength=n) / some
    again = np.zeros(len(name), bool)
    again[1:] = (name[1:] == name[:-1]) & (line[1:] == line[:-1])
    own[:, 11] = np.bincount(line, again, n) / some
    upper = (total[end, 2] - total[begin, 2] > 0) & (total[end, 1] == total[begin, 1])
    own[:, 12] = np.bincount(line, upper, n) / some
    own[:, 13] = np.bincount(line, kind[end - 1] == 5, n) / some
    double = np.zeros(len(data) + 1, np.int32)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & (kind[1:] != 0)
    np.cumsum(same, out=double[1:])
    own[:, 14] = (double[ends] - double[np.minimum(starts + 1, ends)]) / long
    # Lines that the document repeats.
    stripped = np.zeros(n, np.uint64)
    np.add.at(stripped, line, mix(name + (begin - starts[line]).astype(np.uint64)))
    key = mix(stripped + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    copies = times[back] * (number > 0)
    own[:, 15], own[:, 16] = copies > 1, np.log1p(copies)
    per_doc = np.bincount(doc, minlength=len(offsets) - 1)
    own[:, 17] = np.log1p(per_doc[doc]) / 4
    own[:, 18] = np.isin(data[np.maximum(ends - 1, 0)], np.frombuffer(b".!?", np.uint8)) & (size > 0) if len(data) else 0
    full = np.zeros((n, FEATURES))
    full[:, :OWN] = own
    joined = np.flatnonzero(doc[1:] == doc[:-1])
    full[joined + 1, OWN : 2 * OWN] = own[joined]
    full[joined, 2 * OWN : 3 * OWN] = own[joined + 1]
    full[:, -2], full[:, -1] = 1, np.append(True, doc[1:] != doc[:-1])
    return full, size, doc


def marginals(score: np.ndarray, doc: np.ndarray, turn: np.ndarray, want_pairs: bool = False):
    """Probability that each line is good, by forward-backward over all documents at once; score is its log-odds alone, turn[i, j] of a step from i to j."""
    n = len(score)
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    node = np.column_stack([np.zeros(n), np.clip(score, -30, 30)])
    ahead, behind = node.copy(), np.zeros((n, 2))
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")  # documents with more than t lines
    for t in range(1, length[0]):
        at = first[: alive[t]] + t
        x = ahead[at - 1][:, :, None] + turn
        ahead[at] += np.logaddexp(x[:, 0], x[:, 1])
    for t in range(length[0] - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        x = (node[at + 1] + behind[at + 1])[:, None, :] + turn
        behind[at] = np.logaddexp(x[:, :, 0], x[:, :, 1])
    both = ahead + behind
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
    if not want_pairs:
        return good
    at = np.flatnonzero(doc[1:] == doc[:-1])
    x = ahead[at][:, :, None] + turn + (node[at + 1] + behind[at + 1])[:, None, :]
    x = np.exp(x - x.max((1, 2), keepdims=True))
    return good, at, x / x.sum((1, 2), keepdims=True)


def train(x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 250, rate: float = 0.05, ridge: float = 1e-4) -> dict:
    """Weights and transitions by Adam on the conditional likelihood of the line labels y; weight is of each line's document."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    mean[-2:], scale[-2:] = 0, 1
    x = (x - mean) / scale
    w = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    total = weight.sum()
    for step in range(1, rounds + 1):
        good, at, pairs = marginals(x @ w[:-4], doc, w[-4:].reshape(2, 2), True)
        real = np.zeros((len(at), 2, 2))
        real[np.arange(len(at)), y[at].astype(int), y[at + 1].astype(int)] = 1
        grad = np.concatenate([x.T @ (weight * (good - y)), ((pairs - real) * weight[at][:, None, None]).sum(0).ravel()]) / total + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return {"mean": mean, "scale": scale, "w": w}


def document_quality(model: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length-weighted log-odds of each document, and each line's probability and document."""
    x, size, doc = line_features(data, offsets)
    good = marginals(((x - model["mean"]) / model["scale"]) @ model["w"][:-4], doc, model["w"][-4:].reshape(2, 2))
    weight = size + 1.0
    mean = np.bincount(doc, weight * good) / np.bincount(doc, weight)
    return np.log((mean + 1e-3) / (1 - mean + 1e-3)), good, doc


def _learned(batches, learned_lines: int):
    for rows, data, offsets in blocks(batches):
        x, _, doc = line_features(data, offsets)
        count = np.bincount(doc, minlength=len(offsets) - 1)
        for row, (doc_id, label) in enumerate(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)):
            if count[row] <= learned_lines:
                own = x[doc == row].astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([label], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["doc_id", "label", "x"])


def _measured(batches, model):
    for rows, data, offsets in blocks(batches):
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(document_quality(model.value, data, offsets)[0])], ["doc_id", "label", "odds"])


def _scores(batches, model, layer: np.ndarray, names: list[str]):
    for rows, data, offsets in blocks(batches):
        odds = document_quality(model.value, data, offsets)[0]
        score = 1 / (1 + np.exp(-np.clip(odds * layer[0] + layer[1], -30, 30)))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], [*names, "__score"])


def _line_labels(batches, model):
    for rows, data, offsets in blocks(batches):
        _, good, doc = document_quality(model.value, data, offsets)
        at = np.arange(len(doc)) - np.searchsorted(doc, doc)
        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(doc)), pa.array(at), pa.array(good)], ["doc_id", "line", "good"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, learned_lines: int = LEARNED_LINES) -> dict | None:
    """Field and logistic layer from (doc_id, label 0 or 1); None when a class is missing.

    Learned from are at most `per_class` documents of each class, the field from those of them that have at most `learned_lines` lines.
    """
    spark = docs.sparkSession
    stages = Stages(spark)
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label IN (0, 1)")
    sample, counts = labelled_sample(stages, docs, labels, per_class)
    rows = sample.mapInArrow(partial(_learned, learned_lines=learned_lines), "doc_id long, label int, x binary").toPandas().sort_values("doc_id") if set(counts) == {0, 1} else []
    if not len(rows) or rows["label"].nunique() < 2:
        return None
    parts = [np.frombuffer(x, "<f4").reshape(-1, FEATURES) for x in rows["x"]]
    size = np.array([len(x) for x in parts])
    doc, label = np.repeat(np.arange(len(parts)), size), rows["label"].to_numpy(float)
    # Documents weigh the same whatever their number of lines, and so do the classes.
    share = label.mean()
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) / size
    model = train(np.concatenate(parts).astype(float), doc, label[doc], weight[doc])
    found = sample.mapInArrow(partial(_measured, model=spark.sparkContext.broadcast(model)), "doc_id long, label int, odds double").toPandas().sort_values("doc_id")
    y = found["label"].to_numpy(float)
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum()) * len(y) / (counts[0] + counts[1])
    layer = logistic(found[["odds"]].to_numpy(), y, weight)
    return {"model": model, "layer": np.array([max(layer[0], 1e-3), layer[1]])}


def line_labels(docs: DataFrame, fitted: dict) -> DataFrame:
    """(doc_id, line, good): probability of every line of every document to be good, lines counted from 0."""
    model = docs.sparkSession.sparkContext.broadcast(fitted["model"])
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(partial(_line_labels, model=model), "doc_id long, line long, good double")


def quality(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.7, per_class: int = PER_CLASS, learned_lines: int = LEARNED_LINES
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: good likelier), predicted.

    Labels (doc_id, quality) of documents whose fold is `held` are not learned from; `per_class` and `learned_lines` bound what is (see `fit`). Null and empty texts are one empty line. Without labels of both
    classes every score is 0.5. Rows that repeat are scored each; reads only doc_id and text.
    A text is held whole by one task, with about 80 bytes of memory for each of its bytes.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    fitted = fit(slim, learned.where(fold(F.col("doc_id"), folds) != held), per_class, learned_lines)
    if fitted is None:
        scored = slim.withColumn("__score", F.lit(0.5))
    else:
        work = partial(_scores, model=spark.sparkContext.broadcast(fitted["model"]), layer=fitted["layer"], names=slim.columns)
        scored = slim.mapInArrow(work, "doc_id long, text string, __score double")
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))
