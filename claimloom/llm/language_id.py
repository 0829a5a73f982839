"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 4 bytes of lower-cased words, with word ends, are hashed to a fixed number of buckets. Term frequency is the share of a text's
n-grams, document frequency is counted over all documents that may be learned from. Weights are trained by follow-the-regularised-leader with
elastic-net penalties, which leaves most of them exactly zero; a temperature fitted on a part of the sample calibrates the probabilities.
"""

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import LOWER, Stages, blocks, salted
from claimloom.llm.samples import fold, labelled_sample

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 16
PER_CLASS = 600
UNKNOWN = "und"


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a block and the document of each. What is no letter or multi-byte character counts as a space."""
    data = LOWER[data]
    data = np.where((data >= 97) & (data <= 122) | (data >= 128), data, np.uint8(32))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    value, times = salted(401, 256)[data], salted(402, max(GRAMS))
    plain = data == 32
    found, owners, total = [], [], np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            break
        total = total[: len(data) - n + 1] + value[n - 1 :] * times[n - 1]
        if n in GRAMS:
            # Inside one document; a space only at either end, and not alone.
            ok = doc[: len(total)] == doc[n - 1 :]
            for k in range(1, n - 1):
                ok &= ~plain[k : k + len(total)]
            if n < 3:
                ok &= ~plain[: len(total)] | (n > 1)
                ok &= ~(plain[: len(total)] & plain[n - 1 :])
            found.append((total[ok] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64))
            owners.append(doc[: len(total)][ok])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    low = data | 32
    np.cumsum((low >= 97) & (low <= 122) & (data < 128), out=ascii_letter[1:])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for row in np.flatnonzero(~found & (offsets[1:] > offsets[:-1])):
        found[row] = any(c.isalpha() for c in data[offsets[row] : offsets[row + 1]].tobytes().decode())
    return found


def _frequencies(batches):
    """One row for each task: number of documents, and of those with each bucket."""
    counts, flags, rows = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, bool), 0
    for _, data, offsets in blocks(batches, limit=1 << 18):
        bucket, doc = grams(data, offsets)
        order = np.argsort(doc, kind="stable")
        bucket, cut = bucket[order], np.searchsorted(doc[order], np.arange(len(offsets)))
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            flags[bucket[low:high]] = True
            some = np.flatnonzero(flags)
            counts[some] += 1
            flags[some] = False
        rows += len(offsets) - 1
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], rows))], ["bucket", "n"])


def _sampled(batches):
    for rows, data, offsets in blocks(batches, limit=1 << 18):
        bucket, doc = grams(data, offsets)
        for row, (doc_id, label) in enumerate(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)):
            some, times = np.unique(bucket[doc == row], return_counts=True)
            columns = [pa.array([doc_id], pa.int64()), pa.array([label]), pa.array([some.astype("<i4").tobytes()]), pa.array([times.astype("<i4").tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "buckets", "times"])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 2e-3, l2: float = 1e-3) -> np.ndarray:
    """Weights (buckets, classes) of a multinomial logistic regression, from sparse rows (buckets, values).

    Per coordinate: z sums adjusted gradients, n their squares; a weight is zero while |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt n) / alpha + l2).
    """
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at):
        own = z[at]
        return np.where(np.abs(own) <= l1, 0.0, -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            score = x @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    return weights(slice(None))


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """Divisor of the scores with the best likelihood of y, by a search over a fixed grid."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.02, 20, 121):
        s = scores / t
        s = s - s.max(1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]))
        best = min(best, (loss, float(t)))
    return best[1]


def fit(docs: DataFrame, learnable: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """Model from `learnable` rows (doc_id, text, lang not null), or None when there are none.

    Document frequencies are of all these rows; weights and temperature of at most `per_class` of each language.
    """
    stages = Stages(docs.sparkSession)
    frequency = learnable.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    sample, counts = labelled_sample(stages, learnable, learnable.select(F.col("doc_id"), F.col("lang").alias("label")), per_class)
    if not counts:
        return None
    total = int(frequency.loc[frequency["bucket"] == -1, "n"].sum())
    seen = np.zeros(BUCKETS)
    known = frequency[frequency["bucket"] >= 0]
    seen[known["bucket"]] = known["n"]
    idf = np.log((1 + total) / (1 + seen)) + 1
    picked = sample.mapInArrow(_sampled, "doc_id long, label string, buckets binary, times binary").toPandas().sort_values("doc_id")
    names = sorted(counts)
    y = picked["label"].map({c: i for i, c in enumerate(names)}).to_numpy()
    rows = []
    for buckets, times in zip(picked["buckets"], picked["times"], strict=True):
        at, tf = np.frombuffer(buckets, "<i4"), np.frombuffer(times, "<i4")
        rows.append((at, tf / max(tf.sum(), 1) * idf[at] * SCALE))
    spare = np.array([zlib.crc32(f"spare{x}".encode()) % 5 == 0 for x in picked["doc_id"]])
    if spare.all() or not spare.any():
        spare[:] = False
    fit_on = np.flatnonzero(~spare)
    weights = ftrl([rows[i] for i in fit_on], y[fit_on], len(names))
    check = np.flatnonzero(spare) if spare.any() else fit_on
    scores = np.array([x @ weights[at] for at, x in (rows[i] for i in check)]).reshape(len(check), len(names))
    return {"names": names, "table": (weights * idf[:, None] * SCALE).astype(np.float32), "temperature": _temperature(scores, y[check])}


#: Puts the values of a text's n-grams near 1, where the learning rates fit.
SCALE = 10.0


def _predictions(batches, model):
    found = model.value
    table, names = found["table"], np.array([*found["names"], UNKNOWN], object)
    for rows, data, offsets in blocks(batches, limit=1 << 19):
        n = len(offsets) - 1
        bucket, doc = grams(data, offsets)
        count = np.maximum(np.bincount(doc, minlength=n), 1)
        score = np.column_stack([np.bincount(doc, table[bucket, c], n) for c in range(table.shape[1])]) / count[:, None] / found["temperature"]
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        letter = has_letter(data, offsets)
        best = np.where(letter, p.argmax(1), len(names) - 1)
        value = np.where(letter, p.max(1), 0.0)
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(value)], ["doc_id", "lang_pred", "score"])


def language_id(docs: DataFrame, folds: int = 4, held: int = 2, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and non-null lang of documents whose fold is not `held`. Null texts and texts without a letter are `und` with score 0; so is every
    text when there is nothing to learn from. Rows that repeat are predicted each; a row without doc_id is not learned from.
    A text is held whole by one task, with about 125 bytes of memory for each of its bytes.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    model = fit(slim, slim.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out), per_class)
    if model is None:
        return slim.select("doc_id", held_out.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    found = slim.select("doc_id", "text").mapInArrow(partial(_predictions, model=shared), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
