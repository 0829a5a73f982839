"""Toxicity by a bidirectional gated recurrent network with attention pooling over character and word inputs, trained in numpy.

Texts are words between ASCII white space, cut into overlapping windows. A word enters as its log-odds between toxic and clean training
documents (whole word, and its byte 5-grams), a few shape figures, a learned word embedding and the mean of learned byte embeddings. Two
gated recurrent layers read a window in both directions; attention pools their states to one logit. Every window of every text
is scored; a logistic layer over the highest windows, their sum and their number gives the document's probability.
"""

import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import LOWER, SPACE, Stages, blocks, runs, salted, span_hashes, with_neutral_names
from claimloom.llm.samples import fold, labelled_sample, logistic

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORDS = 1 << 18  # buckets of the log-odds tables
EMBEDDED = 1 << 12  # buckets of the word embedding
WIDTH = 4
GRAM = 5
PER_CLASS = 2500
#: Embeddings learn more slowly than the network, or they learn single documents by heart.
LEARNED = {"word": 0.1, "byte": 0.05}
#: Least number of training steps, so that small samples are learned too.
STEPS = 200
#: Windows with more bytes are not learned from; scored are all.
LEARNED_BYTES = 1 << 12
SCALARS = 5


class Words:
    """Distinct words of a block: bytes, hashes, and the byte 5-grams of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends, self.doc = runs(~SPACE[data], offsets)
        name = span_hashes(data, starts, ends)
        self.name, at, self.index = np.unique(name, return_index=True, return_inverse=True)
        starts, self.size = starts[at], (ends - starts)[at]
        first = np.cumsum(self.size) - self.size
        place = np.arange(int(self.size.sum())) + np.repeat(starts - first, self.size)
        self.bytes, self.owner = data[place], np.repeat(np.arange(len(starts)), self.size)
        value = salted(301, 256)[self.bytes]
        gram, times = np.zeros(max(0, len(value) - GRAM + 1), np.uint64), salted(302, GRAM)
        for k in range(GRAM):
            gram += value[k : k + len(gram)] * times[k]
        inside = self.owner[: len(gram)] == self.owner[GRAM - 1 : GRAM - 1 + len(gram)]
        self.gram, self.gram_owner = (gram[inside] >> np.uint64(46)).astype(np.int64), self.owner[: len(gram)][inside]
        self.bucket = (self.name >> np.uint64(46)).astype(np.int64)

    def mean(self, values: np.ndarray) -> np.ndarray:
        """Mean of per-byte values for each word."""
        total = np.zeros((len(self.size) + 1, *values.shape[1:]), np.float64)
        if len(values):
            total[: len(self.size)] = np.add.reduceat(values, np.cumsum(self.size) - self.size)
        return (total[: len(self.size)].T / self.size).T

    def scalars(self, odds: dict) -> np.ndarray:
        out = np.zeros((len(self.size), SCALARS), np.float32)
        out[:, 0] = odds["word"][self.bucket]
        value = odds["gram"][self.gram]
        best, low = np.zeros(len(self.size), np.float32), np.zeros(len(self.size), np.float32)
        np.maximum.at(best, self.gram_owner, value)
        np.minimum.at(low, self.gram_owner, value)
        out[:, 1], out[:, 2] = best, low
        out[:, 3] = np.log1p(self.size) / 3
        letter = (self.bytes >= 97) & (self.bytes <= 122) | (self.bytes >= 128)
        out[:, 4] = self.mean(letter.astype(np.float64))
        return out


def windows(doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows, -1 beyond the text, and the document of each. Every word is in a window; a text without words has one."""
    count = np.bincount(doc, minlength=rows)
    first = np.cumsum(count) - count
    number = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(rows), number)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    start = np.minimum(step * STRIDE, np.maximum(count[owner] - WINDOW, 0))
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < count[owner][:, None], first[owner][:, None] + at, -1), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(seed: int = 7) -> dict:
    rng = np.random.default_rng(seed)
    size = SCALARS + 2 * WIDTH

    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    model = {"word": 0.1 * draw(EMBEDDED, WIDTH) * 64, "byte": 0.1 * draw(256, WIDTH) * 16, "pool": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
    for way in ("f", "b"):
        model |= {f"x{way}": draw(size, 3 * HIDDEN), f"u{way}": draw(HIDDEN, 3 * HIDDEN), f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
    return model


def forward(model: dict, projected: dict, index: np.ndarray, keep: bool = False):
    """Logit of each window from word projections; index is -1 (the last row, zero input) beyond the text."""
    n, steps = index.shape
    states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
    trace: dict = {"f": [], "b": []}
    for way, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h, side = np.zeros((n, HIDDEN), np.float32), slice(0, HIDDEN) if way == "f" else slice(HIDDEN, 2 * HIDDEN)
        for t in order:
            pre, rec = projected[way][index[:, t]], h @ model[f"u{way}"]
            gates = 1 / (1 + np.exp(-(pre[:, : 2 * HIDDEN] + rec[:, : 2 * HIDDEN])))
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(pre[:, 2 * HIDDEN :] + r * rec[:, 2 * HIDDEN :])
            before, h = h, h + z * (c - h)
            states[t, :, side] = h
            if keep:
                trace[way].append((t, before, z, r, c, rec[:, 2 * HIDDEN :]))
    there = (index >= 0).T
    there = there | ~there.any(0)
    weight = np.where(there, states @ model["pool"], -1e9)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    logit = pooled @ model["out"] + model["bias"][0]
    return (logit, states, weight, pooled, trace) if keep else logit


def inputs(model: dict, scalars: np.ndarray, bucket: np.ndarray, byte_mean: np.ndarray) -> np.ndarray:
    return np.concatenate([scalars, model["word"][bucket], byte_mean], 1).astype(np.float32)


def project(model: dict, x: np.ndarray) -> dict:
    """Input part of all gates for each word, and a last row for no word."""
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    return {way: np.clip(x @ model[f"x{way}"] + model[f"c{way}"], -20, 20) for way in ("f", "b")}


def gradients(model: dict, scalars, bucket, histogram, index, y, weight) -> tuple[float, dict]:
    """Loss and its gradient for windows; words are given by scalars, embedding bucket and byte shares."""
    x = inputs(model, scalars, bucket, histogram @ model["byte"])
    logit, states, alpha, pooled, trace = forward(model, project(model, x), index, keep=True)
    p = _sigmoid(logit)
    loss = -float(np.mean(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))))
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    d = (weight * (p - y) / len(y)).astype(np.float32)
    grad["bias"][0], grad["out"] = d.sum(), pooled.T @ d
    d_pooled = d[:, None] * model["out"]
    d_states = alpha[:, :, None] * d_pooled[None]
    d_alpha = np.einsum("nh,tnh->tn", d_pooled, states)
    d_score = alpha * (d_alpha - (alpha * d_alpha).sum(0))
    grad["pool"] = np.einsum("tn,tnh->h", d_score, states)
    d_states += d_score[:, :, None] * model["pool"]
    d_x = np.zeros((len(x) + 1, x.shape[1]), np.float32)
    padded = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    for way in ("f", "b"):
        side, u = slice(0, HIDDEN) if way == "f" else slice(HIDDEN, 2 * HIDDEN), model[f"u{way}"]
        dh, d_pre = np.zeros((len(y), HIDDEN), np.float32), np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        for t, before, z, r, c, rec in reversed(trace[way]):
            dh = dh + d_states[t, :, side]
            dc = dh * z * (1 - c * c)
            dz, dr = dh * (c - before) * z * (1 - z), dc * rec * r * (1 - r)
            back = np.concatenate([dz, dr, dc * r], 1)
            grad[f"u{way}"] += before.T @ back
            np.add.at(d_pre, index[:, t], np.concatenate([dz, dr, dc], 1))
            dh = dh * (1 - z) + back @ u.T
        grad[f"x{way}"], grad[f"c{way}"] = padded.T @ d_pre, d_pre.sum(0)
        d_x += d_pre @ model[f"x{way}"].T
    d_x = d_x[:-1]
    np.add.at(grad["word"], bucket, d_x[:, SCALARS : SCALARS + WIDTH])
    grad["byte"] = (histogram.T @ d_x[:, SCALARS + WIDTH :]).astype(np.float32)
    return loss, grad


def train(texts: list[str], y: np.ndarray, half: np.ndarray, odds: list[dict], epochs: int = 12, batch: int = 256, rate: float = 0.01, seed: int = 3) -> dict:
    """Model from labelled window texts, by Adam; classes weigh the same. Windows of half h are seen with odds[h], which the other half gave.

    Few windows are gone through more often than `epochs` times, until there were `STEPS` steps.
    """
    rng, model = np.random.default_rng(seed), initial()
    first, second, number = {k: np.zeros_like(v) for k, v in model.items()}, {k: np.zeros_like(v) for k, v in model.items()}, 0
    share = np.clip(y.mean(), 0.01, 0.99)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    while epochs > 0 or number < STEPS:
        epochs -= 1
        order = rng.permutation(len(texts))
        parts = [own[at : at + batch] for h in (0, 1) for own in [order[half[order] == h]] for at in range(0, len(own), batch)]
        for part in (parts[i] for i in rng.permutation(len(parts))):
            raw = [texts[i].encode() for i in part]
            words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
            where, owner = windows(words.doc, len(raw))
            where, index = where[np.searchsorted(owner, np.arange(len(raw)))], np.append(words.index, -1)
            histogram = np.zeros((len(words.size), 256), np.float32)
            np.add.at(histogram, (words.owner, words.bytes), 1)
            histogram /= np.maximum(words.size, 1)[:, None]
            _, grad = gradients(model, words.scalars(odds[half[part[0]]]), words.bucket >> 6, histogram, index[where], y[part], weight[part])
            number += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] -= rate * LEARNED.get(k, 1.0) * (first[k] / (1 - 0.9**number)) / (np.sqrt(second[k] / (1 - 0.999**number)) + 1e-7)
    return model


def window_logits(model: dict, odds: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all windows of a block of texts and the text of each."""
    words = Words(data, offsets)
    x = inputs(model, words.scalars(odds), words.bucket >> 6, words.mean(model["byte"][words.bytes].astype(np.float64)))
    projected = project(model, x)
    where, owner = windows(words.doc, len(offsets) - 1)
    index = np.append(words.index, -1)[where]
    logits = [forward(model, projected, index[at : at + 4096]) for at in range(0, len(index), 4096)]
    return np.concatenate(logits), owner


def document_features(logit: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Of each document: highest and second window logit, log of the summed window probabilities, log of the number of windows."""
    order = np.lexsort((-logit, owner))
    first = np.searchsorted(owner[order], np.arange(rows))
    number = np.bincount(owner, minlength=rows)
    top = logit[order[first]]
    second = np.where(number > 1, logit[order[np.minimum(first + 1, len(order) - 1)]], -10.0)
    mass = np.bincount(owner, _sigmoid(logit), rows)
    return np.column_stack([np.clip(top, -12, 12), np.clip(second, -12, 12), np.log(mass + 1e-4), np.log(number)])


def _odds_counts(batches):
    """One row for each task: documents with each word and gram bucket, by label."""
    counts = np.zeros((2, 2, WORDS), np.int32)
    for rows, data, offsets in blocks(batches):
        label = rows.column(1).to_numpy(zero_copy_only=False).astype(int)
        words = Words(data, offsets)
        in_doc = np.unique(words.doc.astype(np.int64) * len(words.name) + words.index) if len(words.doc) else np.zeros(0, np.int64)
        doc, word = (in_doc // max(len(words.name), 1), in_doc % max(len(words.name), 1))
        np.add.at(counts, (0, label[doc], words.bucket[word]), 1)
        first = np.searchsorted(words.gram_owner, np.arange(len(words.name) + 1))
        size = first[word + 1] - first[word]
        spot = np.arange(int(size.sum())) + np.repeat(first[word] - (np.cumsum(size) - size), size)
        pair = np.unique(np.repeat(doc, size) * WORDS + words.gram[spot])
        np.add.at(counts, (1, label[pair // WORDS], pair % WORDS), 1)
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["counts"])


def _picked(batches, odds, learned_bytes: int):
    """Windows to learn from: of each document the one with the most log-odds, and one by chance."""
    tables = odds.value
    for rows, data, offsets in blocks(batches):
        words = Words(data, offsets)
        where, owner = windows(words.doc, len(offsets) - 1)
        starts, ends, _ = runs(~SPACE[data], offsets)
        scalars = words.scalars(tables)
        value = np.append(np.maximum(scalars[:, 0], 0) + np.maximum(scalars[:, 1], 0) / 2, 0)[np.append(words.index, -1)[where]].sum(1)
        order = np.lexsort((-value, owner))
        first = np.searchsorted(owner[order], np.arange(len(offsets)))
        out: list[tuple] = []
        for row, (doc_id, label) in enumerate(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)):
            mine = order[first[row] : first[row + 1]]
            other = mine[zlib.crc32(str(doc_id).encode()) % len(mine)]
            for at in [mine[0]] if label else {int(mine[0]), int(other)}:
                spot = where[at][where[at] >= 0]
                if len(spot) and ends[spot[-1]] - starts[spot[0]] <= learned_bytes:
                    out.append((label, data[starts[spot[0]] : ends[spot[-1]]].tobytes().decode()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out])], ["label", "text"])


def _features(batches, model, odds):
    for rows, data, offsets in blocks(batches):
        found = document_features(*window_logits(model.value, odds.value, data, offsets), len(offsets) - 1)
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *[pa.array(x) for x in found.T]], ["doc_id", "label", "a", "b", "c", "d"])


def _scores(batches, model, odds, layer: np.ndarray, names: list[str]):
    for rows, data, offsets in blocks(batches):
        found = document_features(*window_logits(model.value, odds.value, data, offsets), len(offsets) - 1)
        score = _sigmoid(found @ layer[:-1] + layer[-1])
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], [*names, "__score"])


def log_odds(counts: np.ndarray, sizes: np.ndarray) -> dict:
    """Log-odds tables from documents with each bucket, (kind, label, bucket), and documents of each label; near 0 for rare buckets."""
    size = sizes + 1.0
    rate = (counts + 0.5 * (size / size.sum())[None, :, None]) / size[None, :, None]
    seen = counts.sum(1)
    return {k: (np.log(rate[i, 1] / rate[i, 0]) * seen[i] / (seen[i] + 5.0) * (seen[i] > 1)).astype(np.float32) for i, k in enumerate(("word", "gram"))}


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, learned_bytes: int = LEARNED_BYTES) -> dict | None:
    """Model from (doc_id, label 0 or 1) rows; None when a class is missing.

    Learns from at most `per_class` documents of each class (see `labelled_sample`); the driver gets count tables of fixed size, at most two
    windows of each of these documents, none of more than `learned_bytes`, and four figures of each.
    """
    spark = docs.sparkSession
    stages = Stages(spark)
    sample, counts = labelled_sample(stages, docs, labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label IN (0, 1)"), per_class)
    if set(counts) != {0, 1}:
        return None
    # A document is never seen with odds it took part in, as its rare words would give its label away.
    halves = [sample.where(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == h) for h in (0, 1)]
    totals, sizes = np.zeros((2, 2, 2, WORDS), np.int64), np.zeros((2, 2))
    for h, half in enumerate(halves):
        for row in half.mapInArrow(_odds_counts, "counts binary").collect():
            totals[h] += np.frombuffer(zlib.decompress(row[0]), np.int32).reshape(totals[h].shape)
        for row in half.groupBy("label").count().collect():
            sizes[h, row["label"]] = row["count"]
    if not sizes.sum(0).all():  # labelled documents of a class that are not in docs
        return None
    odds = log_odds(totals.sum(0), sizes.sum(0))
    crossed = [log_odds(totals[1 - h], sizes[1 - h]) for h in (0, 1)]
    shared = [spark.sparkContext.broadcast(x) for x in crossed]
    picked = pd.concat(
        half.mapInArrow(partial(_picked, odds=shared[h], learned_bytes=learned_bytes), "label int, text string").toPandas().sort_values(["text", "label"]).assign(half=h) for h, half in enumerate(halves)
    )
    if picked.empty:
        return None
    model = train(picked["text"].tolist(), picked["label"].to_numpy(np.float32), picked["half"].to_numpy(), crossed)
    sent = spark.sparkContext.broadcast(model)
    kind = "doc_id long, label int, a double, b double, c double, d double"
    found = pd.concat(half.mapInArrow(partial(_features, model=sent, odds=shared[h]), kind).toPandas() for h, half in enumerate(halves)).sort_values("doc_id")
    for one in (*shared, sent):
        one.destroy()
    y = found["label"].to_numpy(float)
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum()) * len(y) / (counts[0] + counts[1])
    return {"model": model, "odds": odds, "layer": logistic(found[["a", "b", "c", "d"]].to_numpy(), y, weight)}


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, per_class: int = PER_CLASS, learned_bytes: int = LEARNED_BYTES
) -> DataFrame:
    """`docs` with score (0 to 1, higher: toxic likelier) as `__score`; labels are (doc_id, label).

    Labels of documents whose fold is `held` are not learned from; `per_class` and `learned_bytes` bound what is (see `fit`). Null and empty texts are scored as one window without words. Without labels of
    both classes every score is 0. Rows that repeat are scored each; other columns are carried along whatever their names.
    """
    spark = docs.sparkSession
    fitted = fit(docs, labels.where(fold(F.col("doc_id"), folds) != held), per_class, learned_bytes)
    if fitted is None:
        return docs.withColumn("__score", F.lit(0.0))
    model, odds = (spark.sparkContext.broadcast(fitted[k]) for k in ("model", "odds"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], "__score double"])
    return docs.mapInArrow(partial(_scores, model=model, odds=odds, layer=fitted["layer"], names=docs.columns), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A text is held whole by one task, with about 60 bytes of memory for each of its bytes.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = toxicity_scores(slim, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label")))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of `docs` whose score is below the threshold, with all columns."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label"))

    def kept(docs: DataFrame) -> DataFrame:
        return toxicity_scores(docs, labels).where(F.col("__score") < threshold).drop("__score")

    return with_neutral_names(docs, ("doc_id", "text"), kept)
