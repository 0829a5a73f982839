"""Operators 1, 3, 5 and 7 against plain versions of what they do."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from claimloom.llm import language_id as lang
from claimloom.llm import quality as crf
from claimloom.llm.chunking import _GEAR, WINDOW
from claimloom.llm.common import salted
from claimloom.llm.sharding import hilbert_shards
from claimloom.llm.substring_dedup import BITS, LEAST, MOST, RUN_WORDS, repeats_by_document

TEXTS = ["", "a", "The cat.", "été à 42 l'été", "x  y\n\nz", "aaaa aaaa", "don't", "日本語 text"]


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def plain_grams(text):
    """1 to 4 bytes; what is no letter and no multi-byte character is a space, and a space stands only at either end, never alone."""
    letters = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    out = []
    for n in range(1, 5):
        for i in range(len(letters) - n + 1):
            gram = letters[i : i + n]
            if 32 in gram[1:-1] or n == 1 and gram == b" " or n == 2 and gram == b"  ":
                continue
            out.append(gram)
    return out


def bucket_of(gram):
    value, times = salted(401, 256).tolist(), salted(402, 4).tolist()
    return (sum(value[b] * times[k] for k, b in enumerate(gram)) * 0x9E3779B97F4A7C15 % 2**64) >> 48


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])


def test_character_grams():
    bucket, doc = lang.grams(*packed(TEXTS))
    got = Counter(zip(doc.tolist(), bucket.tolist(), strict=True))
    assert got == Counter((i, bucket_of(g)) for i, t in enumerate(TEXTS) for g in plain_grams(t))


def test_document_frequencies():
    rows = [b for b in lang._frequencies(iter([batch_of(TEXTS[:5]), batch_of(TEXTS[5:])]))]
    got = {b: n for batch in rows for b, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)}
    want = Counter(b for t in TEXTS for b in {bucket_of(g) for g in plain_grams(t)})
    assert got.pop(-1) == len(TEXTS) and got == want


def plain_ftrl(rows, y, classes, epochs, alpha, beta, l1, l2):
    z, n = defaultdict(float), defaultdict(float)

    def weight(b, c):
        if abs(z[b, c]) <= l1:
            return 0.0
        return -(z[b, c] - math.copysign(l1, z[b, c])) / ((beta + math.sqrt(n[b, c])) / alpha + l2)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w = {(b, c): weight(b, c) for b in at for c in range(classes)}
            score = [sum(v * w[b, c] for b, v in zip(at, x, strict=True)) for c in range(classes)]
            p = [math.exp(s) / sum(math.exp(t) for t in score) for s in score]
            for c in range(classes):
                for b, v in zip(at, x, strict=True):
                    g = v * (p[c] - (c == y[i]))
                    z[b, c] += g - (math.sqrt(n[b, c] + g * g) - math.sqrt(n[b, c])) / alpha * w[b, c]
                    n[b, c] += g * g
    return weight


def test_follow_the_regularised_leader():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(40, 8, replace=False)), rng.random(8)) for _ in range(30)]
    y = rng.integers(0, 3, 30)
    options = {"epochs": 2, "alpha": 0.5, "beta": 1.0, "l1": 0.3, "l2": 0.01}
    got, weight = lang.ftrl(rows, y, 3, **options), plain_ftrl([(a.tolist(), x.tolist()) for a, x in rows], y, 3, **options)
    want = np.array([[weight(b, c) for c in range(3)] for b in range(40)])
    assert np.allclose(got[:40], want) and not got[40:].any()
    assert 0 < (want == 0).sum() < want.size  # the penalty leaves some of them zero


def test_predictions(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house and the dog", "en"), ("das haus und der hund", "de"), ("la casa y el perro", "es")] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang.fit(docs, docs)
    df = Counter(b for _, t, _ in rows for b in {bucket_of(g) for g in plain_grams(t)})
    text = "the hund el 12"
    found = Counter(map(bucket_of, plain_grams(text)))
    score = sum(n / found.total() * model["table"][b] for b, n in found.items()).astype(float) / model["temperature"]
    p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()

    class Sent:
        value = model

    (got,) = lang._predictions(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])]), Sent)
    assert got.column(1)[0].as_py() == model["names"][p.argmax()] and abs(got.column(2)[0].as_py() - p.max()) < 1e-6
    assert model["names"] == ["de", "en", "es"] and set(np.flatnonzero(model["table"].any(1))) <= set(df)


def plain_chunks(raw):
    """(start, end) of each chunk: a cut after the byte where the hash of the last bytes has zero bits, not before LEAST nor after MOST bytes."""
    gear, cuts, start = _GEAR.tolist(), [], 0
    while start < len(raw):
        end = min(start + MOST, len(raw))
        for at in range(start + LEAST, end):
            value = sum(gear[raw[at - 1 - k]] << k for k in range(WINDOW)) % 2**32
            if (value >> WINDOW) & ((1 << BITS) - 1) == 0:
                end = at
                break
        cuts.append((start, end))
        start = end
    return cuts


def plain_repeats(rows):
    """{doc_id: [(start, length, words, first_ids), ...]} for rows of distinct doc_ids."""
    chunks = {i: [(a, b, t.encode()[a:b]) for a, b in plain_chunks(t.encode())] for i, t in rows}
    first = {}
    for i in sorted(chunks):
        for _, _, raw in chunks[i]:
            first.setdefault(raw, i)
    out = {}
    for i, t in rows:
        raw, runs, run = t.encode(), [], []
        begins = {k for k in range(len(raw)) if raw[k] not in b" \t\n\v\f\r" and (k == 0 or raw[k - 1] in b" \t\n\v\f\r")}
        for a, b, part in [*chunks[i], (0, 0, None)]:
            if part is not None and first[part] < i:
                run.append((a, b, sum(k in begins for k in range(a, b)), first[part]))
            elif run:
                runs.append((run[0][0], run[-1][1] - run[0][0], sum(r[2] for r in run), sorted({r[3] for r in run})))
                run = []
        if kept := [r for r in runs if r[2] >= RUN_WORDS]:
            out[i] = kept
    return out


def test_repeated_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000").orderBy("doc_id").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    shared = rows[0][1][:900]
    rows += [(10_000 + k, f"{'pre ' * k}{shared} and more of its own {k} {rows[k + 1][1][:700]}") for k in range(6)]
    want = plain_repeats(rows)
    got = repeats_by_document(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(want) >= 6
    assert {r.doc_id: [(s.start, s.length) for s in r.spans] for r in got} == {i: [(a, n) for a, n, _, _ in runs] for i, runs in want.items()}
    assert {r.doc_id: r.first_ids for r in got} == {i: sorted({f for run in runs for f in run[3]}) for i, runs in want.items()}
    assert {r.doc_id: (r.passages, r.repeated_bytes) for r in got} == {i: (len(runs), sum(n for _, n, _, _ in runs)) for i, runs in want.items()}


def test_shards_prune_better_than_dealing_by_hash(spark):
    """Shards that a filter on one value must open, by their least and greatest values: Hilbert order against a hash of doc_id."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "lang", "text")
    rows = hilbert_shards(docs).select("doc_id", "size", "shard").join(docs.drop("text"), "doc_id")
    rows = rows.withColumn("dealt", F.pmod(F.xxhash64("doc_id"), F.lit(8))).toPandas()
    for column in ("source", "lang", "size"):
        values = rows[column].quantile([0.05, 0.2, 0.5, 0.8, 0.95]).tolist() if column == "size" else sorted(set(rows[column]))
        opened = []
        for by in ("shard", "dealt"):
            ends = rows.groupby(by)[column].agg(["min", "max"])
            opened.append(sum(low <= v <= high for low, high in zip(ends["min"], ends["max"], strict=True) for v in values))
        assert opened[0] < opened[1], column


def test_hot_cells_are_split_without_effect(frame, documents, odd_rows):
    for docs in (documents, frame(odd_rows + [(100 + i, "the same", "en", "hot") for i in range(400)])):
        whole, split = (sorted((tuple(r) for r in hilbert_shards(docs, **o).select("shard", "slot", "doc_id", "size", "text_crc32").collect()), key=str) for o in ({}, {"most_ranked": 3}))
        assert split == whole


def log_likelihood(x, doc, y, weight, w):
    """Of the line labels under the field, document by document, by summing over all labellings with a forward pass."""
    total, turn, score = 0.0, w[-4:].reshape(2, 2), x @ w[:-4]
    for d in np.unique(doc):
        own = np.flatnonzero(doc == d)
        ahead = np.array([0.0, score[own[0]]])
        real = score[own[0]] * y[own[0]]
        for i, k in zip(own, own[1:], strict=False):
            ahead = np.logaddexp(ahead[0] + turn[0], ahead[1] + turn[1]) + np.array([0.0, score[k]])
            real += turn[int(y[i]), int(y[k])] + score[k] * y[k]
        total += weight[own[0]] * (real - np.logaddexp(*ahead))
    return total


def test_gradient_of_the_field():
    """One step of training from zero moves against the numeric gradient: Adam's first step is its sign."""
    rng = np.random.default_rng(2)
    doc = np.repeat(np.arange(6), [1, 4, 3, 5, 2, 6])
    x = np.column_stack([rng.standard_normal((len(doc), 5)), np.ones(len(doc)), rng.integers(0, 2, len(doc))])
    y, weight = rng.integers(0, 2, 6)[doc].astype(float), rng.random(6)[doc]
    model = crf.train(x, doc, y, weight, rounds=1, rate=1.0, ridge=0.0)
    plain = (x - model["mean"]) / model["scale"]
    for k in range(len(model["w"])):
        ends = []
        for step in (1e-5, -1e-5):
            w = np.zeros(len(model["w"]))
            w[k] = step
            ends.append(log_likelihood(plain, doc, y, weight, w))
        slope = (ends[0] - ends[1]) / 2e-5
        if abs(slope) > 1e-6:
            assert np.sign(model["w"][k]) == np.sign(slope) and abs(abs(model["w"][k]) - 1) < 1e-3
    # Many small steps raise the likelihood that the gradient belongs to.
    trained = crf.train(x, doc, y, weight, rounds=200, ridge=0.0)
    assert log_likelihood(plain, doc, y, weight, trained["w"]) > log_likelihood(plain, doc, y, weight, np.zeros(len(trained["w"])))


def test_line_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    fitted = crf.fit(docs, labels)
    good = labels.where("label = 1").join(docs, "doc_id").orderBy("doc_id").first()["text"].split("\n")[0]
    bad = "Word*** other%%% thing&&& more### than$$$ that*** again%%%"
    mixed = spark.createDataFrame([(1, "\n".join([good] * 4 + [bad] * 4)), (2, None), (3, "")], "doc_id long, text string")
    found = {(r.doc_id, r.line): r.good for r in crf.line_labels(mixed, fitted).collect()}
    assert set(found) == {(1, k) for k in range(8)} | {(2, 0), (3, 0)}
    assert min(found[1, k] for k in range(3)) > max(found[1, k] for k in range(5, 8))
