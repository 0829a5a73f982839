"""Operator 11 against scores of all documents for all items."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from claimloom.llm import lexical_search as search
from claimloom.llm.lexical_search import Batch, bounds, counted, lexical_search, sketch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k=10):
    """docs (doc_id, text), items (item_id, text) -> rows of the query."""
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, tf) for d, tf in tfs if tf]
    df = Counter(t for _, tf in tfs for t in tf)
    number, total = len(tfs), sum(tf.total() for _, tf in tfs)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, tf in tfs:
            m = 10 + (90 * tf.total() * number) // total
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in own if t in tf)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_given_tables(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = ranked([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(want) > 300
    assert collected(lexical_search(documents, items)) == want
    assert collected(lexical_search(documents.repartition(7), items, first=1)) == want


def test_odd_rows_in_several_batches(spark, frame, odd_rows, monkeypatch):
    monkeypatch.setattr(search, "BATCH", 6)
    monkeypatch.setattr(search, "MOST_SENT", 2)
    rows = odd_rows + [(30 + i, "fox dog " * (i % 4 + 1), None, None) for i in range(40)]
    items = [(1, "The QUICK fox"), (2, None), (3, "!!"), (4, "one, two"), (5, "\u00e9t\u00e9"), (6, "nothing here matches zebra"), (1, "lazy"), (None, "WORD x end"), (7, "fox dog word")]
    table = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, score string")
    want = ranked([r[:2] for r in rows], items, 5)
    assert collected(lexical_search(frame(rows), table, k=5, first=2)) == want
    assert {r[0] for r in want} == {1, 4, 5, 6, 7, None} or {r[0] for r in want} == {1, 4, 5, 7, None}


def test_empty_tables(spark, frame):
    items = spark.createDataFrame([(1, "fox")], "item_id long, text string")
    empty = lexical_search(frame([]), items)
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search(frame([(1, "fox", None, None)]), items.limit(0)).count() == 0


def test_ties_of_many_copies_go_by_doc_id(spark, frame):
    rows = [(i, "the same words in each copy", "en", "a") for i in range(300, 0, -1)] + [(500 + i, f"other words {i}", "en", "a") for i in range(400)]
    items = spark.createDataFrame([(1, "same copy")], "item_id long, text string")
    got = lexical_search(frame(rows).repartition(8), items).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == list(range(1, 11)) and len({r.score for r in got}) == 1


@pytest.mark.parametrize(("vocabulary", "load"), [(30, 1), (3000, 1), (3000, 1024)])
def test_bounds_are_no_less_than_scores(vocabulary, load, monkeypatch):
    monkeypatch.setattr(search, "LOAD", load)
    monkeypatch.setattr(search, "BLOCK", 2000)
    rng = np.random.default_rng(vocabulary)
    words = [f"w{i}".encode() for i in range(vocabulary)]
    texts = [b" ".join(words[j] for j in rng.integers(0, vocabulary, rng.integers(1, 900))) for _ in range(60)] + [b"w1 " * 400]
    tfs = [counted(t) for t in texts]
    df = Counter(t for tf in tfs for t in tf)
    items = Batch([list(rng.choice(vocabulary, 20, replace=False)) for _ in range(9)], words, {i: df[w] for i, w in enumerate(words)}, len(texts), sum(tf.total() for tf in tfs))
    made = [sketch(tf) for tf in tfs]
    batch = pa.RecordBatch.from_arrays([pa.array(range(61)), pa.array([tf.total() for tf in tfs]), *[pa.array([x[k] for x in made]) for k in range(3)]], ["doc_id", "n", "width", "coordinates", "largest"])
    seen, tight = set(), 0
    for rows, bound in bounds(batch, items, {}):
        for row, values in zip(rows, bound, strict=True):
            m = int(items.lengths([tfs[row].total()])[0])
            scores = np.array([items.score(q, tfs[row], m) for q in range(9)])
            assert (values >= scores).all() and (values < 2**53).all()
            seen.add(int(row))
            tight += (values == scores).all()
    assert all(items.score(q, tfs[i], 10) == 0 for i in set(range(61)) - seen for q in range(9))
    assert len(seen) > 40 and (load == 1 or tight > 40)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Tick-tock " * 300 + "x" * 400).encode()
    whole = counted(text)
    monkeypatch.setattr("claimloom.llm.quality_rules.PIECE", 64)
    assert counted(text) == whole == Counter({b"tick": 300, b"tock": 300, b"x" * 400: 1})
