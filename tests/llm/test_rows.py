"""Operators 3, 8 and 10: every row placed, laws and targets kept, ids equal to the tokenizer's."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimloom.llm.mixing import mix_sources, mixed_documents
from claimloom.llm.packing import WordTokenizer, default_vocabulary, pack
from claimloom.llm.sharding import hilbert_index, hilbert_shards


def test_hilbert_curve_visits_neighbours(spark):
    grid = spark.range(512).selectExpr("id % 8 AS x", "id div 8 % 8 AS y", "id div 64 AS z")
    rows = grid.withColumn("h", hilbert_index([F.col(c) for c in "xyz"], 3)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(512))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(rows, rows[1:], strict=False))


def check_shards(docs, got):
    assert len(got) == docs.count()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 1) for r in docs.collect())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[k]) for k in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    cells = sorted((r.shard, r.slot, r.cell) for r in got)
    assert [c[2] for c in cells] == sorted(c[2] for c in cells)


def test_shards(frame, documents, odd_rows):
    for docs in (documents, frame(odd_rows)):
        got = hilbert_shards(docs).collect()
        check_shards(docs, got)
    crc = {r.doc_id: r.text_crc32 for r in got}
    assert crc[9] == zlib.crc32(b"one") and crc[2] == 0
    assert hilbert_shards(frame([])).count() == 0


def wanted_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mixing(frame, documents, odd_rows):
    for docs in (documents, frame(odd_rows)):
        rows = mix_sources(docs).collect()
        assert len(rows) == docs.count()
        sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
            assert r.taken in (0, r.size, 2 * r.size)
        target = wanted_targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
        assert sorted(map(str, rows)) == sorted(map(str, mix_sources(docs).collect()))
        mixed = mixed_documents(docs)
        assert mixed.columns == docs.columns
        assert mixed.count() == sum(r.taken // r.size for r in rows if r.size)
    assert mix_sources(frame([])).count() == 0 and mixed_documents(frame([])).count() == 0


def test_tokenizer_equals_the_library(documents):
    texts = [r.text for r in documents.limit(60).collect()]
    texts += ["", "it's a dog's", "don't  \n\n x", "  lead", "trail  ", "a\t\tb  c", "日本語 テスト 123abc", "😀 smile", "<|endoftext|>x", "x\r\n\r\n y", " z", "é1é", "'s"]
    raw = [t.encode() for t in texts]
    tokenizer = WordTokenizer(default_vocabulary())
    plain = Tokenizer.from_file(default_vocabulary())
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for pool in (1 << 22, 3000):  # the second is overfull all the time
        tokenizer.POOL = pool
        tokenizer.clear()
        for _ in range(2):
            got = []
            for at in range(0, len(raw), 7):
                part = raw[at : at + 7]
                ids, sizes = tokenizer.encode(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0] + [len(x) for x in part]))
                got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
            assert got == want


def check_pieces(rows, pieces):
    plain = Tokenizer.from_file(default_vocabulary())
    sequences, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        docs[p.doc_id].append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert sum(p.length for p in own) <= 1024 and own[0].offset == 0
        assert all(a.offset + a.length == b.offset for a, b in zip(own, own[1:], strict=False))
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    for i in ids:
        for p in docs[i]:
            part = np.array(ids[i][p.start : p.start + p.length], "<u4")
            assert p.length == len(part) > 0 and p.ids_crc32 == zlib.crc32(part.tobytes()) and p.doc_tokens == len(ids[i])
    return sum(p.length for p in pieces), len(sequences)


def test_packing(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    total, sequences = check_pieces(rows, pack(documents.repartition(5, "doc_id")).collect())
    plain = Tokenizer.from_file(default_vocabulary())
    assert total == sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert total / (1024 * sequences) > 0.97


def test_packing_of_odd_rows(frame, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    pieces = pack(frame(odd_rows)).collect()
    check_pieces([(r[0], r[1]) for r in rows], pieces)
    covered = defaultdict(int)
    for p in pieces:
        covered[p.doc_id] += p.length
    tokens = {p.doc_id: p.doc_tokens for p in pieces if p.doc_id is not None}
    assert all(covered[i] == n * (2 if i == 6 else 1) for i, n in tokens.items()) and set(tokens) == {r[0] for r in rows}
    assert pack(frame([])).count() == 0
