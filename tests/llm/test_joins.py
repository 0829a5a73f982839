"""Operators 2, 4, 5 and 6 against brute force."""

import hashlib
import re
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from claimloom.llm import ngram_join
from claimloom.llm.chunking import WINDOW, chunk_cuts, gear_hashes
from claimloom.llm.embedding_join import codes, embedding_near_dedup, met, plan
from claimloom.llm.exact_dedup import drop_copies, exact_dedup
from claimloom.llm.ngram_join import group_counts, keep_one_of_each, ngram_jaccard_join, overlap_bounds
from claimloom.llm.substring_dedup import cut_passages, repeats_by_document

SPACES = re.compile("[\x20\x09-\x0d]+")


def shingle_set(text, words):
    found = [w for w in SPACES.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def least_reached(ids, links):
    label = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def joined_by_brute_force(rows, words, num, den):
    sets = {i: shingle_set(t, words) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    label = least_reached(sets, links)
    return {(i, len(s), label[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("words", "share"), [(3, (90, 100)), (5, (8, 10))])
def test_ngram_join(documents, words, share):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {tuple(r) for r in ngram_jaccard_join(documents, words, share).collect()}
    assert got == joined_by_brute_force(rows, words, *share)


def test_ngram_join_of_chains_in_one_cell(frame, monkeypatch):
    """Copies with random edits of one text: many are near one another but not near the least of their cells."""
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.choice(150, rng.integers(0, 5), replace=False):
            words[at] = f"new{rng.integers(4)}"
        rows.append((i, " ".join(words)))
    got = {tuple(r) for r in ngram_jaccard_join(frame([(*r, "en", "a") for r in rows]), 3, (9, 10)).collect()}
    want = joined_by_brute_force(rows, 3, 9, 10)
    assert 1 < len({x[2] for x in want}) < 100
    assert got == want


def test_cells_left_out_lose_no_similar_set():
    """Whatever the order of cells, two sets that are just similar keep a common one; at all sizes, as the smaller or larger of a band."""
    rng = np.random.default_rng(9)
    for num, den in ((8, 10), (9, 10), (1, 2)):
        starts, plan = ngram_join.band_starts(), ngram_join.band_plan((num, den))
        left_out = 0
        for n in [*range(1, 40), *rng.integers(40, 900, 150)]:
            other = rng.integers(n, n * den // num + 1)
            common = -(-num * (n + other) // (den + num))
            if common > n:
                continue
            value = rng.choice(1 << 62, n + other - common, replace=False).astype(np.uint64) * np.uint64(4)
            band = bisect_right(starts, other) - 1
            kept = []
            for own in (value[:n], value[n - common :]):
                largest = min(len(own) * den // num, starts[band + 1] - 1)
                names, spare = ngram_join.cells(len(own), own, band, plan[band][1], (len(own) + largest) * (den - num) // (den + num))
                left_out += spare
                # Common cells come last, so they are the first to be left out.
                kept.append((names, spare))
            shared = np.intersect1d(kept[0][0], kept[1][0])
            assert not set.intersection(*[set(names.tolist()) - set(shared[:spare].tolist()) for names, spare in kept]) == set()
        assert left_out > 1000


def test_ngram_join_leaves_out_hot_cells(frame, monkeypatch):
    """Texts with some passages in common: their cells are hot, and texts that are not similar meet in few others. Near copies are found all the same."""
    rng = np.random.default_rng(6)
    passages = [[f"p{k}w{i}" for i in range(14)] for k in range(3)]
    rows = []
    for i in range(150):
        words = [f"d{i}w{j}" for j in range(100)]
        for passage in passages[: 1 + i % 3]:
            at = rng.integers(len(words))
            words[at:at] = passage
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            for at in rng.choice(len(words), i // 5 % 4, replace=False):
                words[at] = f"new{i}"
            rows.append((1000 + i, " ".join(words)))
    stored, keep = {}, ngram_join.Stages.keep

    def counted(self, name, df):
        stored[name] = (out := keep(self, name, df)).count()
        return out

    monkeypatch.setattr(ngram_join.Stages, "keep", counted)
    got = {tuple(r) for r in ngram_jaccard_join(frame([(*r, "en", "a") for r in rows]), 5, (8, 10)).collect()}
    want = joined_by_brute_force(rows, 5, 8, 10)
    assert len({x[2] for x in want}) < len(rows) - 10
    assert got == want
    assert stored["several"] < 100 and stored["candidates"] == 0


def test_a_pair_leaves_one_leaf(frame, monkeypatch):
    """Texts that meet in many cells and are near, but not similar, are handed on once and not from each cell."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(150, 4, replace=False):
            words[at] = f"new{i}at{at}"
        rows.append((i, " ".join(words)))
    made, leaf_pairs = [], ngram_join._leaf_pairs

    def counted(leaves):
        both = [f"{c}{side}" for c in ngram_join._HELD for side in ("", "_b")]
        for row in leaves.collect():
            held = {c: getattr(row, c.removesuffix("_b")) for c in both}
            schema = pa.schema([("cell", pa.int64()), *[(c, ngram_join._LEAF[c.removesuffix("_b")]) for c in both]])
            batch = pa.RecordBatch.from_pylist([{"cell": row.cell, **held}], schema)
            made.extend(tuple(pair.values()) for out in leaf_pairs(iter([batch]), (8, 10), own=True) for pair in out.to_pylist())

    monkeypatch.setattr(ngram_join, "_descended", lambda stages, leaves, share, f=ngram_join._descended: counted(leaves) or f(stages, leaves, share))
    got = {tuple(r) for r in ngram_jaccard_join(frame([(*r, "en", "a") for r in rows]), 5, (8, 10), per_group=8, least_groups=64).collect()}
    assert got == joined_by_brute_force(rows, 5, 8, 10)
    assert len(set(made)) > 10 and len(made) < 1.5 * len(set(made))


def test_ngram_join_of_odd_rows(frame, odd_rows):
    got = ngram_jaccard_join(frame(odd_rows), 3, (9, 10)).collect()
    assert len(got) == len(odd_rows)
    group = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert group[(6, 12)] == group[(5, 12)] == group[(1, 12)] == 1
    assert group[(10, 1)] == 9 and group[(2, 0)] == 2 and group[(4, 0)] == 4 and group[(8, 1)] == 8
    assert {v for k, v in group.items() if k[0] is None} == {None}
    kept = keep_one_of_each(frame(odd_rows), 3, (9, 10))
    assert kept.columns == frame([]).columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 7, 8, 9, 11, None}
    assert ngram_jaccard_join(frame([])).count() == 0


def test_exact_dedup(frame, documents, odd_rows):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACES.sub(" ", t or "")].append(i)
    want = {(i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}
    assert {tuple(r) for r in exact_dedup(documents).drop("n_chunks").collect()} == want

    got = exact_dedup(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert sorted((r.keep_id, r.group_size) for r in got if r.doc_id == 6) == [(1, 4), (1, 4)]
    assert sum(r.kept for r in got) == 8 and {r.group_size for r in got if r.doc_id == 2} == {3}
    kept = drop_copies(frame(odd_rows))
    assert kept.columns == frame([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 7, 8, 9, 11]
    assert sorted(r.doc_id for r in drop_copies(frame([(2, "a", "", ""), (2, "a", "", ""), (3, "a", "", "")])).collect()) == [2]
    assert drop_copies(frame([])).count() == 0


def test_gear_hashes_and_cuts():
    data = np.frombuffer(np.random.default_rng(1).bytes(5000), np.uint8)
    hashes = gear_hashes(data)
    assert (gear_hashes(data[100:])[WINDOW:] == hashes[100 + WINDOW :]).all()
    offsets = np.array([0, 0, 3000, 3010, 5000])
    starts, ends, doc = chunk_cuts(data, offsets, 64, 5, 200)
    for k in range(4):
        own = doc == k
        assert (ends[own] - starts[own]).sum() == offsets[k + 1] - offsets[k] and (starts[own][1:] == ends[own][:-1]).all()
    assert (ends - starts).max() <= 200 and sorted(set(doc)) == [1, 2, 3]


def test_substring_dedup(frame, odd_rows):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "kmnprst" for b in ("ala", "iro", "uve", "osti")]

    def prose(n):
        return " ".join(rng.choice(words, n) + rng.choice(list("abcdefgh"), n))

    passages = [prose(55) for _ in range(20)]
    rows = [(i, prose(80) + " " + passages[i % 20] + " " + prose(40 + i), "en", "a") for i in range(40)]
    clean = [(100 + i, prose(200), "en", "a") for i in range(30)]
    found = {r.doc_id: r for r in repeats_by_document(frame(rows + clean)).collect()}
    assert set(found) == set(range(20, 40))
    assert all(found[i].first_ids == [i - 20] for i in found)
    cut = {r.doc_id: r.text for r in cut_passages(frame(rows + clean)).collect()}
    assert all(cut[r[0]] == r[1] for r in rows[:20] + clean)
    for i in range(20, 40):
        assert len(cut[i]) < len(rows[i][1]) and passages[i - 20] not in cut[i] and cut[i].startswith(rows[i][1][:400])
    assert {r.doc_id for r in repeats_by_document(frame(odd_rows)).collect()} <= {5, 6, 7, 8}
    assert repeats_by_document(frame([])).count() == 0


def test_embedding_join(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 20))
    vectors = [c + rng.standard_normal(20) * 0.16 for c in centres for _ in range(12)]
    vectors += [vectors[0]] * 3 + [3 * vectors[1]]
    odd = [None, [], [0.0] * 20, [float("nan")] * 20, [None, *[1.0] * 19], [float("inf"), *[1.0] * 19], [1.0, 2.0]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(odd)]
    got = {r.vec_id: r for r in embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=8).collect()}
    unit = np.array([np.array(v, np.float32).astype(float) for v in vectors])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(vectors))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.9 * near.sum()
    for i in range(1000, 1007):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[480].component_id == got[0].component_id
    assert len(got) == len(rows)
    assert embedding_near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize(("vectors", "hashes"), [(500, 2), (1_000_000, 3), (50_000_000_000, 5)])
def test_tables_are_planned_for_the_recall_wanted(vectors, hashes):
    """At the threshold itself; measured on other pairs than those that the plan looks at."""
    found, tables = plan(vectors, 64, 0.9)
    assert found == hashes
    rng = np.random.default_rng(99)
    a, other = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 300, 64)))
    other -= (a * other).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(0.19) * other / np.linalg.norm(other, axis=1, keepdims=True)
    seen = met(codes(a, tables, found, 3), codes(b, tables, found, 3)).any(1).mean()
    assert seen >= 0.95
    apart = met(codes(a, tables, found, 3), codes(a[::-1].copy(), tables, found, 3))
    assert apart.mean() < 0.01  # vectors that are not near hardly meet


def test_work_of_a_vector_does_not_grow_with_their_number():
    """Vectors without near ones: the share of all pairs that meet in a bucket falls as they become more."""
    rng = np.random.default_rng(8)
    shares = []
    for n in (2_000, 40_000):
        unit = rng.standard_normal((n, 16))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        hashes, tables = plan(n, 16, 0.9)
        code = codes(unit, 4, hashes, 3)
        pairs = sum((np.unique(code[:, t, 0], return_counts=True)[1] ** 2).sum() for t in range(4))
        shares.append(pairs * tables / 4 / n**2)
    assert shares[1] < 0.5 * shares[0]


def test_finer_points_bound_the_overlap_from_above():
    rng = np.random.default_rng(5)
    for n, m, common in [(1, 1, 1), (40, 45, 38), (700, 900, 0), (2000, 4100, 1500), (5000, 5000, 4999)]:
        values = rng.permutation(np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64) * np.uint64(2)))[: n + m - common]
        a, b = values[:n], values[n - common : n - common + m]
        bound = overlap_bounds(pa.array([group_counts(a)]), pa.array([group_counts(b)]))[0]
        assert common <= bound <= min(n, m)
        if n > 500 and common == 0:
            assert bound < 0.889 * n
    assert group_counts(np.arange(5000, dtype=np.uint64)) is None  # one group holds all: no byte holds the count
