"""Operator 13: measures against a plain version, lines and documents removed as stated."""

import re
from collections import Counter

import pytest

from claimloom.llm import quality_rules as rules
from claimloom.llm.quality_rules import BaseRules, LineRules, clean_lines, judged, line_fails, pieces, quality_rules, repeated_words

WORD = re.compile("[^\x20\x09-\x0d]+")


def measured(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_measures(documents, frame, odd_rows):
    for docs in (documents, frame(odd_rows)):
        want = Counter((r.doc_id, *measured(r.text)) for r in docs.collect())
        got = quality_rules(docs).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules(frame([])).count() == 0


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("A sentence, with words; and an end.", None),
        ("What*** is%%% this&&& text$$$ now", "punctuation"),
        ("Home | News | Sport | About", "navigation"),
        ("  Back to top ", "navigation"),
        ("This  work is LICENSED\tunder the licence.", "boilerplate"),
        ("read more about this in the other chapter", None),
        ("a - b is a difference", None),
    ],
)
def test_lines(line, rule):
    assert line_fails(line.encode(), LineRules(marks_share=100 if rule == "navigation" else 40)) == rule


def test_documents_that_lose_too_much(frame):
    good = [f"Line{i} has{i} seven{i} words{i} of{i} its{i} own{i}." for i in range(10)]
    bad = ["one*** two&&& three### four%%% five$$$"] * 30
    docs = frame([(1, "\n".join(good), None, "a"), (2, "\n".join(good + bad[:2]), None, "a"), (3, "\n".join(good[:6] + bad), None, "a"), (4, None, "en", "b")])
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[2].n_punctuation == 2 and got[2].n_dup_lines == 1
    kept = clean_lines(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text, r.node) for r in kept.collect()} == {(1, "\n".join(good), "x"), (2, "\n".join(good), "x")}


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = b"tick tock " * 500 + b"x" * 300 + b" end\n" + b"one two three four " * 9
    whole = repeated_words(text, 3)
    monkeypatch.setattr(rules, "PIECE", 64)
    assert b"".join(pieces(text, 64)) == text and max(map(len, pieces(text, 64))) > 300
    assert repeated_words(text, 3) == whole == measured(text.decode())[::4]


def test_labels_of_the_given_tables(spark):
    """Of documents that pass the base rules, the verdict follows the labels."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_what_stays_of_a_text():
    text = "Home\nAll rights reserved to nobody.\n\nThe end of it.\nWhat*** is%%% this&&&"
    measures, left = judged(text.encode(), BaseRules(), LineRules())
    assert (measures["n_navigation"], measures["n_boilerplate"], measures["n_punctuation"]) == (1, 1, 1)
    assert left == b"\nThe end of it."
