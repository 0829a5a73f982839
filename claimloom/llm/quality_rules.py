"""Quality rules, lines first: lines that break a rule go, then documents that lost too much of their text.

A line is judged by itself, so the work is one pass over the texts, without a shuffle:

* punctuation: decoration in place of sentences, `marks` per word above a share;
* navigation: words divided by separators (menus, breadcrumbs), or a short line that is a menu entry;
* boilerplate: a phrase of notices, banners and licences.

Blank lines are neutral. A document is rejected when the lines that stay hold less than a share of its characters in
words. Before that the base rules look at the whole document: too few words, or too many words in repeated windows.

Texts are read as UTF-8 bytes. Words are looked up piece by piece, so a very long text takes, beside itself and its
vocabulary, some 60 bytes a word in the task that holds it.
"""

from collections import defaultdict
from dataclasses import dataclass
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_NO_POINTS = bytes(range(0x80, 0xC0)) + _SPACES  # bytes that begin no code point of a word
PIECE = 1 << 20

# Fixed values of the line rules, in the lower case of A-Z.
MARKS = "#*$%&|<>!?=_~^@{}[]\\"
SEPARATORS = ("|", ">", "»", "•", "·", "::", "/", "-", "–", "—")
MENU = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "share", "next", "previous", "contact", "contact us",
    "about us", "sitemap", "read more", "more", "back to top", "skip to content", "subscribe", "download", "print",
)
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies", "accept cookies", "enable javascript",
    "lorem ipsum", "copyright (c)", "copyright ©", "licensed under", "click here", "powered by", "subscribe to our", "sign up for our",
)
_MARKS = MARKS.encode()
_SEPARATORS = [s.encode() for s in SEPARATORS]


@dataclass(frozen=True)
class LineRules:
    """A line fails with `least_marks` marks or more that exceed `marks_share` percent of its words, with `least_separators` separators or
    more that are `separator_share` percent or more of its words, as a menu entry, or with a phrase. A document needs `kept_share` percent
    of its characters in the lines that stay."""

    least_marks: int = 3
    marks_share: int = 40
    least_separators: int = 3
    separator_share: int = 25
    menu: tuple[str, ...] = MENU
    phrases: tuple[str, ...] = PHRASES
    kept_share: int = 60


@dataclass(frozen=True)
class BaseRules:
    """A document needs `least_words` words, of which at most `repeat_share` percent lie in repeated windows of `window` words."""

    least_words: int = 50
    repeat_share: int = 50
    window: int = 3


def code_points(text: bytes) -> int:
    """Code points outside white space."""
    return len(text.translate(None, _NO_POINTS))


def pieces(text: bytes, most: int = 0):
    """Parts of about `most` bytes (`PIECE` by default) that end between words; a longer word is one part."""
    most = most or PIECE
    at = 0
    while len(text) - at > most:
        end = at + most
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def repeated_words(text: bytes, window: int) -> tuple[int, int]:
    """Number of words, and of those that lie in a window of words found twice or more in the text."""
    names: dict[bytes, int] = defaultdict(count().__next__)
    found = [np.fromiter(map(names.__getitem__, words), np.int64, len(words)) for part in pieces(text) if (words := part.split())]
    if not found:
        return 0, 0
    word = np.concatenate(found)
    if len(word) <= window or len(names) == len(word):
        return len(word), 0
    name, kinds = word, len(names)
    for k in range(1, window):  # windows of k + 1 words are named by the window of k and the word after it
        known, name = np.unique(name[:-1] * kinds + word[k:], return_inverse=True)
    again = np.flatnonzero(np.bincount(name, minlength=len(known))[name] > 1)
    covered = np.zeros(len(word), bool)
    for k in range(window):
        covered[again + k] = True
    return len(word), int(covered.sum())


def line_fails(line: bytes, rules: LineRules) -> str | None:
    """Name of the first rule that a line with words breaks."""
    words = line.lower().split()
    marks = len(line) - len(line.translate(None, _MARKS))
    if marks >= rules.least_marks and 100 * marks > rules.marks_share * len(words):
        return "punctuation"
    separators = sum(map(words.count, _SEPARATORS))
    if separators >= rules.least_separators and 100 * separators >= rules.separator_share * len(words):
        return "navigation"
    plain = b" ".join(words)
    if len(words) <= 3 and plain.decode() in rules.menu:
        return "navigation"
    return "boilerplate" if any(p.encode() in plain for p in rules.phrases) else None


def judged(text: bytes, base: BaseRules, rules: LineRules) -> tuple[dict, bytes]:
    """The measures of a text, and what stays of it."""
    n_words, n_repeat = repeated_words(text, base.window)
    seen: set[bytes] = set()
    duplicates, kept_chars, stay = 0, 0, []
    failed = dict.fromkeys(("punctuation", "navigation", "boilerplate"), 0)
    for line in text.split(b"\n"):
        if chars := code_points(line):
            duplicates += line in seen
            seen.add(line)
            if broken := line_fails(line, rules):
                failed[broken] += 1
                continue
            kept_chars += chars
        stay.append(line)
    chars = code_points(text)
    base_failed = n_words < base.least_words or 100 * n_repeat > base.repeat_share * n_words
    measures = {
        "n_words": n_words, "word_chars": chars, "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": duplicates,
        "n_repeat_words": n_repeat, **{f"n_{rule}": n for rule, n in failed.items()}, "kept_chars": kept_chars,
        "base_failed": base_failed, "kept": not base_failed and 100 * kept_chars >= rules.kept_share * chars,
    }
    return measures, b"\n".join(stay)


_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_punctuation long, n_navigation long, "
    "n_boilerplate long, kept_chars long, base_failed boolean, kept boolean"
)


def _judged(batches, base: BaseRules, rules: LineRules, with_text: bool):
    """Adds the measures, and the cleaned text if asked for, to (id, text)."""
    names = [f.split()[0] for f in _MEASURES.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            rows = batch.slice(at, 1000)
            found = [judged((t.as_py() or "").encode(), base, rules) for t in rows.column(1)]
            columns = [rows.column(0), *[pa.array([m[n] for m, _ in found], pa.bool_() if n in ("base_failed", "kept") else pa.int64()) for n in names]]
            if with_text:
                columns.append(pa.array([t.decode() for _, t in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["id", *names, *(["cleaned"] if with_text else [])])


def quality_rules(docs: DataFrame, base: BaseRules = BaseRules(), rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, and the number of lines that each rule removed.

    Reads doc_id and text only, so other columns may have any name. A null text has no words and fails the base rules, as does an empty
    one. Rows that repeat a doc_id, or have none, are judged each by itself. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(partial(_judged, base=base, rules=rules, with_text=False), f"id long, {_MEASURES}").withColumnRenamed("id", "doc_id")


def clean_lines(docs: DataFrame, base: BaseRules = BaseRules(), rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, with all their columns, and without the lines that broke a rule.

    The row travels as one struct beside its text, so columns may have any name.
    """
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])
    held = docs.select(row.alias("id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([held.schema["id"], *T.StructType.fromDDL(f"{_MEASURES}, cleaned string").fields])
    found = held.mapInArrow(partial(_judged, base=base, rules=rules, with_text=True), schema).where("kept")

    def column(name: str) -> Column:
        return (F.col("cleaned") if name == "text" else F.col("id").getField(name)).alias(name)

    return found.select(*[column(c) for c in docs.columns])


def _sql_list(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rules_sql(base: BaseRules = BaseRules(), rules: LineRules = LineRules()) -> str:
    """DuckDB SQL with the rows of `quality_rules` over `documents`, for windows of three words."""
    assert base.window == 3
    words = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    marks = "".join("\\" + c if c in "[]\\^" else c for c in MARKS)
    phrase = " OR ".join(f"contains(plain, {_sql_list((p,))})" for p in rules.phrases)
    return rf"""
        WITH docs AS (
            SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body, {words.format("coalesce(text, '')")} AS w FROM documents
        ), measured AS (
            SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                   length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols
            FROM docs
        ), windows AS (
            SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS times
            FROM (SELECT r, w, unnest(range(1, n_words - 1)) AS p FROM measured)
        ), repeated AS (
            SELECT r, count(DISTINCT p + k) AS n_repeat_words
            FROM windows, (VALUES (0), (1), (2)) AS shift(k) WHERE times > 1 GROUP BY r
        ), lines AS (
            SELECT r, place, line, {words.format(f"translate(line, '{upper}', '{lower}')")} AS lw
            FROM (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM (SELECT r, string_split(body, chr(10)) AS l FROM docs))
        ), counted AS (
            SELECT *, array_to_string(lw, ' ') AS plain, length(array_to_string(lw, '')) AS chars,
                   length(line) - length(regexp_replace(line, '[{marks}]', '', 'g')) AS marks,
                   len(list_filter(lw, lambda x: list_contains([{_sql_list(SEPARATORS)}], x))) AS separators,
                   row_number() OVER (PARTITION BY r, line ORDER BY place) > 1 AS duplicate
            FROM lines WHERE len(lw) > 0
        ), judged AS (
            SELECT *, CASE WHEN marks >= {rules.least_marks} AND 100 * marks > {rules.marks_share} * len(lw) THEN 1
                           WHEN separators >= {rules.least_separators} AND 100 * separators >= {rules.separator_share} * len(lw) THEN 2
                           WHEN len(lw) <= 3 AND plain IN ({_sql_list(rules.menu)}) THEN 2
                           WHEN {phrase} THEN 3 ELSE 0 END AS broken
            FROM counted
        ), by_doc AS (
            SELECT r, count(*) FILTER (WHERE duplicate) AS n_dup_lines, count(*) FILTER (WHERE broken = 1) AS n_punctuation,
                   count(*) FILTER (WHERE broken = 2) AS n_navigation, count(*) FILTER (WHERE broken = 3) AS n_boilerplate,
                   coalesce(sum(chars) FILTER (WHERE broken = 0), 0)::BIGINT AS kept_chars
            FROM judged GROUP BY r
        ), whole AS (
            SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_punctuation, 0) AS n_punctuation, coalesce(n_navigation, 0) AS n_navigation,
                   coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(kept_chars, 0) AS kept_chars
            FROM measured LEFT JOIN by_doc USING (r) LEFT JOIN repeated USING (r)
        ), failing AS (
            SELECT *, n_words < {base.least_words} OR 100 * n_repeat_words > {base.repeat_share} * n_words AS base_failed FROM whole
        )
        SELECT *, NOT base_failed AND 100 * kept_chars >= {rules.kept_share} * word_chars AS kept FROM failing
    """
