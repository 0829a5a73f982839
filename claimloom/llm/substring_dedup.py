"""Substring dedup: passages that several documents share, by content-defined chunks.

Texts are cut by a gear rolling hash into small variable chunks, so text inserted before a passage moves its chunks without changing them.
Chunks are deduplicated by 128-bit digest: the occurrence with the least (doc_id, start) is the first, and a chunk found in
another document than its first is a repeat. Neighbouring repeats make a run; runs with enough words are passages.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.chunking import chunk_cuts
from claimloom.llm.common import SPACE, Stages, blocks, runs, span_digests, with_neutral_names

LEAST, BITS, MOST = 24, 5, 256
#: Words in the whole chunks of a run. A passage of 50 words loses at most about half of them to the chunks at its ends.
RUN_WORDS = 16


def _chunks(batches):
    for rows, data, offsets in blocks(batches):
        starts, ends, doc = chunk_cuts(data, offsets, LEAST, BITS, MOST)
        if not len(starts):
            continue
        begun = np.zeros(len(data) + 1, np.int64)
        first, _, _ = runs(~SPACE[data], offsets)
        begun[first + 1] = 1
        begun = np.cumsum(begun)
        columns = {
            "d1": span_digests(data, starts, ends, 1).view(np.int64),
            "d2": span_digests(data, starts, ends, 2).view(np.int64),
            "at": np.arange(len(starts)) - np.searchsorted(doc, doc),
            "start": starts - offsets[doc],
            "bytes": ends - starts,
            "words": begun[ends] - begun[starts],
        }
        ids = rows.column(0).take(pa.array(doc))
        yield pa.RecordBatch.from_arrays([ids, *[pa.array(x) for x in columns.values()]], ["doc_id", *columns])


def repeated_passages(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per passage that an earlier document has too: doc_id, start and length in UTF-8 bytes, words, first_ids (documents that hold
    its chunks first).

    Null and empty texts have no passages. Rows without doc_id are left out. Rows that repeat a doc_id count as one document, whose spans belong to
    any of them; a passage repeated only inside one document is none. Reads only doc_id and text; an empty table gives none.
    A text is held whole by one task, with about 50 bytes of memory for each of its bytes.
    """
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    fields = ["doc_id", "d1", "d2", "at", "start", "bytes", "words"]
    chunks = stages.keep("chunks", docs.mapInArrow(_chunks, ", ".join(f"{x} long" for x in fields)))
    several = chunks.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    several = several.where("first_id < last_id").select("d1", "d2", "first_id")
    repeats = chunks.join(several, ["d1", "d2"]).where("doc_id > first_id")
    repeats = stages.keep("repeats", repeats.select("doc_id", "at", "start", "bytes", "words", "first_id").distinct())
    place = Window.partitionBy("doc_id").orderBy("at", "start")
    fresh = F.coalesce(F.col("at") > F.lag("at").over(place) + 1, F.lit(True))
    marked = repeats.withColumn("run", F.sum(fresh.cast("int")).over(place.rowsBetween(Window.unboundedPreceding, 0)))
    passages = marked.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("bytes")) - F.min("start")).alias("length"),
        F.sum("words").alias("words"),
        F.sort_array(F.collect_set("first_id")).alias("first_ids"),
    )
    return passages.where(F.col("words") >= run_words).drop("run")


def _cut(batches, names: list[str]):
    """Texts without their spans; a character that a span only touches goes with it."""
    for batch in batches:
        texts, spans = batch.column(names.index("text")).to_pylist(), batch.column(len(names)).to_pylist()
        for i, found in enumerate(spans):
            if found and texts[i] is not None:
                raw, at, parts = texts[i].encode(), 0, []
                for start, length in sorted((x["start"], x["length"]) for x in found):
                    parts.append(raw[at : max(at, start)])
                    at = max(at, start + length)
                texts[i] = b"".join([*parts, raw[at:]]).decode(errors="ignore")
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(names)]
        yield pa.RecordBatch.from_arrays(columns, names)


def cut_passages(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """`docs` with every passage cut from the texts except at its first document; all columns stay."""

    def cut(docs: DataFrame) -> DataFrame:
        spans = repeated_passages(docs, run_words).groupBy(F.col("doc_id").alias("__id"))
        spans = spans.agg(F.collect_list(F.struct("start", "length")).alias("__spans"))
        joined = docs.join(spans, F.col("doc_id").cast("long") == F.col("__id"), "left").drop("__id")
        return joined.mapInArrow(partial(_cut, names=docs.columns), docs.schema)

    return with_neutral_names(docs, ("doc_id", "text"), cut)


def repeats_by_document(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document that repeats passages of earlier ones: doc_id, first_ids, passages, repeated_bytes, spans."""
    found = repeated_passages(docs, run_words)
    return found.groupBy("doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_ids")))).alias("first_ids"),
        F.count(F.lit(1)).alias("passages"),
        F.sum("length").alias("repeated_bytes"),
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"),
    )
