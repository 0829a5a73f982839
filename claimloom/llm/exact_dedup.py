"""Exact dedup by content-defined chunk recipes.

A text is normalised (each run of ASCII white space becomes one space) and cut into content-defined chunks inside the task that
reads it. What is shuffled are chunk digests, never texts: equal digests are verified by byte length and SHA-256 and get one
identifier, a document becomes the ordered list of its identifiers (its recipe), and equal recipes are equal texts.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.chunking import chunk_cuts
from claimloom.llm.common import SPACE, Stages, blocks, checked, with_neutral_names

LEAST, BITS, MOST = 512, 10, 8192
_CHUNK = pa.struct([("digest", pa.binary()), ("check", pa.binary()), ("bytes", pa.int64())])


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with each run of white space inside a document as one space."""
    space = SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = space[:-1]
    stays = ~space | ~before | first[:-1]
    moved = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stays, out=moved[1:])
    return np.where(space, np.uint8(32), data)[stays], moved[offsets]


def _recipes(batches):
    for rows, data, offsets in blocks(batches):
        data, offsets = normalised(data, offsets)
        starts, ends, doc = chunk_cuts(data, offsets, LEAST, BITS, MOST)
        raw = data.tobytes()
        chunks = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        flat = pa.StructArray.from_arrays(
            [
                pa.array([xxhash.xxh3_128_digest(x) for x in chunks], pa.binary()),
                pa.array([hashlib.sha256(x).digest() for x in chunks], pa.binary()),
                pa.array(ends - starts),
            ],
            fields=list(_CHUNK),
        )
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        whole = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(whole), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)], ["doc_id", "text_sha256", "chunks"]
        )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Null texts count as empty, and all empty texts are equal. Of equal texts the row with the smallest doc_id stays, doc_ids before
    null, and of rows that repeat this doc_id exactly one. keep_id is null when no row of the group has a doc_id. Reads only doc_id
    and text. An empty table gives an empty result.
    """
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, text_sha256 string, chunks array<struct<digest binary, check binary, bytes long>>"
    rows = docs.mapInArrow(_recipes, kind).withColumn("row", F.monotonically_increasing_id())
    rows = stages.keep("rows", rows)

    placed = rows.select("row", F.posexplode("chunks").alias("at", "chunk")).select("row", "at", "chunk.*")
    identity = ["digest", "check", "bytes"]
    known = placed.groupBy(*identity).agg(F.count(F.lit(1)).alias("uses")).withColumn("chunk_id", F.monotonically_increasing_id())
    known = stages.keep("known", known)
    listed = placed.join(known.drop("uses"), identity).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "chunk_id"))).alias("list"))
    recipes = rows.select("row", "doc_id", "text_sha256", F.size("chunks").alias("n_chunks")).join(
        listed.select("row", F.col("list.chunk_id").alias("recipe")), "row", "left"
    )
    recipes = stages.keep("recipes", recipes.withColumn("recipe", F.coalesce("recipe", F.array().cast("array<long>"))))
    stages.drop("rows", "known")

    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("least")
    groups = recipes.groupBy("recipe").agg(least, F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join deals both sides itself and a hot recipe can be split.
    out = recipes.join(stages.keep("groups", groups), "recipe")
    kept = F.col("row") == F.col("least.row")
    return out.select("doc_id", F.col("least.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "n_chunks")


def normalised_sha256(text: Column) -> Column:
    """The text_sha256 of a row, as an expression."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all columns; columns of any name are left alone.

    A row stays when its (doc_id, text) was chosen. Where rows repeat that pair, one of them stays.
    """
    return with_neutral_names(docs, ("doc_id", "text"), _without_copies)


def _without_copies(docs: DataFrame) -> DataFrame:
    stages = Stages(docs.sparkSession)
    found = stages.keep("found", exact_dedup(docs).select("doc_id", "keep_id", "text_sha256", "kept"))
    if not found.groupBy("doc_id").count().where("count > 1").head(1):
        gone = stages.keep("gone", found.where("NOT kept").select(F.col("doc_id").alias("__gone")))
        return docs.join(checked(gone), F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    key = F.struct(F.col("doc_id").cast("long").alias("id"), normalised_sha256(F.col("text").cast("string")).alias("sha"))
    mine = F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    same = found.where("doc_id <=> keep_id").groupBy(mine.alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    gone = found.where("NOT (doc_id <=> keep_id)").select(mine.alias("__key")).distinct()
    docs = docs.withColumn("__key", key).join(gone, "__key", "left_anti")
    # One of several rows with the same doc_id and text.
    again = same.where("__rows > 1").select("__key")
    if not again.head(1):
        return docs.drop("__key")
    return docs.join(again, "__key", "left_anti").unionByName(docs.join(again, "__key", "left_semi").dropDuplicates(["__key"])).drop("__key")
