"""What the operators share: staged tables, blocks of UTF-8 bytes, word hashes, connected components."""

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.files import shared_root

BLOCK_BYTES = 1 << 20
#: Spark's setting that removes shuffle files when the execution that wrote them ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages:
    """Tables written to the folder all executors share, so that a lost executor costs no more than its tasks.

    The folder is `spark.checkpoint.dir`, or the warehouse where that is unset. `drop` removes a table that no
    later step reads; what a returned DataFrame still reads stays, and goes with the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/llm-stages/{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Writes the table and reads it back. Shuffle files of the write go with its end, since only the table is read later."""
        path, before = f"{self.root}/{name}", self.spark.conf.get(RELEASE, None)
        self.spark.conf.set(RELEASE, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(RELEASE)
            else:
                self.spark.conf.set(RELEASE, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def checked(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """`rows` marked for broadcast when they were counted and are at most `most`; otherwise as they are, to be joined by a shuffle.

    Meant for rows of a few numbers. The count stops at `most` + 1.
    """
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def with_neutral_names(docs: DataFrame, used: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of `docs`, which must have the same columns. It sees the columns in `used` under their own names and
    all others under names that nothing else has, so columns of any name can be carried through."""
    neutral = [name if name.lower() in used else f"carried column {i}" for i, name in enumerate(docs.columns)]
    return work(docs.toDF(*neutral)).toDF(*docs.columns)


def give_back_memory() -> None:
    """Returns freed memory of a worker to the system, as workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings in a row, and where each begins and ends; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(buffers[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[ends[0] : ends[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most `limit` bytes of text, or one longer row: (rows, bytes, offsets)."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        begin, rows = 0, len(offsets) - 1
        while begin < rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), rows, begin + 10_000)
            part = offsets[begin : end + 1]
            yield batch.slice(begin, end - begin), data[part[0] : part[-1]], part - part[0]
            begin = end
    give_back_memory()


# Bytes that end a word, by contract: tab to carriage return, and space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that don't cross documents: starts, ends, and the document of each."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(salt: int, count: int) -> np.ndarray:
    """`count` fixed odd 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_BYTE = salted(11, 256)
_STEP = 0x5851F42D4C957F2D
_UNDO = pow(_STEP, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(max(count, 1), base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)[:count]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end], by differences of one running polynomial.

    Texts of certain forms collide under it whatever its base, so it names features only; identities are `span_digests`.
    """
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, len(data)), out=total[1:])
    value = (total[ends] - total[starts]) * _powers(_UNDO, len(data) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Eight bytes are read at once up to this length; longer spans end in one call of a library for each.
_STEPS = 64


def span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit digest of each data[start:end]: eight bytes at a time are mixed in by a bijection, so equal lengths up to eight bytes never
    collide, and longer spans do so by chance alone. Different seeds give independent digests."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    left = (ends - starts).astype(np.int64)
    value = mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salted(1009 + seed, 1)[0])
    live = np.flatnonzero(left > 0)
    at, left = starts[live], left[live]
    for _ in range(_STEPS):
        if not len(live):
            return value
        piece, brief = eight[at], left < 8
        piece[brief] &= (np.uint64(1) << (left[brief] * 8).astype(np.uint64)) - np.uint64(1)
        value[live] = mix(value[live] ^ piece)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    rest = [xxhash.xxh3_64_intdigest(data[a : a + n].tobytes(), seed) for a, n in zip(at, left, strict=True)]
    value[live] = mix(value[live] ^ np.array(rest, np.uint64))
    return value


def span_heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length and first eight bytes of each data[start:end] in one number, to be compared beside a digest."""
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    left = (ends - starts).astype(np.uint64)
    unused = np.uint64(8) * (np.uint64(8) - np.minimum(np.maximum(left, np.uint64(1)), np.uint64(8)))
    return (eight[starts] << unused) + left * np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each document: (document numbers, hashes), sorted by both.

    A-Z is lower-cased. A document with fewer words than `words` has its whole sequence as one shingle.
    """
    data = LOWER[data]
    starts, ends, doc = runs(~SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word, rows = span_digests(data, starts, ends), len(offsets) - 1
    count = np.bincount(doc, minlength=rows)
    first = np.cumsum(count) - count
    times = salted(23, words)
    full = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1 :]) if len(doc) >= words else np.zeros(0, np.int64)
    value = np.zeros(len(full), np.uint64)
    for k in range(words):
        value += word[full + k] * times[k]
    short = np.flatnonzero((count > 0) & (count < words))
    brief = np.full(len(short), 0x1234567, np.uint64) + count[short].astype(np.uint64)
    for k in range(words - 1):
        there = count[short] > k
        brief[there] += word[first[short[there]] + k] * times[k]
    doc, value = np.concatenate([doc[full], short]), mix(np.concatenate([value, brief]))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Array column from consecutive values, `counts[i]` of them in row i."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def components(stages: Stages, edges: DataFrame, name: str) -> DataFrame:
    """(node, comp) for every node of `edges` (a, b), comp being the least node it reaches.

    Each round takes the least label among neighbours, then the label of that label, so chains shrink about
    exponentially. A round is written before the next reads it. Labels are folded map-side; the joins are plain
    equi-joins, which adaptive execution splits at a hot node.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    labels = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("comp"))
    labels, number = stages.keep(f"{name}-0", labels), 0
    while True:
        heard = both.join(labels.select(F.col("node").alias("u"), F.col("comp")), "u").groupBy(F.col("v").alias("node"))
        near = heard.agg(F.min("comp").alias("heard"))
        near = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "heard").alias("comp"))
        step = near.join(labels.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp")
        step = step.select("node", F.least("comp", "next").alias("comp"), (F.least("comp", "next") < F.col("old")).alias("moved"))
        step = stages.keep(f"{name}-{number + 1}", step)
        if not step.where("moved").head(1):
            stages.drop(f"{name}-{number + 1}")
            return labels
        stages.drop(f"{name}-{number}")
        labels, number = step.select("node", "comp"), number + 1
