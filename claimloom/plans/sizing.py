"""Shuffle width for the amount of input at hand, and input of a task that sorts what it reads."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Input bytes aimed at per shuffle partition.
PARTITION_BYTES = 256 * MIB

# Stored or shuffled bytes that one task takes; as rows in a sort they are up to ten times as many.
TASK_BYTES = 32 * MIB

ADAPTIVE = "spark.sql.adaptive.enabled"
INITIAL_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FIXED_WIDTH = "spark.sql.shuffle.partitions"
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
# Whether the shuffle files of a query go when it ends; else they stay until the driver's garbage collector finds its plan.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bytes_of(size: str) -> int:
    """A number of bytes as Spark's settings have it: 134217728b, 128m, ..."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shuffle_width(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    return -(-input_bytes // partition_bytes)


@contextmanager
def fitted(spark: SparkSession, input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> Iterator[None]:
    """Shuffles wide enough for an input, while the block runs; the session's settings are as before afterwards.

    Under adaptive execution only the starting width is set, and partitions that turn out small are merged. A wider
    shuffle chosen by the user is left alone.
    """
    name = INITIAL_WIDTH if spark.conf.get(ADAPTIVE) == "true" else FIXED_WIDTH
    before = spark.conf.get(name, None) if name in spark.conf.getAll else None
    width = int(before or spark.conf.get(FIXED_WIDTH))
    wanted = shuffle_width(input_bytes, partition_bytes)
    if wanted <= width:
        yield
        return
    spark.conf.set(name, str(wanted))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def small_tasks(spark: SparkSession, most: int = TASK_BYTES) -> Iterator[None]:
    """Tasks read at most `most` bytes of files or of a merged shuffle, while the block runs; smaller sizes of the user are left alone.

    Claims are sorted where they are read (copies are cut down before the shuffle) and where they meet: what one task reads bounds
    the memory of its sort. The session's settings are as before afterwards.
    """
    with _set(spark, {name: str(most) for name in TASK_SIZES if bytes_of(spark.conf.get(name)) > most}):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A query that ends in the block drops its shuffle files, so that what it stored takes their place on disk and does not add to them.

    For queries that store their result: one that is read again by the same plan would shuffle anew. The session's settings are as before afterwards.
    """
    with _set(spark, {DROP_SHUFFLES: "true"}):
        yield


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session while the block runs."""
    given = spark.conf.getAll
    before = {name: given.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
