"""Sharding along a Hilbert curve, with DataFrame functions only.

Source, language and size are quantised in a few bits each and give a cell of a three-dimensional Hilbert curve. Rows are ordered by cell, then by
a hash of doc_id, and the order is cut in runs, so a shard's files span narrow ranges of all three dimensions. The global order needs no
global sort: rows are counted by (cell, top bits of the hash), these counts are summed in order, and rows are ranked inside their bucket. Where a
bucket holds too many rows, they are counted once more by further bits of the hash.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import Stages, checked

BITS = 4
#: Top bits of the hash that split every cell.
SPLIT_BITS = 5
#: Rows that are ranked together, about. A part of a cell that holds more is split by as many further bits as it needs.
MOST_RANKED = 1 << 20


def _axis(frame: DataFrame, name: str) -> Column:
    """Order-preserving quantile-free code of a string column: the three bytes after the prefix all values share, put on a linear scale
    between the least and the largest value. Null is 0."""
    low, high = frame.select(F.min(name), F.max(name)).head()
    shared = 0
    while low and high and shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1

    def number(c: Column) -> Column:
        return F.conv(F.rpad(F.substring(F.hex(F.encode(F.substring(c, shared + 1, 3), "UTF-8")), 1, 6), 6, "0"), 16, 10).cast("double")

    least, most = number(F.lit(low or "")), number(F.lit(high or ""))
    scaled = F.floor((number(F.col(name)) - least) / F.greatest(most - least, F.lit(1.0)) * (1 << BITS)).cast("long")
    return F.coalesce(F.least(F.greatest(scaled, F.lit(0)), F.lit((1 << BITS) - 1)), F.lit(0)).cast("long")


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a point given by its coordinates of `bits` bits, as a long.

    Bits are inverted and exchanged from the top down, then Gray-decoded and interleaved; every step is one array expression.
    """
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, step: Column) -> Column:
        low = step["q"] - 1
        mine = F.element_at(x, step["i"] + 1)
        swap = F.element_at(x, 1).bitwiseXOR(mine).bitwiseAND(low)
        inverted = mine.bitwiseAND(step["q"]) != 0

        def one(v: Column, j: Column) -> Column:
            first, other = j == 0, (j == step["i"]) & (j != 0)
            change = F.when(inverted, F.when(first, low)).when((step["i"] != 0) & (first | other), swap)
            return v.bitwiseXOR(F.coalesce(change, F.lit(0).cast("long")))

        return F.transform(x, one)

    turned = F.aggregate(steps, F.array(*[a.cast("long") for a in axes]), turn)
    gray = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.aggregate(F.slice(turned, 1, k), F.lit(0).cast("long"), lambda s, v: s.bitwiseXOR(v)))
    last = F.element_at(gray, n)
    fix = F.aggregate(
        F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]),
        F.lit(0).cast("long"),
        lambda t, q: t.bitwiseXOR(F.when(last.bitwiseAND(q) != 0, q - 1).otherwise(F.lit(0)).cast("long")),
    )
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            bit = F.shiftright(F.element_at(gray, i + 1).bitwiseXOR(fix), b).bitwiseAND(F.lit(1).cast("long"))
            index = F.shiftleft(index, 1).bitwiseOR(bit)
    return index


def hilbert_shards(docs: DataFrame, shards: int = 8, most_ranked: int = MOST_RANKED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, cell.

    Law `rows`: shard counts differ by one at most. size is the UTF-8 bytes of the text (null: none) plus 1. Missing source, language or text
    count as least. Rows that repeat a doc_id are placed each; a doc_id may be null. Rows that agree in everything take their
    slots in any order. `most_ranked` bounds, about, the rows that one task ranks, and has no effect on the result. Reads doc_id, text, lang and source only; an empty table gives an empty result.
    """
    stages = Stages(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
    )
    rows = stages.keep("rows", rows)
    wide = F.least(F.floor(F.log2(F.col("size")) * (1 << BITS) / 24).cast("long"), F.lit((1 << BITS) - 1).cast("long"))
    mixed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = rows.select(
        "doc_id", "size", "text_crc32", _axis(rows, "source").alias("x"), _axis(rows, "lang").alias("y"), wide.alias("z"), mixed.alias("mixed")
    ).withColumn("part", F.shiftright("mixed", 32 - SPLIT_BITS))

    # At most 2 ** (3 * BITS + SPLIT_BITS) buckets, and one more for each half of `most_ranked` rows.
    point = ["x", "y", "z", "part"]
    counted = stages.keep("counted", rows.groupBy(*point).agg(F.count(F.lit(1)).alias("n")))
    more = F.least(F.ceil(F.log2(F.col("n") / most_ranked)), F.lit(32 - SPLIT_BITS)).cast("int")
    hot = counted.where(F.col("n") > most_ranked).select(*point, more.alias("more"))
    if hot.head(1):
        rows = rows.join(checked(hot), point, "left").withColumn("more", F.coalesce("more", F.lit(0)))
        # The order of parts is that of the hash, however many bits of it they show.
        rows = rows.withColumn("inner", F.expr(f"shiftright(mixed, {32 - SPLIT_BITS} - more) % shiftleft(1L, more)")).drop("more")
        point.append("inner")
        counted = stages.keep("counted-again", rows.groupBy(*point).agg(F.count(F.lit(1)).alias("n")))
    cells = counted.select("x", "y", "z").distinct().withColumn("cell", hilbert_index([F.col(c) for c in "xyz"], BITS))
    counted = counted.join(F.broadcast(cells), ["x", "y", "z"])
    order = Window.orderBy("cell", *point[3:]).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    buckets = stages.keep("buckets", counted.select(*point, "cell", "before"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]

    placed = rows.join(checked(buckets), point)
    inside = Window.partitionBy("cell", *point[3:]).orderBy("mixed", "doc_id", "text_crc32", "size")
    placed = placed.withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )
