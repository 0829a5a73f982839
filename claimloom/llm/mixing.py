"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

A source's target is first met by complete epochs of all its documents; the remainder is a weighted sample without replacement: documents get
exponential keys divided by their quality weight, and the smallest keys whose sizes sum up to the remainder are taken. Keys
are not sorted as a whole: rows are summed by source and key bucket, the buckets' sums are added up in order, and only the bucket in which the
remainder ends is sorted. One more document, the one that comes nearest, closes the gap.
"""

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import Stages, with_neutral_names

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
#: Key buckets of each source. Exponential keys are put on a scale from 0 to 1, so buckets hold like numbers of rows.
BUCKETS = 1024
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1: the share of letters and spaces, with less for texts of less than 200 characters."""
    length = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", "")) / length
    return F.when(length > 0, 0.25 + 0.75 * plain * F.least(length / 200.0, F.lit(1.0))).otherwise(0.25)


def targets(sources: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The share is dealt by weight; a source that would get more than `most` times its size is held there, the rest is dealt anew, until none is
    above. Sources fill up in the order of most * size / weight, so one running sum finds those that are held.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    dealt = sources.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    dealt = dealt.withColumn("fill", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fill", F.col("source").isNull(), "source")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = dealt.withColumns(
        {
            "share": F.sum("source_size").over(whole) * percent / 100.0,
            "held": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
            "place": F.row_number().over(order),
        }
    )
    # The first source, in this order, whose part of what is left is below its cap sets the level for itself and all after it.
    part = (F.col("share") - F.col("held")) / F.col("left")
    dealt = dealt.withColumn("part", F.when(part < F.col("fill"), F.struct("place", part.alias("level"))))
    dealt = dealt.withColumn("level", F.min("part").over(whole)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return dealt.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_EPOCHS, seed: str = "mix-1") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source.

    A document is taken `taken / size` times: the complete epochs, and once more if it is sampled. Documents of size 0 take nothing. A null
    source is a source of its own, after the others. Keys depend on doc_id, the text's hash and the seed alone, so reruns agree; rows
    that agree in both are told apart only when they are ranked. An empty table gives an empty result.
    """
    stages = Stages(docs.sparkSession)
    text = F.col("text").cast("string")
    code = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.crc32(text.cast("binary")).cast("string")).cast("binary")), 1, 13), 16, 10)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words(text).alias("size"),
        F.greatest(F.coalesce(quality_weight(text), F.lit(0.25)), F.lit(0.25)).alias("weight"),
        ((code.cast("double") + 0.5) / float(1 << 52)).alias("u"),
    )
    rows = rows.select("doc_id", "source", "size", (-F.log("u") / F.col("weight")).alias("key"))
    rows = rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS).cast("int"), F.lit(BUCKETS - 1)))
    rows = stages.keep("rows", rows.withColumn("row", F.monotonically_increasing_id()))

    sums = stages.keep("sums", rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")))
    dealt = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, percent, most)
    dealt = dealt.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    dealt = stages.keep("targets", dealt.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    ordered = Window.partitionBy("source").orderBy("bucket")
    placed = sums.withColumn("before", F.sum("bucket_size").over(ordered) - F.col("bucket_size"))
    placed = placed.join(dealt.withColumnRenamed("source", "source_t"), F.col("source").eqNullSafe(F.col("source_t"))).drop("source_t")
    placed = stages.keep("placed", placed.withColumn("ends", (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("bucket_size") > F.col("rest"))))

    def with_bucket(frame: DataFrame) -> DataFrame:
        place = placed.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "ends", "source_size", "target", "epochs", "rest")
        return frame.join(place, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")

    rows = with_bucket(rows)
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    edge = stages.keep("edge", rows.where("ends").withColumn("upto", F.col("before") + F.sum("size").over(inside)))
    names = ["doc_id", "size", "source_size", "target", "epochs", "source", "rest", "key", "row"]
    drawn = rows.where("NOT ends").select(*names, (F.col("before") < F.col("rest")).alias("sampled"))
    drawn = drawn.union(edge.select(*names, (F.col("upto") <= F.col("rest")).alias("sampled")))
    # The document whose size is nearest to what is still missing, if it brings the source nearer.
    gap = edge.groupBy("source").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto")).otherwise(F.col("before"))).alias("reached"))
    gap = gap.withColumnRenamed("source", "s")
    missing = F.col("rest") - F.col("reached")
    near = drawn.where("NOT sampled").join(gap, F.col("source").eqNullSafe(F.col("s"))).where(F.abs(F.col("size") - missing) < missing)
    near = near.groupBy(F.col("source").alias("s")).agg(F.min(F.struct(F.abs(F.col("size") - missing).alias("off"), "key", "row"))["row"].alias("last"))
    out = drawn.join(near, F.col("source").eqNullSafe(F.col("s")), "left")
    out = out.withColumn("once", F.col("sampled") | F.coalesce(F.col("row") == F.col("last"), F.lit(False)))
    taken = F.least(F.col("epochs") + F.col("once").cast("long"), F.lit(most)) * F.col("size")
    return out.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """`docs` as the mix has them: a document taken twice is two rows, one not taken is none. Documents without words go."""
    return with_neutral_names(docs, ("doc_id", "source", "text"), partial(_mixed, **options))


def _mixed(docs: DataFrame, **options) -> DataFrame:
    stages = Stages(docs.sparkSession)
    taken = mix_sources(docs, **options).where("taken > 0")
    # Rows that repeat a doc_id: their draws are shared out by size, so each row joins one draw of its own size.
    number = F.row_number().over(Window.partitionBy("__id", "__size").orderBy("__more"))
    draws = taken.select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"), (F.col("taken") / F.col("size")).cast("int").alias("__more"))
    draws = stages.keep("draws", draws.withColumn("__number", number))
    again = draws.where("__number > 1").select("__id", "__size").distinct()
    single = draws.where("__number = 1").drop("__number")
    sized = docs.withColumn("__size", words(F.col("text").cast("string")))
    key = lambda right: F.col("doc_id").cast("long").eqNullSafe(right["__id"]) & (sized["__size"] == right["__size"])
    if again.head(1):
        mine = Window.partitionBy("doc_id", "__size").orderBy(F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
        several = sized.join(again, key(again), "left_semi").withColumn("__number", F.row_number().over(mine))
        several = several.join(draws.withColumnsRenamed({"__id": "__i", "__size": "__s", "__number": "__n"}), F.expr("doc_id <=> __i AND __size = __s AND __number = __n")).drop("__number", "__i", "__s", "__n")
        once = sized.join(again, key(again), "left_anti").join(single.withColumnsRenamed({"__id": "__i", "__size": "__s"}), F.expr("doc_id <=> __i AND __size = __s")).drop("__i", "__s")
        chosen = once.unionByName(several)
    else:
        chosen = sized.join(single.withColumnsRenamed({"__id": "__i", "__size": "__s"}), F.expr("doc_id <=> __i AND __size = __s")).drop("__i", "__s")
    return chosen.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__more")))).select(*docs.columns)
