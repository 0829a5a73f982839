"""CSV records with line breaks inside quotes, read by as many tasks as a file has splits.

Whether a line begins a record depends on the quotes of all lines before it, but only through one bit: is a quoted field open? Every line, and
every split, is a function from that bit at its start to that bit at its end. Functions of one bit are "always open", "always closed",
"flipped" and "as before", so the bit before any place is that of the last constant function before it, flipped as often as flips followed.

1. Lines are stored with the split they come from and the two values of their function.
2. A split's function is put together from its lines, the bit before each split from the splits before it in its file.
3. In splits that begin outside quotes and have no line that leaves a field open, which is nearly all of them, each line is a record.
   In the others records are counted by a prefix sum of the bit and their lines joined; the pieces of a record that
   crosses splits, at most two rows a split, are joined last.

Line breaks are `\\n` or `\\r\\n`. A quote opens a field only at the field's start, so a stray quote inside a text field changes nothing. Where a quote is
never closed, the rest of the file is one record, for any reader of such files.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# States of a line read from left to right, at its quotes.
_START, _PLAIN, _QUOTED, _CLOSED = 0, 1, 2, 3


def _open_at_end(line: Column, begin: int) -> Column:
    """Whether a quoted field is open at the end of a line that begins in this state."""
    before_quotes = F.split(line, '"', -1)
    before_quotes = F.slice(before_quotes, 1, F.size(before_quotes) - 1)

    def step(state: Column, text: Column) -> Column:
        at_start = F.endswith(text, F.lit(",")) | ((text == "") & state.isin(_START, _CLOSED))  # a closed field and a quote: a doubled one
        return F.when(state == _QUOTED, F.lit(_CLOSED)).when(at_start, F.lit(_QUOTED)).otherwise(F.lit(_PLAIN))

    return F.aggregate(before_quotes, F.lit(begin), step) == _QUOTED


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, line, from_closed, from_open): lines in the order of `at` within a split, splits in the order of their start."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quoted = F.contains("value", F.lit('"'))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        F.when(quoted, _open_at_end(F.col("value"), _START)).otherwise(F.lit(False)).alias("from_closed"),
        F.when(quoted, _open_at_end(F.col("value"), _QUOTED)).otherwise(F.lit(True)).alias("from_open"),
    )


def _bit_before(within: str, order: str, constant: str, value: str, flips: str, first: str) -> str:
    """SQL for the bit before a row: that of the last constant before it, or `first`, flipped by the flips since then.

    `flips` is 0 for constant rows. The running sum of flips at that constant is the sum up to it, as it adds none.
    """
    past = f"OVER (PARTITION BY {within} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    so_far = f"coalesce(sum({flips}) {past}, 0)"
    at_last = f"coalesce(last(IF({constant}, flips_upto, NULL)) IGNORE NULLS {past}, 0)"
    return f"(coalesce(last(IF({constant}, {value}, NULL)) IGNORE NULLS {past}, {first}) != (({so_far} - {at_last}) % 2 = 1))"


def _upto(within: str, order: str, flips: str) -> str:
    return f"sum({flips}) OVER (PARTITION BY {within} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


_CONSTANT, _FLIP = "from_closed = from_open", "(from_closed AND NOT from_open)"


def split_states(lines: DataFrame) -> DataFrame:
    """One row for each split: whether it begins inside quotes (`inside`), whether each of its lines is a record (`plain`)."""
    facts = lines.groupBy("file", "split").agg(
        F.expr(f"max(at) FILTER (WHERE {_CONSTANT})").alias("last_at"),
        F.expr(f"max_by(from_closed, at) FILTER (WHERE {_CONSTANT})").alias("last"),
        F.expr("count_if(from_closed)").alias("left_open"),
        F.expr("min(at) FILTER (WHERE line NOT IN ('', '\r'))").alias("first_at"),
    )
    later = lines.where(_FLIP).join(facts.select("file", "split", "last_at"), ["file", "split"])
    later = later.where("last_at IS NULL OR at > last_at").groupBy("file", "split").agg(F.count(F.lit(1)).alias("flips"))
    facts = facts.join(later, ["file", "split"], "left").withColumn("flips", F.coalesce("flips", F.lit(0)))
    # The function of a split: constant (last, flipped as often as flips follow), else as many flips as it has.
    facts = facts.selectExpr("*", "last IS NOT NULL AS constant", "last != (flips % 2 = 1) AS value", "IF(last IS NULL, flips, 0) AS free_flips")
    facts = facts.withColumn("flips_upto", F.expr(_upto("file", "split", "free_flips")))
    facts = facts.withColumn("inside", F.expr(_bit_before("file", "split", "constant", "value", "free_flips", "false")))
    header = F.expr("first_value(first_at) IGNORE NULLS OVER (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
    return facts.withColumn("header_at", header).selectExpr("file", "split", "inside", "NOT inside AND left_open = 0 AS plain", "header_at")


def records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(record): the records of all files without their headers, from stored lines and their stored splits.

    The first record of a file that is not empty is its header; empty records are left out.
    """
    lines = lines.join(splits, ["file", "split"])
    single = lines.where("plain").select("at", "header_at", F.col("line").alias("record"))

    place = "file, split"
    broken = lines.where("NOT plain").withColumn("flip", F.expr(f"int({_FLIP})")).withColumn("flips_upto", F.expr(_upto(place, "at", "flip")))
    broken = broken.withColumn("begins", ~F.expr(_bit_before(place, "at", _CONSTANT, "from_closed", "flip", "inside")))
    broken = broken.withColumn("number", F.expr(_upto(place, "at", "int(begins)")))
    piece = F.array_sort(F.collect_list(F.struct("at", "line")))
    pieces = broken.groupBy("file", "split", "number", "header_at").agg(F.min("at").alias("at"), F.array_join(piece["line"], "\n").alias("record"))
    # Only the last record of a split may go on, as number 0 of the next ones.
    ends = pieces.groupBy("file", "split").agg(F.max("number").alias("most"))
    owner = F.expr("last(IF(most > 0, split, NULL)) IGNORE NULLS OVER (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    ends = ends.withColumn("owner", owner)
    pieces = pieces.join(ends, ["file", "split"])
    inner = pieces.where("number > 0 AND number < most").select("at", "header_at", "record")
    border = pieces.where("number = 0 OR number = most").withColumn("home", F.expr("IF(number = 0, owner, split)"))
    part = F.array_sort(F.collect_list(F.struct("split", "at", "record")))
    joined = border.groupBy("file", "home", "header_at").agg(part.alias("parts"))
    joined = joined.select(F.col("parts")[0]["at"].alias("at"), "header_at", F.array_join(F.col("parts.record"), "\n").alias("record"))

    found = single.unionByName(inner).unionByName(joined).where("header_at IS NULL OR at != header_at")
    return found.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record != ''")
