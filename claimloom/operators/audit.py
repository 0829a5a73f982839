"""Row counts of a run."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def row_count(stage: DataFrame) -> DataFrame:
    """One row with the number of rows `n`; stored Parquet is counted from its file footers."""
    return stage.agg(F.count(F.lit(1)).alias("n"))


def audit_of(spark: SparkSession, counts: dict[str, int], run_date: date) -> DataFrame:
    """The row of `audit_counts` from numbers that are known."""
    row = [F.lit(n).cast("bigint").alias(f"{stage}_rows") for stage, n in counts.items()]
    return spark.range(1).select(*row, F.lit(run_date).alias("run_date"))


def audit_counts(counts: dict[str, DataFrame], run_date: date) -> DataFrame:
    """One row: `<stage>_rows` for every stage in order, then run_date. Each stage is a one-row frame with `n`."""
    parts = [count.select(F.lit(stage).alias("stage"), "n") for stage, count in counts.items()]
    rows = reduce(DataFrame.unionByName, parts)
    columns = [F.max(F.when(F.col("stage") == stage, F.col("n"))).alias(f"{stage}_rows") for stage in counts]
    return rows.agg(*columns).withColumn("run_date", F.lit(run_date))
