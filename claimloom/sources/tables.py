"""Claims view of an order-processing database: one claim per order line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.columns import zero_padded
from claimloom.schema import struct

# Declared schemas of the columns used, so that no file is opened for inference.
TABLES = {
    "lineitem": struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "orders": struct("o_orderkey bigint, o_custkey bigint"),
    "customer": struct("c_custkey bigint, c_nationkey int"),
    "nation": struct("n_nationkey int, n_name string"),
    "part": struct("p_partkey bigint, p_name string, p_brand string, p_size int"),
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}.parquet")


def claims_from_tables(spark: SparkSession, root: str) -> DataFrame:
    """Raw claims from the lineitem, orders, customer, nation and part tables under `root`.

    Orders meet their customer before the lines do, so customer keys are shuffled with orders and not with the
    larger line table. Lines and orders are both large at every scale and merge-join on the order key, where
    adaptive execution splits a hot key; the other sides are broadcast only while Spark's size check allows it.
    Times become dates below the shuffles; texts of nations come above them.
    """

    lineitem, orders, customer, nation, part = (read_table(spark, root, name) for name in TABLES)
    days = lineitem.withColumn("l_shipdate", F.expr("date(l_shipdate)"))
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        days.join(buyers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return lines.selectExpr(
        f"concat('CLM', {zero_padded('l_orderkey', 8)}, '-', string(l_linenumber)) AS claim_id",
        f"concat('MBR', {zero_padded('o_custkey', 6)}) AS member_id",
        f"{zero_padded('l_partkey', 11)} AS ndc_code",
        "p_name AS drug_name",
        "concat(' ', lower(p_brand), ' ') AS drug_class",
        "string(l_suppkey + 1000000000) AS npi_number",
        "string(l_shipdate) AS service_date",
        "double(CAST(l_extendedprice - 5000 AS decimal(12, 2))) AS claim_amount",
        "l_quantity - 1 AS quantity",
        "p_size * 8 AS days_supply",
        f"concat('PLAN_', {zero_padded('c_nationkey + 1', 3)}) AS plan_id",
        "n_name AS member_state",
        "CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'ADJUDICATED' WHEN 'R' THEN 'REVERSED' END "
        "AS claim_status",
    )
