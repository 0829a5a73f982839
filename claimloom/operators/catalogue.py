"""The published star schema as catalogue tables with statistics, so that SQL joins are chosen by what the tables hold."""

from pyspark.sql import SparkSession

from claimloom.operators.load import table_folders
from claimloom.schema import STAR

# Columns that are joined on or filtered by. Statistics of the dimensions cover all their columns.
FACT_STATISTICS = ("drug_key", "provider_key", "service_date", "claim_status", "plan_id")


def register_tables(spark: SparkSession, root: str, database: str) -> dict[str, str]:
    """Enter the version published under `root` as tables of `database`, and return their names.

    The tables are external: entering a later version or dropping them leaves the files alone. Row counts, sizes and, for each column listed,
    distinct values, extremes and nulls are computed in one pass a table; Spark's cost-based rules
    (`spark.sql.cbo.enabled`) estimate filters and joins from them, which file sizes alone cannot tell.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{_literal(root)}/catalogue'")
    names = {}
    for table, folder in table_folders(spark, root).items():
        names[table] = name = f"{_quoted(database)}.{table}"
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in STAR[table])
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{_literal(folder)}'")
        known = FACT_STATISTICS if table == "fact_claims" else STAR[table].names
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(known)}")
    return names


def drop_tables(spark: SparkSession, database: str) -> None:
    """Take the tables out of the catalogue; their files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database)} CASCADE")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
