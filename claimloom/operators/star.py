"""Star schema: three dimensions and one fact table, all built from cleaned claims."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.columns import hashed, keep_first
from claimloom.schema import FACT_CLAIMS


def dim_drug(cleaned: DataFrame) -> DataFrame:
    """One row per ndc_code, described by its smallest claim_id."""
    columns = ["drug_name", "drug_class"]
    drugs = keep_first(cleaned.select("ndc_code", *columns, "claim_id"), ["ndc_code"], ["claim_id", *columns])
    return drugs.select("ndc_code", *columns, hashed("ndc_code").alias("drug_key"))


def dim_provider(cleaned: DataFrame) -> DataFrame:
    """One row per npi_number; the state is that of its smallest claim_id."""
    columns = ["member_state"]
    providers = keep_first(cleaned.select("npi_number", *columns, "claim_id"), ["npi_number"], ["claim_id", *columns])
    return providers.select("npi_number", *columns, hashed("npi_number").alias("provider_key"))


def dim_date(cleaned: DataFrame) -> DataFrame:
    """One row per service date, calendar parts computed after the distinct."""
    day = F.col("date_value")
    return cleaned.select(F.col("service_date").alias("date_value")).distinct().select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def fact_claims(cleaned: DataFrame) -> DataFrame:
    """One row per cleaned claim. Keys are computed in place, so no dimension is joined and nothing shuffles."""
    keyed = cleaned.withColumns(
        {
            "claim_key": hashed("claim_id"),
            "member_key": F.col("member_id"),
            "drug_key": hashed("ndc_code"),
            "provider_key": hashed("npi_number"),
        }
    )
    return keyed.select(*FACT_CLAIMS.names)


def build_star(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The four tables in load order. Pass a stored `cleaned` to compute it only once."""
    return {
        "dim_drug": dim_drug(cleaned),
        "dim_provider": dim_provider(cleaned),
        "dim_date": dim_date(cleaned),
        "fact_claims": fact_claims(cleaned),
    }
