"""The standard questions on the star schema.

Every join question first reduces the fact to one row per dimension key and joins that to the dimension. The
dimensions are unique on their key, so the answer is the same, while the join never sees the fact rows: a drug,
provider or day that holds a third of all claims is folded by map-side aggregation.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.columns import exact, mean_money, money, packed_digest, unpacked_digest

Star = dict[str, DataFrame]

def _rows() -> Column:
    return F.count(F.lit(1))


def _per_key(star: Star, key: str) -> DataFrame:
    """The fact folded to one row per key: claims `n` and exact `amount`. Digests are shuffled as bytes."""
    digest = key.endswith("_key")
    folded = star["fact_claims"].groupBy(packed_digest(key).alias(key) if digest else key).agg(_rows().alias("n"), F.sum(exact("claim_amount")).alias("amount"))
    return folded.withColumn(key, unpacked_digest(key)) if digest else folded


def _claims() -> Column:
    return F.sum("n")


def _amount() -> Column:
    return money(F.sum("amount"))


def _mean() -> Column:
    return mean_money(F.sum("amount"), F.sum("n"))


def pipeline_summary(star: Star) -> DataFrame:
    total = F.sum(exact("claim_amount"))
    return star["fact_claims"].agg(
        _rows().alias("total_claims"),
        F.countDistinct(packed_digest("member_key")).alias("unique_members"),
        F.countDistinct(packed_digest("drug_key")).alias("unique_drugs"),
        money(total).alias("total_amount"),
        mean_money(total, F.count("claim_amount")).alias("avg_claim"),
        F.round(F.min("claim_amount"), 2).alias("min_claim"),
        F.round(F.max("claim_amount"), 2).alias("max_claim"),
    )


def claims_by_status(star: Star) -> DataFrame:
    return _per_key(star, "claim_status").select(
        "claim_status",
        F.col("n").alias("claims"),
        money(F.col("amount")).alias("total_amount"),
        mean_money(F.col("amount"), F.col("n")).alias("avg_amount"),
    ).orderBy(F.desc("claims"), F.asc_nulls_last("claim_status"))


def top_drug_classes(star: Star, k: int = 5) -> DataFrame:
    drugs = star["dim_drug"].select("drug_key", "drug_class")
    return (
        _per_key(star, "drug_key")
        .join(drugs, "drug_key")
        .groupBy("drug_class")
        .agg(_claims().alias("claims"), _amount().alias("total_revenue"), _mean().alias("avg_cost"))
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("drug_class"))
        .limit(k)
    )


def top_drugs(star: Star, k: int = 5) -> DataFrame:
    drugs = star["dim_drug"].select("drug_key", "drug_name", "drug_class")
    return (
        _per_key(star, "drug_key")
        .join(drugs, "drug_key")
        .groupBy("drug_name", "drug_class")
        .agg(_claims().alias("prescriptions"), _mean().alias("avg_cost"))
        .orderBy(F.desc("prescriptions"), F.asc_nulls_last("drug_name"), F.asc_nulls_last("drug_class"))
        .limit(k)
    )


def top_states(star: Star, k: int = 5) -> DataFrame:
    """Claims by the state stored on the provider."""
    providers = star["dim_provider"].select("provider_key", F.col("member_state").alias("state"))
    return (
        _per_key(star, "provider_key")
        .join(providers, "provider_key")
        .groupBy("state")
        .agg(_claims().alias("claims"), _amount().alias("total_amount"))
        .orderBy(F.desc("claims"), F.asc_nulls_last("state"))
        .limit(k)
    )


def claims_by_quarter(star: Star) -> DataFrame:
    dates = star["dim_date"].select(F.col("date_value").alias("service_date"), "year", "quarter")
    return (
        _per_key(star, "service_date")
        .join(dates, "service_date")
        .groupBy("year", "quarter")
        .agg(_claims().alias("claims"), _amount().alias("total_amount"))
        .orderBy("year", "quarter")
    )


# The titles under which the questions are published.
QUESTIONS: dict[str, Callable[[Star], DataFrame]] = {
    "Pipeline summary": pipeline_summary,
    "Claims by status": claims_by_status,
    "Top 5 drug classes by revenue": top_drug_classes,
    "Top 5 most prescribed drugs": top_drugs,
    "Top 5 states by volume": top_states,
    "Claims by quarter": claims_by_quarter,
}


def answer_all(star: Star) -> dict[str, DataFrame]:
    """Every standard question by title, still lazy."""
    return {title: question(star) for title, question in QUESTIONS.items()}
