"""De-duplication, standardisation and row acceptance of raw claims."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.columns import date_of, hashed, keep_first, standard_text
from claimloom.functions.rules import AMOUNT_RANGE, AmountRange, acceptance, violated
from claimloom.schema import CLEAN_CLAIMS, COPY_ORDER


def dedup_claims(raw: DataFrame) -> DataFrame:
    """One row per claim_id. Runs before the acceptance rules, so an invalid copy can win."""
    return keep_first(raw, ["claim_id"], list(COPY_ORDER))


def standardise(deduped: DataFrame, run_ts: datetime | None = None, salt: str | None = None) -> DataFrame:
    """Typed and normalised columns, member ids pseudonymised, processing time added."""
    return deduped.withColumns(
        {
            "claim_amount": F.col("claim_amount").try_cast("double"),
            "quantity": F.col("quantity").try_cast("double"),
            "days_supply": F.col("days_supply").try_cast("double").try_cast("int"),
            "service_date": F.expr(date_of("service_date")),
            "drug_class": standard_text("drug_class"),
            "claim_status": standard_text("claim_status"),
            "member_id": hashed("member_id", salt),
            "etl_processed_at": F.current_timestamp() if run_ts is None else F.lit(run_ts),
        }
    )


def clean_claims(raw: DataFrame, run_ts: datetime | None = None, salt: str | None = None, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """De-duplicated, standardised claims that pass every acceptance rule. `amounts` are the accepted ones, both ends included."""
    return accepted_claims(dedup_claims(raw), run_ts, salt, amounts)


def accepted_claims(deduped: DataFrame, run_ts: datetime | None = None, salt: str | None = None, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """`clean_claims` of claims that are de-duplicated already. They take less room than cleaned ones, whose member ids are digests."""
    accepted = " AND ".join(acceptance(amounts).values())
    return standardise(deduped, run_ts, salt).where(accepted).select(*CLEAN_CLAIMS.names)


def judged_claims(raw: DataFrame, run_ts: datetime | None = None, salt: str | None = None, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """All de-duplicated claims with `reason`: the failed rules joined by commas, empty when accepted."""
    failed = ", ".join(f"IF({violated(rule)}, '{name}', NULL)" for name, rule in acceptance(amounts).items())
    standard = standardise(dedup_claims(raw), run_ts, salt)
    return standard.selectExpr(*CLEAN_CLAIMS.names, f"concat_ws(',', {failed}) AS reason")


def rejected_claims(raw: DataFrame, run_ts: datetime | None = None, salt: str | None = None, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """De-duplicated claims removed by the acceptance rules, with the reason."""
    return judged_claims(raw, run_ts, salt, amounts).where(F.col("reason") != "")
