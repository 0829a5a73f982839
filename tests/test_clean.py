"""De-duplication, standardisation and acceptance on hand-written dirty rows."""

import hashlib
from datetime import date

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from claimloom.operators.clean import clean_claims, dedup_claims, judged_claims, rejected_claims
from claimloom.operators.star import fact_claims
from claimloom.schema import CLEAN_CLAIMS

NAN, INF = float("nan"), float("inf")


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_schema(claims):
    cleaned = clean_claims(claims({}), RUN_TS)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in CLEAN_CLAIMS]
    assert cleaned.first()["etl_processed_at"] == RUN_TS


def test_invalid_copy_wins_and_claim_is_rejected(claims):
    raw = claims({"claim_id": "A", "claim_amount": 10.0}, {"claim_id": "A", "claim_amount": -1.0})
    assert clean_claims(raw, RUN_TS).count() == 0
    assert rows(rejected_claims(raw, RUN_TS), "claim_id", "claim_amount", "reason") == [("A", -1.0, "claim_amount")]


def test_null_ids_collapse_to_one_row(claims):
    raw = claims({"claim_id": None, "plan_id": "PLAN_002"}, {"claim_id": None, "plan_id": "PLAN_001"}, {})
    deduped = dedup_claims(raw)
    assert rows(deduped.where("claim_id IS NULL"), "plan_id") == [("PLAN_001",)]
    assert deduped.count() == 2


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_choice_ignores_order_and_partitioning(claims, partitions):
    copies = [{"claim_id": f"C{i % 5}", "service_date": f"2024-01-{1 + i % 9:02d}", "drug_name": f"D{i}"} for i in range(60)]
    expected = rows(dedup_claims(claims(*copies)), "*")
    shuffled = claims(*copies[::-1]).repartition(partitions)
    assert rows(dedup_claims(shuffled), "*") == expected
    for claim_id, *_ in expected:
        mine = [c for c in copies if c["claim_id"] == claim_id]
        first = min(mine, key=lambda c: (c["service_date"], c["drug_name"]))
        assert (claim_id, first["service_date"], first["drug_name"]) in rows(
            dedup_claims(shuffled), "claim_id", "service_date", "drug_name"
        )


ACCEPTANCE_CASES = [
    ({"claim_amount": 0.0}, "claim_amount"),
    ({"claim_amount": -5.0}, "claim_amount"),
    ({"claim_amount": None}, "claim_amount"),
    ({"claim_amount": NAN}, "claim_amount"),
    ({"claim_amount": INF}, "claim_amount"),
    ({"quantity": 0.0}, "quantity"),
    ({"quantity": NAN}, "quantity"),
    ({"days_supply": 0}, "days_supply"),
    ({"days_supply": 366}, "days_supply"),
    ({"days_supply": None}, "days_supply"),
    ({"claim_amount": -1.0, "quantity": None, "days_supply": 400}, "claim_amount,quantity,days_supply"),
    ({"days_supply": 1}, ""),
    ({"days_supply": 365}, ""),
    ({"claim_amount": 0.01}, ""),
    ({"service_date": None}, ""),
    ({"claim_status": None}, ""),
]


def test_acceptance(claims):
    raw = claims(*[change for change, _ in ACCEPTANCE_CASES])
    expected = [(f"CLM{i:08d}", reason) for i, (_, reason) in enumerate(ACCEPTANCE_CASES, start=1)]
    assert rows(judged_claims(raw, RUN_TS), "claim_id", "reason") == expected
    assert rows(rejected_claims(raw, RUN_TS), "claim_id", "reason") == [case for case in expected if case[1]]
    assert rows(clean_claims(raw, RUN_TS), "claim_id") == [(claim_id,) for claim_id, reason in expected if not reason]


def test_text_is_trimmed_of_spaces_only(claims):
    raw = claims({"claim_status": " paid "}, {"claim_status": "paid\t"}, {"drug_class": "  diabetes"})
    cleaned = clean_claims(raw, RUN_TS)
    assert rows(cleaned, "claim_id", "claim_status", "drug_class") == [
        ("CLM00000001", "PAID", "DIABETES"),
        ("CLM00000002", "PAID\t", "DIABETES"),
        ("CLM00000003", "PAID", "DIABETES"),
    ]


def test_dates(claims):
    texts = ["2024-02-29", "2024-13-40", "2024/01/05", "", None]
    days = clean_claims(claims(*[{"service_date": text} for text in texts]), RUN_TS)
    found = [row["service_date"] for row in days.orderBy("claim_id").collect()]
    assert found == [date(2024, 2, 29), None, None, None, None]


def test_text_numbers_are_cast_and_malformed_ones_rejected(claims):
    raw = claims({}, {}).withColumns(
        {
            "claim_amount": F.expr("IF(claim_id = 'CLM00000001', 'abc', '12.5')"),
            "days_supply": F.lit("30.0"),
        }
    )
    assert rows(clean_claims(raw, RUN_TS), "claim_id", "claim_amount", "days_supply") == [("CLM00000002", 12.5, 30)]
    assert rows(rejected_claims(raw, RUN_TS), "claim_id", "reason") == [("CLM00000001", "claim_amount")]


def test_member_is_hashed_with_optional_salt(claims):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    raw = claims({"member_id": "MBR000042"}, {"member_id": None})
    assert rows(clean_claims(raw, RUN_TS).where("member_id IS NOT NULL"), "member_id") == [(digest("MBR000042"),)]
    assert clean_claims(raw, RUN_TS).where("member_id IS NULL").count() == 1
    salted = clean_claims(raw, RUN_TS, salt="pepper").where("member_id IS NOT NULL")
    assert rows(salted, "member_id") == [(digest("pepperMBR000042"),)]


def test_keys_keep_leading_zeros(claims):
    key = fact_claims(clean_claims(claims({}), RUN_TS)).first()["drug_key"]
    assert key == hashlib.sha256(b"00002143301").hexdigest()
