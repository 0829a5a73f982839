"""The eight checks, their texts, the summary, the gate and the unexpected statuses."""

import pytest

from claimloom.operators.quality import (
    CHECKS,
    DataQualityError,
    dq_check,
    dq_gate,
    dq_report,
    dq_summary,
    found_values_by_check,
    unexpected_statuses,
)

NAN, INF = float("nan"), float("inf")


def outcome(raw, key):
    row = dq_check(raw, key).first()
    return row["passed"], row["detail"]


def test_report_has_all_checks_in_order_and_agrees_with_single_checks(claims):
    raw = claims({}, {"quantity": 60.0, "days_supply": 90, "claim_status": "REVERSED"})
    report = [tuple(row) for row in dq_report(raw).collect()]
    assert report == [tuple(dq_check(raw, key).first()) for key in CHECKS]
    assert report == [
        ("Row count in valid range", False, "(2 rows)"),
        ("No null claim_ids", True, "(0 nulls found)"),
        ("No duplicate claim_ids", True, "(2 unique out of 2)"),
        ("claim_amount is positive", True, "(min=125.50, max=125.50)"),
        ("quantity is positive", True, "(min=30.0)"),
        ("days_supply between 1-365", True, "(2 distinct values, min=30, max=90, 0 rows outside)"),
        ("claim_status values valid", True, "(2 distinct values, 0 rows unexpected)"),
        ("service_date is parseable", True, "(0 unparseable dates)"),
    ]


@pytest.mark.parametrize(("rows", "passed"), [(999, False), (1_000, True)])
def test_row_count(spark, claims, rows, passed):
    raw = claims({}).crossJoin(spark.range(rows)).drop("id")
    assert outcome(raw, "row_count") == (passed, f"({rows:,} rows)")


def test_null_and_duplicate_ids(claims):
    raw = claims({"claim_id": None}, {"claim_id": None}, {"claim_id": "A"}, {"claim_id": "A"})
    assert outcome(raw, "null_claim_id") == (False, "(2 nulls found)")
    assert outcome(raw, "duplicate_claim_id") == (False, "(1 unique out of 4)")
    assert outcome(claims({"claim_id": None}), "duplicate_claim_id")[0] is False


@pytest.mark.parametrize("amount", [0.0, -5.0, None, NAN, INF])
def test_amount_must_be_positive_and_finite(claims, amount):
    assert outcome(claims({}, {"claim_amount": amount}), "claim_amount")[0] is False
    assert outcome(claims({}, {"quantity": amount}), "quantity")[0] is False


def test_amount_detail_skips_nan(claims):
    raw = claims({"claim_amount": NAN}, {"claim_amount": 10.0}, {"claim_amount": 1234.5})
    assert outcome(raw, "claim_amount") == (False, "(min=10.00, max=1234.50)")
    assert outcome(claims({"quantity": NAN}), "quantity") == (False, "(min=nan)")


@pytest.mark.parametrize(("days", "passed"), [(0, False), (1, True), (365, True), (366, False), (None, False)])
def test_days_supply(claims, days, passed):
    assert outcome(claims({"days_supply": days}), "days_supply")[0] is passed


def test_days_supply_extremes_are_those_of_numbers(claims):
    raw = claims(*[{"days_supply": d} for d in (100, 9, None, 30)])
    assert outcome(raw, "days_supply") == (False, "(3 distinct values, min=9, max=100, 1 rows outside)")


@pytest.mark.parametrize("status", [" paid ", "VOID", None, "PAID\t"])
def test_unexpected_status(claims, status):
    raw = claims({}, {"claim_status": status})
    assert outcome(raw, "claim_status")[0] is False
    assert [row[0] for row in unexpected_statuses(raw).collect()] == [status]


def test_all_values_found_are_returned(spark, claims):
    raw = claims({}).crossJoin(spark.range(5_000)).selectExpr(
        "'S' || id AS claim_status", "int(id) AS days_supply", *[c for c in claims({}).columns if c not in ("claim_status", "days_supply")]
    )
    found = {(row["check"], row["value"]): row["claims"] for row in found_values_by_check(raw).collect()}
    assert len(found) == 10_000 and set(found.values()) == {1}
    assert outcome(raw, "claim_status") == (False, "(5000 distinct values, 5000 rows unexpected)")
    assert outcome(raw, "days_supply") == (False, "(5000 distinct values, min=0, max=4999, 4635 rows outside)")
    assert unexpected_statuses(raw).count() == 5_000


def test_no_valid_status(claims):
    assert unexpected_statuses(claims({}), ()).count() == 1


def test_row_range_is_an_argument(claims):
    raw = claims({}, {})
    assert dq_check(raw, "row_count", (1, 2)).first()["passed"] is True
    assert dq_check(raw, "row_count", (3, 9)).first()["passed"] is False
    dq_gate(dq_report(raw, (1, 2)))


@pytest.mark.parametrize("text", ["2024-13-40", "2024/01/05", None, ""])
def test_unparseable_date(claims, text):
    assert outcome(claims({}, {"service_date": text}), "service_date") == (False, "(1 unparseable dates)")


def test_empty_batch_fails_only_the_row_count(claims):
    report = dq_report(claims({}).limit(0)).collect()
    assert [row["check"] for row in report if not row["passed"]] == ["Row count in valid range"]
    assert all(row["detail"] for row in report)


def test_summary_and_gate(spark, claims):
    good = claims({}).crossJoin(spark.range(1_000)).selectExpr(
        "concat('CLM', id) AS claim_id", *[c for c in claims({}).columns if c != "claim_id"]
    )
    report = dq_report(good)
    assert tuple(dq_summary(report).first()) == (True, 8, 8)
    dq_gate(report)

    bad = dq_report(claims({"quantity": 0.0}))
    assert tuple(dq_summary(bad).first()) == (False, 6, 8)
    with pytest.raises(DataQualityError, match="stopped by 2 of its checks.*Row count in valid range.*quantity is positive"):
        dq_gate(bad)
