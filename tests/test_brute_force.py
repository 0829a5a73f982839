"""Random dirty batches against a plain Python evaluation of the same rules."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import RUN_TS, TEMPLATE

from claimloom.operators.clean import clean_claims, dedup_claims, rejected_claims
from claimloom.operators.quality import CHECKS, dq_metrics, dq_report, found_values_by_check, unexpected_statuses
from claimloom.operators.star import build_star
from claimloom.plans import analytics
from claimloom.schema import COPY_ORDER, VALID_STATUSES

NAN = float("nan")


def dirty_batch(seed: int) -> list[dict]:
    pick = random.Random(seed)
    batch = []
    for _ in range(400):
        ndc = pick.randint(0, 8)
        batch.append({
            **TEMPLATE,
            # A third of the rows share one id.
            "claim_id": pick.choice(["HOT", None, f"C{pick.randint(0, 120):03d}", f"C{pick.randint(0, 120):03d}"]),
            "member_id": pick.choice([None, *[f"MBR{i:06d}" for i in range(9)]]),
            "ndc_code": f"{ndc:011d}",
            "drug_name": f"Drug {pick.randint(0, 3)}",
            "drug_class": pick.choice([" c1", "C1 ", "c2", "C3", None]),
            "npi_number": str(1000000000 + pick.randint(0, 6)),
            "service_date": pick.choice(["2023-12-31", "2024-02-29", "2024-07-06", "2024/07/06", "2024-13-01", None]),
            "claim_amount": pick.choice([NAN, None, 0.0, -1.5, *[round(pick.uniform(1, 900), 2) for _ in range(9)]]),
            "quantity": pick.choice([None, 0.0, 30.0, 60.0, 90.0, 180.0]),
            "days_supply": pick.choice([None, 0, 1, 30, 60, 90, 365, 366]),
            "member_state": pick.choice(["FL", "TX", "CA", None]),
            "claim_status": pick.choice(["PAID", " paid ", "REVERSED", "VOID", None]),
        })
    return batch


def copy_rank(row: dict) -> tuple:
    def rank(value):
        if value is None:
            return (2, 0)
        return (1, 0) if value != value else (0, value)  # NaN after every number, NULL last

    return tuple(rank(row[name]) for name in COPY_ORDER)


def parsed(text):
    try:
        return date.fromisoformat(text) if text and text[4] == "-" else None
    except ValueError:
        return None


def sha(text):
    return None if text is None else hashlib.sha256(text.encode()).hexdigest()


def standard(text):
    return None if text is None else text.strip(" ").upper()


def failed_rules(row: dict) -> str:
    rules = {
        "claim_amount": row["claim_amount"] is not None and 0 < row["claim_amount"] < math.inf,
        "quantity": row["quantity"] is not None and row["quantity"] > 0,
        "days_supply": row["days_supply"] is not None and 1 <= row["days_supply"] <= 365,
    }
    return ",".join(name for name, holds in rules.items() if not holds)


def cents(value: Decimal) -> float:
    return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))


def fold(rows, key):
    """claims and exact amount per key, without rows whose key is None as a whole."""
    out = defaultdict(lambda: [0, Decimal(0)])
    for row in rows:
        out[key(row)][0] += 1
        out[key(row)][1] += Decimal(str(row["claim_amount"]))
    return out


def last_null(value):
    return (value is None, value or "")


@pytest.fixture(params=[1, 2])
def batch(request):
    return dirty_batch(request.param)


def as_set(df):
    return Counter(tuple(repr(v) for v in row) for row in df.collect())


def test_whole_chain(claims, batch):
    raw = claims(*batch).repartition(7)
    best = {}
    for row in batch:
        if row["claim_id"] not in best or copy_rank(row) < copy_rank(best[row["claim_id"]]):
            best[row["claim_id"]] = row
    names = list(TEMPLATE)
    assert as_set(dedup_claims(raw)) == Counter(tuple(repr(r[n]) for n in names) for r in best.values())

    rejected = {r["claim_id"]: failed_rules(r) for r in best.values() if failed_rules(r)}
    assert {r["claim_id"]: r["reason"] for r in rejected_claims(raw, RUN_TS).collect()} == rejected

    kept = sorted((r for r in best.values() if not failed_rules(r)), key=lambda r: last_null(r["claim_id"]))
    star = build_star(clean_claims(raw, RUN_TS))
    fact = Counter(
        tuple(map(repr, (sha(r["claim_id"]), sha(r["member_id"]), sha(r["ndc_code"]), sha(r["npi_number"]),
                         parsed(r["service_date"]), r["claim_amount"], r["quantity"], r["days_supply"], r["plan_id"],
                         standard(r["claim_status"]), RUN_TS)))
        for r in kept
    )
    assert as_set(star["fact_claims"]) == fact

    drugs, providers = {}, {}
    for row in kept:
        drugs.setdefault(row["ndc_code"], (row["drug_name"], standard(row["drug_class"])))
        providers.setdefault(row["npi_number"], row["member_state"])
    assert {(r[0], r[1], r[2], r[3]) for r in star["dim_drug"].collect()} == {
        (code, *drug, sha(code)) for code, drug in drugs.items()
    }
    assert {tuple(r) for r in star["dim_provider"].collect()} == {(n, s, sha(n)) for n, s in providers.items()}
    assert {r["date_value"] for r in star["dim_date"].collect()} == {parsed(r["service_date"]) for r in kept}

    classes = fold(kept, lambda r: drugs[r["ndc_code"]][1])
    expected = sorted(((k, n, cents(a)) for k, (n, a) in classes.items()), key=lambda t: (-t[2], last_null(t[0])))[:5]
    assert [tuple(r)[:3] for r in analytics.top_drug_classes(star).collect()] == expected

    prescribed = fold(kept, lambda r: drugs[r["ndc_code"]])
    expected = sorted(((*k, n) for k, (n, _) in prescribed.items()), key=lambda t: (-t[2], t[0], last_null(t[1])))[:5]
    assert [tuple(r)[:3] for r in analytics.top_drugs(star).collect()] == expected

    states = fold(kept, lambda r: providers[r["npi_number"]])
    expected = sorted(((k, n, cents(a)) for k, (n, a) in states.items()), key=lambda t: (-t[1], last_null(t[0])))[:5]
    assert [tuple(r) for r in analytics.top_states(star).collect()] == expected

    dated = [r for r in kept if parsed(r["service_date"])]
    quarters = fold(dated, lambda r: (parsed(r["service_date"]).year, (parsed(r["service_date"]).month + 2) // 3))
    assert [tuple(r) for r in analytics.claims_by_quarter(star).collect()] == [
        (*k, n, cents(a)) for k, (n, a) in sorted(quarters.items())
    ]

    statuses = fold(kept, lambda r: standard(r["claim_status"]))
    expected = sorted(((k, n, cents(a)) for k, (n, a) in statuses.items()), key=lambda t: (-t[1], last_null(t[0])))
    assert [tuple(r)[:3] for r in analytics.claims_by_status(star).collect()] == expected

    summary = analytics.pipeline_summary(star).first()
    assert (summary["total_claims"], summary["unique_members"], summary["unique_drugs"]) == (
        len(kept), len({r["member_id"] for r in kept} - {None}), len(drugs)
    )
    assert summary["total_amount"] == cents(sum(Decimal(str(r["claim_amount"])) for r in kept))


def test_checks(claims, batch):
    raw = claims(*batch).repartition(5)
    report = dict(zip(CHECKS, dq_report(raw).collect()))
    ids = {r["claim_id"] for r in batch} - {None}
    nulls = sum(r["claim_id"] is None for r in batch)
    undated = sum(parsed(r["service_date"]) is None for r in batch)
    amounts = [r["claim_amount"] for r in batch if r["claim_amount"] is not None and r["claim_amount"] == r["claim_amount"]]
    assert not any(row["passed"] for row in report.values())
    assert report["row_count"]["detail"] == "(400 rows)"
    assert report["null_claim_id"]["detail"] == f"({nulls} nulls found)"
    assert report["duplicate_claim_id"]["detail"] == f"({len(ids)} unique out of 400)"
    assert report["claim_amount"]["detail"] == f"(min={min(amounts):.2f}, max={max(amounts):.2f})"
    assert report["quantity"]["detail"] == "(min=0.0)"
    outside = sum(r["days_supply"] is None or not 1 <= r["days_supply"] <= 365 for r in batch)
    assert report["days_supply"]["detail"] == f"(7 distinct values, min=0, max=366, {outside} rows outside)"
    invalid = sum(r["claim_status"] not in VALID_STATUSES for r in batch)
    assert report["claim_status"]["detail"] == f"(4 distinct values, {invalid} rows unexpected)"
    values = Counter((CHECKS[k][0], None if r[k] is None else str(r[k])) for r in batch for k in ("days_supply", "claim_status"))
    assert {(r["check"], r["value"]): r["claims"] for r in found_values_by_check(raw).collect()} == values
    assert report["service_date"]["detail"] == f"({undated} unparseable dates)"
    assert dq_metrics(raw, deduped=dedup_claims(raw)).first() == dq_metrics(raw).first()
    found = {r["claim_status"] for r in batch} - set(VALID_STATUSES)
    assert {r[0] for r in unexpected_statuses(raw).collect()} == found
