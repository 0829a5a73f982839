"""Taking up a run that broke off, and tables that change together."""

import compare
import pytest
from conftest import RUN_TS

import oracle_queries
from claimloom.operators import load, quality
from claimloom.operators.clean import clean_claims, rejected_claims
from claimloom.operators.star import build_star
from claimloom.plans import run as plan
from claimloom.plans.stages import StageStore, source_fingerprint
from claimloom.schema import LOAD_ORDER
from claimloom.sources import files, snapshots

LAX = {"run_ts": RUN_TS, "strict": False}


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def stored(spark, claims, tmp_path):
    """Claims in Parquet, so that a run knows its source."""
    files.write_parquet(claims({}, {}, {"quantity": -1.0}, {"ndc_code": "X"}), f"{tmp_path}/source")
    return files.read_parquet(spark, f"{tmp_path}/source")


def written(tmp_path):
    """Files of all stages with the time they were written."""
    return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}


def test_a_broken_run_is_taken_up(spark, stored, tmp_path, monkeypatch):
    whole = plan.run(spark, stored, f"{tmp_path}/whole", **LAX)
    monkeypatch.setattr(plan, "metrics_of", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        plan.run(spark, stored, f"{tmp_path}/out", **LAX)
    monkeypatch.undo()
    before = written(tmp_path)
    assert {name.split("/")[1] for name in before} == {"raw_claims", "judged_claims", "dq_found_values"}
    result = plan.run(spark, stored, f"{tmp_path}/out", resume=True, **LAX)
    assert result.reused == ("raw_claims", "judged_claims", "dq_found_values")
    assert {name: at for name, at in written(tmp_path).items() if name in before} == before
    assert rows(result.audit) == rows(whole.audit)
    for name in LOAD_ORDER:
        assert rows(result.star[name]) == rows(whole.star[name])
    after = written(tmp_path)
    again = plan.run(spark, stored, f"{tmp_path}/out", resume=True, **LAX)
    assert written(tmp_path) == after and "load_report" in again.reused and len(again.reused) == 13
    assert rows(again.audit) == rows(whole.audit)


def test_what_changed_is_computed_anew(spark, claims, stored, tmp_path):
    out = f"{tmp_path}/out"
    plan.run(spark, stored, out, **LAX)
    other = plan.run(spark, stored, out, resume=True, row_count_range=(1, 5), **LAX)
    assert "dq_report" not in other.reused and {"judged_claims", "dq_metrics", "load_report", "audit"} <= set(other.reused)
    assert other.quality.where("check = 'Row count in valid range' AND passed").count() == 1
    salted = plan.run(spark, stored, out, resume=True, row_count_range=(1, 5), salt="s", **LAX)
    assert set(salted.reused) == {"raw_claims", "dq_found_values"}
    files.write_parquet(claims({}), f"{tmp_path}/source")
    fresh = plan.run(spark, files.read_parquet(spark, f"{tmp_path}/source"), out, resume=True, **LAX)
    assert fresh.reused == () and fresh.audit.first()["raw_rows"] == 1


def test_damaged_and_unknown_stages_are_not_taken_up(spark, claims, stored, tmp_path):
    out = f"{tmp_path}/out"
    plan.run(spark, stored, out, **LAX)
    next((tmp_path / "out" / "judged_claims").glob("*.parquet")).unlink()
    result = plan.run(spark, stored, out, resume=True, **LAX)
    assert set(result.reused) >= {"raw_claims", "audit"} and "judged_claims" not in result.reused
    assert spark.read.parquet(f"{out}/judged_claims").count() == 4
    assert result.audit.first()["deduped_rows"] == 4
    in_memory = claims({}, {})
    assert source_fingerprint(in_memory) is None and source_fingerprint(stored.crossJoin(in_memory.select("plan_id"))) is None
    assert source_fingerprint(stored) == source_fingerprint(stored) != source_fingerprint(stored.where("quantity > 0"))
    assert plan.run(spark, in_memory, out, resume=True, **LAX).reused == ()
    named = plan.run(spark, in_memory, out, source="batch 7", **LAX)
    assert named.reused == ()
    assert "raw_claims" in plan.run(spark, lambda: 1 / 0, out, source="batch 7", resume=True, **LAX).reused


def test_run_time_is_that_of_the_first_run(spark, stored, tmp_path):
    first = plan.run(spark, stored, f"{tmp_path}/out", strict=False)
    second = plan.run(spark, stored, f"{tmp_path}/out", strict=False, resume=True)
    assert len(second.reused) == 13 and rows(second.star["fact_claims"]) == rows(first.star["fact_claims"])


def test_a_failed_primary_load_is_tried_again(spark, stored, tmp_path):
    def broken(table, name):
        raise OSError("no route")

    out, primary = f"{tmp_path}/out", f"{tmp_path}/primary"
    first = plan.run(spark, stored, out, primary=broken, **LAX)
    assert first.load_report.where("NOT ok").count() == 4
    second = plan.run(spark, stored, out, primary=load.parquet_sink(primary), resume=True, **LAX)
    assert "load_report" not in second.reused and second.load_report.where("NOT ok").count() == 0
    assert rows(load.read_star(spark, primary)["fact_claims"]) == rows(second.star["fact_claims"])


def test_a_stage_has_no_manifest_until_it_is_complete(spark, tmp_path):
    out = f"{tmp_path}/out"
    StageStore(spark, out, False, "s").keep("x", lambda: spark.range(3).toDF("a"), ("source",))
    store = StageStore(spark, out, True, "t")
    with pytest.raises(Exception, match="boom"):
        store.keep("x", lambda: spark.range(3).selectExpr("raise_error('boom') AS a"), ("source",))
    again = StageStore(spark, out, True, "s")
    again.keep("x", lambda: spark.range(4).toDF("a"), ("source",))
    assert again.reused == []


def test_tables_are_published_together(spark, claims, tmp_path):
    root = str(tmp_path)
    old = build_star(clean_claims(claims({}), RUN_TS))
    load.load_star(spark, old, root)
    held = load.read_star(spark, root)
    want = {name: rows(table) for name, table in old.items()}
    new = build_star(clean_claims(claims({"ndc_code": "Y"}, {"npi_number": "1"}), RUN_TS))
    failing = {**new, "dim_date": new["dim_date"].selectExpr("*", "raise_error('boom') AS more").drop("year").withColumnRenamed("more", "year")}
    with pytest.raises(Exception, match="boom"):
        load.load_star(spark, failing, root)
    assert {name: rows(table) for name, table in load.read_star(spark, root).items()} == want
    load.load_star(spark, new, root)
    assert {name: rows(table) for name, table in held.items()} == want  # resolved before: all old
    assert {name: rows(table) for name, table in load.read_star(spark, root).items()} == {name: rows(table) for name, table in new.items()}
    for _ in range(2):
        load.load_star(spark, new, root)
    names = files.names_in(spark, f"{root}/versions")
    assert len(names) == 2 and names[-1] == snapshots.published(spark, root)


BAD_AMOUNTS = (0.005, 0.01, 1e12, 1e13, 0.0, 5.0)


@pytest.mark.parametrize("name", ["claims_clean", "claims_rejected", "dq_claim_amount"])
def test_the_amount_rule_is_that_of_its_sql(spark, claims, tmp_path, name):
    raw = claims(*[{"claim_amount": amount} for amount in BAD_AMOUNTS])
    files.write_parquet(raw.coalesce(1), f"{tmp_path}/raw")
    sql = oracle_queries.QUERIES[name].replace(oracle_queries.RAW, f"\nraw AS (SELECT * FROM read_parquet('{tmp_path}/raw/*.parquet'))")
    assert "lineitem" not in sql
    ours = {
        "claims_clean": lambda: clean_claims(raw, RUN_TS).drop("etl_processed_at"),
        "claims_rejected": lambda: rejected_claims(raw, RUN_TS).drop("etl_processed_at"),
        "dq_claim_amount": lambda: quality.dq_check(raw, "claim_amount"),
    }[name]()
    assert compare.differences(ours.toPandas(), compare.duck(str(tmp_path / "none")).execute(sql).df()) == []


def test_another_amount_range(spark, claims, tmp_path):
    raw = claims(*[{"claim_amount": amount} for amount in BAD_AMOUNTS])
    wide = (0.005, 1e13)
    assert clean_claims(raw, RUN_TS, amounts=wide).count() == 5 and rejected_claims(raw, RUN_TS, amounts=wide).count() == 1
    assert quality.dq_check(raw.where("claim_amount > 0"), "claim_amount", amounts=wide).first()["passed"]
    result = plan.run(spark, raw, f"{tmp_path}/out", amount_range=(5.0, 5.0), **LAX)
    assert result.audit.first()["rejected_rows"] == 5 and result.star["fact_claims"].count() == 1
