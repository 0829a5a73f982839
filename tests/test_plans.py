"""Shape of the physical plans that large and skewed inputs depend on."""

import re

import pytest
from conftest import RUN_TS

from claimloom.operators.clean import clean_claims, dedup_claims
from claimloom.operators.quality import dq_check
from claimloom.operators.star import build_star, fact_claims
from claimloom.plans import analytics
from claimloom.schema import CLEAN_CLAIMS
from claimloom.sources import files
from claimloom.sources.tables import claims_from_tables


@pytest.fixture
def stored(spark, claims, tmp_path):
    files.write_parquet(claims({}, {}), f"{tmp_path}/raw")
    return files.read_parquet(spark, f"{tmp_path}/raw")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_limited_before_the_shuffle(stored):
    text = plan(dedup_claims(stored))
    assert re.search(r"Final.*Exchange hashpartitioning\(claim_id.*Partial", text, re.S)
    assert text.count("Exchange ") == 1


def test_fact_adds_no_shuffle(stored):
    assert plan(fact_claims(clean_claims(stored, RUN_TS))).count("Exchange ") == 1


def test_dimensions_are_limited_before_the_shuffle(stored):
    tables = build_star(clean_claims(stored, RUN_TS))
    for name, key in (("dim_drug", "ndc_code"), ("dim_provider", "npi_number")):
        assert re.search(rf"Final.*Exchange hashpartitioning\({key}.*Partial", plan(tables[name]), re.S)


@pytest.mark.parametrize("question", [analytics.top_drug_classes, analytics.top_drugs, analytics.top_states,
                                      analytics.claims_by_quarter])
def test_fact_is_folded_below_the_join(spark, stored, tmp_path, question):
    cleaned = clean_claims(stored, RUN_TS)
    cleaned.write.parquet(f"{tmp_path}/cleaned")
    tables = build_star(spark.read.schema(CLEAN_CLAIMS).parquet(f"{tmp_path}/cleaned"))
    optimized = question(tables)._jdf.queryExecution().optimizedPlan().toString()
    below = optimized[optimized.index("Join Inner"):]
    assert re.search(r":-\s+(Filter.*\n\s+:\s+\+- )?Aggregate", below)
    assert "TakeOrderedAndProject" in plan(question(tables)) or question is analytics.claims_by_quarter


def test_single_check_reads_only_its_columns(stored):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(dq_check(stored, "null_claim_id"))).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"claim_id", "days_supply", "claim_status"}


def test_duplicate_check_shuffles_ids_only(stored):
    text = plan(dq_check(stored, "duplicate_claim_id"))
    ids = re.search(r"Exchange hashpartitioning\(claim_id.*?FileScan parquet \[([^\]]*)\]", text, re.S).group(1)
    assert re.fullmatch(r"claim_id#\d+", ids)
    assert "Expand" not in text


def test_source_tables_are_pruned_and_lines_never_broadcast(spark):
    text = plan(claims_from_tables(spark, "/root/testdata/sf0.001").select("claim_id"))
    assert "SortMergeJoin [l_orderkey" in text
    assert "l_shipdate" not in text and "p_name" not in text


@pytest.mark.parametrize("name", ["top_drug_classes", "top_drugs", "top_states", "claims_by_quarter", "audit_counts", "dq_report"])
def test_registered_queries_read_lines_once(spark, name):
    import __spark_entry__

    text = plan(__spark_entry__.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "lineitem" not in text and not re.search(r"Exchange hashpartitioning\(claim_id#.*Partial", text)


def test_branches_share_the_shuffle_by_claim(spark):
    star = build_star(clean_claims(claims_from_tables(spark, "/root/testdata/sf0.001"), RUN_TS))
    answer = analytics.top_states(star)
    answer.collect()
    assert "ReusedExchange" in plan(answer)
