"""Catalogue tables of the published version, and joins chosen by their statistics."""

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from claimloom.operators import catalogue, load
from claimloom.operators.clean import clean_claims
from claimloom.operators.star import build_star
from claimloom.schema import LOAD_ORDER, STAR

QUESTION = "SELECT count(*) AS n FROM {fact_claims} JOIN {dim_provider} USING (provider_key) WHERE member_state = 'S7'"


@pytest.fixture
def loaded(spark, claims, tmp_path):
    """3,000 claims of as many providers in 40 states, loaded and entered."""
    many = claims({}).drop("claim_id", "npi_number", "member_state").crossJoin(spark.range(3000))
    many = many.withColumns({"claim_id": F.expr("string(id)"), "npi_number": F.expr("string(1000000 + id)"), "member_state": F.expr("concat('S', id % 40)")})
    tables = build_star(clean_claims(many, RUN_TS))
    load.load_star(spark, tables, str(tmp_path))
    yield catalogue.register_tables(spark, str(tmp_path), "claims_test"), tables, str(tmp_path)
    catalogue.drop_tables(spark, "claims_test")


def joins(spark, sql, **conf):
    session = spark.newSession()
    for name, value in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "60000", **conf}.items():
        session.conf.set(name, value)
    plan = session.sql(sql)._jdf.queryExecution().executedPlan().toString()
    return "BroadcastHashJoin" in plan, "SortMergeJoin" in plan


def test_tables_are_those_of_the_published_version(spark, loaded):
    names, tables, root = loaded
    assert set(names) == set(LOAD_ORDER)
    for name in LOAD_ORDER:
        assert spark.table(names[name]).schema == STAR[name]
        assert spark.table(names[name]).exceptAll(tables[name]).count() == 0
    load.load_star(spark, {**tables, "fact_claims": tables["fact_claims"].limit(5)}, root)
    assert spark.table(names["fact_claims"]).count() == 3000  # as entered, until the new version is
    again = catalogue.register_tables(spark, root, "claims_test")
    assert again == names and spark.table(names["fact_claims"]).count() == 5


def test_the_side_of_a_join_follows_the_statistics(spark, loaded):
    names, _, _ = loaded
    sql = QUESTION.format(**names)
    assert spark.sql(sql).first()["n"] == 75
    by_file_size, by_statistics = joins(spark, sql), joins(spark, sql, **{"spark.sql.cbo.enabled": "true"})
    assert by_file_size == (False, True)  # 3,000 providers are over the threshold
    assert by_statistics == (True, False)  # 75 in one state are not
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {names['dim_provider']}").collect()}
    assert "3000 rows" in found["Statistics"]


def test_a_folder_of_any_name(spark, claims, tmp_path):
    root = f"{tmp_path}/it's here"
    load.load_star(spark, build_star(clean_claims(claims({}), RUN_TS)), root)
    names = catalogue.register_tables(spark, root, "odd_name")
    assert spark.table(names["dim_drug"]).count() == 1
    catalogue.drop_tables(spark, "odd_name")
