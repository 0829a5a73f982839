"""Every registered query against DuckDB on the driver's tables."""

import compare
import pytest

import __spark_entry__ as contract
import oracle_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_claims_query_has_an_oracle():
    """The training-data queries, where present, are tested beside their operators; some have SQL too."""
    training = {name for name in contract.queries() if name == "pipeline" or name.startswith("op") and name[2].isdigit()}
    assert set(contract.queries()) - training == set(oracle_queries.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    ours = contract.queries()[name](spark, SF_DIR).toPandas()
    assert compare.differences(ours, con.execute(contract.oracle_sql()[name]).df()) == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["drug_class", "claims", "total_revenue", "avg_cost"]
