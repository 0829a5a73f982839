import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from claimloom.schema import RAW_CLAIMS  # noqa: E402

RUN_TS = datetime(2024, 5, 1, 2, 0)
TEMPLATE = {
    "claim_id": "CLM00000001",
    "member_id": "MBR000042",
    "ndc_code": "00002143301",
    "drug_name": "Insulin Glargine",
    "drug_class": "DIABETES",
    "npi_number": "1234567890",
    "service_date": "2024-03-09",
    "claim_amount": 125.5,
    "quantity": 30.0,
    "days_supply": 30,
    "plan_id": "PLAN_007",
    "member_state": "FL",
    "claim_status": "PAID",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("claimloom-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        # Keep small fixtures spread over several tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def claims(spark):
    """Raw claims from changes to a valid template; each row gets its own claim_id unless it names one."""

    def build(*changes: dict):
        rows = []
        for number, change in enumerate(changes, start=1):
            row = {**TEMPLATE, "claim_id": f"CLM{number:08d}", **change}
            rows.append(tuple(row[name] for name in RAW_CLAIMS.names))
        return spark.createDataFrame(rows, RAW_CLAIMS)

    return build
