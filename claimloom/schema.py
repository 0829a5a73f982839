"""Declared schemas: nothing is inferred on read, so codes keep their leading zeros."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(spec: str) -> T.StructType:
    """Schema from `name type, ...`; unlike the DDL parser of Spark it needs no running session."""
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_CLAIMS = struct(
    "claim_id string, member_id string, ndc_code string, drug_name string, drug_class string, "
    "npi_number string, service_date string, claim_amount double, quantity double, days_supply int, "
    "plan_id string, member_state string, claim_status string"
)

CLEAN_CLAIMS = struct(
    "claim_id string, member_id string, ndc_code string, drug_name string, drug_class string, "
    "npi_number string, service_date date, claim_amount double, quantity double, days_supply int, "
    "plan_id string, member_state string, claim_status string, etl_processed_at timestamp"
)

DIM_DRUG = struct("ndc_code string, drug_name string, drug_class string, drug_key string")

DIM_PROVIDER = struct("npi_number string, member_state string, provider_key string")

DIM_DATE = struct(
    "date_value date, year int, month int, quarter int, day int, "
    "month_name string, day_name string, is_weekend boolean"
)

FACT_CLAIMS = struct(
    "claim_key string, member_key string, drug_key string, provider_key string, service_date date, "
    "claim_amount double, quantity double, days_supply int, plan_id string, claim_status string, "
    "etl_processed_at timestamp"
)

STAR = {
    "dim_drug": DIM_DRUG,
    "dim_provider": DIM_PROVIDER,
    "dim_date": DIM_DATE,
    "fact_claims": FACT_CLAIMS,
}

# Dimensions are loaded before the fact that points at them.
LOAD_ORDER = tuple(STAR)

DQ_REPORT = struct("check string, passed boolean, detail string")

LOAD_REPORT = struct("table string, sink string, rows bigint, ok boolean, error string")

# The accepted claim states.
VALID_STATUSES = ("PAID", "ADJUDICATED", "REVERSED", "PENDING")

# Precedence used to pick one row among copies of a claim. It names every column besides the key, so two
# rows that tie are identical and the choice never depends on input order or partitioning.
COPY_ORDER = (
    "service_date",
    "ndc_code",
    "npi_number",
    "claim_amount",
    "quantity",
    "claim_status",
    "days_supply",
    "plan_id",
    "member_state",
    "member_id",
    "drug_name",
    "drug_class",
)
