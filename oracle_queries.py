"""DuckDB SQL that answers every registered query independently of Spark, on the same Parquet tables."""

RAW = """
raw AS (
    SELECT 'CLM' || lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(length(CAST(l_orderkey AS VARCHAR)), 8) AS INTEGER), '0')
               || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
           'MBR' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(length(CAST(o_custkey AS VARCHAR)), 6) AS INTEGER), '0')
               AS member_id,
           lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(length(CAST(l_partkey AS VARCHAR)), 11) AS INTEGER), '0')
               AS ndc_code,
           p_name AS drug_name,
           ' ' || lower(p_brand) || ' ' AS drug_class,
           CAST(1000000000 + l_suppkey AS VARCHAR) AS npi_number,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS service_date,
           CAST(CAST(l_extendedprice - 5000 AS DECIMAL(12, 2)) AS DOUBLE) AS claim_amount,
           l_quantity - 1 AS quantity,
           CAST(p_size * 8 AS INTEGER) AS days_supply,
           'PLAN_' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') AS plan_id,
           n_name AS member_state,
           CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'ADJUDICATED' WHEN 'R' THEN 'REVERSED' END
               AS claim_status
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
)"""

DEDUPED = """
deduped AS (
    SELECT * EXCLUDE (place)
    FROM (SELECT *, row_number() OVER (
              PARTITION BY claim_id
              ORDER BY service_date NULLS LAST, ndc_code NULLS LAST, npi_number NULLS LAST, claim_amount NULLS LAST,
                       quantity NULLS LAST, claim_status NULLS LAST, days_supply NULLS LAST, plan_id NULLS LAST,
                       member_state NULLS LAST, member_id NULLS LAST, drug_name NULLS LAST, drug_class NULLS LAST
          ) AS place FROM raw)
    WHERE place = 1
)"""

STANDARD = """
standard AS (
    SELECT claim_id, sha256(member_id) AS member_id, ndc_code, drug_name, upper(trim(drug_class)) AS drug_class,
           npi_number, CAST(try_strptime(service_date, '%Y-%m-%d') AS DATE) AS service_date, claim_amount, quantity,
           days_supply, plan_id, member_state, upper(trim(claim_status)) AS claim_status
    FROM deduped
)"""

CLEANED = """
cleaned AS (
    SELECT * FROM standard WHERE claim_amount BETWEEN 0.01 AND 1e12 AND quantity > 0 AND days_supply BETWEEN 1 AND 365
)"""

DIM_DRUG = """
dim_drug AS (
    SELECT ndc_code, drug_name, drug_class, sha256(ndc_code) AS drug_key
    FROM (SELECT *, row_number() OVER (PARTITION BY ndc_code ORDER BY claim_id) AS place FROM cleaned)
    WHERE place = 1
)"""

DIM_PROVIDER = """
dim_provider AS (
    SELECT npi_number, member_state, sha256(npi_number) AS provider_key
    FROM (SELECT *, row_number() OVER (PARTITION BY npi_number ORDER BY claim_id) AS place FROM cleaned)
    WHERE place = 1
)"""

DIM_DATE = """
dim_date AS (
    SELECT service_date AS date_value,
           CAST(year(service_date) AS INTEGER) AS "year", CAST(month(service_date) AS INTEGER) AS "month",
           CAST(quarter(service_date) AS INTEGER) AS "quarter", CAST(day(service_date) AS INTEGER) AS "day",
           monthname(service_date) AS month_name, dayname(service_date) AS day_name,
           dayofweek(service_date) IN (0, 6) AS is_weekend
    FROM (SELECT DISTINCT service_date FROM cleaned)
)"""

FACT = """
fact_claims AS (
    SELECT sha256(claim_id) AS claim_key, member_id AS member_key, sha256(ndc_code) AS drug_key,
           sha256(npi_number) AS provider_key, service_date, claim_amount, quantity, days_supply, plan_id, claim_status
    FROM cleaned
)"""

_CLEAN = (RAW, DEDUPED, STANDARD, CLEANED)
_STAR = (*_CLEAN, DIM_DRUG, DIM_PROVIDER, DIM_DATE, FACT)


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH" + ",".join(parts) + "\n" + select.strip()


def _total(column: str = "claim_amount") -> str:
    return f"round(CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE), 2)"


def _mean(column: str = "claim_amount") -> str:
    return f"round(CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) / count({column}), 2)"


# One SELECT per quality check, over raw.
CHECKS = {
    "row_count": """
        SELECT 'Row count in valid range' AS "check", count(*) BETWEEN 1000 AND 10000000 AS passed,
               '(' || format('{:,}', count(*)) || ' rows)' AS detail FROM raw""",
    "null_claim_id": """
        SELECT 'No null claim_ids' AS "check", count(*) = count(claim_id) AS passed,
               '(' || (count(*) - count(claim_id)) || ' nulls found)' AS detail FROM raw""",
    "duplicate_claim_id": """
        SELECT 'No duplicate claim_ids' AS "check", count(DISTINCT claim_id) = count(*) AS passed,
               '(' || format('{:,}', count(DISTINCT claim_id)) || ' unique out of ' || format('{:,}', count(*)) || ')'
                   AS detail FROM raw""",
    "claim_amount": """
        SELECT 'claim_amount is positive' AS "check",
               coalesce(bool_and(coalesce(claim_amount BETWEEN 0.01 AND 1e12, false)), true) AS passed,
               '(min=' || printf('%.2f', min(claim_amount)) || ', max=' || printf('%.2f', max(claim_amount)) || ')'
                   AS detail FROM raw""",
    "quantity": """
        SELECT 'quantity is positive' AS "check", coalesce(bool_and(coalesce(quantity > 0, false)), true) AS passed,
               '(min=' || CAST(min(quantity) AS VARCHAR) || ')' AS detail FROM raw""",
    "days_supply": """
        SELECT 'days_supply between 1-365' AS "check",
               coalesce(bool_and(coalesce(days_supply BETWEEN 1 AND 365, false)), true) AS passed,
               '(' || count(DISTINCT days_supply) || ' distinct values, min=' || coalesce(CAST(min(days_supply) AS VARCHAR), 'nan')
                   || ', max=' || coalesce(CAST(max(days_supply) AS VARCHAR), 'nan') || ', '
                   || count(*) FILTER (NOT coalesce(days_supply BETWEEN 1 AND 365, false)) || ' rows outside)' AS detail FROM raw""",
    "claim_status": """
        SELECT 'claim_status values valid' AS "check",
               coalesce(bool_and(coalesce(claim_status IN ('PAID', 'ADJUDICATED', 'REVERSED', 'PENDING'), false)), true)
                   AS passed,
               '(' || count(DISTINCT claim_status) || ' distinct values, '
                   || count(*) FILTER (NOT coalesce(claim_status IN ('PAID', 'ADJUDICATED', 'REVERSED', 'PENDING'), false))
                   || ' rows unexpected)' AS detail FROM raw""",
    "service_date": """
        SELECT 'service_date is parseable' AS "check",
               count(*) = count(try_strptime(service_date, '%Y-%m-%d')) AS passed,
               '(' || (count(*) - count(try_strptime(service_date, '%Y-%m-%d'))) || ' unparseable dates)' AS detail
        FROM raw""",
}

_REPORT = "\nUNION ALL".join(CHECKS.values())


_RAW_COLUMNS = (
    "claim_id, member_id, ndc_code, drug_name, drug_class, npi_number, service_date, claim_amount, quantity, "
    "days_supply, plan_id, member_state, claim_status"
)

# A day with claims in the tables; see read_day in the registered query.
SCANNED_DAY = "1996-03-13"

# Asked as it stands here of the loaded tables, too.
WAREHOUSE_QUESTION = """
    SELECT drug_class, claim_status, count(*) AS claims
    FROM fact_claims JOIN dim_drug USING (drug_key) GROUP BY drug_class, claim_status"""

# Table names are filled in: those of the catalogue for Spark, the common table expressions for DuckDB.
CATALOGUE_QUESTION = """
    SELECT member_state, drug_class, "year", count(*) AS claims, min(plan_id) AS first_plan
    FROM {fact_claims} JOIN {dim_provider} USING (provider_key) JOIN {dim_drug} USING (drug_key)
    JOIN {dim_date} ON service_date = date_value
    WHERE member_state < 'F' AND claim_status = 'PAID'
    GROUP BY member_state, drug_class, "year"
"""

_AUDIT = _with(
    (*_STAR,),
    """
    SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM deduped) AS deduped_rows,
           (SELECT count(*) FROM deduped) - (SELECT count(*) FROM cleaned) AS rejected_rows,
           (SELECT count(*) FROM dim_drug) AS dim_drug_rows, (SELECT count(*) FROM dim_provider) AS dim_provider_rows,
           (SELECT count(*) FROM dim_date) AS dim_date_rows, (SELECT count(*) FROM fact_claims) AS fact_claims_rows,
           DATE '2024-01-01' AS run_date""",
)

QUERIES: dict[str, str] = {
    "claims_dedup": _with((RAW, DEDUPED), "SELECT * FROM deduped"),
    "claims_clean": _with(_CLEAN, "SELECT * FROM cleaned"),
    "claims_rejected": _with(
        (RAW, DEDUPED, STANDARD),
        """
        SELECT * FROM (
            SELECT *, concat_ws(',', CASE WHEN claim_amount BETWEEN 0.01 AND 1e12 THEN NULL ELSE 'claim_amount' END,
                                CASE WHEN quantity > 0 THEN NULL ELSE 'quantity' END,
                                CASE WHEN days_supply BETWEEN 1 AND 365 THEN NULL ELSE 'days_supply' END) AS reason
            FROM standard)
        WHERE reason <> ''""",
    ),
    "dim_drug": _with((*_CLEAN, DIM_DRUG), "SELECT * FROM dim_drug"),
    "dim_provider": _with((*_CLEAN, DIM_PROVIDER), "SELECT * FROM dim_provider"),
    "dim_date": _with((*_CLEAN, DIM_DATE), "SELECT * FROM dim_date"),
    "fact_claims": _with((*_CLEAN, FACT), "SELECT * FROM fact_claims"),
    "pipeline_summary": _with(
        _STAR,
        f"""
        SELECT count(*) AS total_claims, count(DISTINCT member_key) AS unique_members,
               count(DISTINCT drug_key) AS unique_drugs, {_total()} AS total_amount, {_mean()} AS avg_claim,
               round(min(claim_amount), 2) AS min_claim, round(max(claim_amount), 2) AS max_claim
        FROM fact_claims""",
    ),
    "claims_by_status": _with(
        _STAR,
        f"""
        SELECT claim_status, count(*) AS claims, {_total()} AS total_amount, {_mean()} AS avg_amount
        FROM fact_claims GROUP BY claim_status ORDER BY claims DESC, claim_status""",
    ),
    "top_drug_classes": _with(
        _STAR,
        f"""
        SELECT drug_class, count(*) AS claims, {_total()} AS total_revenue, {_mean()} AS avg_cost
        FROM fact_claims JOIN dim_drug USING (drug_key)
        GROUP BY drug_class ORDER BY total_revenue DESC, drug_class NULLS LAST LIMIT 5""",
    ),
    "top_drugs": _with(
        _STAR,
        f"""
        SELECT drug_name, drug_class, count(*) AS prescriptions, {_mean()} AS avg_cost
        FROM fact_claims JOIN dim_drug USING (drug_key)
        GROUP BY drug_name, drug_class
        ORDER BY prescriptions DESC, drug_name NULLS LAST, drug_class NULLS LAST LIMIT 5""",
    ),
    "top_states": _with(
        _STAR,
        f"""
        SELECT member_state AS state, count(*) AS claims, {_total()} AS total_amount
        FROM fact_claims JOIN dim_provider USING (provider_key)
        GROUP BY member_state ORDER BY claims DESC, state NULLS LAST LIMIT 5""",
    ),
    "claims_by_quarter": _with(
        _STAR,
        f"""
        SELECT "year", "quarter", count(*) AS claims, {_total()} AS total_amount
        FROM fact_claims JOIN dim_date ON service_date = date_value
        GROUP BY "year", "quarter" ORDER BY "year", "quarter" """,
    ),
    **{f"dq_{key}": _with((RAW,), select) for key, select in CHECKS.items()},
    "dq_report": _with((RAW,), _REPORT),
    "dq_summary": _with(
        (RAW,),
        f"""
        SELECT bool_and(passed) AS success, count(*) FILTER (WHERE passed) AS passed, count(*) AS total
        FROM ({_REPORT})""",
    ),
    "unexpected_statuses": _with(
        (RAW,),
        """
        SELECT claim_status FROM raw
        EXCEPT SELECT * FROM (VALUES ('PAID'), ('ADJUDICATED'), ('REVERSED'), ('PENDING'))""",
    ),
    "statuses_not_final": _with((RAW,), "SELECT claim_status FROM raw EXCEPT SELECT * FROM (VALUES ('PAID'), ('PENDING'))"),
    "csv_roundtrip": _with((RAW,), "SELECT * FROM raw"),
    "parquet_roundtrip": _with((RAW,), "SELECT * FROM raw"),
    "partitioned_day_scan": _with((RAW,), f"SELECT {_RAW_COLUMNS} FROM raw WHERE service_date = '{SCANNED_DAY}'"),
    "day_replay": _with((RAW,), f"SELECT {_RAW_COLUMNS} FROM raw"),
    "load_report": _with(
        _STAR,
        """
        SELECT t AS "table", sink, n AS "rows", true AS ok, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT 'dim_drug' AS t, count(*) AS n FROM dim_drug
              UNION ALL SELECT 'dim_provider', count(*) FROM dim_provider
              UNION ALL SELECT 'dim_date', count(*) FROM dim_date
              UNION ALL SELECT 'fact_claims', count(*) FROM fact_claims)
        CROSS JOIN (VALUES ('backup'), ('primary')) AS sinks(sink)""",
    ),
    "audit_counts": _AUDIT,
    "daily_run": _AUDIT,
    "warehouse_sql": _with(_STAR, WAREHOUSE_QUESTION),
    "warehouse_catalogue": _with(_STAR, CATALOGUE_QUESTION.format(**{t: t for t in ("dim_drug", "dim_provider", "dim_date", "fact_claims")})),
    "days_supply_values": _with((RAW,), "SELECT DISTINCT days_supply FROM raw ORDER BY days_supply"),
    "claim_status_values": _with((RAW,), "SELECT DISTINCT claim_status FROM raw ORDER BY claim_status"),
    "dq_found_values": _with(
        (RAW,),
        """
        SELECT 'days_supply between 1-365' AS "check", CAST(days_supply AS VARCHAR) AS value, count(*) AS claims
        FROM raw GROUP BY days_supply
        UNION ALL SELECT 'claim_status values valid', claim_status, count(*) FROM raw GROUP BY claim_status""",
    ),
}
