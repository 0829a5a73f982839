"""Eight data-quality checks on raw claims, as rows, as a summary and as a gate.

One pass folds the claims to one row per (days_supply, claim_status) and yields every count and extreme; a second pass
reads claim_id alone for the number of distinct ids, so the shuffle by claim_id carries nothing but the id, and a run
that has stored its de-duplicated claims counts those instead. Every check is an expression over the one row of
metrics, and asking for a single check lets Spark drop the columns it does not need. Details state facts of fixed size;
the values found, however many, are rows of `found_values_by_check`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.columns import date_of
from claimloom.functions.rules import AMOUNT_RANGE, DAYS_SUPPLY_RANGE, ROW_COUNT_RANGE, AmountRange, amount_within, one_of, positive, violated, within
from claimloom.schema import VALID_STATUSES


class DataQualityError(ValueError):
    """Raised by the gate; names the failed checks."""


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in expressions.items()]


def _profile(raw: DataFrame, amounts: AmountRange) -> DataFrame:
    """Counts and extremes per (days_supply, claim_status)."""
    grouped = ("bad_days", "bad_statuses", "min_day", "max_day")
    return raw.groupBy("days_supply", "claim_status").agg(*_named({n: sql for n, sql in row_measures(amounts).items() if n not in grouped}))


# What each row of the profile contributes: to the totals, to the days and to the statuses found.
_CONTRIBUTIONS = """stack(3,
    'total', int(NULL), string(NULL),
    'day', days_supply, string(NULL),
    'status', int(NULL), claim_status
) AS (kind, day, status)"""


def dq_metrics(raw: DataFrame, with_ids: bool = True, deduped: DataFrame | None = None, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """One row with everything the checks look at.

    `deduped` holds one stored row per claim_id of `raw`; its ids are then counted without shuffling them again.
    """
    bad_days = f"IF({violated(within('days_supply', DAYS_SUPPLY_RANGE))}, n, 0)"
    bad_statuses = f"IF({violated(one_of('claim_status', VALID_STATUSES))}, n, 0)"
    sums = ("n", "null_ids", "bad_amounts", "bad_quantities", "bad_days", "bad_statuses", "bad_dates")
    extremes = {"min_amount": "min", "max_amount": "max", "min_quantity": "min"}

    groups = (
        _profile(raw, amounts)
        .selectExpr("*", f"{bad_days} AS bad_days", f"{bad_statuses} AS bad_statuses", _CONTRIBUTIONS)
        .groupBy("kind", "day", "status")
        .agg(*_named({c: f"sum({c})" for c in sums} | {c: f"{f}({c})" for c, f in extremes.items()}))
    )
    metrics = groups.agg(
        *_named({c: f"coalesce(sum({c}) FILTER (WHERE kind = 'total'), 0)" for c in sums}),
        *_named({c: f"{f}({c}) FILTER (WHERE kind = 'total')" for c, f in extremes.items()}),
        *_named({"days": "count(day)", "min_day": "min(day)", "max_day": "max(day)", "statuses": "count(status)"}),
    )
    if with_ids:
        ids = raw.agg(F.countDistinct("claim_id")) if deduped is None else deduped.agg(F.count("claim_id"))
        metrics = metrics.select("*", ids.scalar().alias("ids"))
    return metrics


def row_measures(amounts: AmountRange = AMOUNT_RANGE) -> dict[str, str]:
    """Aggregates over raw claims that need no grouping, as SQL, to be taken while the claims are stored."""

    def without_nan(column: str) -> str:
        return f"IF(isnan({column}), NULL, {column})"

    return {
        "n": "count(1)",
        "null_ids": "count_if(claim_id IS NULL)",
        "bad_amounts": f"count_if({violated(amount_within(amounts))})",
        "bad_quantities": f"count_if({violated(positive('quantity'))})",
        "bad_days": f"count_if({violated(within('days_supply', DAYS_SUPPLY_RANGE))})",
        "bad_statuses": f"count_if({violated(one_of('claim_status', VALID_STATUSES))})",
        "bad_dates": f"count_if({date_of('service_date')} IS NULL)",
        "min_amount": f"min({without_nan('claim_amount')})",
        "max_amount": f"max({without_nan('claim_amount')})",
        "min_quantity": f"min({without_nan('quantity')})",
        "min_day": "min(days_supply)",
        "max_day": "max(days_supply)",
    }


def metrics_of(measures: dict, ids: int, found: DataFrame) -> DataFrame:
    """The row of `dq_metrics` from measures taken while the claims were stored, the number of de-duplicated claims with an id, and the
    stored values found: no pass over the claims."""

    def values(check: str) -> Column:
        return found.where(F.col("check") == CHECKS[check][0]).agg(F.count("value")).scalar()

    kinds = {"min_amount": "double", "max_amount": "double", "min_quantity": "double", "min_day": "int", "max_day": "int"}
    known = {**measures, "ids": ids}
    row = found.sparkSession.range(1).select(*[F.lit(value).cast(kinds.get(name, "bigint")).alias(name) for name, value in known.items()])
    return row.select("*", values("days_supply").alias("days"), values("claim_status").alias("statuses"))


def _two_decimals(value: str) -> str:
    return f"IF({value} IS NULL, 'nan', format_string('%.2f', {value}))"


# Check names and wording of the details, as (name, passed, detail) in report order.
CHECKS = {
    "row_count": (
        "Row count in valid range",
        within("n", ("{low}", "{high}")),
        "concat('(', format_number(n, 0), ' rows)')",
    ),
    "null_claim_id": (
        "No null claim_ids",
        "null_ids = 0",
        "concat('(', null_ids, ' nulls found)')",
    ),
    "duplicate_claim_id": (
        "No duplicate claim_ids",
        "ids = n",
        "concat('(', format_number(ids, 0), ' unique out of ', format_number(n, 0), ')')",
    ),
    "claim_amount": (
        "claim_amount is positive",
        "bad_amounts = 0",
        f"concat('(min=', {_two_decimals('min_amount')}, ', max=', {_two_decimals('max_amount')}, ')')",
    ),
    "quantity": (
        "quantity is positive",
        "bad_quantities = 0",
        "concat('(min=', nvl(string(min_quantity), 'nan'), ')')",
    ),
    "days_supply": (
        "days_supply between 1-365",
        "bad_days = 0",
        "concat('(', days, ' distinct values, min=', nvl(string(min_day), 'nan'), ', max=', nvl(string(max_day), 'nan'), "
        "', ', bad_days, ' rows outside)')",
    ),
    "claim_status": (
        "claim_status values valid",
        "bad_statuses = 0",
        "concat('(', statuses, ' distinct values, ', bad_statuses, ' rows unexpected)')",
    ),
    "service_date": (
        "service_date is parseable",
        "bad_dates = 0",
        "concat('(', bad_dates, ' unparseable dates)')",
    ),
}


RowRange = tuple[int, int]


def _check(key: str, rows: RowRange) -> tuple[str, str, str]:
    name, passed, detail = CHECKS[key]
    return name, passed.replace("{low}", str(int(rows[0]))).replace("{high}", str(int(rows[1]))), detail


def dq_check(raw: DataFrame, key: str, rows: RowRange = ROW_COUNT_RANGE, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """One check as one row (check, passed, detail). `rows` is the accepted batch size, `amounts` are the accepted ones, ends included."""
    name, passed, detail = _check(key, rows)
    metrics = dq_metrics(raw, key == "duplicate_claim_id", amounts=amounts)
    return metrics.selectExpr(f"'{name}' AS check", f"{passed} AS passed", f"{detail} AS detail")


def report_of(metrics: DataFrame, rows: RowRange = ROW_COUNT_RANGE) -> DataFrame:
    """All eight checks as rows, from the row of metrics."""
    checks = (_check(key, rows) for key in CHECKS)
    structs = ", ".join(
        f"struct('{name}' AS check, {passed} AS passed, {detail} AS detail)" for name, passed, detail in checks
    )
    return metrics.selectExpr(f"inline(array({structs}))")


def dq_report(raw: DataFrame, rows: RowRange = ROW_COUNT_RANGE, amounts: AmountRange = AMOUNT_RANGE) -> DataFrame:
    """All eight checks as rows. Only reports, whatever the outcome."""
    return report_of(dq_metrics(raw, amounts=amounts), rows)


def dq_summary(report: DataFrame) -> DataFrame:
    """One row: success, checks passed, checks in total."""
    return report.agg(
        F.bool_and("passed").alias("success"),
        F.count_if("passed").alias("passed"),
        F.count(F.lit(1)).alias("total"),
    )


def dq_gate(report: DataFrame, corrupt: DataFrame | None = None) -> None:
    """Stop the run when a check of the report failed (a report has eight rows) or a record is corrupt."""
    failed = [row["check"] for row in report.where(~F.col("passed")).collect()]
    if corrupt is not None and corrupt.head(1):
        failed.append("Records have all fields")
    if failed:
        raise DataQualityError(f"the batch was stopped by {len(failed)} of its checks: {', '.join(failed)}")


def unexpected_statuses(raw: DataFrame, valid: tuple[str, ...] = VALID_STATUSES) -> DataFrame:
    """Distinct raw statuses outside the valid set, NULL included: the set difference found minus valid.

    The valid set is a handful of literals, so the difference is a filter below the distinct, not an anti-join.
    """
    accepted = F.col("claim_status").isin(*valid) if valid else F.lit(False)
    return raw.where(~F.coalesce(accepted, F.lit(False))).select("claim_status").distinct()


def found_values(raw: DataFrame, column: str) -> DataFrame:
    """All distinct values of a column in order, NULL last."""
    return raw.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def found_values_by_check(raw: DataFrame) -> DataFrame:
    """Every value that the days_supply and claim_status checks met: rows (check, value, claims), NULL included."""
    pairs = raw.groupBy("days_supply", "claim_status").agg(F.count(F.lit(1)).alias("n"))
    days, status = CHECKS["days_supply"][0], CHECKS["claim_status"][0]
    values = pairs.selectExpr("n", f"stack(2, '{days}', string(days_supply), '{status}', claim_status) AS (check, value)")
    return values.groupBy("check", "value").agg(F.sum("n").alias("claims"))
