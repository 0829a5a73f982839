"""The daily run: check, clean, build the star schema, load it, audit it, answer the questions."""

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from claimloom.functions.rules import AMOUNT_RANGE, ROW_COUNT_RANGE
from claimloom.operators.audit import audit_of
from claimloom.operators.clean import judged_claims
from claimloom.operators.load import Rows, Sink, load_star, read_star
from claimloom.operators.quality import dq_gate, dq_metrics, found_values_by_check, metrics_of, report_of, row_measures
from claimloom.operators.star import build_star
from claimloom.plans.analytics import answer_all
from claimloom.plans.sizing import PARTITION_BYTES, fitted
from claimloom.plans.stages import StageStore, source_fingerprint
from claimloom.schema import CLEAN_CLAIMS, LOAD_ORDER
from claimloom.sources.files import size_of
from claimloom.sources.snapshots import published


@dataclass(frozen=True)
class RunResult:
    """Everything a run produced; all frames read stored files. `reused` names the stages taken up from an earlier run."""

    quality: DataFrame
    found_values: DataFrame
    star: dict[str, DataFrame]
    rejected: DataFrame
    load_report: DataFrame
    audit: DataFrame
    answers: dict[str, DataFrame]
    reused: tuple[str, ...] = ()


Claims = DataFrame | Callable[[], DataFrame]


def run(
    spark: SparkSession,
    raw: Claims,
    out: str,
    *,
    run_ts: datetime | None = None,
    run_date: date | None = None,
    strict: bool = True,
    salt: str | None = None,
    primary: Sink | None = None,
    primary_rows: Rows | None = None,
    corrupt: Claims | None = None,
    stage_raw: bool = True,
    input_bytes: int = 0,
    row_count_range: tuple[int, int] = ROW_COUNT_RANGE,
    amount_range: tuple[float, float] = AMOUNT_RANGE,
    partition_bytes: int = PARTITION_BYTES,
    resume: bool = False,
    source: str | None = None,
) -> RunResult:
    """Run the batch on `raw` and write everything below `out`.

    `stage_raw` first copies the claims to Parquet, so that a source that is costly to read (CSV, joins) is read
    once and the checks scan only the columns they need; turn it off for claims that already are Parquet.
    The de-duplicated claims are written once, with the reason of the rejected ones, and the fact and all dimensions
    read that copy: they agree on the chosen rows and nothing is shuffled by claim twice.
    Row, null and range counts are taken by the tasks that write these copies, so nothing is read only to be counted.
    The checks look at the raw values; that copy only spares them a second shuffle of all ids, so it is written
    first. Nothing is built or loaded when a check failed, unless the run is not `strict`.
    `corrupt` are records of the source that could not be read as claims: they are stored and counted in the audit, and
    one of them stops a strict run. `raw` and `corrupt` may be functions, called only when their stage is computed.
    `row_count_range` is the accepted batch size, both ends included: give a larger one for larger batches. `amount_range`
    are the accepted amounts of a claim, both ends included.
    `partition_bytes` is the input aimed at per shuffle partition; `input_bytes` tells the size of claims not staged.
    The tables become visible together when all are stored (`load_star`).

    `resume` takes up a run that broke off in the same `out`: every stage that is complete and whose inputs and arguments are the same is read
    back, others are computed; run_ts and run_date are those of the earlier run unless given. `source` names the state of
    the source, such as a fingerprint of its files; without it that of the files which `raw` reads is taken, and a source
    that is neither named nor read from files is computed anew with all that follows from it.
    """
    given, now = (run_ts, run_date), datetime.now()
    source = source or (None if callable(raw) else source_fingerprint(raw))
    stages = StageStore(spark, out, resume, source)
    run_ts = given[0] or datetime.fromisoformat(stages.remembered("run_ts", now.isoformat()))
    run_date = given[1] or date.fromisoformat(stages.remembered("run_date", run_ts.date().isoformat()))

    def frame(claims: Claims) -> DataFrame:
        return claims() if callable(claims) else claims

    origin = "source"
    if stage_raw:
        origin, claims = "raw_claims", raw
        raw = stages.keep(origin, lambda: frame(claims), ("source",), measures=row_measures(amount_range))
        input_bytes = size_of(spark, f"{out}/{origin}")
    else:
        raw = frame(raw)
    with fitted(spark, input_bytes, partition_bytes):
        judged = stages.keep(
            "judged_claims",
            lambda: judged_claims(raw, run_ts, salt, amount_range),
            (origin,),
            measures={"deduped": "count(1)", "rejected": "count_if(reason <> '')", "ids": "count(claim_id)"},
            run_ts=run_ts,
            salt=salt,
            amounts=amount_range,
        )
        known = stages.counts["judged_claims"]
        found = stages.keep("dq_found_values", lambda: found_values_by_check(raw), (origin,))

        def measured() -> DataFrame:
            """Claims that were staged were measured then; others are read for it."""
            if origin in stages.counts:
                return metrics_of(stages.counts[origin], known["ids"], found)
            return dq_metrics(raw, deduped=judged, amounts=amount_range)

        metrics = stages.keep("dq_metrics", measured, (origin, "judged_claims", "dq_found_values"), amounts=amount_range)
        quality = stages.keep("dq_report", lambda: report_of(metrics, row_count_range), ("dq_metrics",), rows=row_count_range)
        if corrupt is not None:
            records = corrupt
            corrupt = stages.keep("corrupt_records", lambda: frame(records), ("source",), measures={"n": "count(1)"})
        if strict:
            dq_gate(quality, corrupt)

        cleaned = judged.where("reason = ''").select(*CLEAN_CLAIMS.names)
        rejected = judged.where("reason <> ''")
        root = f"{out}/warehouse"
        report = stages.keep(
            "load_report",
            lambda: load_star(spark, build_star(cleaned), root, primary, primary_rows, fact_codec="zstd"),
            ("judged_claims",),
            complete=lambda rows: published(spark, root) is not None and not rows.where("NOT ok").head(1),
            primary=primary is not None,
        )
        star = read_star(spark, root)

        counts = {"raw": metrics.first()["n"]}
        if corrupt is not None:
            counts["corrupt"] = stages.counts["corrupt_records"]["n"]
        counts |= {"deduped": known["deduped"], "rejected": known["rejected"]}
        loaded_rows = {row["table"]: row["rows"] for row in report.where("sink = 'backup'").collect()}
        counts |= {name: loaded_rows[name] for name in LOAD_ORDER}
        loaded = ("load_report", "dq_metrics", *(("corrupt_records",) if corrupt is not None else ()))
        audit = stages.keep("audit", lambda: audit_of(spark, counts, run_date), loaded, run_date=run_date)
        answers = {
            title: stages.keep(f"answers/{re.sub('[^a-z0-9]+', '_', title.lower())}", lambda answer=answer: answer, ("load_report",))
            for title, answer in answer_all(star).items()
        }
        return RunResult(quality, found, star, rejected, report, audit, answers, tuple(stages.reused))
