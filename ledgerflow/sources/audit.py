"""Load audit log: folding events, healing stuck runs, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.codes import job_result
from ledgerflow.functions.dates import minutes_between, seconds_between, timestamp_of_ints
from ledgerflow.operators.latest import latest_per_key

# fixed values of the audit rules
STUCK_MINUTES = 60
HEALED = "interrupted: previous execution did not finish (closed when starting a new load)"
ORPHANED = "interrupted: execution did not finish (closed by orphan cleanup)"


def _ts(now: dt.datetime) -> Column:
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def fold_status(events: DataFrame) -> DataFrame:
    """Event log (execution_id, table_name, at, event_id, status, row_count, message) -> one row per load.

    The last event decides: running, success with its row count, or error with
    its whole message.
    """
    keys = ["execution_id", "table_name"]
    # only an error's message is ever shown, so no other one is sorted or shuffled
    message = F.when(F.col("status") == "error", F.col("message")).alias("message")
    newest = F.max(F.struct("at", "event_id", "status", "row_count", message)).alias("last")
    status = F.col("last.status")
    return events.groupBy(*keys).agg(F.min("at").alias("started_at"), newest).select(
        *keys, "started_at",
        F.when(status != "running", F.col("last.at")).alias("finished_at"),
        status.alias("status"),
        F.when(status == "success", F.col("last.row_count")).alias("row_count"),
        F.col("last.message").alias("error_message"),
    )


def _interrupt(log: DataFrame, condition: Column, at: Column, message: str) -> DataFrame:
    return log.withColumns(
        {
            "finished_at": F.when(condition, at).otherwise(F.col("finished_at")),
            "error_message": F.when(condition, message).otherwise(F.col("error_message")),
            "status": F.when(condition, "interrupted").otherwise(F.col("status")),
        }
    )


def self_heal(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Close runs still `running` of every table that starts a new load.

    starts: (table_name, new_start), one row per table.
    """
    joined = log.join(starts, "table_name", "left")
    stale = (F.col("status") == "running") & F.col("new_start").isNotNull()
    return _interrupt(joined, stale, F.col("new_start"), HEALED).select(*log.columns)


def is_stuck(now: dt.datetime) -> Column:
    return (F.col("status") == "running") & (
        minutes_between(F.col("started_at"), _ts(now)) > STUCK_MINUTES
    )


def cleanup_orphans(log: DataFrame, now: dt.datetime) -> DataFrame:
    return _interrupt(log, is_stuck(now), _ts(now), ORPHANED)


def latest_loads(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["table_name"], "started_at", "id")


def issues(log: DataFrame, now: dt.datetime) -> DataFrame:
    """Tables whose latest load failed, was interrupted or is stuck; empty means all is well."""
    status = F.col("status")
    diagnosis = F.when(status.isin("error", "interrupted"), status).when(is_stuck(now), "stuck")
    elapsed = minutes_between(F.col("started_at"), F.coalesce(F.col("finished_at"), _ts(now)))
    return (
        latest_loads(log)
        .withColumn("diagnosis", diagnosis)
        .where(F.col("diagnosis").isNotNull())
        .withColumn("elapsed_min", elapsed)
    )


def job_latest_run(history: DataFrame, now: dt.datetime, prefix: str = "ingestion_") -> DataFrame:
    """Latest whole-job outcome (step 0) of every job with the name prefix."""
    whole = history.where(F.col("job").startswith(prefix) & (F.col("step_id") == 0))
    latest = latest_per_key(whole, ["job"], "run_date", "run_time", "instance_id")
    last_run = timestamp_of_ints(F.col("run_date"), F.col("run_time"))
    return latest.select(
        "job", job_result(F.col("run_status")).alias("result"), last_run.alias("last_run"),
        minutes_between(last_run, _ts(now)).alias("min_since"),
        F.col("run_duration").alias("duration_hhmmss"), "message",
    )


def round_summary(log: DataFrame, now: dt.datetime) -> DataFrame:
    """Outcome counts, rows and duration of one round of loads."""

    def counted(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1)).alias(status)

    return log.agg(
        F.count(F.lit(1)).alias("tables"),
        *(counted(s) for s in ("success", "error", "running")),
        F.sum("row_count").alias("total_rows"),
        seconds_between(
            F.min("started_at"), F.max(F.coalesce(F.col("finished_at"), _ts(now)))
        ).alias("total_sec"),
    )
