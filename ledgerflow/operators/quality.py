"""Data-quality checks.

Every check returns the failing rows.  Row checks need no shuffle; key checks
combine counts on the map side before they shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.setops import union_bricks
from ledgerflow.operators.skew import anti_join
from ledgerflow.sources.sinks import append_days


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys pass."""
    filled = df.dropna(subset=list(keys)) if len(keys) == 1 else df
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, where: Column | None = None
) -> DataFrame:
    """Child rows whose key is absent from the parent; NULL keys pass."""
    rows = child.where(F.col(column).isNotNull())
    if where is not None:
        rows = rows.where(where)
    return anti_join(rows, parent, {column: parent_column})


def accepted_range(df: DataFrame, column: str, minimum=None, maximum=None) -> DataFrame:
    outside = F.lit(False)
    if minimum is not None:
        outside = outside | (F.col(column) < F.lit(minimum))
    if maximum is not None:
        outside = outside | (F.col(column) > F.lit(maximum))
    return df.where(outside)


# fixed value: cents tolerated between the two sides of a ledger entry
TOLERANCE = 0.01


def double_entry(lines: DataFrame) -> DataFrame:
    """Transactions whose debits and credits differ by more than the tolerance."""
    sums = lines.groupBy("transaction_id").agg(F.sum("debit").alias("d"), F.sum("credit").alias("c"))
    gap = F.col("d") - F.col("c")
    return sums.where(F.abs(gap) > F.lit(TOLERANCE).cast("decimal(3,2)")).select(
        "transaction_id",
        *(c.cast("decimal(20,2)").alias(n) for n, c in (
            ("total_debit", F.col("d")), ("total_credit", F.col("c")), ("difference", gap),
        )),
    )


def debit_xor_credit(lines: DataFrame) -> DataFrame:
    """Ledger lines filled on both sides."""
    return lines.where((F.col("debit") > 0) & (F.col("credit") > 0)).select(
        "transaction_id", "line_number", "ledger_account", "debit", "credit"
    )


def single_open_version(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one open version."""
    return (
        versions.where(F.col("valid_to").isNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("open_versions"))
        .where("open_versions > 1")
    )


@dataclass(frozen=True)
class Check:
    """One check: its failing rows, how serious they are and what identifies a row."""

    name: str
    failing: DataFrame
    identity: str
    severity: str = "error"


def counted(checks: Sequence[Check]) -> DataFrame:
    """test, severity, failures, sample of every check."""

    def summary(check: Check) -> DataFrame:
        sample = F.min(F.col(check.identity).cast("string"))
        failing = check.failing.agg(F.count(F.lit(1)).alias("failures"), sample.alias("sample"))
        return failing.select(F.lit(check.name).alias("test"), F.lit(check.severity).alias("severity"), "failures", "sample")

    return union_bricks(summary(c) for c in checks)


def judged(counts: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Counts of failures as results of a run: test, status, severity, failures, sample, run_at."""
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    at = F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return counts.select("test", status.alias("status"), "severity", "failures", "sample", at.alias("run_at"))


def run_results(checks: Sequence[Check], run_at: dt.datetime) -> DataFrame:
    """One row per check: status, failing rows and a sample key."""
    return judged(counted(checks), run_at)


def store_run(results: DataFrame, path: str) -> DataFrame:
    """Add a run to the stored results, by its day; a run of the same day replaces it. Returns all runs."""
    append_days(results.withColumn("run_day", F.col("run_at").cast("date")), path, "run_day")
    return results.sparkSession.read.parquet(path).drop("_day")


def run_history(runs: DataFrame) -> DataFrame:
    """Per test: its runs, when it last passed, the state of its last run and the change of failures since the run before."""
    by_test = Window.partitionBy("test").orderBy("run_at")
    before = F.lag("failures").over(by_test)
    marked = runs.withColumn("change", F.col("failures") - before)
    last = F.struct("run_at", "status", "failures", "change")
    grouped = marked.groupBy("test").agg(
        F.count(F.lit(1)).alias("runs"), F.max(F.when(F.col("status") == "pass", F.col("run_day"))).alias("last_pass"), F.max_by(last, "run_at").alias("last")
    )
    return grouped.select("test", "runs", "last_pass", F.col("last.status").alias("status"), F.col("last.failures").alias("failures"), F.col("last.change").alias("change"))


def row_check_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(test, failures) of many row conditions in one pass over the table."""
    counted = df.agg(*(F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()))
    return counted.unpivot([], list(conditions), "test", "failures")


def volume_anomaly(
    series: DataFrame, group: str, day: str, metric: str, history: int = 7, threshold: float = 3.0
) -> DataFrame:
    """Z-score of a daily metric against the mean and deviation of all its earlier days.

    `series` holds one row per group and day, so a group is at most as long as
    the calendar.  The first `history` days get no score.
    """
    before = Window.partitionBy(group).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    scored = series.withColumns(
        {
            "points": F.count(metric).over(before),
            "mean": F.avg(metric).over(before),
            "deviation": F.stddev(metric).over(before),
        }
    )
    usable = (F.col("points") >= history) & (F.col("deviation") > 0)
    z = F.when(usable, (F.col(metric) - F.col("mean")) / F.col("deviation"))
    return scored.withColumn("z_score", z).withColumn(
        "anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False))
    )
