"""Reports over the output tables, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, ERROR, FAILED, PASSED, RESOLVED


def _of(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def run_summary(results: DataFrame, run_id: str) -> DataFrame:
    """Rules of a run by group and status, with the share that passed."""
    per = results.where(F.col("run_id") == run_id).groupBy("rule_group")
    score = F.round(_of(PASSED) * 100.0 / F.count("*"), 1)
    return per.agg(F.count("*").alias("total_rules"), _of(PASSED).alias("passed"), _of(FAILED).alias("failed"), _of(ERROR).alias("errors"), score.alias("quality_score_pct")).orderBy("rule_group")


def latest_run_id(results: DataFrame) -> str | None:
    return results.agg(F.max_by("run_id", F.struct("run_timestamp", "run_id"))).first()[0]


def latest_run_summary(results: DataFrame) -> DataFrame:
    return run_summary(results, latest_run_id(results)).drop("quality_score_pct")


def violations_by_status(violations: DataFrame) -> DataFrame:
    return violations.groupBy("issue_status").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "issue_status")


def top_slowest(results: DataFrame, n: int = 5) -> DataFrame:
    return results.select("rule_group", "rule_id", "rule_name", "rule_duration_seconds").orderBy(F.desc("rule_duration_seconds"), "rule_group", "rule_id").limit(n)


def latest_metrics(metrics: DataFrame, n: int = 10) -> DataFrame:
    cols = ("script_name", "status", "row_count", "started_at_utc", "finished_at_utc", "duration_seconds", "is_retryable", "error_message")
    return metrics.select(*cols).orderBy(F.desc("finished_at_utc")).limit(n)


def bi_measures(results: DataFrame, violations: DataFrame) -> DataFrame:
    """One row: the measures of the dashboard."""
    r = results.agg((_of(PASSED) * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias("dq_score_pct"), F.count("*").alias("total_rules"), _of(PASSED).alias("rules_passed"), _of(FAILED).alias("rules_failed"), _of(ERROR).alias("rules_in_error"), F.max("run_timestamp").alias("latest_run_timestamp"))
    v = violations.agg(F.count_if(F.col("issue_status") == ACTIVE).alias("active_violations"), F.count_if(F.col("issue_status") == RESOLVED).alias("resolved_violations"))
    return r.withColumn("k", F.lit(1)).join(v.withColumn("k", F.lit(1)), "k").drop("k")  # two single rows


def rule_group_status(results: DataFrame) -> DataFrame:
    return results.groupBy("rule_group", "status").agg(F.count("*").alias("rules"))


def backlog_by_column(violations: DataFrame) -> DataFrame:
    return violations.where(F.col("issue_status") == ACTIVE).groupBy("violated_column").agg(F.count("*").alias("active_violations"))


def resolution_trend(violations: DataFrame) -> DataFrame:
    """Violations first seen by day, and how many of them are active or resolved."""
    per = violations.groupBy(F.to_date("first_seen_at").alias("first_seen_date"))
    return per.agg(F.count_if(F.col("issue_status") == ACTIVE).alias("active"), F.count_if(F.col("issue_status") == RESOLVED).alias("resolved"))
