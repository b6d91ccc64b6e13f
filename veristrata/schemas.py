"""Output tables, status words and errors."""

from __future__ import annotations

from pyspark.sql import types as T

PASSED, FAILED, ERROR = "PASSED", "FAILED", "ERROR"
ACTIVE, RESOLVED = "Active", "Resolved"
ROW, GROUP, TABLE = "row", "group", "table"
SUCCEEDED, RUN_FAILED = "Succeeded", "Failed"


class RuleError(ValueError):
    """A rule whose definition can't be evaluated; recorded as ERROR, the run goes on."""


class CatalogError(ValueError):
    """A catalog that can't be loaded; the run stops."""


def _table(*fields: str) -> T.StructType:
    """'name type' or 'name type !' for not null."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(p[0], kinds[p[1]], len(p) < 3) for p in (f.split() for f in fields)])


_HEAD = ("run_id string !", "run_timestamp timestamp !", "batch_date date !", "rule_group string !", "rule_id string !", "rule_name string !", "table_name string !")
RESULTS = _table(*_HEAD, "expectation string !", "total_rows long", "passed_rows long", "failed_rows long", "success_pct double", "status string !", "details string", "rule_duration_seconds double", "error_category string")
RECORD = _table("primary_key_value string", "violated_column string", "actual_value string", "expected_condition string", "violation_detail string")
VIOLATIONS = _table(*_HEAD, *(f"{f.name} string" for f in RECORD), "issue_status string !", "resolution_timestamp string", "first_seen_at timestamp", "violation_scope string")
METRICS = _table("script_name string", "status string", "output_target string", "artifact_target string", "row_count long", "started_at_utc timestamp", "finished_at_utc timestamp", "duration_seconds double", "is_retryable boolean", "error_message string")
OUTPUTS = {"results_table": RESULTS, "violations_table": VIOLATIONS, "metrics_table": METRICS}
