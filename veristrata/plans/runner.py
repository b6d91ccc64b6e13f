"""A validation run: plan, count, collect violations, write."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Expired
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lifecycle import diff
from ..operators.rules import Compiled, compile_rule
from ..schemas import ACTIVE, ERROR, FAILED, GROUP, METRICS, PASSED, RESULTS, RUN_FAILED, SUCCEEDED, VIOLATIONS, RuleError
from ..sources.catalog import Catalog, Rule, load_catalogs
from ..sources.source import scoped_source
from ..sources.store import MetastoreStore, append_metric, resolve_targets
from . import planner

#: Parts of an error's text or condition that tell its category.
INFRASTRUCTURE = ("timed out", "timeout", "connection", "unavailable", "executor lost", "out of memory", "throttle", "temporar")
SOURCE_DATA = ("table_or_view_not_found", "path_not_found", "unresolved_column", "no such file", "no column", "column_not_found")


@dataclass(frozen=True)
class Settings:
    fail_on_empty_source: bool = True
    max_rule_retries: int = 2
    rule_timeout_seconds: float = 300
    retryable_error_markers: tuple[str, ...] = ("timeout", "timed out", "temporar", "connection", "unavailable", "throttle")
    filter_overrides: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def parse(cls, raw: Mapping[str, Any]) -> Settings:
        """From upper- or lower-case keys; an unknown key is an error."""
        if not isinstance(raw, Mapping):
            raise TypeError("settings must be a mapping")
        names = {"catalog_filter_overrides": "filter_overrides"}
        low = {names.get(k.lower(), k.lower()): v for k, v in raw.items()}
        if unknown := set(low) - set(cls.__dataclass_fields__):
            raise ValueError(f"unknown settings {', '.join(sorted(unknown))}")
        if "retryable_error_markers" in low:
            low["retryable_error_markers"] = tuple(low["retryable_error_markers"])
        return cls(**low)

    def retryable(self, message: str | None) -> bool:
        return any(m in (message or "").lower() for m in self.retryable_error_markers)


@dataclass(frozen=True)
class RunContext:
    run_id: str
    run_timestamp: datetime

    @classmethod
    def new(cls, now: datetime | None = None) -> RunContext:
        return cls(str(uuid.uuid4()), now or datetime.now(UTC).replace(tzinfo=None))

    @property
    def batch_date(self) -> date:
        return self.run_timestamp.date()


def error_category(status: str, details: str | None, condition: str | None = None) -> str | None:
    if status != ERROR:
        return None
    text = f"{condition or ''} {details or ''}".lower()
    if any(m in text for m in INFRASTRUCTURE):
        return "infrastructure"
    return "source_data" if any(m in text for m in SOURCE_DATA) else "configuration"


@dataclass
class Verdict:
    """What a rule came to. Rules that were counted together share the time of their job."""

    rule: Rule
    total: int = 0
    failed: int = 0
    status: str = ERROR
    details: str = ""
    seconds: float = 0.0
    category: str | None = None
    compiled: Compiled | None = None
    seen: int | None = None

    @property
    def pct(self) -> float:
        return 0.0 if self.status == ERROR else 100.0 if not self.total else round((self.total - self.failed) / self.total * 100, 2)

    def judge(self, raw: tuple[int, int], seconds: float) -> None:
        self.seen = raw[0]
        self.total, self.failed = planner.finished(self.compiled, raw)
        self.seconds, self.category = seconds, None
        self.status = FAILED if self.failed else PASSED
        held = self.total - self.failed
        self.details = f"{self.compiled.describes}: holds for {held} and is broken by {self.failed} out of {self.total} {self.compiled.unit}"

    def fail(self, error: BaseException, seconds: float) -> None:
        condition = error.getCondition() if isinstance(error, PySparkException) else None
        self.total = self.failed = 0
        self.status, self.details, self.seconds = ERROR, str(error)[:4000], seconds
        self.category = error_category(ERROR, self.details, condition)


class Engine:
    """Validates catalogs on a session whose arithmetic is not ANSI: a predicate that can't
    be computed is not evaluated, it does not stop the run."""

    def __init__(self, spark: SparkSession, config: Mapping[str, str] | None = None, settings: Settings | Mapping | None = None, store=None, sleep: Callable[[float], None] = time.sleep, fuse: bool = True):
        self.spark, self.sleep, self.fuse = spark, sleep, fuse
        self.settings = settings if isinstance(settings, Settings) else Settings.parse(settings or {})
        self.targets = resolve_targets(config or {})
        self.store = store or MetastoreStore(spark)
        spark.conf.set("spark.sql.ansi.enabled", "false")

    def bounded(self, work: Callable[[], Any], seconds: float) -> Any:
        """Run a job in a thread; on time-out its Spark jobs are cancelled."""
        tag, sc = f"rule-{uuid.uuid4().hex}", self.spark.sparkContext

        def tagged():
            sc.addJobTag(tag)
            try:
                return work()
            finally:
                sc.removeJobTag(tag)

        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(tagged).result(seconds)
        except Expired:
            sc.cancelJobsWithTag(tag)
            raise TimeoutError(f"Timed out after {seconds:g} s") from None
        finally:
            pool.shutdown(wait=False)

    def _tried(self, v: Verdict, work: Callable[[], Any]) -> Any:
        """Work for one rule within its time-out, again after errors that may pass; a time-out is
        not tried again. An error that stays is the rule's verdict, and the result is null."""
        for attempt in range(self.settings.max_rule_retries + 1):
            began = time.monotonic()
            try:
                return self.bounded(work, self.settings.rule_timeout_seconds)
            except Exception as e:
                v.fail(e, time.monotonic() - began)
                if isinstance(e, TimeoutError) or attempt == self.settings.max_rule_retries or not self.settings.retryable(str(e)):
                    return None
                self.sleep(2.0 ** (attempt + 1))

    def _alone(self, df: DataFrame, v: Verdict) -> None:
        began = time.monotonic()
        if (raw := self._tried(v, lambda: planner.raw_counts(df, v.compiled))) is not None:
            v.judge(raw, time.monotonic() - began)

    def _collect(self, df: DataFrame, verdicts: list[Verdict]) -> list[tuple[Verdict, DataFrame]]:
        """The written violations of each failed rule, row checks together. A rule whose
        violations can't be written ends in error; the others go on. The number of rows, groups
        or tables that fail is that of the written ones, so the two agree even if the
        source changed since it was counted."""
        failed = [v for v in verdicts if v.status == FAILED]
        shared = [v for v in failed if v.compiled.record is not None]
        out: list[tuple[Verdict, DataFrame]] = []

        def written(group: list[Verdict]) -> DataFrame:
            return self.store.scratch(planner.violations(df, [v.compiled for v in group], [v.seen for v in group]))

        if len(shared) > 1:
            try:
                frame = self.bounded(lambda: written(shared), self.settings.rule_timeout_seconds)
                out += [(v, frame.where(F.col("rule_index") == i)) for i, v in enumerate(shared)]
            except Exception:  # one of them can't be computed: find out which
                shared = []
        else:
            shared = []
        for v in failed:
            if v not in shared and (frame := self._tried(v, lambda v=v: written([v]))) is not None:
                out.append((v, frame))
        for v, frame in out:
            n = frame.agg(F.count("*"), F.count_distinct("primary_key_value")).first()
            failures = n[1] if v.compiled.scope == GROUP else n[0]
            if failures != v.failed:
                v.judge((max(v.total, failures), failures) if v.compiled.finish is None else (v.seen, 0), v.seconds)
        return out

    def evaluate(self, catalog: Catalog, df: DataFrame) -> list[Verdict]:
        out = []
        for rule in catalog.rules:
            v = Verdict(rule)
            try:
                v.compiled = compile_rule(rule, df, catalog.pk_column)
            except (RuleError, PySparkException) as e:
                v.fail(e, 0.0)
            out.append(v)
        ready = [v for v in out if v.compiled]
        fused = [v for v in ready if v.compiled.count_columns] if self.fuse else []
        if len(fused) > 1:
            began = time.monotonic()
            try:
                found = self.bounded(lambda: planner.fused_raw(df, [v.compiled for v in fused]), self.settings.rule_timeout_seconds)
                share = (time.monotonic() - began) / len(fused)
                for v, x in zip(fused, found, strict=True):
                    v.judge(x, share)
            except Exception:  # one of them can't be computed: find out which
                fused = []
        else:
            fused = []
        for v in ready:
            if v not in fused:
                self._alone(df, v)
        return out

    def _head(self, run: RunContext, catalog: Catalog) -> list:
        return [F.lit(run.run_id).alias("run_id"), F.lit(run.run_timestamp).cast("timestamp").alias("run_timestamp"), F.lit(run.batch_date).alias("batch_date"), F.lit(catalog.rule_group).alias("rule_group")]

    def _source(self, catalog: Catalog) -> DataFrame:
        """What a catalog's rules see. Joins are computed once, and written, if rules beside the
        shared scan would compute them again."""
        df = scoped_source(self.spark, catalog, self.settings.filter_overrides, self.settings.fail_on_empty_source)
        alone = sum(r.kind_or_blank not in ("check", "row_count") for r in catalog.rules)
        return self.store.scratch(df) if catalog.joins and alone > 1 and len({c.lower() for c in df.columns}) == len(df.columns) else df

    def validate(self, catalog: Catalog, run: RunContext, df: DataFrame | None = None, written: bool = False) -> tuple[DataFrame, DataFrame]:
        """(results, violations) of a catalog, in the columns of the output tables. written:
        violations are computed once and kept in the store until the run ends."""
        if df is None:
            df = self._source(catalog) if written else scoped_source(self.spark, catalog, self.settings.filter_overrides, self.settings.fail_on_empty_source)
        verdicts = self.evaluate(catalog, df)
        if written:
            collected = self._collect(df, verdicts)
            failed = [v for v, _ in collected]
            frames = [f.withColumn("rule_index", F.lit(i)) for i, (_, f) in enumerate(collected)]
            found = reduce(DataFrame.unionByName, frames) if frames else planner.violations(df, [])
        else:
            failed = [v for v in verdicts if v.status == FAILED]
            found = planner.violations(df, [v.compiled for v in failed], [v.seen for v in failed])
        rows = [(run.run_id, run.run_timestamp, run.batch_date, catalog.rule_group, v.rule.rule_id, v.rule.name, catalog.full_table, v.rule.kind_or_blank, v.total, v.total - v.failed, v.failed, v.pct, v.status, v.details, round(v.seconds, 3), v.category) for v in verdicts]
        at = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs] or [F.lit("")]), F.col("rule_index") + 1)
        found = found.select(
            *self._head(run, catalog), at([v.rule.rule_id for v in failed]).alias("rule_id"), at([v.rule.name for v in failed]).alias("rule_name"), F.lit(catalog.full_table).alias("table_name"),
            "primary_key_value", "violated_column", "actual_value", "expected_condition", "violation_detail", F.lit(ACTIVE).alias("issue_status"), F.lit(None).cast("string").alias("resolution_timestamp"),
            F.lit(run.run_timestamp).cast("timestamp").alias("first_seen_at"), at([v.compiled.scope for v in failed]).alias("violation_scope"))
        return self.spark.createDataFrame(rows, RESULTS), found

    def run_catalogs(self, sources: Mapping[str, str], run: RunContext | None = None, written: bool = False) -> tuple[DataFrame, DataFrame, RunContext]:
        run = run or RunContext.new()
        results = violations = None
        for catalog in load_catalogs(sources):
            r, v = self.validate(catalog, run, written=written)
            results, violations = (r, v) if results is None else (results.unionByName(r), violations.unionByName(v))
        return results, violations, run

    def setup(self) -> dict[str, str]:
        """Create the output tables; returns their names."""
        for (key, name), schema in zip(self.targets.items(), (RESULTS, VIOLATIONS, METRICS), strict=True):
            self.store.ensure(name, schema)
        return self.targets

    def run(self, sources: Mapping[str, str], run: RunContext | None = None) -> tuple[DataFrame, RunContext]:
        """Validate and write: violations first, results last, so that a run with results is
        whole. Returns the results that were written."""
        try:
            results, found, run = self.run_catalogs(sources, run, written=True)
            name = self.targets["violations_table"]
            evaluated = results.where(F.col("status") != ERROR).select("rule_id")
            old = self.store.read(name) if self.store.exists(name) else self.spark.createDataFrame([], VIOLATIONS)
            try:
                self.store.replace(name, diff(old, found, run.run_timestamp, evaluated, results.select("rule_id")))
            except Exception as e:
                raise RuntimeError(f"Violations not written: {e}") from e
            self.store.append(self.targets["results_table"], results)
            return results, run
        finally:
            self.store.clear_scratch()

    def run_with_metrics(self, sources: Mapping[str, str], script_name: str = "run_validation", now: Callable[[], datetime] = lambda: datetime.now(UTC).replace(tzinfo=None)) -> tuple[DataFrame, RunContext]:
        """As run(), and a metric row whether it ends well or not; errors are raised again."""
        began = now()
        row: dict[str, Any] = {"script_name": script_name, "output_target": self.targets["results_table"], "artifact_target": self.targets["violations_table"], "started_at_utc": began}
        try:
            out = self.run(sources)
            row |= {"status": SUCCEEDED, "row_count": out[0].count(), "is_retryable": False}
            return out
        except Exception as e:
            row |= {"status": RUN_FAILED, "row_count": None, "is_retryable": self.settings.retryable(str(e)), "error_message": str(e)[:4000]}
            raise
        finally:
            ended = now()
            row |= {"finished_at_utc": ended, "duration_seconds": (ended - began).total_seconds()}
            df = self.spark.createDataFrame([tuple(row.get(f) for f in METRICS.names)], METRICS)
            if warning := append_metric(self.store, self.targets["metrics_table"], df):
                print(f"Warning: {warning}")
