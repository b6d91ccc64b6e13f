"""Checks of catalogs against real schemas, before any data is read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..functions.predicates import predicate_problem, resolve
from ..operators.rules import KINDS, compile_rule
from ..schemas import CatalogError, RuleError
from ..sources.catalog import RULE_KEYS, RULE_TYPES, Catalog, load_catalogs
from ..sources.source import joined_source, where_of
from ..sources.store import resolve_targets
from .runner import Settings


class PreflightError(ValueError):
    def __init__(self, problems: list[str]):
        super().__init__("\n".join(problems))
        self.problems = problems


def join_problems(spark: SparkSession, catalog: Catalog) -> list[str]:
    """Join tables and columns that don't exist. Names are compared as the session does."""
    out = []
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"

    def fold(names) -> set[str]:
        return set(names) if exact else {n.lower() for n in names}

    left = fold(spark.table(catalog.full_table).columns)
    for j in catalog.joins:
        if not spark.catalog.tableExists(j.table):
            out.append(f"{catalog.key}: the join table {j.table} does not exist")
            continue
        right = fold(spark.table(j.table).columns)
        out += [f"{catalog.key}: {j.table} has no column {c}" for c in (*j.select, *j.on, *([j.right_on] if j.right_on else [])) if not fold([c]) <= right]
        out += [f"{catalog.key}: the source has no column {c} to join on" for c in (*j.on, *([j.left_on] if j.left_on else [])) if not fold([c]) <= left]
        left |= fold(j.select) if j.select else right
    return out


def rule_problems(probe: DataFrame, catalog: Catalog) -> list[str]:
    out, seen = [], set()
    for rule in catalog.rules:
        label = f"{catalog.key}/{rule.rule_id}"
        if rule.rule_id in seen:
            out.append(f"{label}: the rule_id occurs twice")
        seen.add(rule.rule_id)
        if unknown := set(rule.body) - RULE_KEYS - set(RULE_TYPES):
            out.append(f"{label}: unknown keys {', '.join(sorted(map(str, unknown)))}")
        pk = rule.body.get("pk_column")
        if pk and resolve(str(pk), probe) is None:
            out.append(f"{label}: there is no column {pk}")
        try:
            kind = rule.kind
            if isinstance(rule.config, Mapping) and "completion_gate" in rule.config and "completion_gate" not in KINDS[kind].optional:
                out.append(f"{label}: '{kind}' takes no completion_gate")
                continue
            compile_rule(rule, probe, catalog.pk_column)
        except (RuleError, PySparkException) as e:
            out.append(f"{label}: {str(e).strip().splitlines()[0]}")
    return out


def preflight(spark: SparkSession, sources: Mapping[str, str], config: Mapping[str, str] | None = None, settings: Mapping | Settings | None = None) -> dict[str, int]:
    """Number of rules by catalog, if nothing is wrong; else one error that lists all. Missing
    source tables are reported before anything else."""
    settings = settings if isinstance(settings, Settings) else Settings.parse(settings or {})
    resolve_targets(config or {})
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        catalogs = load_catalogs(sources)
    except CatalogError as e:
        raise PreflightError(str(e).split("; ")) from None
    if missing := [f"{c.key}: the table {c.full_table} does not exist" for c in catalogs if not spark.catalog.tableExists(c.full_table)]:
        raise PreflightError(missing)
    out: list[str] = []
    for c in catalogs:
        out += [f"{c.key}: unknown key {k}" for k in c.unknown_keys]
        if found := join_problems(spark, c):
            out += found
            continue
        try:
            probe = joined_source(spark, c, probe=True)
            where = where_of(c, settings.filter_overrides)
        except (PySparkException, ValueError) as e:
            out.append(f"{c.key}: {str(e).strip().splitlines()[0]}")
            continue
        if where and (problem := predicate_problem(probe, where)):
            out.append(f"{c.key}: 'where': {problem}")
        if not c.pk_column:
            out.append(f"{c.key}: no pk_column")
        elif resolve(c.pk_column, probe) is None:
            out.append(f"{c.key}: there is no column {c.pk_column}")
        out += rule_problems(probe, c)
    if out:
        raise PreflightError(out)
    return {c.key: len(c.rules) for c in catalogs}
