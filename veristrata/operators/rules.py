"""The six rule types, compiled to columns or frames.

A compiled rule counts in the unit of its scope. ``check`` and ``row_count`` compile to
columns, so any number of them share one scan; the others are one aggregation each.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import predicate_problem, read_predicate, resolve
from ..schemas import GROUP, RECORD, ROW, TABLE, RuleError
from ..sources.catalog import Rule, as_list

AGGREGATES: dict[str, Callable[[str], Column]] = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Kind:
    scope: str
    unit: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()


KINDS = {
    "check": Kind(ROW, "rows"),
    "unique": Kind(ROW, "rows"),
    "row_count": Kind(TABLE, "tables", ("minimum", "maximum")),
    "event_flow": Kind(GROUP, "groups", ("event_column", "group_column", "order_column", "cycle"), ("starts_with", "ends_with", "completion_gate"), ("event_column", "group_column", "order_column")),
    "required_event": Kind(GROUP, "groups", ("event_column", "group_column", "value"), ("order_column",), ("event_column", "group_column", "order_column")),
    "aggregate_matches": Kind(GROUP, "groups", ("group_column", "aggregate_column", "reference_column"), ("aggregate", "tolerance"), ("group_column", "aggregate_column", "reference_column")),
}


@dataclass(frozen=True)
class Compiled:
    """counts: columns (total, failed) of one fused aggregation, or a frame with them.
    violations: a struct column that is null where nothing is violated, or a frame."""

    rule: Rule
    scope: str
    unit: str
    describes: str
    count_columns: tuple[Column, Column] | None = None
    record: Column | None = None
    counts: DataFrame | None = None
    violations: DataFrame | None = None
    finish: Callable[[int, int], tuple[int, int]] | None = None
    table_record: Callable[[int], tuple | None] | None = None


def _text(c: Column | str) -> Column:
    return (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")


def _shown(c: Column | str) -> Column:
    return F.coalesce(_text(c), F.lit("NULL"))


def _record(key, column: str | None, actual, condition: str, detail) -> list[Column]:
    values = (key, F.lit(column), actual, F.lit(condition), detail)
    return [(F.lit(None) if v is None else v).cast("string").alias(f.name) for v, f in zip(values, RECORD, strict=True)]


def _mapping(rule: Rule, kind: Kind) -> Mapping[str, Any]:
    cfg = rule.config
    if not isinstance(cfg, Mapping):
        raise RuleError(f"'{rule.kind}' must be a mapping")
    if missing := [k for k in kind.required if k not in cfg or cfg[k] is None or cfg[k] == "" or cfg[k] == []]:
        raise RuleError(f"'{rule.kind}' needs {', '.join(missing)}")
    if extra := set(cfg) - {*kind.required, *kind.optional}:
        raise RuleError(f"'{rule.kind}' has unknown keys {', '.join(sorted(map(str, extra)))}")
    return cfg


def _columns(df: DataFrame, *names: Any) -> list[str]:
    out = []
    for n in names:
        if not isinstance(n, str) or not n:
            raise RuleError(f"a column name must be a non-empty string, not {n!r}")
        found = resolve(n, df)
        if found is None:
            raise RuleError(f"there is no column {n}")
        out.append(found)
    return out


def _scope(rule: Rule, df: DataFrame) -> Column | None:
    when = rule.when
    if when is None:
        return None
    if problem := predicate_problem(df.where("false"), when):
        raise RuleError(f"'when': {problem}")
    return F.coalesce(F.expr(when), F.lit(False))


def _check(rule: Rule, df: DataFrame, pk: str) -> Compiled:
    text = rule.config
    if not isinstance(text, str) or not text.strip():
        raise RuleError("'check' must be a non-empty predicate")
    text = text.strip()
    if problem := predicate_problem(df.where("false"), text):
        raise RuleError(f"'check': {problem}")
    holds, scope = F.expr(text), _scope(rule, df)
    inside, fails = holds.isNotNull(), F.coalesce(~holds, F.lit(False))
    if scope is not None:
        inside, fails = scope & inside, scope & fails
    reading = read_predicate(df.sparkSession, text)
    subject = resolve(reading.subject, df) if reading.subject else None
    if subject:
        detail = F.concat(F.lit(f"{subject} = "), _shown(subject), F.lit(f"; must satisfy {text}"))
        if reading.words:
            detail = F.concat(detail, F.lit("; "), _shown(subject), F.lit(f" {reading.words} {reading.other}"))
        actual = _text(subject)
    else:
        detail, actual = F.lit(f"The row does not satisfy {text}"), None
    record = F.when(fails, F.struct(*_record(_text(pk), subject or reading.subject, actual, text, detail)))
    return Compiled(rule, ROW, "rows", text, (F.count_if(inside), F.count_if(fails)), record)


def _row_count(rule: Rule, df: DataFrame, pk: str | None) -> Compiled:
    cfg = _mapping(rule, KINDS["row_count"])
    try:
        low, high = int(cfg["minimum"]), int(cfg["maximum"])
    except (TypeError, ValueError):
        raise RuleError("'minimum' and 'maximum' must be integers") from None
    if low > high:
        raise RuleError(f"'minimum' {low} is greater than 'maximum' {high}")
    scope = _scope(rule, df)
    count = F.count("*") if scope is None else F.count_if(scope)

    def record(n: int) -> tuple | None:
        if low <= n <= high:
            return None
        return None, "row_count", str(n), f"{low} <= row_count <= {high}", f"{n} rows; between {low} and {high} are expected"

    return Compiled(rule, TABLE, "tables", f"row_count in [{low}, {high}]", (count, F.lit(0)), None, finish=lambda n, _: (1, int(record(n) is not None)), table_record=record)


def _scoped(rule: Rule, df: DataFrame) -> DataFrame:
    scope = _scope(rule, df)
    return df if scope is None else df.where(scope)


def _unique(rule: Rule, df: DataFrame, pk: str) -> Compiled:
    """Counts come from one aggregation by the columns, combined before the shuffle, so a key
    of a third of all rows is a few rows. Violating rows are a semi-join with the keys that
    occur more than once. Keys with a null are never duplicates."""
    cfg = rule.config
    names = [cfg] if isinstance(cfg, str) else cfg
    if not isinstance(names, list) or not names:
        raise RuleError("'unique' needs a column or a list of columns")
    cols = _columns(df, *names)
    scoped = _scoped(rule, df)
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(cols)]
    ks = [f"_k{i}" for i in range(len(cols))]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks])
    per = scoped.select(*keys).groupBy(*ks).agg(F.count("*").alias("_n"))
    counts = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when((F.col("_n") > 1) & whole, F.col("_n"))), F.lit(0)).alias("failed"))
    twice = per.where((F.col("_n") > 1) & whole).select(*ks)
    rows = scoped.select(_text(pk).alias("_pk"), *keys).join(twice, ks, "left_semi")
    named = ", ".join(cols)
    record = _record(F.col("_pk"), cols[0], F.concat_ws("|", *[_text(k) for k in ks]), f"UNIQUE({named})", F.lit(f"({named}) occurs more than once"))
    return Compiled(rule, ROW, "rows", f"UNIQUE({named})", counts=counts, violations=rows.select(*record))


def _reached(event: str, values: list, order: str | None) -> Column:
    got = _text(event).isin([str(v) for v in values])
    if order:
        got = got & F.col(f"`{order}`").isNotNull()
    return F.coalesce(got, F.lit(False))


def _required_event(rule: Rule, df: DataFrame, pk: str | None) -> Compiled:
    cfg = _mapping(rule, KINDS["required_event"])
    event, group = _columns(df, cfg["event_column"], cfg["group_column"])
    order = _columns(df, cfg["order_column"])[0] if cfg.get("order_column") is not None else None
    values = as_list(cfg["value"])
    scoped = _scoped(rule, df).select(F.col(f"`{group}`").alias("_g"), _reached(event, values, order).alias("_hit")).where("_g is not null")
    per = scoped.groupBy("_g").agg(F.bool_or("_hit").alias("_ok"))
    counts = per.agg(F.count("*").alias("total"), F.count_if(~F.col("_ok")).alias("failed"))
    shown = " or ".join(map(str, values))
    condition = f"Group must contain at least one row where {event} = '{cfg['value'] if not isinstance(cfg['value'], list) else shown}'" + (f" and {order} IS NOT NULL" if order else "")
    record = _record(_text("_g"), event, None, condition, F.lit(f"No row of the group has {event} {shown}"))
    return Compiled(rule, GROUP, "groups", condition, counts=counts, violations=per.where("not _ok").select(*record))


def _aggregate_matches(rule: Rule, df: DataFrame, pk: str | None) -> Compiled:
    cfg = _mapping(rule, KINDS["aggregate_matches"])
    group, column, reference = _columns(df, cfg["group_column"], cfg["aggregate_column"], cfg["reference_column"])
    name = str(cfg.get("aggregate", "sum")).lower()
    if name not in AGGREGATES:
        raise RuleError(f"the aggregate {name} is not one of {', '.join(AGGREGATES)}")
    try:
        tolerance = float(cfg.get("tolerance", 0.01))
    except (TypeError, ValueError):
        raise RuleError("'tolerance' must be a number") from None
    scoped = _scoped(rule, df).select(F.col(f"`{group}`").alias("_g"), F.col(f"`{column}`").alias("_v"), F.col(f"`{reference}`").alias("_r"))
    scoped = scoped.where("_g is not null and _v is not null and _r is not null")
    per = scoped.groupBy("_g", "_r").agg(AGGREGATES[name]("_v").alias("_a")).withColumn("_d", F.abs(F.col("_a") - F.col("_r")))
    bad = F.coalesce(F.col("_d") > tolerance, F.lit(False))
    by = per.groupBy("_g").agg(F.bool_or(bad).alias("_bad"))
    counts = by.agg(F.count("*").alias("total"), F.count_if("_bad").alias("failed"))
    condition = f"ABS({name.upper()}({column}) - {reference}) <= {tolerance}"
    detail = F.concat(F.lit(f"{name.upper()}({column}) is "), _shown("_a"), F.lit(f", {reference} is "), _shown("_r"), F.lit("; they differ by "), _shown("_d"))
    return Compiled(rule, GROUP, "groups", condition, counts=counts, violations=per.where(bad).select(*_record(_text("_g"), column, _text("_a"), condition, detail)))


@dataclass(frozen=True)
class Flow:
    event: str
    group: str
    order: str
    cycle: list[str]
    start: str | None
    ends: list[str]
    gate: tuple[str, list[str], str | None] | None

    @property
    def shown(self) -> str:
        return " → ".join([*([self.start] if self.start else []), f"({', '.join(self.cycle)})*", *([" or ".join(self.ends)] if self.ends else [])])


def parse_flow(rule: Rule, df: DataFrame) -> Flow:
    cfg = _mapping(rule, KINDS["event_flow"])
    event, group, order = _columns(df, cfg["event_column"], cfg["group_column"], cfg["order_column"])
    cycle = [str(x) for x in as_list(cfg["cycle"])]
    if not cycle or len(set(cycle)) < len(cycle):
        raise RuleError("'cycle' must be a list of different events")
    start = cfg.get("starts_with")
    if isinstance(start, (list, tuple, Mapping)):
        raise RuleError("'starts_with' must be a single event")
    start = None if start in (None, "") else str(start)
    ends = [str(x) for x in as_list(cfg.get("ends_with"))]
    if {start, *ends} & set(cycle) or start in ends:
        raise RuleError("'starts_with', 'cycle' and 'ends_with' must not share events")
    gate = None
    if (raw := cfg.get("completion_gate")) is not None:
        if not isinstance(raw, Mapping):
            raise RuleError("'completion_gate' must be a mapping")
        values = [str(v) for v in as_list(raw.get("value"))]
        if raw.get("event_column") and values:
            cols = _columns(df, raw["event_column"], *([raw["order_column"]] if raw.get("order_column") else []))
            gate = (cols[0], values, cols[1] if len(cols) > 1 else None)
    return Flow(event, group, order, cycle, start, ends, gate)


def flow_groups(df: DataFrame, flow: Flow) -> DataFrame:
    """One row per group in scope: _g, _bad, _event and _expected of the first offender.

    One shuffle by the group: running counts in one window, then one aggregation. Rows whose
    event is not declared, or without an order, only make their group known.
    """
    width, e = len(flow.cycle), _text(flow.event)
    rank = F.lit(None).cast("int")
    ranked = [*([(flow.start, 0)] if flow.start else []), *((c, i + 1) for i, c in enumerate(flow.cycle)), *((x, width + 1) for x in flow.ends)]
    for value, r in ranked:
        rank = F.when(e == value, r).otherwise(rank)
    order = F.col(f"`{flow.order}`")
    gate = F.lit(True)
    if flow.gate:
        gate = _reached(*flow.gate)
        if flow.ends:
            gate = gate | _reached(flow.event, flow.ends, None)
    rows = df.select(F.col(f"`{flow.group}`").alias("_g"), e.alias("_e"), order.alias("_o"), F.when(order.isNotNull(), rank).alias("_r"), gate.alias("_in")).where("_g is not null")
    by = Window.partitionBy("_g").orderBy("_o", "_r", "_e")
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_g")
    turn = F.col("_r").between(1, width)
    one = lambda c: F.when(c, 1).otherwise(0)
    rows = rows.withColumns({"_pos": F.sum(one(F.col("_r").isNotNull())).over(upto), "_last": F.sum(one(F.col("_r").isNotNull())).over(whole), "_c": F.sum(one(turn)).over(upto)})
    due = (F.col("_c") - 1) % width + 1
    off = F.coalesce(((F.col("_r") == 0) & (F.col("_pos") != 1)) | ((F.col("_r") == width + 1) & (F.col("_pos") != F.col("_last"))) | (turn & (F.col("_r") != due)), F.lit(False))
    names = F.array(*[F.lit(c) for c in flow.cycle])
    wanted = F.when(turn, F.element_at(names, due.cast("int")))
    per = rows.groupBy("_g").agg(
        F.bool_or("_in").alias("_in"), F.count_if(F.col("_r") == 0).alias("_starts"), F.count_if(F.col("_r") == width + 1).alias("_ends"), F.count_if(turn).alias("_n"),
        F.min(F.when(off, F.struct(F.col("_o").alias("o"), F.col("_e").alias("e"), wanted.alias("w")))).alias("_first"))
    broken = (F.col("_starts") > 1) | (F.col("_ends") > 1) | (F.col("_n") % width != 0)
    after = F.when(broken & (F.col("_n") > 0), F.element_at(names, (F.col("_n") % width + 1).cast("int")))
    return per.where("_in").select("_g", (broken | F.col("_first").isNotNull()).alias("_bad"), F.col("_first.e").alias("_event"), F.coalesce("_first.w", after).alias("_expected"))


def _event_flow(rule: Rule, df: DataFrame, pk: str | None) -> Compiled:
    flow = parse_flow(rule, df)
    per = flow_groups(_scoped(rule, df), flow)
    counts = per.agg(F.count("*").alias("total"), F.count_if("_bad").alias("failed"))
    head = F.when(F.col("_event").isNotNull(), F.concat(F.lit("'"), F.col("_event"), F.lit("' is out of place"))).otherwise(F.lit("the sequence is incomplete"))
    tail = F.when(F.col("_expected").isNotNull(), F.concat(F.lit("'"), F.col("_expected"), F.lit("' comes next"))).otherwise(F.lit(f"the order is {flow.shown}"))
    condition = f"Events must follow: {flow.shown}"
    record = _record(_text("_g"), flow.event, F.col("_event"), condition, F.concat(head, F.lit("; "), tail))
    return Compiled(rule, GROUP, "groups", condition, counts=counts, violations=per.where("_bad").select(*record))


_COMPILE = {"check": _check, "unique": _unique, "row_count": _row_count, "event_flow": _event_flow, "required_event": _required_event, "aggregate_matches": _aggregate_matches}


def compile_rule(rule: Rule, df: DataFrame, pk_column: str | None = None) -> Compiled:
    """Plan a rule over its source; RuleError if its definition doesn't fit. No job runs."""
    kind = rule.kind
    pk = rule.body.get("pk_column") or pk_column
    if KINDS[kind].scope == ROW:
        if not pk:
            raise RuleError("no primary key: set pk_column on the rule or the catalog")
        pk = _columns(df, pk)[0]
    return _COMPILE[kind](rule, df, pk)
