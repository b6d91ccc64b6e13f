"""Queries over the given tables, one for each operator of the engine, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.lifecycle import diff
from .operators.rules import compile_rule
from .plans import planner, reports
from .plans.runner import Engine, RunContext
from .schemas import VIOLATIONS, CatalogError
from .sources.catalog import Catalog, Join, Rule, parse_catalog
from .sources.source import joined_source, scoped_source

RUN = RunContext("run-2", datetime(2024, 2, 2, 3, 0))
EARLIER = RunContext("run-1", datetime(2024, 2, 1, 3, 0))
LATER = RunContext("run-3", datetime(2024, 2, 3, 3, 0))
KEYS = ("primary_key_value", "violated_column", "expected_condition")
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _rule(**body) -> Rule:
    return Rule(body.pop("rule_id", "R-1"), body.pop("name", "rule"), body)


def _violations(df: DataFrame, pk: str | None, *cols: str, **body) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.ansi.enabled", "false")
    return planner.violations(df, [compile_rule(_rule(**body), df, pk)]).select(*KEYS, *cols)


def _counts(df: DataFrame, pk: str | None, **body) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.ansi.enabled", "false")
    total, failed = planner.counts(df, compile_rule(_rule(**body), df, pk))
    return df.sparkSession.createDataFrame([(total, failed)], "total_rows long, failed_rows long")


def _add(name: str, sql: str, run: Callable[[SparkSession, str], DataFrame]) -> None:
    _queries[name] = run
    _sql[name] = sql


def _bad(pk: str, column: str | None, condition: str, source: str, where: str, extra: str = "") -> str:
    col = f"'{column}'" if column else "null::varchar"
    return f"select cast({pk} as varchar) as primary_key_value, {col} as violated_column, '{condition.replace(chr(39), chr(39) * 2)}' as expected_condition{extra} from {source} where {where}"


def _check(name: str, table: str, pk: str, column: str | None, text: str, sql_where: str | None = None, source=None, sql_source: str | None = None, detail: str | None = None, **more) -> None:
    build = source or (lambda s, d: _t(s, d, table))
    actual = f", cast({column or 'null'} as varchar) as actual_value"
    columns, extra = ("actual_value", *(["violation_detail"] if detail else [])), actual + (f", {detail} as violation_detail" if detail else "")
    _add(name, _bad(pk, column, text, sql_source or table, sql_where or f"not ({text})", extra), lambda s, d: _violations(build(s, d), pk, *columns, check=text, **more))


def _views(spark: SparkSession, d: str, *names: str) -> None:
    for n in names:
        _t(spark, d, n).createOrReplaceTempView(n)


def _joined(*tables: str, **catalog):
    def build(s: SparkSession, d: str) -> DataFrame:
        _views(s, d, *tables)
        return joined_source(s, Catalog("c", "c", rules=(), **catalog))

    return build


_ORDERS = Join("orders", left_on="l_orderkey", right_on="o_orderkey", how="inner", select=("o_orderdate", "o_totalprice"))
_lines = _joined("lineitem", "orders", table="lineitem", joins=(_ORDERS,))
_LINES = "lineitem join orders on l_orderkey = o_orderkey"
_PK = "concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar))"


def _lines_pk(s: SparkSession, d: str) -> DataFrame:
    return _lines(s, d).withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))


def _labelled(s: SparkSession, d: str) -> DataFrame:
    return _joined("documents", "labels", table="documents", joins=(Join("labels", on=("doc_id",), select=("quality", "toxic")),))(s, d)


_check("check_literal", "customer", "c_custkey", "c_acctbal", "c_acctbal >= 0", detail="'c_acctbal = ' || cast(c_acctbal as varchar) || '; must satisfy c_acctbal >= 0; ' || cast(c_acctbal as varchar) || ' is less than 0'")
_check("check_columns", "lineitem", "line", "l_shipdate", "l_shipdate >= o_orderdate", source=_lines_pk, sql_source=f"(select *, {_PK} as line from {_LINES})")
_add("join_left_on_right_on", "select p_brand, count(*)::bigint as lines, sum(p_size)::bigint as sizes, count_if(p_brand is null)::bigint as unknown from lineitem left join part on l_partkey = p_partkey group by p_brand",
     lambda s, d: _joined("lineitem", "part", table="lineitem", joins=(Join("part", left_on="l_partkey", right_on="p_partkey", select=("p_brand", "p_size")),))(s, d).groupBy("p_brand").agg(F.count("*").alias("lines"), F.sum("p_size").alias("sizes"), F.count_if(F.col("p_brand").isNull()).alias("unknown")))
_check("check_null_semantics", "documents", "doc_id", "quality", "quality = 1", source=_labelled, sql_source="documents left join labels using (doc_id)")
_check("check_fk", "documents", "doc_id", "quality", "quality IS NOT NULL", source=_labelled, sql_source="documents left join labels using (doc_id)")
_check("check_not_null", "orders", "o_orderkey", "big", "big IS NOT NULL", source=lambda s, d: _t(s, d, "orders").withColumn("big", F.expr("nullif(o_orderstatus, 'P')")), sql_source="(select *, nullif(o_orderstatus, 'P') as big from orders)")
_check("check_in", "orders", "o_orderkey", "o_orderstatus", "o_orderstatus IN ('F', 'O')", detail="'o_orderstatus = ' || o_orderstatus || '; must satisfy o_orderstatus IN (''F'', ''O'')'")
_check("check_like", "part", "p_partkey", "p_type", "p_type LIKE 'P%'")
_check("check_not_equal", "orders", "o_orderkey", "o_orderpriority", "o_orderpriority != '1-URGENT'")
_check("check_constant", "nation", "n_nationkey", None, "1 = 0")
_check("check_or_date", "orders", "o_orderkey", "o_orderdate", "o_orderdate >= DATE'1998-01-01' OR o_orderstatus = 'F'")
_check("check_division", "customer", "c_custkey", "c_acctbal", "c_acctbal / (c_nationkey % 3) > 0", sql_where="not (c_acctbal / nullif(c_nationkey % 3, 0) > 0)")
_check("check_date", "orders", "o_orderkey", "o_orderdate", "datediff(DATE'1998-12-31', CAST(o_orderdate AS DATE)) <= 700", sql_where="not (date_diff('day', cast(o_orderdate as date), date '1998-12-31') <= 700)")
_check("when_scope", "orders", "o_orderkey", "o_totalprice", "o_totalprice >= 100000", sql_where="o_orderstatus = 'F' and not (o_totalprice >= 100000)", when="o_orderstatus = 'F'")
_add("when_scope_counts", "select count(*)::bigint as total_rows, count_if(o_totalprice < 100000)::bigint as failed_rows from orders where o_orderstatus = 'F'", lambda s, d: _counts(_t(s, d, "orders"), "o_orderkey", check="o_totalprice >= 100000", when="o_orderstatus = 'F'"))


def _filtered(overrides=None):
    def build(s: SparkSession, d: str) -> DataFrame:
        _views(s, d, "orders")
        return scoped_source(s, Catalog("orders", "orders", "orders", (), where="o_orderpriority LIKE '1%'"), overrides)

    return build


_check("where_filter", "orders", "o_orderkey", "o_totalprice", "o_totalprice >= 100000", sql_where="o_orderpriority like '1%' and not (o_totalprice >= 100000)", source=_filtered())
_check("where_override", "orders", "o_orderkey", "o_totalprice", "o_totalprice >= 100000", sql_where="o_orderstatus = 'O' and not (o_totalprice >= 100000)", source=_filtered({"orders": "o_orderstatus = 'O'"}))
_check("where_disabled", "orders", "o_orderkey", "o_totalprice", "o_totalprice >= 100000", source=_filtered({"orders": None}))


def _guarded(s: SparkSession, d: str) -> DataFrame:
    """Whether a source is refused, and how many rows it has else: a table, and one without rows."""
    _views(s, d, "nation")
    _t(s, d, "nation").where("n_nationkey < 0").createOrReplaceTempView("no_nation")
    out = []
    for name in ("nation", "no_nation"):
        for fail in (True, False):
            try:
                out.append((name, fail, False, scoped_source(s, Catalog(name, name, name, ()), None, fail).count()))
            except CatalogError:
                out.append((name, fail, True, None))
    return s.createDataFrame(out, "source string, fail_on_empty boolean, refused boolean, rows_seen long")


_add("source_guard", "with t as (select 'nation' as source, count(*) as n from nation union all select 'no_nation', count(*) from nation where n_nationkey < 0) select source, f as fail_on_empty, f and n = 0 as refused, case when not (f and n = 0) then n end::bigint as rows_seen from t, (values (true), (false)) v(f)", _guarded)
_add("join_using", "select doc_id, quality, toxic from documents left join labels using (doc_id)", lambda s, d: _labelled(s, d).select("doc_id", "quality", "toxic"))
_add(
    "join_chain", "select n_nationkey, n_name, r_name, count(c_custkey)::bigint as customers from nation left join region on n_regionkey = r_regionkey left join customer on n_nationkey = c_nationkey group by all",
    lambda s, d: _joined("nation", "region", "customer", table="nation", joins=(Join("region", left_on="n_regionkey", right_on="r_regionkey", select=("r_name",)), Join("customer", left_on="n_nationkey", right_on="c_nationkey", select=("c_custkey",))))(s, d).groupBy("n_nationkey", "n_name", "r_name").agg(F.count("c_custkey").alias("customers")))

_add("unique_composite", _bad(_PK, "l_orderkey", "UNIQUE(l_orderkey, l_linenumber)", "lineitem", "true", ", cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) as actual_value") + " qualify count(*) over (partition by l_orderkey, l_linenumber) > 1",
     lambda s, d: _violations(_t(s, d, "lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber")), "line", "actual_value", unique=["l_orderkey", "l_linenumber"]))
_add("unique_single", _bad("doc_id", "text", "UNIQUE(text)", "documents", "text is not null") + " qualify count(*) over (partition by text) > 1", lambda s, d: _violations(_t(s, d, "documents"), "doc_id", unique="text"))
_add("unique_passing", _bad("o_orderkey", "o_orderkey", "UNIQUE(o_orderkey)", "orders", "true") + " qualify count(*) over (partition by o_orderkey) > 1", lambda s, d: _violations(_t(s, d, "orders"), "o_orderkey", unique="o_orderkey"))
_add("unique_null_keys", _bad("doc_id", "quality", "UNIQUE(quality, lang)", "documents left join labels using (doc_id)", "quality is not null and lang is not null") + " qualify count(*) over (partition by quality, lang) > 1", lambda s, d: _violations(_labelled(s, d), "doc_id", unique=["quality", "lang"]))
for _name, _low, _high in (("row_count_ok", 1, 100), ("row_count_low", 30, 100), ("row_count_high", 0, 10)):
    _add(_name, f"select null::varchar as primary_key_value, 'row_count' as violated_column, '{_low} <= row_count <= {_high}' as expected_condition, cast(count(*) as varchar) as actual_value from nation having count(*) not between {_low} and {_high}",
         lambda s, d, low=_low, high=_high: _violations(_t(s, d, "nation"), None, "actual_value", row_count={"minimum": low, "maximum": high}))


def _required(name: str, shown: str, values: list[str], more: str = "", **cfg) -> None:
    has = f"bool_or(o_orderstatus in ({', '.join(repr(v) for v in values)}))"
    condition = f"Group must contain at least one row where o_orderstatus = '{shown}'{more}"
    _add(name, _bad("o_custkey", "o_orderstatus", condition, "orders", "o_custkey is not null") + f" group by o_custkey having not {has}", lambda s, d: _violations(_t(s, d, "orders"), None, required_event={"event_column": "o_orderstatus", "group_column": "o_custkey", **cfg}))
    _add(f"{name}_totals", f"select count(*)::bigint as total_rows, count_if(not ok)::bigint as failed_rows from (select {has} as ok from orders where o_custkey is not null group by o_custkey)", lambda s, d: _counts(_t(s, d, "orders"), None, required_event={"event_column": "o_orderstatus", "group_column": "o_custkey", **cfg}))


_required("required_event", "F", ["F"], value="F")
_required("required_event_list", "F or P", ["F", "P"], value=["F", "P"])
_required("required_event_dated", "P", ["P"], " and o_orderdate IS NOT NULL", value="P", order_column="o_orderdate")


def _aggregate(name: str, function: str, column: str, reference: str, source, sql_source: str, group: str = "l_orderkey", tolerance=None) -> None:
    tol = 0.01 if tolerance is None else float(tolerance)
    cfg = {"group_column": group, "aggregate_column": column, "reference_column": reference, "aggregate": function} | ({} if tolerance is None else {"tolerance": tolerance})
    condition = f"ABS({function.upper()}({column}) - {reference}) <= {tol}"
    where = f"{group} is not null and {column} is not null and {reference} is not null"
    whole = function in ("count", "min", "max")  # sums of doubles differ in their last digits
    extra = f", cast({function}({column}) as varchar) as actual_value, '{function.upper()}({column}) is ' || {function}({column}) || ', {reference} is ' || {reference} || '; they differ by ' || abs({function}({column}) - {reference}) as violation_detail" if whole else f", round({function}({column}), 2)::double as actual_value"
    sql = _bad(group, column, condition, sql_source, where, extra) + f" group by {group}, {reference} having abs({function}({column}) - {reference}) > {tol}"

    def run(s: SparkSession, d: str) -> DataFrame:
        got = _violations(source(s, d), None, "actual_value", "violation_detail", aggregate_matches=cfg)
        return got if whole else got.withColumn("actual_value", F.round(F.col("actual_value").cast("double"), 2)).drop("violation_detail")

    _add(name, sql, run)
    _add(f"{name}_totals", f"select count(*)::bigint as total_rows, count_if(bad)::bigint as failed_rows from (select {group}, bool_or(bad) as bad from (select {group}, abs({function}({column}) - {reference}) > {tol} as bad from {sql_source} where {where} group by {group}, {reference}) group by {group})", lambda s, d: _counts(source(s, d), None, aggregate_matches=cfg))


def _with_max(s: SparkSession, d: str) -> DataFrame:
    df = _t(s, d, "lineitem")
    return df.join(df.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("top")), "l_orderkey")


_MAX = "lineitem join (select l_orderkey, max(l_linenumber) as top from lineitem group by l_orderkey) using (l_orderkey)"
_aggregate("aggregate_sum", "sum", "l_extendedprice", "o_totalprice", _lines, _LINES)
_aggregate("aggregate_count", "count", "l_linenumber", "top", _with_max, _MAX)
_aggregate("aggregate_avg", "avg", "l_quantity", "top", _with_max, _MAX, tolerance=20)
_aggregate("aggregate_min", "min", "l_linenumber", "top", _with_max, _MAX)
_aggregate("aggregate_max", "max", "l_linenumber", "top", _with_max, _MAX)
_aggregate("aggregate_tolerance", "sum", "l_extendedprice", "o_totalprice", _lines, _LINES, tolerance=100000)

_FLOW = {"event_column": "event_type", "group_column": "visit", "order_column": "ts", "cycle": ["click", "purchase"], "starts_with": "signup", "ends_with": "error"}


def _visits(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "events").withColumn("visit", F.concat_ws("|", "user_id", F.to_date("ts").cast("string")))


def _flow(name: str, cfg: dict, start: str | None, cycle: list[str], ends: list[str], shown: str, gate: str = "true") -> None:
    w = len(cycle)
    ranks = [*([(start, 0)] if start else []), *((c, i + 1) for i, c in enumerate(cycle)), *((e, w + 1) for e in ends)]
    rank = "case event_type " + " ".join(f"when '{e}' then {r}" for e, r in ranks) + " end"
    turn = f"coalesce(r between 1 and {w}, false)"
    names = "[" + ", ".join(f"'{c}'" for c in cycle) + "]"
    sql = f"""
with b as (select concat_ws('|', cast(user_id as varchar), cast(cast(ts as date) as varchar)) as g, event_type as e, ts as o, {rank} as r from events),
p as (select *, count(r) over w as pos, count(r) over (partition by g) as last, sum(case when {turn} then 1 else 0 end) over w as c
  from b window w as (partition by g order by o, r, e rows between unbounded preceding and current row)),
q as (select *, coalesce((r = 0 and pos <> 1) or (r = {w + 1} and pos <> last) or ({turn} and r <> (c - 1) % {w} + 1), false) as off, case when {turn} then {names}[((c - 1) % {w} + 1)::int] end as want from p),
s as (select g, count_if(r = 0) as ns, count_if(r = {w + 1}) as ne, count_if({turn}) as n, count_if(off) as nb, arg_min(e, (o, e)) filter (where off) as ev, arg_min(coalesce(want, ''), (o, e)) filter (where off) as want, bool_or({gate.replace("event_type", "e")}) as inside from q group by g),
v as (select *, ns > 1 or ne > 1 or n % {w} <> 0 as broken from s)
select g as primary_key_value, 'event_type' as violated_column, 'Events must follow: {shown}' as expected_condition, ev as actual_value from v where inside and (broken or nb > 0)"""
    _add(name, sql, lambda s, d: _violations(_visits(s, d), None, "actual_value", event_flow=cfg))
    totals = sql.rpartition("select g as primary_key_value")[0] + "select count(*)::bigint as total_rows, count_if(broken or nb > 0)::bigint as failed_rows from v where inside"
    _add(f"{name}_totals", totals, lambda s, d: _counts(_visits(s, d), None, event_flow=cfg))


_SHOWN = "signup → (click, purchase)* → error"
_flow("event_flow_full", _FLOW, "signup", ["click", "purchase"], ["error"], _SHOWN)
_flow("event_flow_cycle_only", {**{k: _FLOW[k] for k in ("event_column", "group_column", "order_column")}, "cycle": ["view", "click", "purchase"]}, None, ["view", "click", "purchase"], [], "(view, click, purchase)*")
_flow("event_flow_width_one", {**_FLOW, "cycle": ["click"], "ends_with": ["error", "purchase"]}, "signup", ["click"], ["error", "purchase"], "signup → (click)* → error or purchase")
_flow("event_flow_gated", {**{k: v for k, v in _FLOW.items() if k != "ends_with"}, "completion_gate": {"event_column": "event_type", "value": "view"}}, "signup", ["click", "purchase"], [], "signup → (click, purchase)*", "event_type = 'view'")
_flow("event_flow_gate_fallback", {**_FLOW, "completion_gate": {"event_column": "event_type", "value": "view", "order_column": "ts"}}, "signup", ["click", "purchase"], ["error"], _SHOWN, "event_type in ('view', 'error')")
_flow("event_flow_gate_list", {**_FLOW, "completion_gate": {"event_column": "event_type", "value": ["view", "click"]}}, "signup", ["click", "purchase"], ["error"], _SHOWN, "event_type in ('view', 'click', 'error')")

_CATALOG = {
    "rule_group": "Orders", "table": "orders", "pk_column": "o_orderkey",
    "rules": [
        {"rule_id": "O-1", "name": "price", "check": "o_totalprice >= 100000"},
        {"rule_id": "O-2", "name": "status", "check": "o_orderstatus IN ('F', 'O')", "when": "o_orderpriority LIKE '1%'"},
        {"rule_id": "O-3", "name": "key", "unique": "o_orderkey"},
        {"rule_id": "O-4", "name": "size", "row_count": {"minimum": 1, "maximum": 10}},
        {"rule_id": "O-5", "name": "filled", "required_event": {"event_column": "o_orderstatus", "group_column": "o_custkey", "value": "F"}},
        {"rule_id": "O-6", "name": "broken", "check": "no_such_column > 0"},
    ],
}
_CAT_SQL = """
with r(rule_id, expectation, total_rows, failed_rows) as (
  select 'O-1', 'check', count(*), count_if(o_totalprice < 100000) from orders union all
  select 'O-2', 'check', count(*), count_if(o_orderstatus not in ('F', 'O')) from orders where o_orderpriority like '1%' union all
  select 'O-3', 'unique', count(*), coalesce(sum(case when n > 1 then n else 0 end), 0) from (select o_orderkey, count(*) over (partition by o_orderkey) as n from orders) union all
  select 'O-4', 'row_count', 1, case when count(*) between 1 and 10 then 0 else 1 end from orders union all
  select 'O-5', 'required_event', count(*), count_if(not ok) from (select o_custkey, bool_or(o_orderstatus = 'F') as ok from orders group by o_custkey) union all
  select 'O-6', 'check', 0, 0),
s as (select *, case when rule_id = 'O-6' then 'ERROR' when failed_rows = 0 then 'PASSED' else 'FAILED' end as status from r)"""


def _orders(s: SparkSession, d: str, run: RunContext = RUN, df: DataFrame | None = None, fuse: bool = True) -> tuple[DataFrame, DataFrame]:
    df = _t(s, d, "orders") if df is None else df
    return Engine(s, fuse=fuse).validate(parse_catalog("orders", _CATALOG), run, df)


_RESULT_COLUMNS = ("rule_group", "rule_id", "expectation", "total_rows", "passed_rows", "failed_rows", "success_pct", "status", "error_category")
_RESULT_SQL = _CAT_SQL + " select 'Orders' as rule_group, rule_id, expectation, total_rows::bigint as total_rows, (total_rows - failed_rows)::bigint as passed_rows, failed_rows::bigint as failed_rows, case when status = 'ERROR' then 0 when total_rows = 0 then 100 else round((total_rows - failed_rows) / total_rows * 100, 2) end::double as success_pct, status, case when status = 'ERROR' then 'source_data' end as error_category from s"
_add("results_table", _RESULT_SQL, lambda s, d: _orders(s, d)[0].select(*_RESULT_COLUMNS))
_add("results_table_unfused", _RESULT_SQL, lambda s, d: _orders(s, d, fuse=False)[0].select(*_RESULT_COLUMNS))


def _keys_sql(where: str = "true") -> str:
    parts = [("O-1", "row", _bad("o_orderkey", "o_totalprice", "o_totalprice >= 100000", "orders", f"o_totalprice < 100000 and {where}")),
             ("O-2", "row", _bad("o_orderkey", "o_orderstatus", "o_orderstatus IN ('F', 'O')", "orders", f"o_orderpriority like '1%' and o_orderstatus not in ('F', 'O') and {where}")),
             ("O-4", "table", f"select null::varchar as primary_key_value, 'row_count' as violated_column, '1 <= row_count <= 10' as expected_condition from orders where {where} having count(*) not between 1 and 10"),
             ("O-5", "group", _bad("o_custkey", "o_orderstatus", "Group must contain at least one row where o_orderstatus = 'F'", "orders", where) + " group by o_custkey having not bool_or(o_orderstatus = 'F')")]
    return " union all ".join(f"select '{i}' as rule_id, '{scope}' as violation_scope, * from ({q})" for i, scope, q in parts)


_add("violations_table", _keys_sql(), lambda s, d: _orders(s, d)[1].select("rule_id", "violation_scope", *KEYS))


def _two_runs(s: SparkSession, d: str) -> DataFrame:
    """Two ranges of dates that have some in common and all together."""
    state = diff(s.createDataFrame([], VIOLATIONS), _orders(s, d, EARLIER, _dated(s, d, "o_orderdate < '1999-06-17'"))[1], EARLIER.run_timestamp)
    return diff(state, _orders(s, d, RUN, _dated(s, d, "o_orderdate >= '1996-06-17'"))[1], RUN.run_timestamp)


def _dated(s: SparkSession, d: str, where: str) -> DataFrame:
    return _t(s, d, "orders").where(where)


_A, _B = _keys_sql("o_orderdate < timestamp '1999-06-17'"), _keys_sql("o_orderdate >= timestamp '1996-06-17'")
_SAME = " and ".join(f"a.{k} is not distinct from b.{k}" for k in ("rule_id", *KEYS))
_LIFE = f"with a as ({_A}), b as ({_B}), j as (select coalesce(a.rule_id, b.rule_id) as rule_id, {', '.join(f'coalesce(a.{k}, b.{k}) as {k}' for k in KEYS)}, a.rule_id is not null as old, b.rule_id is not null as now from a full join b on {_SAME}) select rule_id, {', '.join(KEYS)}, case when now then 'Active' else 'Resolved' end as issue_status, case when old then 'run-1' else 'run-2' end as first_seen from j"


def _life(s: SparkSession, d: str) -> DataFrame:
    seen = F.when(F.col("first_seen_at") == F.lit(RUN.run_timestamp), "run-2").otherwise("run-1").alias("first_seen")
    return _two_runs(s, d).select("rule_id", *KEYS, "issue_status", seen)


_add("lifecycle_history", _LIFE, _life)


def _reopened(s: SparkSession, d: str) -> DataFrame:
    """A third run that finds the first one's violations again, each of them twice: what had been
    resolved opens a new episode beside its history."""
    found = _orders(s, d, LATER, _dated(s, d, "o_orderdate < '1999-06-17'"))[1]
    state = diff(_two_runs(s, d), found.unionByName(found), LATER.run_timestamp)
    seen = F.element_at(F.create_map(*[x for r in (EARLIER, RUN, LATER) for x in (F.lit(r.run_timestamp), F.lit(r.run_id))]), F.col("first_seen_at").cast("timestamp"))
    return state.select("rule_id", *KEYS, "issue_status", seen.alias("first_seen"))


_add("lifecycle_reopened", f"with h as ({_LIFE}), c as ({_A}) select rule_id, {', '.join(KEYS)}, 'Resolved' as issue_status, first_seen from h where issue_status = 'Resolved' union all select coalesce(a.rule_id, b.rule_id) as rule_id, {', '.join(f'coalesce(a.{k}, b.{k}) as {k}' for k in KEYS)}, case when b.rule_id is not null then 'Active' else 'Resolved' end, coalesce(a.first_seen, 'run-3') from (select * from h where issue_status = 'Active') a full join c b on {_SAME}", _reopened)
_add("lifecycle_new", f"select * from ({_LIFE}) where issue_status = 'Active' and first_seen = 'run-2'", lambda s, d: _life(s, d).where("issue_status = 'Active' and first_seen = 'run-2'"))
_add("lifecycle_still_active", f"select * from ({_LIFE}) where issue_status = 'Active' and first_seen = 'run-1'", lambda s, d: _life(s, d).where("issue_status = 'Active' and first_seen = 'run-1'"))
_add("lifecycle_resolved", f"select * from ({_LIFE}) where issue_status = 'Resolved'", lambda s, d: _life(s, d).where("issue_status = 'Resolved'"))

_SUMMARY = _CAT_SQL + " select 'Orders' as rule_group, count(*)::bigint as total_rules, count_if(status = 'PASSED')::bigint as passed, count_if(status = 'FAILED')::bigint as failed, count_if(status = 'ERROR')::bigint as errors"
_add("run_summary", _SUMMARY + ", round(count_if(status = 'PASSED') * 100.0 / count(*), 1)::double as quality_score_pct from s", lambda s, d: reports.run_summary(_orders(s, d)[0], RUN.run_id))
_add("latest_run_summary", _SUMMARY + " from s", lambda s, d: reports.latest_run_summary(_orders(s, d)[0].unionByName(_orders(s, d, EARLIER)[0])))
_add("violations_by_status", f"select issue_status, count(*)::bigint as cnt from ({_LIFE}) group by issue_status", lambda s, d: reports.violations_by_status(_two_runs(s, d)))
_add("rule_group_status", _CAT_SQL + " select 'Orders' as rule_group, status, count(*)::bigint as rules from s group by status", lambda s, d: reports.rule_group_status(_orders(s, d)[0]))
_add("backlog_by_column", f"select violated_column, count(*)::bigint as active_violations from ({_LIFE}) where issue_status = 'Active' group by violated_column", lambda s, d: reports.backlog_by_column(_two_runs(s, d)))
_add("resolution_trend", f"select case first_seen when 'run-1' then date '2024-02-01' else date '2024-02-02' end as first_seen_date, count_if(issue_status = 'Active')::bigint as active, count_if(issue_status = 'Resolved')::bigint as resolved from ({_LIFE}) group by 1", lambda s, d: reports.resolution_trend(_two_runs(s, d)))
_add("bi_measures", f"select r.*, v.* from (select * from ({_CAT_SQL} select count_if(status = 'PASSED') * 100.0 / count(*) ::double as dq_score_pct, count(*)::bigint as total_rules, count_if(status = 'PASSED')::bigint as rules_passed, count_if(status = 'FAILED')::bigint as rules_failed, count_if(status = 'ERROR')::bigint as rules_in_error from s)) r, (select count_if(issue_status = 'Active')::bigint as active_violations, count_if(issue_status = 'Resolved')::bigint as resolved_violations from ({_LIFE})) v",
     lambda s, d: reports.bi_measures(_orders(s, d)[0], _two_runs(s, d)).drop("latest_run_timestamp").withColumn("dq_score_pct", F.col("dq_score_pct").cast("double")))


def _timed(s: SparkSession, d: str) -> DataFrame:
    """Results of a run whose durations are given, as measured ones differ from run to run."""
    return _orders(s, d)[0].withColumn("rule_duration_seconds", F.expr("cast(substring(rule_id, 3) as double)"))


_add("top_slowest", "select 'Orders' as rule_group, 'O-' || i as rule_id, ['price', 'status', 'key', 'size', 'filled', 'broken'][i] as rule_name, i::double as rule_duration_seconds from range(2, 7) t(i)", lambda s, d: reports.top_slowest(_timed(s, d)))


def _metrics(s: SparkSession) -> DataFrame:
    from .schemas import METRICS

    rows = [("run_validation", "Succeeded", "dq_results", "dq_violations", i, EARLIER.run_timestamp, RUN.run_timestamp.replace(minute=i), 60.0 * i, False, None) for i in range(15)]
    return s.createDataFrame(rows, METRICS)


_add("latest_metrics", "select 'run_validation' as script_name, 'Succeeded' as status, i::bigint as row_count, 60.0::double * i as duration_seconds from range(5, 15) t(i)", lambda s, d: reports.latest_metrics(_metrics(s)).select("script_name", "status", "row_count", "duration_seconds"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
