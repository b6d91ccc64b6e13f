"""The validation engine on small inline tables."""

import random
import time
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
import yaml

import __spark_entry__ as entry
from veristrata import cli
from veristrata import queries as q
from veristrata.functions.predicates import predicate_problem, read_predicate
from veristrata.operators.lifecycle import diff
from veristrata.operators.rules import compile_rule, flow_groups, parse_flow
from veristrata.plans import planner
from veristrata.plans.preflight import PreflightError, preflight
from veristrata.plans.runner import Engine, RunContext, Settings, Verdict, error_category
from veristrata.schemas import METRICS, RESULTS, VIOLATIONS, CatalogError, RuleError
from veristrata.sources.catalog import Join, Rule, load_catalogs
from veristrata.sources.source import scoped_source, where_of
from veristrata.sources.store import MetastoreStore, SnapshotStore, append_metric, drift, resolve_targets, safe_name

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 1, 2, 0)


@pytest.fixture(scope="module", autouse=True)
def plain(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")


def rule(**body):
    return Rule("R", "r", body)


def run(df, pk=None, **body):
    c = compile_rule(rule(**body), df, pk)
    return planner.counts(df, c), sorted(map(tuple, planner.violations(df, [c]).drop("rule_index").collect()), key=str)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_check(spark):
    df = frame(spark, [(1, 5, 3), (2, 1, 3), (3, None, 3), (None, 0, 1)], "id int, a int, b int")
    counts, bad = run(df, "id", check="a >= b")
    assert counts == (3, 2) and [b[:4] for b in bad] == [("2", "a", "1", "a >= b"), (None, "a", "0", "a >= b")]
    assert "less than" in bad[0][4]
    assert run(df, "id", check="1 = 0")[1][0][1:3] == (None, None)
    assert run(df, "id", check="b / (a - 1) > 0")[0] == (2, 1)
    assert run(df, "id", check="A >= 0", when="b = 3")[0] == (2, 0)
    assert run(df, "id", check="a > 0", when="a > 100")[0] == (0, 0)
    for bad in ({"check": ""}, {"check": "a +"}, {"check": "a + 1"}, {"check": "a > 0", "when": " "}, {"check": "a > 0", "when": "zz > 1"}, {"check": "a > 0", "unique": "a"}, {}):
        with pytest.raises(RuleError):
            compile_rule(rule(**bad), df, "id")
    for pk in (None, "nope"):
        with pytest.raises(RuleError):
            compile_rule(rule(check="a > 0"), df, pk)
    assert compile_rule(rule(check="a > 0", pk_column="b"), df, "id")


def test_predicates(spark):
    assert read_predicate(spark, "b > 1 and a < b").columns == ("b", "a")
    r = read_predicate(spark, "a <> 3")
    assert (r.subject, r.words, r.other) == ("a", "equals", "3")
    assert read_predicate(spark, "1 = 0").subject is None and read_predicate(spark, "((").columns == ()
    probe = frame(spark, [], "a int, s string")
    assert predicate_problem(probe, "a > 1") is None and predicate_problem(probe, "size(a) > 0") and predicate_problem(probe, "a")


def test_unique_and_row_count(spark):
    df = frame(spark, [(1, "x", "y"), (2, "x", "y"), (3, "x", None), (4, "x", None), (5, "z", "y")], "id int, a string, b string")
    counts, bad = run(df, "id", unique=["a", "b"])
    assert counts == (5, 2) and [b[:4] for b in bad] == [("1", "a", "x|y", "UNIQUE(a, b)"), ("2", "a", "x|y", "UNIQUE(a, b)")]
    assert run(df, "id", unique="a")[0] == (5, 4)
    for low, high, n in ((5, 5, 0), (6, 9, 1), (0, 4, 1)):
        counts, bad = run(df, row_count={"minimum": low, "maximum": high})
        assert counts == (1, n) and len(bad) == n
    assert run(df, row_count={"minimum": 0, "maximum": 0}, when="a = 'none'")[0] == (1, 0)
    for cfg in ({"minimum": 3, "maximum": 1}, {"minimum": "x", "maximum": 1}, {"minimum": 1}, 7):
        with pytest.raises(RuleError):
            compile_rule(rule(row_count=cfg), df)
    for cfg in ([], ["nope"], 3):
        with pytest.raises(RuleError):
            compile_rule(rule(unique=cfg), df, "id")


def test_group_rules(spark):
    df = frame(spark, [("a", "open", 1.0, 3.0), ("a", "done", 2.0, 3.0), ("b", "open", 1.0, 5.0), (None, "open", 1.0, 9.0), ("c", None, None, 1.0)], "g string, e string, v double, r double")
    need = {"event_column": "e", "group_column": "g", "value": "done"}
    assert run(df, required_event=need)[0] == (3, 2)
    assert run(df, required_event={**need, "value": ["done", "open"]})[0] == (3, 1)
    assert run(df, required_event={**need, "order_column": "v"})[0] == (3, 2)
    agg = {"group_column": "g", "aggregate_column": "v", "reference_column": "r"}
    counts, bad = run(df, aggregate_matches=agg)
    assert counts == (2, 1) and bad[0][0] == "b" and bad[0][3] == "ABS(SUM(v) - r) <= 0.01"
    assert run(df, aggregate_matches={**agg, "tolerance": 4})[0] == (2, 0)
    for cfg in ({**agg, "aggregate": "median"}, {**agg, "tolerance": "x"}, {**agg, "group_column": "zz"}, {"group_column": "g"}):
        with pytest.raises(RuleError):
            compile_rule(rule(aggregate_matches=cfg), df)


def machine(events, start, cycle, ends):
    """The specification of event_flow, event by event: (failed, reported, expected)."""
    w = len(cycle)
    ranks = ({start: 0} if start else {}) | {c: i + 1 for i, c in enumerate(cycle)} | dict.fromkeys(ends, w + 1)
    seq = sorted(((o, ranks[e], e) for o, e in events if o is not None and e in ranks))
    off, c = [], 0
    for pos, (o, r, e) in enumerate(seq):
        want = None
        if 1 <= r <= w:
            want = cycle[c % w]
            wrong = e != want
            c += 1
        else:
            wrong = pos != 0 if r == 0 else pos != len(seq) - 1
        if wrong:
            off.append((o, e, want is not None, want))
    broken = sum(r == 0 for _, r, _ in seq) > 1 or sum(r == w + 1 for _, r, _ in seq) > 1 or c % w
    first = min(off, key=lambda x: (x[0], x[1])) if off else None
    want = first[3] if first else None
    return bool(off or broken), first and first[1], want or (cycle[c % w] if broken and c else None)


@pytest.mark.parametrize("start,cycle,ends", [("S", ["A", "B"], ["E"]), (None, ["A"], ["E", "F"]), ("S", ["A", "B", "C"], [])])
def test_event_flow(spark, start, cycle, ends):
    r = random.Random(len(cycle))
    made = {f"g{i}": [(r.choice([None, 1, 2, 3, 4, 5, 6]), r.choice(["S", "A", "B", "C", "E", "F", "noise", None])) for _ in range(r.randrange(7))] for i in range(400)}
    rows = [(g, e, o) for g, events in made.items() for o, e in events] + [(None, "A", 1)]
    df = frame(spark, rows, "g string, e string, o int")
    cfg = {"event_column": "e", "group_column": "g", "order_column": "o", "cycle": cycle} | ({"starts_with": start} if start else {}) | ({"ends_with": ends} if ends else {})
    got = {x[0]: (x[1], x[2], x[3]) for x in flow_groups(df, parse_flow(rule(event_flow=cfg), df)).collect()}
    want = {g: machine(e, start, cycle, ends) for g, e in made.items() if e}
    assert set(got) == set(want)
    for g, (failed, event, expected) in want.items():
        assert got[g][0] == failed and (not failed or got[g][1:] == (event, expected)), (g, made[g])
    for wrong in ({"cycle": []}, {"cycle": ["A", "A"]}, {"starts_with": ["S"]}, {"starts_with": cycle[0]}, {"event_column": "zz"}, {"completion_gate": 3}):
        with pytest.raises(RuleError):
            compile_rule(rule(event_flow={**cfg, **wrong}), df)
    gated = {**cfg, "completion_gate": {"event_column": "e", "value": "noise"}}
    groups = {x[0] for x in flow_groups(df, parse_flow(rule(event_flow=gated), df)).collect()}
    assert groups == {g for g, e in made.items() if any(x in ("noise", *ends) for _, x in e)}


YAML = """
rule_group: Items
table: items
pk_column: id
where: a IS NOT NULL
joins:
  - {table: other, on: id, select: [b]}
rules:
  - {rule_id: 1, name: positive, check: a > 0}
  - {rule_id: 2, name: broken, check: nothing > 0}
  - {rule_id: 3, name: known, check: b IS NOT NULL}
  - {rule_id: 4, name: once, unique: id}
"""


@pytest.fixture
def items(spark):
    frame(spark, [(1, 1), (2, -1), (2, 5), (3, None)], "id int, a int").createOrReplaceTempView("items")
    frame(spark, [(1, "x")], "id int, b string").createOrReplaceTempView("other")


def test_catalogs(spark, items):
    (c,) = load_catalogs({"items": YAML})
    assert c.joins == (Join("other", ("id",), select=("b",)),) and [r.rule_id for r in c.rules] == ["1", "2", "3", "4"]
    assert scoped_source(spark, c).count() == 3 and where_of(c, {"Items": None}) is None and where_of(c, {"Other": "x"}) == "a IS NOT NULL"
    with pytest.raises(ValueError):
        where_of(c, ["x"])
    with pytest.raises(CatalogError) as e:
        load_catalogs({"b": "a: [", "a": "just text", "c": "table: t", "d": "table: t\nrules: [3]", "e": "table: t\nrules: [{name: x}]", "f": "table: t\nrules: [{rule_id: 1, name: x}]\njoins: [{table: z}]"})
    assert all(f"{k}:" in str(e.value) for k in "abcdef")
    with pytest.raises(CatalogError):
        load_catalogs({})
    with pytest.raises(TypeError):
        load_catalogs([YAML])
    assert Join.parse(yaml.safe_load("{table: t, on: k}")).on == ("k",)
    frame(spark, [], "id int, a int").createOrReplaceTempView("items")
    with pytest.raises(CatalogError, match="empty"):
        scoped_source(spark, c)


def test_preflight(spark, items):
    with pytest.raises(PreflightError) as e:
        preflight(spark, {"items": YAML})
    assert len(e.value.problems) == 1 and "items/2" in e.value.problems[0]
    good = YAML.replace("nothing > 0", "a < 9")
    assert preflight(spark, {"items": good}) == {"items": 4}
    bad = good.replace("table: items", "table: items\ncolour: red").replace("pk_column: id", "pk_column: zz").replace("a IS NOT NULL", "a + 1").replace("rule_id: 4, name: once", "rule_id: 3, name: once, speed: 1, completion_gate: x")
    with pytest.raises(PreflightError) as e:
        preflight(spark, {"items": bad})
    assert all(any(w in p for p in e.value.problems) for w in ("colour", "zz", "'where'", "twice", "speed"))
    for old, new in (("table: items", "table: none"), ("table: other", "table: none"), ("select: [b]", "select: [q]"), ("on: id", "on: q")):
        with pytest.raises(PreflightError):
            preflight(spark, {"items": good.replace(old, new)})


def test_run_and_lifecycle(spark, items, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    engine = Engine(spark, settings={"MAX_RULE_RETRIES": 0}, store=store)
    engine.setup()
    results, ctx = engine.run({"items": YAML}, RunContext("one", NOW))
    got = {r.rule_id: (r.status, r.total_rows, r.failed_rows, r.success_pct, r.error_category) for r in store.read(engine.targets["results_table"]).collect()}
    assert got == {"1": ("FAILED", 3, 1, 66.67, None), "2": ("ERROR", 0, 0, 0.0, "source_data"), "3": ("FAILED", 3, 2, 33.33, None), "4": ("FAILED", 3, 2, 33.33, None)}
    name = engine.targets["violations_table"]
    assert store.read(name).count() == 3 and [f.name for f in store.read(name).schema] == VIOLATIONS.names  # equal keys of one rule are one violation
    frame(spark, [(1, 1), (2, 7)], "id int, a int").createOrReplaceTempView("items")
    engine.run({"items": YAML}, RunContext("two", NOW.replace(day=2)))
    state = {(r.rule_id, r.primary_key_value): (r.issue_status, r.first_seen_at, r.resolution_timestamp) for r in store.read(name).collect()}
    assert state == {("1", "2"): ("Resolved", NOW, "2024-05-02T02:00:00"), ("3", "2"): ("Active", NOW, None), ("4", "2"): ("Resolved", NOW, "2024-05-02T02:00:00")}
    with pytest.raises(CatalogError):
        engine.run_with_metrics({"items": "x"})
    engine.run_with_metrics({"items": YAML}, now=lambda: NOW)
    assert [r.status for r in store.read(engine.targets["metrics_table"]).orderBy("status").collect()] == ["Failed", "Succeeded"]
    a, b = (Engine(spark, fuse=f).validate(load_catalogs({"items": YAML})[0], ctx) for f in (True, False))
    cut = ["rule_id", "status", "total_rows", "failed_rows", "details"]
    assert sorted(a[0].select(cut).collect()) == sorted(b[0].select(cut).collect()) and a[1].count() == b[1].count()


def test_diff_keeps_errors_and_nulls(spark):
    def row(rule_id, pk, status="Active", seen=NOW, run="r0"):
        return (run, NOW, NOW.date(), "g", rule_id, "n", "t", pk, None, "1", "c", "d", status, None, seen, "row")

    old = frame(spark, [row("a", None), row("b", "1"), row("gone", "1"), row("a", "9", "Resolved"), row("a", "8", None)], "run_id string, run_timestamp timestamp, batch_date date, rule_group string, rule_id string, rule_name string, table_name string, primary_key_value string, violated_column string, actual_value string, expected_condition string, violation_detail string, issue_status string, resolution_timestamp string, first_seen_at timestamp, violation_scope string")
    later = NOW.replace(day=3)
    now = frame(spark, [row("a", None, seen=later, run="r1"), row("a", None, seen=later, run="r1"), row("a", "9", seen=later, run="r1")], VIOLATIONS)
    ids = lambda *x: frame(spark, [(i,) for i in x], "rule_id string")
    out = sorted((r.rule_id, r.primary_key_value or "", r.issue_status or "", r.first_seen_at.day) for r in diff(old, now, later, ids("a"), ids("a", "b")).collect())
    assert out == [("a", "", "Active", 1), ("a", "8", "", 1), ("a", "9", "Active", 3), ("a", "9", "Resolved", 1), ("b", "1", "Active", 1), ("gone", "1", "Resolved", 1)]
    with pytest.raises(ValueError):
        diff(old, now.drop("rule_id"), later)


def test_retry_and_timeout(spark):
    slept = []
    engine = Engine(spark, settings=Settings(max_rule_retries=2, rule_timeout_seconds=5), sleep=slept.append)
    df = frame(spark, [(1, 1)], "id int, a int")
    v = Verdict(rule(check="a > 0"), compiled=compile_rule(rule(check="a > 0"), df, "id"))
    calls = []

    def flaky(*_):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("connection lost")
        return 1, 0

    engine.bounded = lambda work, s: flaky()
    engine._alone(df, v)
    assert v.status == "PASSED" and slept == [2.0, 4.0]
    engine = Engine(spark, settings=Settings(rule_timeout_seconds=0.2))
    with pytest.raises(TimeoutError):
        engine.bounded(lambda: time.sleep(2), 0.2)
    assert error_category("ERROR", "Timed out after 5 s") == "infrastructure" and error_category("PASSED", "timeout") is None and error_category("ERROR", "x") == "configuration"
    with pytest.raises(ValueError):
        Settings.parse({"colour": 1})


def test_store(spark, tmp_path):
    with pytest.raises(ValueError):
        safe_name("a; drop")
    assert resolve_targets({"schema": "s", "results_table": "x.y"}) == {"results_table": "x.y", "violations_table": "s.dq_violations", "metrics_table": "s.dq_metrics"}
    store = MetastoreStore(spark)
    store.ensure("q_demo.results", RESULTS)
    store.ensure("q_demo.results", RESULTS)
    assert not drift(store.read("q_demo.results").schema, RESULTS)
    with pytest.raises(RuntimeError):
        store.ensure("q_demo.results", METRICS)
    store.append("q_demo.results", frame(spark, [("r", 1)], "run_id string, extra int"))
    store.replace("q_demo.results", store.read("q_demo.results").union(store.read("q_demo.results")))
    assert store.read("q_demo.results").count() == 2
    metric = frame(spark, [("s", "Succeeded", None, None, 1, NOW, NOW, 0.0, False, None)], METRICS)
    assert "bare" not in (append_metric(store, "nowhere_db.q_metrics", metric) or "") and store.exists("q_metrics")
    snap = SnapshotStore(spark, f"file://{tmp_path}/snap")
    snap.ensure("t", METRICS)
    snap.append("t", metric)
    snap.replace("t", snap.read("t").union(metric))
    assert snap.read("t").count() == 2


def test_counts_and_violations_agree(spark, items, tmp_path, monkeypatch):
    """The source changes between counting and collecting; results say what was written."""
    path = f"{tmp_path}/moving"
    frame(spark, [(1, 1), (2, -1)], "id int, a int").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("items")
    real = planner.violations

    def moved(df, rules, seen=None):
        frame(spark, [(3, -3), (4, -4), (4, -5)], "id int, a int").write.mode("append").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView("items")
        return real(spark.table("items").join(spark.table("other"), "id", "left"), [compile_rule(r.rule, spark.table("items").join(spark.table("other"), "id", "left"), "id") for r in rules], seen)

    monkeypatch.setattr(planner, "violations", moved)
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    engine = Engine(spark, settings={"MAX_RULE_RETRIES": 0}, store=store)
    text = YAML.replace("unique: id", "row_count: {minimum: 1, maximum: 1}")
    results, _ = engine.run({"items": text}, RunContext("one", NOW))
    written = {r.rule_id: r["count"] for r in store.read(engine.targets["violations_table"]).groupBy("rule_id").count().collect()}
    got = {r.rule_id: (r.total_rows, r.passed_rows, r.failed_rows) for r in results.collect()}
    assert got["1"][2] >= 2 and all(t == p + f for t, p, f in got.values()) and got["4"] == (1, 0, 1) and written["4"] == 1
    assert not store._scratch and not [x for x in store._leaves("", "scratch-")]


def test_one_failing_collection_leaves_the_others(spark, items, tmp_path, monkeypatch):
    real = planner.violations

    def fails(df, rules, seen=None):
        if any(r.rule.rule_id == "1" for r in rules):
            raise RuntimeError("connection lost")
        return real(df, rules, seen)

    slept = []
    monkeypatch.setattr(planner, "violations", fails)
    engine = Engine(spark, settings={"MAX_RULE_RETRIES": 1}, store=SnapshotStore(spark, f"file://{tmp_path}/store"), sleep=slept.append)
    results, _ = engine.run({"items": YAML}, RunContext("one", NOW))
    assert {r.rule_id: r.status for r in results.collect()} == {"1": "ERROR", "2": "ERROR", "3": "FAILED", "4": "FAILED"} and slept == [2.0]
    assert {r.rule_id for r in engine.store.read(engine.targets["violations_table"]).collect()} == {"3", "4"}


def test_configuration_keys(spark, items):
    long = {"DEFAULT_SCHEMA": "dq", "DQ_RESULTS_TABLE": "runs", "DQ_VIOLATIONS_TABLE": "other.bad", "DQ_EXECUTION_METRICS_TABLE": "metrics"}
    assert resolve_targets(long) == {"results_table": "dq.runs", "violations_table": "other.bad", "metrics_table": "dq.metrics"}
    for wrong in ({k: v for k, v in long.items() if k != "DQ_RESULTS_TABLE"}, long | {"COLOUR": "x"}, long | {"schema": "x"}, {"colour": "x"}, long | {"DEFAULT_SCHEMA": "a b"}):
        with pytest.raises(ValueError):
            resolve_targets(wrong)
        with pytest.raises(ValueError):
            preflight(spark, {"items": YAML}, wrong)
    with pytest.raises(TypeError):
        resolve_targets(["schema"])
    frame(spark, [(1, "x")], "ID int, B string").createOrReplaceTempView("other")
    good = YAML.replace("nothing > 0", "a < 9")
    assert preflight(spark, {"items": good}) == {"items": 4} and scoped_source(spark, load_catalogs({"items": good})[0]).count() == 3
    frame(spark, [(1, "x")], "key int, b string").createOrReplaceTempView("other")
    with pytest.raises(PreflightError):
        preflight(spark, {"items": good})


def test_command_line(spark, items, tmp_path, capsys):
    frame(spark, [(1, 1), (2, -1)], "id int, a int").write.parquet(f"{tmp_path}/items.parquet")
    (tmp_path / "items.yaml").write_text(YAML.replace("nothing > 0", "a < 9"))
    config = {"catalogs": {"items": "items.yaml"}, "tables": {"schema": "cli_db"}, "settings": {"max_rule_retries": 0}, "views": {"items": f"{tmp_path}/items.parquet"}}
    (tmp_path / "config.yaml").write_text(yaml.safe_dump(config))
    for command, words in (("setup", ["cli_db.dq_results"]), ("preflight", ["items: 4 rules"]), ("run", ["Succeeded", "Items", "Active"]), ("report", ["Succeeded", "Items", "Active"])):
        assert cli.main([command, str(tmp_path / "config.yaml")], spark) == 0
        out = capsys.readouterr().out
        assert all(w in out for w in words), out
    assert spark.table("cli_db.dq_violations").count() == 2 and not [t.name for t in spark.catalog.listTables() if t.name.startswith("dq_scratch")]


def test_example_catalog(spark):
    folder = Path(__file__).resolve().parents[1] / "examples"
    config = yaml.safe_load((folder / "config.yaml").read_text())
    for name in config["views"]:
        spark.read.parquet(f"{SF}/{name}.parquet").createOrReplaceTempView(name)
    sources = {k: (folder / v).read_text() for k, v in config["catalogs"].items()}
    assert preflight(spark, sources, config["tables"], config["settings"]) == {"orders": 7}
    (catalog,) = load_catalogs(sources)
    assert {r.status for r in Engine(spark).validate(catalog, RunContext("one", NOW))[0].collect()} <= {"PASSED", "FAILED"}


class Crash(Exception):
    pass


@pytest.mark.parametrize("kind", ["metastore", "snapshot"])
def test_crash_leaves_old_or_new(spark, items, tmp_path, kind):
    """A run that dies after any step of the replacement: the history is there, and the next run goes on from it."""

    def make():
        return MetastoreStore(spark) if kind == "metastore" else SnapshotStore(spark, f"file://{tmp_path}/{kind}")

    config = {"schema": "crash_db"} if kind == "metastore" else {}
    engine = Engine(spark, config, settings={"MAX_RULE_RETRIES": 0}, store=make())
    engine.setup()
    name = engine.targets["violations_table"]
    engine.run({"items": YAML}, RunContext("one", NOW))
    want = sorted(map(tuple, engine.store.read(name).collect()), key=str)
    step, done = 0, False
    while not done:
        store = make()
        calls = []

        def dying(real, before=False):
            def call(*a):
                calls.append(1)
                if len(calls) > step:
                    if not before:
                        real(*a)
                    raise Crash
                return real(*a)

            return call

        if kind == "metastore":
            store._sql = dying(store._sql)
        else:
            store._point, store._write = dying(store._point, before=step % 2 == 0), dying(store._write)
        try:
            store.replace(name, store.read(name))
            done = True
        except Crash:
            pass
        again = make()
        assert again.exists(name) and sorted(map(tuple, again.read(name).collect()), key=str) == want, step
        step += 1
    assert step >= 2
    engine = Engine(spark, config, settings={"MAX_RULE_RETRIES": 0}, store=make())
    engine.run({"items": YAML}, RunContext("two", NOW.replace(day=2)))
    assert {r.first_seen_at for r in engine.store.read(name).collect()} == {NOW}


def test_queries_match_sql(spark):
    db = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "labels"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, build in q.queries().items():
        df = build(spark, SF)
        want = db.sql(q.oracle_sql()[name])
        cols = sorted(df.columns)
        assert cols == sorted(want.columns), name
        at = [want.columns.index(c) for c in cols]
        assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str), name
    assert entry.entry(spark).count() == 6 and set(entry.oracle_sql()) <= set(entry.queries())
