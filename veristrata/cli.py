"""Command line: set up the output tables, check catalogs, run them and report.

    python -m veristrata.cli {setup,preflight,run,report} CONFIG.yaml

CONFIG has catalogs (name to file), and optionally tables (names and schema), settings and
views (name to Parquet path).
"""

from __future__ import annotations

import argparse
from pathlib import Path

import yaml
from pyspark.sql import SparkSession

from .plans import reports
from .plans.preflight import preflight
from .plans.runner import Engine


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    args.add_argument("command", choices=("setup", "preflight", "run", "report"))
    args.add_argument("config", type=Path)
    got = args.parse_args(argv)
    config = yaml.safe_load(got.config.read_text())
    spark = spark or SparkSession.builder.getOrCreate()
    for name, path in (config.get("views") or {}).items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    sources = {k: (got.config.parent / v).read_text() for k, v in (config.get("catalogs") or {}).items()}
    engine = Engine(spark, config.get("tables"), config.get("settings"))
    if got.command == "setup":
        print(*engine.setup().values(), sep="\n")
    elif got.command == "preflight":
        for key, n in preflight(spark, sources, config.get("tables"), engine.settings).items():
            print(f"{key}: {n} rules")
    elif got.command == "run":
        results, run = engine.run_with_metrics(sources)
        reports.top_slowest(results).show(truncate=False)
        reports.run_summary(results, run.run_id).show(truncate=False)
    if got.command in ("run", "report"):
        found = {k: engine.store.read(n) for k, n in engine.targets.items() if engine.store.exists(n)}
        if "metrics_table" in found:
            reports.latest_metrics(found["metrics_table"]).show(truncate=False)
        if "results_table" in found:
            reports.latest_run_summary(found["results_table"]).show(truncate=False)
        if "violations_table" in found:
            reports.violations_by_status(found["violations_table"]).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
