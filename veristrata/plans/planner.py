"""One scan for all row checks and row counts of a catalog, one job for each other rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Compiled
from ..schemas import RECORD


def fused_raw(df: DataFrame, rules: Sequence[Compiled]) -> list[tuple[int, int]]:
    """What the count columns of rules give, by one aggregation."""
    if not rules:
        return []
    cols = [c.alias(f"{k}{i}") for i, r in enumerate(rules) for k, c in zip("tf", r.count_columns, strict=True)]
    row = df.agg(*cols).first()
    return [(row[f"t{i}"], row[f"f{i}"]) for i in range(len(rules))]


def raw_counts(df: DataFrame, rule: Compiled) -> tuple[int, int]:
    """The same of one rule, by a job of its own."""
    if rule.count_columns is not None:
        return fused_raw(df, [rule])[0]
    total, failed = rule.counts.select("total", "failed").first()
    return total, failed


def finished(rule: Compiled, raw: tuple[int, int]) -> tuple[int, int]:
    """(total, failed) of a rule."""
    return rule.finish(*raw) if rule.finish else raw


def counts(df: DataFrame, rule: Compiled) -> tuple[int, int]:
    return finished(rule, raw_counts(df, rule))


def violations(df: DataFrame, rules: Sequence[Compiled], seen: Sequence[int | None] | None = None) -> DataFrame:
    """rule_index and the record of all violations of these rules. Row checks share a scan: a
    row gives an array of its records, which is then exploded. seen: rows that were counted,
    for rules about the whole table, which are not counted again."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    fused = [(i, r) for i, r in enumerate(rules) if r.record is not None]
    if fused:
        hits = F.array_compact(F.array(*[F.when(r.record.isNotNull(), F.struct(F.lit(i).alias("rule_index"), r.record.alias("r"))) for i, r in fused]))
        parts.append(df.select(F.explode(hits).alias("h")).select("h.rule_index", "h.r.*"))
    for i, r in enumerate(rules):
        if r.violations is not None:
            parts.append(r.violations.select(F.lit(i).alias("rule_index"), *RECORD.names))
        elif r.table_record is not None:
            n = seen[i] if seen and seen[i] is not None else df.agg(r.count_columns[0].alias("n")).first()["n"]
            if record := r.table_record(n):
                parts.append(spark.createDataFrame([record], RECORD).select(F.lit(i).alias("rule_index"), *RECORD.names))
    if not parts:
        return spark.createDataFrame([], RECORD).select(F.lit(0).alias("rule_index"), *RECORD.names)
    return reduce(DataFrame.unionByName, parts)
