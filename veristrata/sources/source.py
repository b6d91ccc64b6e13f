"""A catalog's source: scan, joins, filter."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CatalogError
from .catalog import Catalog, Join


def _join(spark: SparkSession, df: DataFrame, join: Join, probe: bool) -> DataFrame:
    right = spark.table(join.table)
    right = right.where("false") if probe else right
    if join.select:
        keys = join.on or (join.right_on,)
        right = right.select(*dict.fromkeys([*join.select, *keys]))
    if join.on:
        return df.join(right, list(join.on), join.how)
    return df.join(right, df[join.left_on] == right[join.right_on], join.how)


def where_of(catalog: Catalog, overrides: Mapping[str, Any] | None = None) -> str | None:
    """The catalog's filter, or the override of its rule group; a null override disables it."""
    if overrides is not None and not isinstance(overrides, Mapping):
        raise ValueError("filter overrides must be a mapping of rule groups to predicates")
    where = overrides[catalog.rule_group] if overrides and catalog.rule_group in overrides else catalog.where
    if where and not isinstance(where, str):
        raise ValueError(f"{catalog.key}: 'where' must be a predicate, not {where!r}")
    return where.strip() or None if where else None


def joined_source(spark: SparkSession, catalog: Catalog, probe: bool = False) -> DataFrame:
    """Table and joins, in the given order; as a probe without rows but with its real schema."""
    df = spark.table(catalog.full_table)
    return reduce(lambda d, j: _join(spark, d, j, probe), catalog.joins, df.where("false") if probe else df)


def scoped_source(spark: SparkSession, catalog: Catalog, overrides: Mapping[str, Any] | None = None, fail_on_empty: bool = True) -> DataFrame:
    """What the rules see. The filter comes after the joins, so it may use their columns;
    Catalyst moves it below them where it can."""
    if fail_on_empty and spark.table(catalog.full_table).isEmpty():
        raise CatalogError(f"Source table is empty: {catalog.full_table}")
    df = joined_source(spark, catalog)
    where = where_of(catalog, overrides)
    return df.where(F.expr(where)) if where else df
