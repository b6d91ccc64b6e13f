"""Output tables: names, creation, drift, alignment, appends and replacement.

Two back ends. ``MetastoreStore`` uses the session catalog; ``SnapshotStore`` keeps Parquet
snapshots in a folder and adds a numbered pointer file, so that a reader never sees half a
table. In both a write that fails or dies at any step leaves the old table or the new one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import OUTPUTS

_PART = re.compile(r"[A-Za-z0-9_]+")
_NO_PLACE = {"SCHEMA_NOT_FOUND", "DATABASE_NOT_FOUND", "REQUIRES_SINGLE_PART_NAMESPACE", "TABLE_OR_VIEW_NOT_FOUND"}


def safe_name(name: str, setting: str = "table name") -> str:
    if not isinstance(name, str) or not all(_PART.fullmatch(p) for p in name.split(".")):
        raise ValueError(f"{setting} {name!r} must consist of letters, digits and underscores, parts separated by dots")
    return name


# The configuration keys that catalogs' users know, all of them required if one is given.
LONG_KEYS = {"DEFAULT_SCHEMA": "schema", "DQ_RESULTS_TABLE": "results_table", "DQ_VIOLATIONS_TABLE": "violations_table", "DQ_EXECUTION_METRICS_TABLE": "metrics_table"}


def resolve_targets(config: Mapping[str, str]) -> dict[str, str]:
    """Full names of the three output tables; names without a dot go to the schema. Short keys
    may be left out, long ones not; an unknown key or a mixture is an error."""
    if not isinstance(config, Mapping):
        raise TypeError("the configuration must be a mapping")
    if set(config) & set(LONG_KEYS):
        if missing := sorted(set(LONG_KEYS) - set(config)):
            raise ValueError(f"configuration keys are missing: {', '.join(missing)}")
        if unknown := sorted(map(str, set(config) - set(LONG_KEYS))):
            raise ValueError(f"unknown configuration keys: {', '.join(unknown)}")
        config = {LONG_KEYS[k]: safe_name(v, k) for k, v in config.items()}
    if unknown := sorted(map(str, set(config) - {"schema", *OUTPUTS})):
        raise ValueError(f"unknown configuration keys: {', '.join(unknown)}")
    schema = safe_name(config["schema"], "schema") if config.get("schema") else None
    names = {k: safe_name(config.get(k) or f"dq_{k.removesuffix('_table')}", k) for k in OUTPUTS}
    return {k: v if "." in v or not schema else f"{schema}.{v}" for k, v in names.items()}


def drift(actual: StructType, wanted: StructType) -> list[str]:
    """Differences in names, types and order; nullability doesn't count."""
    have = {f.name.lower(): f.dataType.simpleString() for f in actual}
    want = {f.name.lower(): f.dataType.simpleString() for f in wanted}
    out = [f"missing {k}" for k in want if k not in have] + [f"unexpected {k}" for k in have if k not in want]
    out += [f"{k} is {have[k]}, not {want[k]}" for k in want if k in have and have[k] != want[k]]
    return out or (["order differs"] if [*have] != [*want] else [])


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in its order: extra ones go, missing ones are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


class MetastoreStore:
    def __init__(self, spark: SparkSession, provider: str = "parquet"):
        self.spark, self.provider = spark, provider
        self._scratch: list[str] = []

    def scratch(self, df: DataFrame) -> DataFrame:
        """df, computed and written, until clear_scratch()."""
        name = f"dq_scratch_{uuid.uuid4().hex}"
        self._scratch.append(name)
        df.write.format(self.provider).saveAsTable(name)
        return self.spark.table(name)

    def clear_scratch(self) -> None:
        while self._scratch:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._scratch.pop()}")

    def _recover(self, name: str) -> None:
        """Finish what a replacement that died between two steps left: without a table the one
        before comes back, beside a table it is out of date."""
        old = f"{safe_name(name)}_old"
        if self.spark.catalog.tableExists(old):
            if self.spark.catalog.tableExists(name):
                self._sql(f"DROP TABLE IF EXISTS {old}")
            else:
                self._sql(f"ALTER TABLE {old} RENAME TO {name}")

    def _sql(self, text: str) -> None:
        self.spark.sql(text)

    def exists(self, name: str) -> bool:
        self._recover(name)
        return self.spark.catalog.tableExists(name)

    def ensure(self, name: str, schema: StructType) -> None:
        """Create the table; if it exists with another schema, fail and change nothing."""
        if "." in name:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {safe_name(name).rpartition('.')[0]}")
        if not self.exists(name):
            self.spark.sql(f"CREATE TABLE {safe_name(name)} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}) USING {self.provider}")
        elif found := drift(self.spark.table(name).schema, schema):
            raise RuntimeError(f"{name} differs from its schema ({'; '.join(found)}); it is not migrated")

    def read(self, name: str) -> DataFrame:
        self._recover(name)
        return self.spark.table(name)

    def append(self, name: str, df: DataFrame) -> None:
        df = align(df, self.read(name).schema) if self.exists(name) else df
        df.write.mode("append").format(self.provider).saveAsTable(name)

    def replace(self, name: str, df: DataFrame) -> None:
        """Write beside the table, then rename: df may read the old one. The old table goes
        only when the new one has its name; until then the next use of the store restores it."""
        spare, old = f"{safe_name(name)}_next", f"{name}_old"
        there = self.exists(name)
        self._sql(f"DROP TABLE IF EXISTS {spare}")
        df.write.format(self.provider).saveAsTable(spare)
        if there:
            self._sql(f"ALTER TABLE {name} RENAME TO {old}")
        self._sql(f"ALTER TABLE {spare} RENAME TO {name}")
        self._recover(name)


class SnapshotStore:
    """Tables below a folder of any Hadoop filesystem that renames atomically. Pointer files are
    numbered and the highest names the snapshots that count; one is written under another name
    and renamed, so it is whole, and nothing that it replaces goes before it is there. Of two
    writers at a time the second fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._scratch: list[str] = []

    def scratch(self, df: DataFrame) -> DataFrame:
        """df, computed and written, until clear_scratch()."""
        path = f"{self.root}/scratch-{uuid.uuid4().hex}"
        self._scratch.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear_scratch(self) -> None:
        while self._scratch:
            self._fs.delete(self._Path(self._scratch.pop()), True)

    def _leaves(self, name: str, start: str) -> list[str]:
        base = self._Path(f"{self.root}/{name}")
        if not self._fs.exists(base):
            return []
        return sorted(x for s in self._fs.listStatus(base) if (x := s.getPath().getName()).startswith(start))

    def _pointer(self, name: str) -> str | None:
        return max(self._leaves(name, "CURRENT-"), default=None)

    def _parts(self, name: str, pointer: str | None) -> list[str]:
        if pointer is None:
            return []
        return [r.value for r in self.spark.read.text(f"{self.root}/{name}/{pointer}").collect() if r.value]  # a line a snapshot

    def _current(self, name: str) -> list[str]:
        return self._parts(name, self._pointer(name))

    def _point(self, name: str, parts: list[str], after: str | None) -> None:
        """Add the pointer that follows the one these parts were made from."""
        base = f"{self.root}/{name}"
        number = int(after.rpartition("-")[2]) + 1 if after else 1
        tmp, new = self._Path(f"{base}/tmp-{uuid.uuid4().hex[:8]}"), self._Path(f"{base}/CURRENT-{number:012d}")
        out = self._fs.create(tmp, True)
        out.write(bytearray("\n".join(parts).encode()))
        out.close()
        if self._fs.exists(new) or not self._fs.rename(tmp, new):
            self._fs.delete(tmp, False)
            raise RuntimeError(f"{name} was written by another run meanwhile")

    def exists(self, name: str) -> bool:
        return bool(self._current(name))

    def ensure(self, name: str, schema: StructType) -> None:
        if not self.exists(name):
            self.replace(name, self.spark.createDataFrame([], schema))
        elif found := drift(self.read(name).schema, schema):
            raise RuntimeError(f"{name} differs from its schema ({'; '.join(found)}); it is not migrated")

    def read(self, name: str) -> DataFrame:
        parts = self._current(name)
        if not parts:
            raise ValueError(f"{name} does not exist")
        return self.spark.read.parquet(*[f"{self.root}/{name}/{p}" for p in parts])

    def _write(self, name: str, df: DataFrame) -> str:
        part = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}/{part}")
        return part

    def append(self, name: str, df: DataFrame) -> None:
        pointer = self._pointer(name)
        parts = self._parts(name, pointer)
        df = align(df, self.read(name).schema) if parts else df
        self._point(name, [*parts, self._write(name, df)], pointer)

    def replace(self, name: str, df: DataFrame) -> None:
        """The snapshots before stay until the next replacement, for a rollback."""
        pointer = self._pointer(name)
        old = self._parts(name, pointer)
        self._point(name, [part := self._write(name, df)], pointer)
        for leaf in self._leaves(name, "CURRENT-")[:-2]:
            self._fs.delete(self._Path(f"{self.root}/{name}/{leaf}"), False)
        for leaf in self._leaves(name, "v-"):
            if leaf != part and leaf not in old:
                self._fs.delete(self._Path(f"{self.root}/{name}/{leaf}"), True)


def append_metric(store, name: str, df: DataFrame) -> str | None:
    """Append a metric row; where its schema doesn't exist, to the bare table name. Never
    raises: gives a warning, or null."""
    try:
        store.append(name, df)
        return None
    except Exception as e:  # the outcome of the run matters more
        condition = (e.getCondition() or "") if isinstance(e, PySparkException) else ""
        if "." in name and condition.split(".")[0] in _NO_PLACE:
            try:
                store.append(bare := name.rpartition(".")[2], df)
                return f"metrics went to {bare}: {name} has no schema"
            except Exception as again:
                e = again
        return f"metrics were not written to {name}: {e}"
