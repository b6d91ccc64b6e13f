"""Rule catalogs: YAML text to frozen objects, all or nothing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

import yaml

from ..schemas import CatalogError, RuleError

CATALOG_KEYS = frozenset({"rule_group", "table", "database", "description", "pk_column", "where", "joins", "rules"})
JOIN_KEYS = frozenset({"table", "on", "left_on", "right_on", "how", "select"})
RULE_KEYS = frozenset({"rule_id", "name", "description", "when", "pk_column"})
RULE_TYPES = ("check", "unique", "row_count", "event_flow", "required_event", "aggregate_matches")


def as_list(raw: Any) -> list:
    """A scalar or list as a list without nulls and blanks; null gives an empty one."""
    items = list(raw) if isinstance(raw, (list, tuple, set)) else [raw]
    return [x for x in items if x is not None and x != ""]


@dataclass(frozen=True)
class Join:
    """An equi-join that is applied before the filter."""

    table: str
    on: tuple[str, ...] = ()
    left_on: str | None = None
    right_on: str | None = None
    how: str = "left"
    select: tuple[str, ...] = ()

    @classmethod
    def parse(cls, raw: Any) -> Join:
        if not isinstance(raw, Mapping):
            raise CatalogError(f"a join must be a mapping, not {raw!r}")
        raw = {("on" if k is True else k): v for k, v in raw.items()}  # YAML 1.1 reads a bare on as true
        if unknown := set(raw) - JOIN_KEYS:
            raise CatalogError(f"unknown join keys {sorted(map(str, unknown))}")
        if not raw.get("table"):
            raise CatalogError("a join needs a table")
        on = tuple(map(str, as_list(raw.get("on"))))
        if not on and not (raw.get("left_on") and raw.get("right_on")):
            raise CatalogError(f"the join with {raw['table']} needs 'on', or 'left_on' and 'right_on'")
        return cls(str(raw["table"]), on, raw.get("left_on"), raw.get("right_on"), str(raw.get("how") or "left"), tuple(map(str, as_list(raw.get("select")))))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    body: Mapping[str, Any] = field(repr=False)

    @property
    def kind(self) -> str:
        """The one rule-type key."""
        found = [k for k in RULE_TYPES if k in self.body]
        if len(found) != 1:
            raise RuleError(f"a rule needs exactly one of {', '.join(RULE_TYPES)}; found {found or 'none'}")
        return found[0]

    @property
    def kind_or_blank(self) -> str:
        try:
            return self.kind
        except RuleError:
            return ""

    @property
    def config(self) -> Any:
        return self.body[self.kind]

    @property
    def when(self) -> str | None:
        when = self.body.get("when")
        if when is not None and (not isinstance(when, str) or not when.strip()):
            raise RuleError("'when' must be a non-empty predicate")
        return when.strip() if when else None


@dataclass(frozen=True)
class Catalog:
    key: str
    rule_group: str
    table: str
    rules: tuple[Rule, ...]
    database: str | None = None
    pk_column: str | None = None
    where: Any = None
    joins: tuple[Join, ...] = ()
    unknown_keys: tuple[str, ...] = ()

    @property
    def full_table(self) -> str:
        return f"{self.database}.{self.table}" if self.database else self.table


def parse_catalog(key: str, doc: Any) -> Catalog:
    if not isinstance(doc, Mapping):
        raise CatalogError(f"{key}: not a mapping")
    rules = doc.get("rules")
    if not isinstance(rules, list) or not rules:
        raise CatalogError(f"{key}: no rules")
    parsed = []
    for i, r in enumerate(rules):
        if not isinstance(r, Mapping):
            raise CatalogError(f"{key}: rule {i + 1} is not a mapping")
        for k in ("rule_id", "name"):
            if r.get(k) is None or r.get(k) == "":
                raise CatalogError(f"{key}: rule {i + 1} has no {k}")
        parsed.append(Rule(str(r["rule_id"]), str(r["name"]), dict(r)))
    if not doc.get("table"):
        raise CatalogError(f"{key}: no table")
    joins = doc.get("joins") or []
    if not isinstance(joins, list):
        raise CatalogError(f"{key}: joins must be a list")
    try:
        joined = tuple(Join.parse(j) for j in joins)
    except CatalogError as e:
        raise CatalogError(f"{key}: {e}") from None
    return Catalog(key, str(doc.get("rule_group") or key), str(doc["table"]), tuple(parsed), doc.get("database"), doc.get("pk_column"), doc.get("where"), joined, tuple(sorted(str(k) for k in set(doc) - CATALOG_KEYS)))


def load_catalogs(sources: Mapping[str, str | Mapping]) -> list[Catalog]:
    """Catalogs in order of their names. One that can't be used fails the load as a whole,
    and the error lists every such catalog."""
    if not isinstance(sources, Mapping):
        raise TypeError("catalogs must be a mapping of names to YAML texts")
    if not sources:
        raise CatalogError("there are no catalogs")
    out, wrong = [], []
    for key in sorted(sources):
        try:
            doc = yaml.safe_load(sources[key]) if isinstance(sources[key], str) else sources[key]
            out.append(parse_catalog(key, doc))
        except yaml.YAMLError as e:
            wrong.append(f"{key}: not YAML ({str(e).splitlines()[0]})")
        except CatalogError as e:
            wrong.append(str(e))
    if wrong:
        raise CatalogError("; ".join(wrong))
    return out
