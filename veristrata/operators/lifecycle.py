"""The state of violations from run to run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, RESOLVED, VIOLATIONS

KEY = ("rule_id", "primary_key_value", "violated_column", "expected_condition")


def diff(existing: DataFrame, current: DataFrame, run_timestamp: datetime, evaluated: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """The new state of the violation table.

    existing: the table so far; current: this run's violations. A key is new, still active
    (it keeps first_seen_at), or gone, and then resolved. Parts of a key compare null-safely.
    evaluated: rule_ids that gave a verdict in this run; rules that ended in error resolve
    nothing. known: rule_ids of the catalogs; a rule that is no longer among them resolves.
    Rows that are not active are history and stay; a key that comes back starts a new
    episode. Of current rows with equal keys the smallest stays.
    """
    missing = [c for c in (*KEY, "issue_status") if c not in current.columns]
    if missing:
        raise ValueError(f"violations lack {', '.join(missing)}")
    names = VIOLATIONS.names
    rest = [c for c in names if c not in KEY]
    current = current.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("n"))
    live = F.col("issue_status").eqNullSafe(ACTIVE)
    history = existing.where(~live).select(*names)
    old = existing.where(live).select(*KEY, F.struct(*rest).alias("o"))
    if evaluated is not None:
        ids = evaluated.select(F.col("rule_id").alias("_e")).distinct()
        old = old.join(ids, F.col("rule_id") == F.col("_e"), "left")
        if known is not None:
            old = old.join(known.select(F.col("rule_id").alias("_k")).distinct(), F.col("rule_id") == F.col("_k"), "left")
        judged = F.col("_e").isNotNull() | (F.col("_k").isNull() if known is not None else F.lit(False))
        old = old.select(*KEY, "o", judged.alias("_judged"))
    else:
        old = old.withColumn("_judged", F.lit(True))
    a, b = old.alias("a"), current.alias("b")
    same = F.lit(True)
    for k in KEY:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    both = a.join(b, same, "full")
    seen, gone = F.col("n").isNotNull(), F.col("n").isNull() & F.col("_judged")
    stamp = {
        "issue_status": F.when(seen, F.lit(ACTIVE)).when(gone, F.lit(RESOLVED)).otherwise(F.col("o.issue_status")),
        "resolution_timestamp": F.when(gone, F.lit(run_timestamp.isoformat())).when(seen, F.lit(None).cast("string")).otherwise(F.col("o.resolution_timestamp")),
        "first_seen_at": F.coalesce("o.first_seen_at", "n.first_seen_at"),
    }
    out = [F.when(seen, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) if c in KEY else stamp.get(c, F.when(seen, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))) for c in names]
    return both.select(*[c.alias(n) for c, n in zip(out, names, strict=True)]).unionByName(history)
