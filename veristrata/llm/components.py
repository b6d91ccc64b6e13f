"""Connected components by alternating large-star and small-star steps.

Each partition first replaces its edges by stars of its own components, so no step ever
handles more edges than nodes and partitions. Degrees of hubs are split by the adaptive
skew join, as both sides of every join are exchanges of written tables. Nothing is sent
to the driver but counts and checksums.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: So many edges at most are joined up in a single task; their number is counted first.
SMALL = 10_000


def stars(pairs) -> dict[int, int]:
    """Node -> smallest node of its component, for an iterable of pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    return {x: root(x) for x in list(parent)}


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [(b["u"].to_numpy(), b["v"].to_numpy()) for b in batches]
    found = stars(e for u, v in parts for e in zip(u.tolist(), v.tolist(), strict=True))
    rows = [(k, v) for k, v in found.items() if k != v]
    yield pd.DataFrame(rows, columns=["u", "v"], dtype="int64")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node it can reach.

    edges: two long columns, in any order and with repeats; rows with a null and loops
    are ignored. An empty table gives an empty result.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    e = e.where("u > v and " + " and ".join(f"{c} is not null" for c in ("u", "v")))
    e = materialise(e.mapInPandas(_contract, "u long, v long").distinct(), "edges")
    seen = None
    while True:
        n, mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n <= SMALL:
            done = materialise(e.coalesce(1).mapInPandas(_contract, "u long, v long"), "stars")
            discard(e)
            e = done
            break
        if (n, mark) == seen:
            break
        seen = (n, mark)
        both = e.union(e.select("v", "u"))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "large")
        low2 = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialise(small.union(low2.select("u", "m")).distinct(), "edges")
        discard(e, low, large, low2)
        e = new
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
