"""URL filter: host-suffix / path-prefix expressions, hash-prefix join, digest check, precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of a SHA-256 digest that the join compares (4 bytes).
PREFIX = 8
#: So many rules at most are broadcast (their number is counted); more are joined by a shuffle.
BROADCAST_RULES = 100_000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without '://'."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict added (columns of these names are replaced).

    rules: host, path, verdict. A rule fits its host and all subdomains if the url's path
    starts with the rule's path, character by character. The longest rule (host and path
    together) wins; on a tie the longer host, then block before allow. Without a fitting
    rule, rule is null and the verdict is the default: this method lists exceptions, so
    what it doesn't know is allowed. Null or malformed urls have empty host and path and fit
    no rule. Rules with a null are ignored, repeated ones count once. An empty rule table
    leaves every page with the default. Every row stays, repeated ones too.
    """
    rules = rules.select("host", "path", "verdict").dropna().distinct().select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    rules = rules.withColumn("digest", F.sha2(F.concat("r_host", "r_path"), 256)).withColumn("short", F.substring("digest", 1, PREFIX))
    rules = materialise(rules, "rules")
    n, depths, lengths = rules.agg(
        F.count("*"), F.collect_set(F.size(F.split("r_host", r"\."))), F.collect_set(F.length("r_path"))).first()
    host, path = host_path(F.col(url_col))
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    if not n:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", r"\.")
    suffixes = F.filter(F.transform(F.array(*[F.lit(d) for d in sorted(depths)]), lambda d: F.when(d <= F.size(labels), F.array_join(F.slice(labels, F.size(labels) - d + 1, d), "."))), lambda s: s.isNotNull())
    prefixes = F.filter(F.transform(F.array(*[F.lit(k) for k in sorted(lengths)]), lambda k: F.when(k <= F.length("path"), F.substring(F.col("path"), F.lit(1), k))), lambda s: s.isNotNull())
    urls = pages.select("host", "path").where("host <> ''").distinct()
    seen = urls.select("host", "path", F.explode(suffixes).alias("s"), prefixes.alias("ps")).select("host", "path", "s", F.explode("ps").alias("p"))
    seen = seen.withColumn("full", F.sha2(F.concat("s", "p"), 256)).withColumn("short", F.substring("full", 1, PREFIX))
    hit = seen.join(F.broadcast(rules) if n <= BROADCAST_RULES else rules, "short")
    hit = hit.where("full = digest and s = r_host and p = r_path")
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("r_verdict") == "block")
    best = hit.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "r_verdict"), rank).alias("b"))
    best = materialise(best.select("host", "path", "b.rule", "b.r_verdict"), "best")
    out = pages.join(best, ["host", "path"], "left")
    return out.select(*pages.columns, "rule", F.coalesce("r_verdict", F.lit(default)).alias("verdict"))
