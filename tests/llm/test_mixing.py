"""The splitting tree's draws against the exact distribution, and the shards."""

from __future__ import annotations

import random
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from veristrata.llm import common, mixing


def test_draws_invert_the_distribution(spark):
    """Each draw is the smallest x whose exact distribution function reaches u, small or large."""
    r = random.Random(8)
    rows = [(n, k, q, r.random()) for n in (1, 2, 10, 300, 4000) for k in {0, 1, n // 3, n - 1, n} for q in {0, 1, n // 2, n} for _ in range(3)]
    rows += [(3000, 1400, 1500, u) for u in (1e-9, 0.01, 0.5, 0.99, 1 - 1e-9)]  # a variance of 187
    frame = spark.createDataFrame(rows, "N long, K long, q long, u double")
    got = frame.select("*", F.expr(f"transform(array(struct(N, K, q, u)), s0 -> {mixing._DRAW})[0]").alias("x")).collect()
    for d in got:
        low, high = max(0, d.q - (d.N - d.K)), min(d.q, d.K)
        below = Fraction(sum(comb(d.K, i) * comb(d.N - d.K, d.q - i) for i in range(low, d.x)), comb(d.N, d.q))
        upto = below + Fraction(comb(d.K, d.x) * comb(d.N - d.K, d.q - d.x), comb(d.N, d.q))
        assert low <= d.x <= high and float(below) <= d.u + 1e-9 and float(upto) >= d.u - 1e-9, d


def test_tree(spark):
    """Shards share all sources, quotas add up, blocks are disjoint, and a shard holds what was drawn for it."""
    common.prepare(spark)
    r = random.Random(3)
    rows = [(i, r.randrange(1, 900), "abc"[min(i % 5, 2)]) for i in range(400)]
    frame = spark.createDataFrame([(i, i * 7919, s, n) for i, n, s in rows], "rid long, key long, source string, size long")
    whole, drawn, shards = mixing.mix(frame, block=16, leaf=8)
    size = {i: n for i, n, _ in rows}
    passes = {w.rid: (w.passes, w.source, w.target, w.source_size) for w in whole.collect()}
    seen, per, where = set(), {}, {}
    for d in drawn.collect():
        assert d["first"] % 16 == 0 and 0 < d.words <= min(16, size[d.rid] - d["first"]) and (d.rid, d["first"]) not in seen
        seen.add((d.rid, d["first"]))
        s = passes[d.rid][1]
        per[s] = per.get(s, 0) + d.words
        where.setdefault(s, set()).add(d.shard)
    assert shards > mixing.FAN  # a tree of two levels
    for s in "abc":
        n, _, target, total = next(p for p in passes.values() if p[1] == s)
        assert n * total + per.get(s, 0) == int(target + 0.5)
    assert len(set.union(*where.values())) > 0.9 * shards and len(set.intersection(*where.values())) > 0


def test_copies_of_a_row_are_spread(spark):
    common.prepare(spark)
    frame = spark.range(20_000).selectExpr("id as rid", "7L as key", "if(id < 19000, 'a', 'b') as source", "100L as size").repartition(7)
    frame = common.materialise(frame.select(F.monotonically_increasing_id().alias("rid"), "key", "source", "size"), "same")
    whole, drawn, shards = mixing.mix(frame)
    assert drawn.groupBy("shard").count().agg(F.max("count")).first()[0] < 4 * mixing.LEAF and drawn.select("shard").distinct().count() > 0.8 * shards
    assert mixing.numbered(frame).select("key").distinct().count() == 20_000


def test_shards_are_written_in_order(spark):
    common.prepare(spark)
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{k}" for k in range(i % 37 * 20)), f"s{i % 3}", "clash") for i in range(200)], "doc_id long, text string, source string, shard string")
    first, again = (mixing.mixed_documents(docs.repartition(k), leaf=4).collect() for k in (2, 5))
    assert first == again and docs.columns == mixing.mixed_documents(docs).columns
    assert [x.doc_id for x in first] != sorted(x.doc_id for x in first)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 == mixing.taken(docs.limit(0)).count()
    one = docs.where("doc_id = 5")  # 1.5 times its size: a pass and a half
    assert mixing.mixed_documents(one).count() >= 2 and mixing.taken(one).first().taken == 150


@pytest.mark.parametrize("weights, cap", [((3, 1, 2), 2.0), ((1,), 1.6), ((5, 1), 1.5)])
def test_targets(spark, weights, cap):
    common.prepare(spark)
    r = random.Random(int(cap * 10))
    size = {f"s{i:03d}": r.randrange(0, 5000) for i in range(60)} | {None: 100}
    got = {t.source: t for t in mixing.targets(spark.createDataFrame([(s, n, 1) for s, n in size.items()], "source string, size long, n_blocks long"), weights, cap=cap).collect()}
    order = sorted(s for s in size if s) + [None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    want, free = {}, set(order)
    while free:
        level = (1.5 * sum(size.values()) - sum(want.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * size[s]}
        want |= {s: cap * size[s] for s in over} if over else {s: level * weight[s] for s in free}
        free -= over or free
    assert {s: t.weight for s, t in got.items()} == weight
    assert {s: t.target for s, t in got.items()} == pytest.approx(want)
