"""The pipeline's near copies, against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from test_operators import SF, groups

import corpus_pipeline as p
from veristrata.llm import common, near_copies, simhash


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def corpus():
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(r.choices(words, k=40))
    out = []
    for _ in range(12):
        base = r.choices(words, k=r.randrange(30, 200))
        for _ in range(8):
            w = base[: len(base) - r.randrange(1, len(base) // 5)]
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(words)
            out.append(" ".join(w) + (" " + line if r.random() < 0.3 else ""))
    out += [" ".join(r.choices(words, k=k)) for k in (1, 3, 4, 5, 6, 50) for _ in range(3)]
    return out


@pytest.mark.parametrize("short, often", [(16, 8), (2, 2), (2, 10**9)])
def test_near_copies(spark, monkeypatch, short, often):
    monkeypatch.setattr(near_copies, "SHORT", short)
    monkeypatch.setattr(near_copies, "COMMON", often)
    common.prepare(spark)
    texts = corpus()
    n = len(texts)
    near = [(i, j) for i in range(n) for j in range(i + 1, n) if jaccard(texts[i], texts[j]) >= 0.8]
    want = groups(near, range(n))
    assert len(near) > 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in near_copies.near_copies(docs.withColumn("rid", docs.doc_id)).collect()}
    assert {frozenset(i for i in got if got[i] == c) for c in set(got.values())} == {frozenset(i for i in want if want[i] == c) for c in set(want.values())}
    assert sorted(r.doc_id for r in p.keep_one_of_near_copies(spark, docs, SF).collect()) == sorted(set(want.values()))


def test_bounds():
    r = np.random.default_rng(5)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        a = np.unique(r.integers(0, 2**63, int(r.integers(1, 80))).astype(np.uint64))
        b = np.unique(np.r_[a[int(r.integers(0, len(a) // 5 + 1)) :], r.integers(0, 2**63, int(r.integers(0, 3))).astype(np.uint64)])
        counts = np.stack([np.bincount(s & np.uint64(255), minlength=256) for s in (a, b)]).astype(np.uint8)
        if near_copies.similar(a, b):
            assert near_copies.possible(np.array([len(a), len(b)]), counts, 0, np.array([1]))[0].tolist() == [1]
            assert [x.tolist() for x in near_copies.short_pairs(np.array([2]), np.arange(2), np.array([len(a), len(b)]), np.arange(2), counts)] == [[0], [1]]
            for common in (none, np.unique(r.choice(a, len(a) // 2))):
                assert set(near_copies.prefix(a, common)) & set(near_copies.prefix(b, common))


def test_shingles(monkeypatch):
    """Sets have the sizes and common parts of the sets of strings, wherever pieces and texts end."""
    monkeypatch.setattr(near_copies, "PIECE", 50)
    r = random.Random(6)
    odd = ["", " \n", "a", "A b", "a b c d", "a b c d e", "\u4e2d \u00e9 \u00c9", "x" * 300 + " y " + "X" * 300, "z" * 5000, "a b " * 3000, "a\x0bb\x0cc\rd\x1ce"]
    texts = [t.encode() for t in odd + [r.choice(" \n\t").join(r.choices(["a", "b", "A", "long" * 9, "\u00e9"], k=r.randrange(30))) for _ in range(200)]]
    want = []
    for t in texts:
        w = t.lower().split()
        want.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    found = near_copies.sets(texts)
    assert [len(s) for s in found] == [len(s) for s in want]
    assert len(set().union(*want)) == len(np.unique(np.concatenate(found)))
    for _ in range(3000):
        i, j = r.randrange(len(texts)), r.randrange(len(texts))
        assert len(want[i] & want[j]) == len(np.intersect1d(found[i], found[j]))
    assert all((near_copies.shingles(t) == s).all() for t, s in zip(texts, found, strict=True))


def test_rows_without_unique_ids(spark):
    r = random.Random(4)
    a, b, c, d = (" ".join(r.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(4))
    common.prepare(spark)
    rows = [(1, a), (1, b), (1, c), (1, c + " more"), (1, b), (2, a), (None, d), (None, d), (None, c), (None, None), (3, "")]
    kept = p.keep_one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(((k.doc_id or 0), k.text or "") for k in kept if k.text not in (c, c + " more")) == sorted([(1, a), (1, b), (0, d), (3, "")])
    assert [k.doc_id for k in kept if k.text in (c, c + " more")] == [1]


def test_rows_are_judged_one_by_one(spark):
    """A repeated id elsewhere changes nothing; whatever columns there are, even maps."""
    r = random.Random(9)
    a, b, c, d = (" ".join(r.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(4))
    common.prepare(spark)
    for extra, more in (([], []), ([(9, c), (9, d)], [(9, c), (9, d)])):
        rows = [(i, t, {"k": "v"}, 0, 0, 0) for i, t in [(1, a), (5, a), (5, b), *extra]]
        docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,string>, rid int, row int, component int")
        kept = p.keep_one_of_near_copies(spark, docs, SF)
        assert kept.columns == docs.columns
        assert sorted((k.doc_id, k.text) for k in kept.collect()) == sorted([(1, a), (5, b), *more])
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in p.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name


def test_fingerprints_link_first(spark, monkeypatch):
    """With no rounds over lists of shingles, the index of fingerprint bytes connects the texts that
    are similar and whose fingerprints differ in 3 or fewer bits, and no others."""
    common.prepare(spark)
    r = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(15):
        base = r.choices(words, k=300)
        for k in (0, 1, 1, 25):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
    found = near_copies.sets([t.encode() for t in texts])
    fps = []
    for s in found:
        ones = [sum(int(h) >> b & 1 for h in s) for b in range(64)]
        fps.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(s)))
    assert fps == [simhash.majority(s) for s in found]
    n = len(texts)
    near = [(i, j) for i in range(n) for j in range(i + 1, n) if (fps[i] ^ fps[j]).bit_count() <= 3 and jaccard(texts[i], texts[j]) >= 0.8]
    want = groups(near, range(n))
    assert len(near) >= 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "ROUNDS", ())
    got = {x.doc_id: x.component for x in near_copies.near_copies(docs.withColumn("rid", docs.doc_id)).collect()}
    assert {frozenset(i for i in got if got[i] == c) for c in set(got.values())} == {frozenset(i for i in want if want[i] == c) for c in set(want.values())}


def test_common_in_a_share_of_the_texts(spark, monkeypatch):
    """What is common does not depend on how many texts there are."""
    common.prepare(spark)
    monkeypatch.setattr(near_copies, "SAMPLE", 10)
    r = random.Random(13)
    words = [f"w{i}" for i in range(5000)]
    line = r.choices(words, k=9)
    for n in (500, 2000):
        texts = [" ".join(r.choices(words, k=12) + (line if i % (n // 100) == 0 else [])) for i in range(n)]
        docs = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
        shingles = near_copies.shingles(" ".join(line).encode())
        assert set(shingles.tolist()) <= set(near_copies.common_shingles(docs).tolist()), n


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 1000])
def test_met(rows):
    r = random.Random(rows)
    h = sorted(x for k in range(60) for x in [k] * r.choice((1, 1, 2, 3, 4, 5, 20)))
    batches = [pa.RecordBatch.from_arrays([pa.array(h[i : i + rows], pa.int64()), pa.array(range(i, min(i + rows, len(h))), pa.int64())], ["h", "node"]) for i in range(0, len(h), rows)]
    got = [tuple(x.values()) for b in near_copies._met(3)(iter(batches)) for x in b.to_pylist()]
    assert got == [(x, i, h.count(x) > 3) for i, x in enumerate(h) if h.count(x) > 1]
    assert not list(near_copies._met(3)(iter([])))


def test_long_lists(monkeypatch):
    """Pairs of a list against every pair, in chunks of any size; connected ones are left out."""
    r = np.random.default_rng(8)
    base = [r.integers(0, 2**63, int(k)) for k in r.integers(1, 60, 12)]
    found = [np.unique(np.r_[b[int(r.integers(0, len(b) // 6 + 1)) :], r.integers(0, 2**63, int(r.integers(0, 3)))].astype(np.uint64)) for b in base for _ in range(8)]
    found.append(np.zeros(0, np.uint64))
    n = np.array([len(s) for s in found])
    counts = np.stack([np.bincount(s & np.uint64(255), minlength=256) for s in found]).astype(np.uint8)
    node, comp = r.permutation(len(n)), r.integers(0, 20, len(n))

    def passes(i, j):
        return (comp[i] != comp[j]) and max(np.abs(counts[i].astype(int) - counts[j]).sum(), abs(n[i] - n[j])) * 9 <= n[i] + n[j]

    every = {frozenset((int(node[i]), int(node[j]))) for i in range(len(n)) for j in range(i) if passes(i, j)}
    assert len(every) > 100
    for chunk in (1, 50, 20_000):
        monkeypatch.setattr(near_copies, "CHUNK", chunk)
        got = {how: [frozenset((int(a), int(b))) for u, v in near_copies.long_pairs(node, n, comp, counts, how) for a, b in zip(u, v, strict=True)] for how in near_copies.ROUNDS}
        assert len(got["all"]) == len(every) and set(got["all"]) == every
        assert set(got["nearest"]) < every and set(got["leader"]) < every
        assert {x for p in got["nearest"] for x in p} == {x for p in every for x in p}
        assert len(got["leader"]) < len(n)
