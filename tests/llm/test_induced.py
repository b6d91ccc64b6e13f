"""The external induction against sorting, and its memory."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from veristrata.llm import induced, repeats


def brute(t):
    t = t.tolist()
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while k < induced.CAP and t[a + k] == t[b + k]:
            k += 1
        common.append(k)
    return order, common


@pytest.mark.parametrize("small", [0, 10**6])
@pytest.mark.parametrize("batch, least", [(8192, 256), (4, 2)])
@pytest.mark.parametrize("limit", [5, 17, 10**6])
def test_suffixes_and_common_prefixes(monkeypatch, small, batch, least, limit):
    monkeypatch.setattr(induced, "SMALL", small)
    monkeypatch.setattr(induced, "BATCH", batch)
    monkeypatch.setattr(induced, "LEAST", least)
    rng = np.random.default_rng(limit + batch + small)
    for k in range(120):
        t = rng.integers(1, int(rng.choice([2, 3, 9, 40])), int(rng.integers(1, 80)))
        if k % 5 == 0:
            t = np.tile(t, int(rng.integers(2, 6)))
        if k % 7 == 0:
            t = np.r_[np.ones(int(rng.integers(1, 150)), int), t[:5], np.ones(int(rng.integers(1, 150)), int)]
        t = np.r_[t, 0]
        order, common = induced.suffix_array(t, limit)
        assert (order.tolist(), common.tolist()) == brute(t)


def test_memory_stays_far_below_the_shard(monkeypatch):
    """Windows of a shard whose arrays are some 30 MB are found with a few MB beside the files."""
    rng = np.random.default_rng(2)
    base = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    bodies = [base[a : a + 150] + bytes(rng.integers(97, 123, 30).astype(np.uint8)) for a in rng.integers(0, 19_000, 6000).tolist()]
    sizes, key, at = np.full(len(bodies), 81), np.arange(len(bodies)), np.zeros(len(bodies), np.int64)
    want = repeats.repeated_windows(bodies, sizes, key, at)
    monkeypatch.setattr(induced, "PIECE", 4096)
    monkeypatch.setattr(induced, "BATCH", 2048)
    text = np.concatenate([np.r_[np.frombuffer(b, np.uint8).astype(np.uint16) + 2, 1] for b in bodies] + [[0]])
    limit = 20_000
    tracemalloc.start()
    order, common = induced.suffix_array(text, limit)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert isinstance(order, np.memmap) and isinstance(common, np.memmap) and len(text) > 50 * limit
    assert peak < 4_000_000 < 20 * len(text)
    got = repeats.repeated_windows(bodies, sizes, key, at, limit)
    assert sorted(zip(*want.tolist(), strict=True)) == sorted(zip(*got.tolist(), strict=True)) and want.shape[1] > 100_000
