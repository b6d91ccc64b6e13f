"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. SimHash. Each set gets a fingerprint; the inverted index of fingerprint bytes with its count
   filter (``simhash``) finds those at 3 or fewer differing bits, and equal ones are candidates
   as well. Candidates are compared exactly. This connects the closest copies, so that large
   groups have few components when the next step comes to them.
2. The rest. At 0.8 two 64-bit SimHashes differ in about 10 bits, as far as no index of their
   bytes can be complete, so what the first step left apart is found from the sets themselves.
   Shingles are put in one order for all texts. Sets of similarity 0.8 share a shingle among
   the first n - ceil(0.8 n) + 1 of each (prefix filter), hence every such pair meets in a
   posting list. The order is by hash, shingles that a sample shows to be common last; a poor
   sample makes lists longer and never loses a pair. The sample is a share of the texts, so
   that the same lengths are common in a corpus of any size.

Shingles counted in 256 buckets bound a pair from above: the counts differ by no more than
the sets do. Pairs within the bound are compared exactly. Lists longer than ``SHORT`` first
link each text to a leader within the bound; later rounds take only lists that are not
connected yet, and in them only pairs that are not, so a large group of near copies costs a
pair a text, not all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import discard, give_back, materialise, utf8
from .components import connected_components

SEED, WORDS = 42, 5
#: Similarity of at least NUM / DEN.
NUM, DEN = 4, 5
BUCKETS, COARSE = 256, 64
#: Share of the texts in the sample, and how many at least; in about how many of all texts a
#: shingle is common; common shingles that are held at most, those in most texts.
SHARE, SAMPLE, COMMON, MOST = 1 / 8, 20_000, 20, 1_000_000
SHORT, NEAREST = 16, 3
#: Texts to compare that are looked up in memory, at most; more are joined by sorting.
FEW = 1_000_000
#: Bytes of text that are hashed at a time, and shingles of the texts compared last that are held.
PIECE, HELD = 1 << 20, 1 << 22
#: An odd number with about as many ones as zeros.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Pairs whose counts are compared at a time.
CHUNK = 20_000
ROUNDS = ("leader", "nearest", "all")


def _scatter(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers."""
    x = (x + np.uint64(SEED)) * FACTOR
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_INSIDE = np.array([_BLANK.match(bytes([c])) is None for c in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.int64)
_NEAR = _scatter(np.arange(64 << 8, dtype=np.uint64))  # of the first 64 bytes of a word


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word, A-Z lower-cased: the sum of a random number for each byte and
    its place in the word. Long texts are taken in pieces that end at a blank."""
    hashes, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            end = m.start() if (m := _BLANK.search(text, end)) else len(text)
        c = np.frombuffer(text[at:end], np.uint8)
        inside = np.r_[False, _INSIDE[c], False]
        first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        if len(first):
            size = last - first
            offset = np.cumsum(size) - size
            key = (np.arange(size.sum()) - np.repeat(offset, size) << 8) + _LOWER[c[inside[1:-1]]]
            z = _NEAR[np.minimum(key, len(_NEAR) - 1)]
            if size.max() > 64:
                far = np.flatnonzero(key >= len(_NEAR))
                z[far] = _scatter(key[far].astype(np.uint64))
            hashes.append(np.add.reduceat(z, offset))
            starts.append(first + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of so many words."""
    out = np.full(max(0, len(h) - size + 1) if size else 0, size, np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + len(out)]) * FACTOR
        out ^= out >> np.uint64(29)
    return out


def sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of UTF-8 texts; a shorter text is one shingle, one
    without words has none. Texts are hashed together, about ``PIECE`` bytes at a time."""
    out, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end])
            end += 1
        h, start = words(b"\n".join(texts[at:end]))
        edges = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])).tolist()
        every = windows(h, WORDS)  # those across two texts are left out below
        for a, b in pairwise(edges):
            s = np.sort(every[a : b - WORDS + 1] if b - a >= WORDS else windows(h[a:b], b - a))
            out.append(s[np.r_[True, s[1:] != s[:-1]]] if len(s) else s)
        at = end
    return out


def shingles(text: bytes) -> np.ndarray:
    return sets([text])[0]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * DEN >= NUM * (len(a) + len(b) - both)


def prefix(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set, of which a similar set has one among its own."""
    size = len(s) - -(-NUM * len(s) // DEN) + 1 if len(s) else 0
    if len(common):
        last = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
        s = np.r_[s[~last], s[last]]
    return s[:size]


def folded(counts: np.ndarray) -> list[np.ndarray]:
    """Counts in COARSE and in BUCKETS buckets."""
    return [counts.reshape(len(counts), BUCKETS // by, by).sum(1, dtype=np.int16) for by in (COARSE, BUCKETS)]


def possible(n: np.ndarray, counts: np.ndarray | list[np.ndarray], i: int | np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the others that can be similar to i (one row, or a row for each of them), how far
    their counts are apart, and i for each. counts: as they are or folded. A similarity of t needs
    a symmetric difference of at most (1 - t) / (1 + t) of both sizes."""
    i = np.broadcast_to(i, others.shape)
    apart, most = np.abs(n[i] - n[others]), (n[i] + n[others]) * (DEN - NUM)
    keep = apart * (DEN + NUM) <= most
    i, others, apart, most = i[keep], others[keep], apart[keep], most[keep]
    for x in counts if isinstance(counts, list) else folded(counts):
        far = [np.abs(x[i[k : k + CHUNK]] - x[others[k : k + CHUNK]]).sum(1, dtype=np.int64) for k in range(0, len(i), CHUNK)]
        apart = np.maximum(apart, np.concatenate([np.zeros(0, np.int64), *far]))
        keep = apart * (DEN + NUM) <= most
        i, others, apart, most = i[keep], others[keep], apart[keep], most[keep]
    return others, apart, i


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in sets(b.column(0).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["h"])


def _profiles(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = sets(b.column(2).to_pylist())
            node = [xxhash.xxh3_64_intdigest(s.tobytes(), SEED) for s in found]
            counts = [np.minimum(np.bincount(s & np.uint64(BUCKETS - 1), minlength=BUCKETS), 255).astype(np.uint8).tobytes() for s in found]
            fp = [simhash.majority(s) for s in found]
            cols = [*(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (node, fp)), pa.array([len(s) for s in found], pa.int64()), pa.array(counts, pa.binary())]
            first = [np.zeros(0, np.int64), *(prefix(s, common).view(np.int64) for s in found)]
            first = pa.ListArray.from_arrays(pa.array(np.cumsum([len(s) for s in first]), pa.int32()), pa.array(np.concatenate(first)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), *cols, first], ["doc_id", "tkey", "rid", "node", "fp", "n", "counts", "first"])
        give_back()

    return run


def _whole_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a partition sorted by h, in frames that hold whole lists."""
    held = None
    for b in chain(batches, [None]):
        rows = held if b is None else b if held is None else pd.concat([held, b])
        if rows is None or not len(rows):
            continue
        h = rows["h"].to_numpy()
        last = len(h) if b is None else int(np.argmax(h == h[-1]))
        held = rows.iloc[last:]
        if last:
            yield rows.iloc[:last]


def _met(short: int):
    """Of a partition sorted by h, the lists of two or more texts, and whether they have more than
    short. No more is held than a batch and the first rows of its last list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, node, going = np.zeros(0, np.int64), np.zeros(0, np.int64), None  # going: a long list whose rows are being written
        for b in chain(batches, [None]):
            if b is not None:
                h, node = (np.concatenate([x, c.to_numpy()]) for x, c in zip((h, node), b.columns, strict=True))
            if not len(h):
                continue
            cuts = np.r_[0, np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)]
            size = np.diff(cuts)
            is_long = size > short
            is_long[0] |= h[0] == going
            known = is_long | (size > 1)
            if b is not None:
                going = h[-1] if is_long[-1] else None
                known[-1] = is_long[-1]
            keep = np.repeat(known, size)
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(node[keep]), pa.array(np.repeat(is_long, size)[keep])], ["h", "node", "long"])
            rest = len(h) if b is None or is_long[-1] else cuts[-2]
            h, node = h[rest:], node[rest:]

    return run


def short_pairs(size: np.ndarray, node: np.ndarray, n: np.ndarray, comp: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All possible pairs (rows i, j) of short lists, which follow each other and have these sizes."""
    before = np.arange(len(n)) - np.repeat(np.cumsum(size) - size, size)  # rows of the list before each
    j = np.repeat(np.arange(len(n)), before)
    i = np.arange(len(j)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(np.arange(len(n)) - before, before)
    keep = comp[i] != comp[j]
    j, _, i = possible(n, counts, i[keep], j[keep])
    return i, j


def long_pairs(node: np.ndarray, n: np.ndarray, comp: np.ndarray, counts: np.ndarray, how: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of one list that are not connected yet: all, those of the nearest texts, or
    one leader a text. Rows are taken in the order of their sizes, about ``CHUNK`` pairs at a time."""
    if (comp == comp[0]).all():
        return
    by = np.lexsort((node, n))
    node, n, comp, x = node[by], n[by], comp[by], folded(counts[by])
    ahead = np.searchsorted(n * NUM, n * DEN, "right") - np.arange(len(n)) - 1  # rows behind each that are near in size
    ahead = np.maximum(ahead, 0)  # a text without words
    total, free, at = np.cumsum(ahead), np.ones(len(n), bool), 0  # free: without a leader
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
        rows = np.arange(at, end)
        if how == "leader":
            rows = rows[free[at:end]]
        some, at = ahead[rows], end
        i = np.repeat(rows, some)
        j = np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some) + i + 1
        keep = comp[i] != comp[j]
        if how == "leader":
            keep &= free[j]
        j, apart, i = possible(n, x, i[keep], j[keep])
        if how == "leader":
            led = np.zeros(len(i), bool)
            for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
                if free[a] and free[b]:
                    led[k], free[b] = True, False
            i, j = i[led], j[led]
        elif how == "nearest":
            order = np.lexsort((j, apart, i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i, "left")
            i, j = i[rank < NEAREST], j[rank < NEAREST]
        yield node[i], node[j]


def _pairs(how: str):
    """Candidate pairs (u, v) of each list that are not connected yet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_lists(batches):
            h, node, n, comp = (rows[c].to_numpy() for c in ("h", "node", "n", "comp"))
            cuts = np.r_[0, np.nonzero(h[1:] != h[:-1])[0] + 1, len(h)]
            size = np.diff(cuts)
            counts = np.frombuffer(b"".join(rows["counts"]), np.uint8).reshape(-1, BUCKETS)
            is_short = (size > 1) & (size <= SHORT)
            some = np.repeat(is_short, size)
            i, j = short_pairs(size[is_short], node[some], n[some], comp[some], counts[some])
            yield pd.DataFrame({"u": node[some][i], "v": node[some][j]}, dtype="int64")
            for k in np.nonzero(size > SHORT)[0].tolist():
                at = slice(int(cuts[k]), int(cuts[k + 1]))
                for u, v in long_pairs(node[at], n[at], comp[at], counts[at], how):
                    yield pd.DataFrame({"u": u, "v": v}, dtype="int64")
        give_back()

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}  # the least recently used first
    size = 0

    def of(node: int, text: pa.Scalar) -> np.ndarray:
        nonlocal size
        s = held.pop(node, None)
        if s is None:
            s = shingles(text.as_py())
            size += len(s)
        held[node] = s
        while size > HELD and len(held) > 1:
            size -= len(held.pop(next(iter(held))))
        return s

    for b in batches:
        u, v, x, y = (b.column(i) for i in range(4))
        keep = [similar(of(i, s), of(j, t)) for i, j, s, t in zip(u.to_pylist(), v.to_pylist(), x, y, strict=True)]
        yield pa.RecordBatch.from_arrays([u, v], ["u", "v"]).filter(pa.array(keep, pa.bool_()))
    give_back()


def _links(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs that are similar."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    ends = materialise(classes.join(ends, "node", "left_semi").select("node", "tkey"), "ends")
    some = texts.join(F.broadcast(ends) if ends.count() <= FEW else ends, "tkey").groupBy("node").agg(F.min("text").alias("text"))
    some = materialise(some, "texts")
    a, b = some.select(F.col("node").alias("u"), F.col("text").alias("x")), some.select(F.col("node").alias("v"), F.col("text").alias("y"))
    out = materialise(pairs.join(a, "u").join(b, "v").select("u", "v", "x", "y").mapInArrow(_verify, "u long, v long"), "links")
    discard(ends, some)
    return out


def common_shingles(texts: DataFrame) -> np.ndarray:
    """Sorted shingles that a sample of the texts shows to be common."""
    n = texts.count()
    share = min(1.0, max(SHARE, SAMPLE / max(1, n)))
    some = texts.select("text").sample(share, SEED).distinct()
    often = some.mapInArrow(_hashes, "h long").groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= max(2, round(COMMON * share)))
    found = often.orderBy(F.desc("c"), "h").limit(MOST).select("h").toPandas()["h"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def close_fingerprints(classes: DataFrame) -> DataFrame:
    """Pairs (u, v), u < v, of classes (node, fp): links of the index of fingerprint bytes, each
    fingerprint standing for the smallest node that has it, and the nodes of equal fingerprints."""
    first = materialise(classes.groupBy("fp").agg(F.min("node").alias("rep")), "fingerprints")
    same = classes.select("fp", "node").join(first, "fp").where("node <> rep").select(F.col("rep").alias("u"), F.col("node").alias("v"))
    near = simhash.links(first).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    pairs = materialise(near.union(same).distinct(), "pairs")
    discard(first)
    return pairs


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per row of docs (rid, unique; doc_id; text): rid, doc_id, tkey (xxhash64 of the
    text), node (64-bit hash of its set of shingles) and component (smallest node that links
    reach). A null text counts as empty, and texts without words are copies of one another.
    Repeated rows have one node; an empty table gives no rows; other columns are not read."""
    body = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("tkey"), utf8(F.col("text")).alias("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tkey"), utf8(F.col("text")).alias("text"), "rid")
    rows = materialise(rows.mapInArrow(_profiles(common_shingles(texts)), "doc_id long, tkey long, rid long, node long, fp long, n long, counts binary, first array<long>"), "profiles")
    classes = rows.groupBy("node").agg(F.min(F.struct("tkey", "fp", "n", "counts", "first")).alias("r")).select("node", "r.*")
    classes = materialise(classes, "classes")
    pairs = close_fingerprints(classes)
    found = [_links(texts, classes, pairs)]
    discard(pairs)
    posts = classes.select(F.explode("first").alias("h"), "node").repartition("h").sortWithinPartitions("h")
    met = materialise(posts.mapInArrow(_met(SHORT), "h long, node long, long boolean"), "posts")
    comp = connected_components(found[0])
    for how in ROUNDS:
        lists = met if how == ROUNDS[0] else met.where("long")
        lists = materialise(lists.join(comp, "node", "left").select("h", "node", F.coalesce("root", "node").alias("comp")), "lists")
        apart = lists.groupBy("h").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("h")
        here = lists.join(apart, "h", "left_semi").join(classes.select("node", "n", "counts"), "node")
        here = here.select("h", "node", "n", "comp", "counts").repartition("h").sortWithinPartitions("h")
        pairs = here.mapInPandas(_pairs(how), "u long, v long").where("u <> v")
        pairs = materialise(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")
        if not pairs.isEmpty():
            found.append(_links(texts, classes, pairs))
            comp = connected_components(reduce(DataFrame.union, found))
        discard(lists, pairs)
    out = rows.join(comp, "node", "left").select("rid", "doc_id", "tkey", "node", F.coalesce("root", "node").alias("component"))
    out = materialise(out, "near")
    discard(rows, classes, met, *found)
    return out
