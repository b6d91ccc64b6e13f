"""SimHash near-duplicates through an inverted index of fingerprint bytes with count filtering.

Two 64-bit fingerprints with at most 3 differing bits differ in at most 3 of their 8
positional bytes, so they share at least 5 of them: the guaranteed minimum.

1. Index. A list of one positional byte would hold 1/256 of the corpus, so lists are first
   intersected: among the first 6 positions a pair shares at least 3, hence it meets in a
   list whose key is three positions with their bytes (20 keys a fingerprint).
2. Tally. In a list the other five positions are indexed by their bytes, and for every pair
   that shares a byte there the shared bytes are counted. With the three of the key, pairs
   below 5 are rejected; pairs that share none of the five are never formed.
3. Verify. The differing bits of the pairs that are left are counted.

A list longer than ``HOT`` is dealt anew by two more shared bytes: of the 5 positions
outside its key at least 2 agree, so all pairs of the new list have reached the minimum and
24 bits are free. A list that is still longer than ``PAIRWISE`` is searched by flipping up to
3 of the free bits, linear in the list. A list gives a spanning forest of its links, never
all its pairs, and no list is cut off, so no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, materialise, utf8
from .components import connected_components, stars

SEED = 42
MAX_BITS, MIN_BYTES = 3, 5
HOT = 1024
#: Longest list of pairs that share five bytes that is compared pair by pair.
PAIRWISE = 16_384
#: Pairs that are tallied at a time, about.
PAIRS = 2_000_000
KEYS = list(combinations(range(6), 3))


def fingerprint(text: bytes, words: int = 3) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; 0 without words."""
    w = text.lower().split()  # of bytes: A-Z only, and ASCII blanks only
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    elif words == 3:
        shingles = [b"%b %b %b" % x for x in zip(w, w[1:], w[2:], strict=False)]
    else:
        shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, SEED) for s in shingles), dtype=">u8", count=len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """Each bit that is 1 in over half the 64-bit hashes; 0 without hashes."""
    n, hashes, ones = len(hashes), hashes.astype(">u8", copy=False), np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64))], ["doc_id", "fp"])
        give_back()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


def tally(lists: np.ndarray, positions: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of a list that share MIN_BYTES positional bytes or more.

    lists: number of the list of each posting, ascending; positions: for each posting the five
    positions outside the key of its list; fps: fingerprints (uint64)."""
    n, free = positions.shape
    by = np.take_along_axis(fps.astype(">u8").view(np.uint8).reshape(-1, 8), positions, 1).astype(np.int64)
    code = (((lists.astype(np.int64) * free)[:, None] + np.arange(free)) * 256 + by).ravel()
    order = np.argsort(code, kind="stable")
    code, owner = code[order], order // free
    start = np.r_[True, code[1:] != code[:-1]]
    before = np.arange(len(code)) - np.nonzero(start)[0][np.cumsum(start) - 1]  # postings of the run before each
    j = np.repeat(np.arange(len(code)), before)
    i = np.arange(len(j)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(np.arange(len(code)) - before, before)
    pairs, shared = np.unique(owner[i] * n + owner[j], return_counts=True)
    pairs = pairs[shared + (8 - free) >= MIN_BYTES]
    return pairs // n, pairs % n


def close(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[i] ^ fps[j]) <= MAX_BITS


def _rounds(lists: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of postings: whole lists that have about PAIRS pairs together."""
    cuts = np.r_[0, np.nonzero(lists[1:] != lists[:-1])[0] + 1, len(lists)]
    done = np.cumsum(np.diff(cuts) ** 2) // PAIRS
    ends = np.r_[np.nonzero(done[1:] != done[:-1])[0] + 1, len(done)]
    first = 0
    for e in ends.tolist():
        yield int(cuts[first]), int(cuts[e])
        first = e


def forest(fps: np.ndarray, free: tuple[int, ...]) -> list[tuple[int, int]]:
    """Positions (i, j) that span the links among distinct fingerprints (uint64) that differ
    in the free byte positions only."""
    m, pairs = len(fps), []
    if m <= PAIRWISE:
        step = max(1, PAIRS // m)
        for i in range(0, m - 1, step):
            bits = np.bitwise_count(fps[i : i + step, None] ^ fps[None, i + 1 :])
            a, b = np.nonzero(bits <= MAX_BITS)
            a, b = a + i, b + i + 1
            keep = b > a
            pairs += list(stars(zip(a[keep].tolist(), b[keep].tolist(), strict=True)).items())
    else:
        order = np.argsort(fps)
        srt, bits = fps[order], [np.uint64(1 << (56 - 8 * p + s)) for p in free for s in range(8)]
        for r in range(1, MAX_BITS + 1):
            for flip in combinations(bits, r):
                want = srt ^ np.bitwise_or.reduce(np.array(flip, np.uint64))
                at = np.minimum(np.searchsorted(srt, want), m - 1)
                hit = np.nonzero((srt[at] == want) & (srt < want))[0]
                pairs += zip(order[hit].tolist(), order[at[hit]].tolist(), strict=True)
            pairs = list(stars(pairs).items())
    return [(a, b) for a, b in stars(pairs).items() if a != b]


def _edges(u, v) -> pd.DataFrame:
    found = stars(zip(u.tolist(), v.tolist(), strict=True))
    return pd.DataFrame([e for e in found.items() if e[0] != e[1]], columns=["u", "v"], dtype="int64")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forest edges (u, v) of the short lists of a partition sorted by key: tally, then verify.
    The last list of a batch may go on in the next one."""
    outside = np.array([sorted({*range(8)} - {*k}) for k in KEYS])
    held = None
    for b in itertools.chain(batches, [None]):
        if b is None:
            rows, held = held, None
        else:
            rows = b if held is None else pd.concat([held, b])
            last = rows["key"].to_numpy() == rows["key"].iat[-1] if len(rows) else np.zeros(0, bool)
            rows, held = rows[~last], rows[last]
        if rows is None or not len(rows):
            continue
        key, fps, rep = rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), rows["rep"].to_numpy()
        same = np.r_[key[1:] == key[:-1], False]
        some = same | np.r_[False, same[:-1]]  # lists of one have no pairs
        key, fps, rep = key[some], fps[some], rep[some]
        for x, y in _rounds(key) if len(key) else ():
            lists = np.cumsum(np.r_[0, key[x + 1 : y] != key[x : y - 1]])
            i, j = tally(lists, outside[key[x:y] >> 24], fps[x:y])
            near = close(fps[x:y], i, j)
            yield _edges(rep[x:y][i[near]], rep[x:y][j[near]])


def _refined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forest edges of the lists that share five bytes, in a partition sorted by key."""
    last, fp, rep = None, [], []

    def search() -> pd.DataFrame:
        reps = np.concatenate(rep)
        pairs = np.array(forest(np.concatenate(fp).view(np.uint64), tuple(sorted({*range(8)} - {*FINE[int(last) >> 40]}))), np.int64).reshape(-1, 2)
        return _edges(reps[pairs[:, 0]], reps[pairs[:, 1]])

    for b in batches:
        k, f, r = (b[c].to_numpy() for c in ("key", "fp", "rep"))
        cuts = np.r_[0, np.nonzero(k[1:] != k[:-1])[0] + 1, len(k)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if i == j:
                continue
            if k[i] != last:
                if sum(map(len, fp)) > 1:
                    yield search()
                last, fp, rep = k[i], [], []
            fp.append(f[i:j])
            rep.append(r[i:j])
    if sum(map(len, fp)) > 1:
        yield search()


def _bytes_at(fp: Column, positions: tuple[int, ...]) -> Column:
    out = None
    for p in positions:
        byte = F.shiftrightunsigned(fp, 56 - 8 * p).bitwiseAND(F.lit(255).cast("long"))
        out = byte if out is None else F.shiftleft(out, 8).bitwiseOR(byte)
    return out


#: Refined keys: every first key with two of the five positions outside it.
FINE = sorted({tuple(sorted((*k, *x))) for k in KEYS for x in combinations(sorted({*range(8)} - {*k}), 2)})


def _postings(classes: DataFrame, keys) -> DataFrame:
    width = 8 * len(keys[0])
    lists = [F.lit(i << width).cast("long").bitwiseOR(_bytes_at(F.col("fp"), k)) for i, k in enumerate(keys)]
    return classes.select(F.explode(F.array(*lists)).alias("key"), "fp", "rep")


def links(classes: DataFrame) -> DataFrame:
    """Edges (u, v) between representatives that span all links of distinct fingerprints.

    classes: (fp, rep) with each fp once.
    """
    posts = _postings(classes, KEYS)
    hot = materialise(posts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key"), "hot")
    cold, parts = posts, []
    if not hot.isEmpty():
        cold = posts.join(hot, "key", "left_anti")
        again = posts.join(hot, "key", "left_semi").select("fp", "rep").distinct()
        fine = _postings(again, FINE).repartition("key").sortWithinPartitions("key")
        parts.append(fine.mapInPandas(_refined, "u long, v long"))
    parts.append(cold.repartition("key").sortWithinPartitions("key").mapInPandas(_counted, "u long, v long"))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def simhash_groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id.

    Documents link at MAX_BITS or fewer differing bits; component_id is the smallest doc_id
    reachable through links. Texts without words (null, empty, blank) have fingerprint 0 and
    link like any other. Repeated rows stay, each with its row. A row whose doc_id is null
    keeps its row, with the component of its fingerprint (null if no document with an id is
    in it). Other columns are not read, so names never clash.
    """
    fps = materialise(fingerprints(docs, words), "simhash")
    classes = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = materialise(classes, "classes")
    comp = connected_components(links(classes))
    of = classes.join(comp, classes.rep == comp.node, "left")
    of = materialise(of.select("fp", F.coalesce("root", "rep").alias("component_id")), "components")
    return fps.join(of, "fp", "left").select("doc_id", "fp", "component_id")
