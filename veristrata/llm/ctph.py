"""Context-triggered piecewise hashing: chunk signatures compared by edit distance.

A 32-bit rolling hash of the last 7 bytes ends a chunk where it is one less than a multiple
of the block size; a chunk gives one of 64 signature characters. A fingerprint has the
signatures at a block size and at its double, so texts of up to four times each other's
length still share one. Likeness is 1 - (insertions + deletions) / (both lengths), over
signatures at equal block sizes, and 0 unless they share 7 characters in a row; signatures of
fewer than 7 are too short for that test and are compared without it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

# The base64 alphabet, the rolling window, and the smallest block size.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW, SMALLEST, LENGTH = 7, 3, 64
#: Documents of a range bucket, and buckets at most (a first key of 16 bytes each is sent to
#: the driver and the tasks): beyond, buckets grow.
PER_BUCKET, BUCKETS = 1000, 500_000
NO_ID = -(1 << 63)


def _rolling(data: bytes) -> np.ndarray:
    n = len(data)
    p = np.zeros(n + WINDOW - 1, np.uint32)
    p[WINDOW - 1 :] = np.frombuffer(data, np.uint8)
    total, weighted, mixed = (np.zeros(n, np.uint32) for _ in range(3))
    for j in range(WINDOW):
        s = p[WINDOW - 1 - j : WINDOW - 1 - j + n]
        total += s
        weighted += s * np.uint32(WINDOW - j)
        mixed ^= s << np.uint32(5 * j)
    return total + weighted + mixed


def _signature(data: bytes, ends: np.ndarray) -> str:
    cuts = [0, *ends[: LENGTH - 1].tolist()]
    if cuts[-1] < len(data):
        cuts.append(len(data))
    digest = xxhash.xxh32_intdigest
    return "".join([ALPHABET[digest(data[a:b]) & 63] for a, b in zip(cuts, cuts[1:], strict=False)])


def fingerprint(data: bytes) -> str:
    """'block size:signature:signature at the double block size'."""
    size = SMALLEST
    while size * LENGTH < len(data):
        size *= 2
    if not data:
        return f"{size}::"
    after = _rolling(data) + np.uint32(1)
    while True:
        ends = np.nonzero(after % np.uint32(size) == 0)[0]
        if len(ends) + 1 >= LENGTH // 2 or size == SMALLEST:
            break
        size //= 2
    double = ends[after[ends] % np.uint32(2 * size) == 0]
    return f"{size}:{_signature(data, ends + 1)}:{_signature(data, double + 1)}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _score(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if min(len(a), len(b)) >= WINDOW:
        grams = {a[i : i + WINDOW] for i in range(len(a) - WINDOW + 1)}
        if not any(b[i : i + WINDOW] in grams for i in range(len(b) - WINDOW + 1)):
            return 0.0
    return 2.0 * _common(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 for incompatible block sizes."""
    if x == y:
        return 1.0
    (m, a, b), (n, c, d) = x.split(":"), y.split(":")
    m, n = int(m), int(n)
    if m == n:
        return max(_score(a, c), _score(b, d))
    if m == 2 * n:
        return _score(a, d)
    return _score(b, c) if n == 2 * m else 0.0


def edit(text: str, following: str) -> str:
    """text with its last third replaced by as much of the beginning of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    held, last = None, None
    for batch in batches:
        out = []
        for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if guest and (held is None or held[0] != bucket):
                continue  # nothing here comes before it
            if last is None or last[0] != text:
                data = text.encode()
                last = (text, fingerprint(data))
            if held is not None and held[0] == bucket:
                _, own_id, own, own_print = held
                edited = edit(own, text).encode()
                edited_print = fingerprint(edited)
                out.append((own_id, len(own), hashlib.sha256(edited).hexdigest(), own_print, edited_print, likeness(own_print, edited_print), likeness(own_print, last[1])))
            held = None if guest else (bucket, doc_id, text, last[1])
        cols = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def _keys(k: np.ndarray, t: np.ndarray) -> np.ndarray:
    """16 bytes whose order is descending k, then ascending t."""
    sign = np.uint64(1 << 63)
    both = np.stack([~(k.astype(np.int64).view(np.uint64) ^ sign), t.astype(np.int64).view(np.uint64) ^ sign], 1)
    return np.frombuffer(both.astype(">u8").tobytes(), "S16")


def _bucket_of(firsts: np.ndarray):
    """Bucket of a row; rows that are the first of several buckets are spread over these."""

    @F.pandas_udf("long")
    def bucket(k: pd.Series, t: pd.Series, any_: pd.Series) -> pd.Series:
        keys = _keys(k.to_numpy(), t.to_numpy())
        low, high = (np.searchsorted(firsts, keys, side) for side in ("left", "right"))
        same = np.maximum(high - low, 1)
        return pd.Series(high - 1 - np.where(high - low > 1, any_.to_numpy() % same, 0))

    return bucket


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are.

    The next document is the one that follows in descending doc_id, and the first after the
    last; rows of equal ids follow each other by a hash of the text, rows without an id come
    last, and equal rows are interchangeable. A null text counts as empty; a text of any
    length is read whole; a single row is followed by itself; an empty table gives no rows.
    Other columns are not read, so their names never clash.

    Rows are dealt to buckets of neighbours in that order, so each text is shuffled once; the
    first text of a bucket also goes to the bucket before it. Keys alone are ordered first, and
    every so-many-th begins a bucket: one id, rows without an id, or copies of one row fill
    as many buckets as they need.
    """
    spark: SparkSession = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), key.alias("k"), F.xxhash64(text).alias("t"))
    order = [F.col("k").desc(), F.col("t")]
    keys = rows.select("k", "t").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    keys = materialise(keys.select("k", "t", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "keys")
    parts = keys.groupBy("part").agg(F.count("*").alias("n"))  # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    per = max(PER_BUCKET, -(-keys.count() // BUCKETS))
    firsts = keys.join(parts, "part").where((F.col("before") + F.col("place")) % per == 0).select("k", "t").toPandas()
    firsts = np.sort(_keys(firsts["k"].to_numpy(), firsts["t"].to_numpy()))
    of = _bucket_of(firsts)
    any_ = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 1)
    rows = rows.withColumn("bucket", of("k", "t", any_))
    heads = rows.groupBy("bucket").agg(F.min(F.struct(F.bitwise_not("k").alias("k"), "t")).alias("h"))  # not k: descending
    heads = materialise(heads.select("bucket", F.bitwise_not("h.k").alias("k"), F.col("h.t").alias("t")), "heads")
    ring = Window.orderBy("bucket")  # BUCKETS rows at most
    to = F.coalesce(F.lag("bucket").over(ring), F.max("bucket").over(Window.partitionBy()))
    guests = heads.select(to.alias("bucket"), "k", "t")
    texts = rows.select("k", "t", "text").join(heads.select("k", "t").distinct(), ["k", "t"], "left_semi").groupBy("k", "t").agg(F.min("text").alias("text"))
    guests = guests.join(texts, ["k", "t"]).select("bucket", F.lit(1).alias("guest"), F.lit(None).cast("long").alias("doc_id"), "text", "k", "t")
    rows = rows.select("bucket", F.lit(0).alias("guest"), "doc_id", "text", "k", "t").union(guests)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "guest", *order)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("bucket", "guest", "doc_id", "text").mapInArrow(_compare, schema)
