"""Suffix-array removal of repeated byte strings across and within documents.

A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document
with a smaller doc_id, or earlier in the same one.

1. Every window of LENGTH bytes belongs to the GRAM-byte string in it with the smallest
   hash (leftmost on ties), so equal windows belong to equal grams. Consecutive windows of
   one gram form a stretch; only stretches whose gram occurs twice or more can hold repeats.
2. Equal stretches are one class, with its first occurrence; so a passage that a third of
   all documents share is a few rows before anything is gathered. Where a gram has a single
   class, its occurrences after the first repeat as a whole.
3. Classes that share their gram with others are dealt to shards by gram. Those that agree
   with none of them on enough bytes beside the gram are left out; the text of the others
   is suffix-sorted by external induction (``induced``), which gives the common prefixes of
   neighbours as well: runs of at least LENGTH are equal windows. The earliest of a run stays.
   A gram whose classes exceed a shard is split exactly: windows that hold the gram at offsets
   lo to hi share the lo bytes before it and WINDOWS - 1 - hi after it, so its classes are
   dealt anew by these bytes, for either half of the offsets, until a group fits a shard or
   is that of a single window, of which all but the first occurrence repeat.
4. What repeats is brought back to all occurrences and merged into spans by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, materialise, utf8
from .induced import CAP, IN_MEMORY, allocate, pieces, suffix_array

LENGTH, GRAM = 100, 16
WINDOWS = LENGTH - GRAM + 1
assert LENGTH <= CAP
#: Bytes of the classes in a shard, on average; a group of classes is split beyond this.
SHARD = 1_500_000
#: Ranges of offsets by which classes are left out before they are sorted.
RANGES = (2, 10)
RUNS = "array<struct<a:int,b:int>>"


def _hash(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at every position."""
    n = len(data) - GRAM + 1
    word = lambda at: np.ndarray((n,), "<u8", data, at, (1,)).copy()
    x = word(0)
    x *= np.uint64(0x9E3779B97F4A7C15)
    y = word(8)
    y ^= x >> np.uint64(31)
    y *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= y
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def stretches(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash (signed), first window, number of windows and the gram's place after the first
    window's start, of each stretch of a text."""
    n = len(text) - LENGTH + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    h = _hash(np.frombuffer(text, np.uint8))
    low = np.uint64(0xFFFFFFFF)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOWS:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    m = np.minimum(m[: n], m[WINDOWS - width : WINDOWS - width + n])
    at = (m & low).astype(np.int64)
    cut = np.r_[0, np.nonzero(at[1:] != at[:-1])[0] + 1]
    return h[at[cut]].view(np.int64), cut, np.diff(np.r_[cut, n]), at[cut] - cut


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        out: list[list] = [[] for _ in range(6)]
        for k, cell in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = cell.as_py()
            gram, at, n, place = stretches(text)
            ends = (at + n + LENGTH - 1).tolist()
            ids = np.fromiter([digest(text[x:y]) for x, y in zip(at.tolist(), ends, strict=True)], np.uint64, len(at))
            for held, x in zip(out, (gram, ids.view(np.int64), np.full(len(at), k, np.int64), at.astype(np.int32), n.astype(np.int32), place.astype(np.int16)), strict=True):
                held.append(x)
        cols = [np.concatenate(x) for x in out] if out[0] else [np.zeros(0, d) for d in (np.int64, np.int64, np.int64, np.int32, np.int32, np.int16)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["gram", "id", "key", "at", "n", "place"])
    give_back()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["gram", "id", "n", "place", "hot", "key", "at", "body"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())
    for b in batches:
        rows = []
        for key, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
            rows += [(s["gram"], s["id"], s["n"], s["place"], s["hot"], key, s["at"], text[s["at"] : s["at"] + s["n"] + LENGTH - 1]) for s in spans]
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
    give_back()


def may_repeat(bodies: list[bytes], sizes: np.ndarray, place: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which bodies may share a window with another one of their gram, which is at place.

    Shared windows that hold the gram at offsets lo to hi agree on the lo bytes before it and on
    WINDOWS - 1 - hi bytes after it. Ranges of offsets are tried, first wide, then narrow ones.
    Agreement is compared by hash, which can only keep too many."""
    data = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    start = np.cumsum([0, *map(len, bodies)])[:-1]
    word = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    some = np.arange(len(bodies))
    for ranges in RANGES:
        keep = np.zeros(len(bodies), bool)
        edges = [WINDOWS * i // ranges for i in range(ranges + 1)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            rows = some[(place[some] >= lo) & (place[some] - sizes[some] + 1 < hi)]
            begin, length = start[rows] + place[rows] - lo, lo + GRAM + WINDOWS - hi
            x = grams[rows].view(np.uint64).copy()
            for k in [*range(0, length - 7, 8), length - 8]:
                x = (x ^ word[begin + k]) * np.uint64(0x9E3779B97F4A7C15)
                x ^= x >> np.uint64(29)
            order = np.argsort(x)
            same = np.concatenate([[False], x[order][1:] == x[order][:-1], [False]])
            keep[rows[order[same[1:] | same[:-1]] if len(rows) else []]] = True
        some = np.nonzero(keep)[0]
    return keep


def repeated_windows(bodies: list[bytes], sizes: np.ndarray, key: np.ndarray, at: np.ndarray, limit: int = IN_MEMORY):
    """(body, window) of every window that also starts earlier; window k of body i starts at
    (key[i], at[i] + k). By the suffix array of all bodies and its common prefixes: windows are
    equal if no prefix between them is shorter than LENGTH."""
    start = np.r_[0, np.array([len(x) + 1 for x in bodies], np.int64).cumsum()]
    total = int(start[-1]) + 1
    text = allocate(total, np.uint16, limit)
    for i, x in enumerate(bodies):
        text[start[i] : start[i + 1] - 1] = np.frombuffer(x, np.uint8)
        text[start[i] : start[i + 1] - 1] += 2
        text[start[i + 1] - 1] = 1
    text[-1] = 0
    order, prefix = suffix_array(text, limit)
    del text
    sizes, found, held, group = np.r_[sizes, 0], [], np.zeros((3, 0), np.int64), 0

    def later(rows: np.ndarray) -> np.ndarray:
        """Of the rows (group, body, window) those that are not their group's first."""
        same = np.r_[False, rows[0, 1:] == rows[0, :-1], False]
        rows = rows[:, (same[1:] | same[:-1])[: rows.shape[1]]]
        group, who, window = rows[:, np.lexsort((at[rows[1]] + rows[2], key[rows[1]], rows[0]))]
        if not len(group):
            return rows[1:]
        new = np.r_[True, group[1:] != group[:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        more = (key[who] != key[who[first]]) | (at[who] + window != at[who[first]] + window[first])  # a class may be here twice
        return np.stack([who[more], window[more]])

    for s in pieces(total, limit):
        x = np.asarray(order[s]).astype(np.int64)
        groups = group + np.cumsum(prefix[s] < LENGTH)
        group = int(groups[-1])
        who = np.searchsorted(start, x, "right") - 1
        window = x - start[who]
        is_window = window < sizes[who]
        held = np.concatenate([held, np.stack([groups, who, window])[:, is_window]], 1)
        open_ = held[0] == group  # may go on in the next piece
        found.append(later(held[:, ~open_]))
        held = held[:, open_]
    found.append(later(held))
    return np.concatenate(found, 1)


def _sort_shards(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Classes come sorted by shard and gram; a shard is judged when its last one is in."""

        def judge(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows)
            gram, ids, body = t.column("gram"), t.column("id"), t.column("body").to_pylist()
            n, place, key, at = (t.column(c).to_numpy() for c in ("n", "place", "key", "at"))
            some = np.nonzero(may_repeat(body, n.astype(np.int64), place.astype(np.int64), gram.to_numpy()))[0]
            who, window = repeated_windows([body[i] for i in some.tolist()], n[some], key[some], at[some], limit)
            who = some[who]
            by = np.lexsort((window, who))
            who, window = who[by], window[by]
            first = np.r_[True, (who[1:] != who[:-1]) | (window[1:] != window[:-1] + 1)] if len(who) else np.zeros(0, bool)
            last = np.r_[first[1:], True] if len(who) else first
            runs: list[list] = [[] for _ in body]
            for i, x, y in zip(who[first].tolist(), window[first].tolist(), window[last].tolist(), strict=True):
                runs[i].append({"a": x, "b": y + 1})
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            return pa.RecordBatch.from_arrays([gram.combine_chunks(), ids.combine_chunks(), pa.array(runs, kind)], ["gram", "id", "runs"])

        held, last = [], None
        for b in batches:
            shard = b.column(0).to_numpy()
            cuts = np.r_[0, np.nonzero(shard[1:] != shard[:-1])[0] + 1, len(shard)].tolist()
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if held and shard[i] != last:
                    yield judge(held)
                    held = []
                    give_back()
                last = shard[i]
                held.append(b.slice(i, j - i))
        if held:
            yield judge(held)
            give_back()

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remaining bytes of each text; characters that a span cuts are left out of kept."""
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    for b in batches:
        out = []
        for key, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
            merged: list[list[int]] = []
            for s in sorted((s["a"], s["b"]) for s in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            kept, last = [], 0
            for x, y in merged:
                kept.append(text[last:x])
                last = y
            kept = b"".join([*kept, text[last:]])
            out.append((key, len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
    give_back()


def keyed(docs: DataFrame, cols: list[str]) -> tuple[DataFrame, bool]:
    """(key, body, row) and whether key is doc_id. Keys are unique and order the documents;
    row holds the given columns, so their names never clash."""
    n, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    row = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row")
    body = utf8(F.col("text")).alias("body")
    if n == ids:
        return docs.select(F.col("doc_id").cast("long").alias("key"), body, row), True
    rows = docs.select("doc_id", "text", row).orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return materialise(rows.select(F.monotonically_increasing_id().alias("key"), body, "row"), "ordered"), False


def _cut_out(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes with their text, from their first occurrence."""
    of = classes.groupBy("key").agg(F.collect_list(F.struct("gram", "id", "n", "place", "hot", "at")).alias("spans"))
    cut = docs.select("key", "body").join(of, "key").select("key", "body", "spans")
    return cut.mapInArrow(_cut, "gram long, id long, n int, place short, hot boolean, key long, at int, body binary")


def _sorted(groups: DataFrame, size: int, shard: int, limit: int) -> DataFrame:
    """(gram, id, runs) of the classes whose windows repeat, by shards of whole groups (g)."""
    shards = max(1, -(-size // shard))
    dealt = groups.select(F.pmod(F.xxhash64("g"), F.lit(shards)).alias("shard"), "gram", "id", "n", "place", "key", "at", "body")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "gram", "id")
    return dealt.mapInArrow(_sort_shards(limit), f"gram long, id long, runs {RUNS}").where("size(runs) > 0")


def _split(hot: DataFrame, shard: int, limit: int) -> DataFrame:
    """(gram, id, runs) for classes of grams that no shard holds. Each step halves the offsets,
    so there are at most log2(WINDOWS) of them; a class is in one group for each half that its
    windows reach."""
    size = (F.col("n") + LENGTH).cast("long")
    todo = hot.withColumns({"lo": F.lit(0), "hi": F.lit(WINDOWS - 1)})
    found, tables = [], []
    while True:
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi")))
        halves = todo.withColumn("half", F.explode(halves)).withColumns({"lo": F.col("half.lo"), "hi": F.col("half.hi")}).drop("half")
        halves = halves.where((F.col("place") >= F.col("lo")) & (F.col("place") - F.col("n") + 1 <= F.col("hi")))
        shared = F.substring("body", F.col("place") - F.col("lo") + 1, F.col("lo") + GRAM + WINDOWS - 1 - F.col("hi"))
        halves = materialise(halves.withColumn("g", F.xxhash64("gram", "lo", shared)), "halves")
        tables.append(halves)
        groups = materialise(halves.groupBy("g").agg(F.count("*").alias("c"), F.sum(size).alias("size")).where("c > 1"), "groups")
        tables.append(groups)
        small, big = groups.where(F.col("size") <= shard), groups.where(F.col("size") > shard)
        total = small.agg(F.sum("size")).first()[0]
        if total:
            found.append(_sorted(halves.join(small.select("g"), "g", "left_semi"), total, shard, limit))
        if big.isEmpty():
            break
        todo = halves.join(big.select("g"), "g", "left_semi")
        single = todo.where("lo = hi")
        first = single.groupBy("g").agg(F.min(F.struct("key", "at", "id")).alias("f"))
        again = single.join(first, "g").where("f.id <> id")
        a = (F.col("place") - F.col("lo")).cast("int")
        found.append(again.select("gram", "id", F.array(F.struct(a.alias("a"), (a + 1).alias("b"))).alias("runs")))
        todo = todo.where("lo < hi").drop("g")
    empty = hot.select("gram", "id", F.lit(None).cast(RUNS).alias("runs")).limit(0)
    runs = reduce(DataFrame.union, found, empty).groupBy("gram", "id").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    runs = materialise(runs, "runs")  # at most WINDOWS runs a class
    discard(*tables)
    return runs


def spans(docs: DataFrame, shard: int = SHARD, limit: int = IN_MEMORY) -> DataFrame:
    """(key, spans): byte ranges [a, b) that repeat, unmerged, of documents that have any."""
    found = docs.select("key", "body").where(F.length("body") >= LENGTH)
    found = materialise(found.mapInArrow(_find, "gram long, id long, key long, at int, n int, place short"), "stretches")
    twice = materialise(found.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    some = materialise(found.join(twice, "gram", "left_semi"), "stretches")
    discard(found, twice)
    first = F.min(F.struct("key", "at")).alias("f")
    classes = some.groupBy("gram", "id").agg(first, F.first("n").alias("n"), F.first("place").alias("place"), F.count("*").alias("copies"))
    classes = materialise(classes.select("gram", "id", "n", "place", "f.key", "f.at", "copies"), "classes")
    several = materialise(classes.groupBy("gram").agg(F.count("*").alias("c"), F.sum((F.col("n") + LENGTH).cast("long")).alias("size")).where("c > 1"), "grams")
    is_hot = F.col("size") > shard
    cold_size, hot_size = several.agg(F.sum(F.when(~is_hot, F.col("size"))), F.sum(F.when(is_hot, F.col("size")))).first()
    cut = _cut_out(docs, classes.join(several.select("gram", is_hot.alias("hot")), "gram"))
    if hot_size:
        cut = materialise(cut, "cut")
    runs = materialise(_sorted(cut.where("not hot").withColumn("g", F.col("gram")), cold_size or 0, shard, limit), "runs")
    if hot_size:
        runs = runs.unionByName(_split(cut.where("hot").drop("hot"), shard, limit))
        discard(cut)
    judged = classes.join(runs, ["gram", "id"], "left")
    judged = judged.where("copies > 1 or runs is not null")
    judged = materialise(judged.select("gram", "id", F.col("key").alias("f_key"), F.col("at").alias("f_at"), "runs"), "judged")
    hit = some.join(judged, ["gram", "id"])
    every = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    runs = F.when((F.col("key") == F.col("f_key")) & (F.col("at") == F.col("f_at")), F.col("runs")).otherwise(every)
    hit = hit.select("key", "at", F.explode(runs).alias("r"))
    hit = hit.select("key", F.struct((F.col("at") + F.col("r.a")).alias("a"), (F.col("at") + F.col("r.b") + LENGTH - 1).alias("b")).alias("s"))
    out = materialise(hit.groupBy("key").agg(F.collect_list("s").alias("spans")), "spans")
    discard(some, classes, several, judged)
    return out


def removed(docs: DataFrame, cols: list[str], **how) -> DataFrame:
    """row (a struct of the given columns), n_bytes, n_removed, n_spans, kept_sha256, kept."""
    rows, by_id = keyed(docs, cols)
    text = rows.select("key", "body").join(spans(rows, **how), "key", "left").select("key", "body", "spans")
    done = text.mapInArrow(_strip, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
    out = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    if by_id and cols == ["doc_id"]:
        return done.select(F.struct(F.col("key").alias("doc_id")).alias("row"), *out)
    return done.join(rows.select("key", "row"), "key").select("row", *out)


def remove_repeats(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    One row per row of docs. A null text counts as empty; texts under LENGTH bytes lose
    nothing. Rows of equal doc_id are ordered by text, those without an id come last. Spans
    may cut a character: kept_sha256 is of all remaining bytes, kept leaves out what is left
    of such a character. An empty table gives no rows. Other columns are not read.
    """
    return removed(docs, ["doc_id"], **how).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def without_repeats(docs: DataFrame, **how) -> DataFrame:
    """The columns of docs with what is kept as text; n_chars, if there is one, follows."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    got = removed(docs, [c for c in docs.columns if c not in new], **how)
    return got.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
