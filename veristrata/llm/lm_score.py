"""Cross-entropy difference of matched target and background bigram models.

Both models share one open vocabulary and count every word and bigram of every document, so
what is counted grows with the corpus and no two counts share a slot (keys are 48-bit
hashes). No task or driver holds a model:

1. Documents are dealt to blocks of about BLOCK bytes of text.
2. A block sends its distinct keys with their counts, cut by key range, to the nodes of its
   group of GROUP blocks.
3. A node adds them up. While there is more than one group, nodes ask on as blocks did, and
   their groups are GROUP times as large; the last nodes have the sums of the corpus.
4. Sums go back the way the keys came, in their order, and a block scores its documents.

So a key that is everywhere is an entry for each of GROUP senders at most, whatever its count,
a node gets about 2 * BUCKET entries at most, and a sender of a level writes to as many nodes
as its own group has. The text is shuffled once.

The models are matched: the background's counts are scaled to the mass of the target, both
are smoothed alike, words towards equal shares and bigrams towards words, and a document's own
counts are left out of both, so it is scored by what others have in common with it. The score
of a document is its mean loss per token under the background less that under the target:
the higher, the more like the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, materialise, utf8, word_count

#: Bytes of text in a block, tokens for a node, senders of a node: they bound a task's memory.
BLOCK, BUCKET, GROUP = 5_000_000, 1_000_000, 1000
#: Partitions of the blocks at most; a task reads one block after the other.
PARTITIONS = 20_000
#: Words' share of a context (Dirichlet prior), and what every word has beside its count: of 30
#: pairs the one with the best training rows, held-out ones unseen.
PRIOR, UNSEEN = 10_000.0, 0.5
#: Rows that are equal in id and text beyond this number are dealt one by one.
HOT = 1000
MEMORY = 200_000
WIDTH = 6  # bytes of a key


class _Keys(dict):
    def __missing__(self, w: bytes) -> int:
        k = xxhash.xxh3_64_intdigest(w)
        if len(self) >= MEMORY:
            self.clear()
        self[w] = k
        return k


_keys = _Keys()


def codes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word keys and bigram keys of a whole UTF-8 text (A-Z lower-cased, cut at ASCII blanks).
    The first bigram begins with the start of the text, key 0."""
    words = text.lower().split()
    w = np.fromiter(map(_keys.__getitem__, words), np.uint64, len(words))
    before = np.r_[np.uint64(0), w[:-1]] if len(w) else w
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + w) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    cut = np.uint64(64 - 8 * WIDTH)
    return w >> cut, mixed >> cut


def pack(x: np.ndarray, width: int) -> bytes:
    """The low bytes of uint64 values, byte by byte: equal high bytes compress well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view("<u8")


@dataclass(frozen=True)
class Totals:
    """Of all documents and of the target: tokens, and texts that have any."""

    tokens: int
    texts: int
    target_tokens: int
    target_texts: int

    def losses(self, word, pair, before) -> tuple[np.ndarray, np.ndarray]:
        """Loss of each token under target and background. word, pair, before: counts
        (all, target) of the token, of its bigram and of the bigram's first word. What a
        context counts beyond its bigrams is the end of a text."""
        scale = self.target_tokens / self.tokens if self.target_tokens else 1.0
        mass, out = self.tokens * scale, []  # as many slots as tokens
        for w, p, c, s, n in zip(word, pair, before, (scale, 1.0), (mass, self.target_tokens), strict=True):
            words = (w * s + UNSEEN) / (n + UNSEEN * mass)
            out.append(-np.log((p * s + PRIOR * words) / (c * s + PRIOR)))
        return out[1], out[0]


def _gather(rows: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a block (positions in rows), tokens of each, whether target, word and bigram keys."""
    mark = rows.column("mark").to_pylist()
    key = rows.column("k").to_pylist()
    aimed = {k for k, m in zip(key, mark, strict=True) if m}
    at = [i for i, m in enumerate(mark) if not m]
    text = rows.column("text")
    got = [codes(text[i].as_py()) for i in at]
    sizes = np.array([len(w) for w, _ in got], np.int64)
    target = np.array([key[i] in aimed for i in at], bool)
    none = np.zeros(0, np.uint64)
    return at, sizes, target, np.concatenate([none, *(w for w, _ in got)]), np.concatenate([none, *(b for _, b in got)])


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, which come one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        block = b.column(0).to_numpy()
        cuts = np.r_[0, np.nonzero(block[1:] != block[:-1])[0] + 1, len(block)].tolist()
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if i == j:
                continue
            if held and block[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = block[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _edges(buckets: int) -> np.ndarray:
    """First key of every bucket but the first."""
    return np.array([((1 << 8 * WIDTH) * i) // buckets for i in range(1, buckets)], np.uint64)


def _send(sender: int, group: int, buckets: int, keys: np.ndarray, sums) -> pa.RecordBatch:
    """Rows (node, sender, slot, keys, every, target): keys and counts, cut by key range, to the
    nodes of a group."""
    cuts = np.r_[0, np.searchsorted(keys, _edges(buckets)), len(keys)].tolist()
    spans = [(n, i, j) for n, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
    cols = [[group * buckets + n for n, _, _ in spans], [sender] * len(spans), [n for n, _, _ in spans], *([pack(x[i:j], w) for _, i, j in spans] for x, w in ((keys, WIDTH), *((s, 8) for s in sums)))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 3, *[pa.binary()] * 3), strict=True)], ["node", "sender", "slot", "keys", "every", "target"])


ASKED = "node long, sender long, slot long, keys binary, every binary, target binary"
ANSWERS = "sender long, slot long, every binary, target binary"


def _ask(buckets: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            _, sizes, target, words, pairs = _gather(rows)
            keys, inverse, many = np.unique(np.concatenate([words, pairs]), return_inverse=True, return_counts=True)
            aim = np.bincount(inverse, np.tile(np.repeat(target, sizes), 2), len(keys))
            block = rows.column(0)[0].as_py()
            yield _send(block, block // group, buckets, keys, (many, aim))
        give_back()

    return run


def _add(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys that a node was asked for, their sums, the place of each entry's key, and where senders' entries end."""
    asked = [unpack(x.as_py(), WIDTH) for x in rows.column("keys")]
    keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    sums = [np.zeros(len(keys), np.uint64) for _ in range(2)]
    for s, name in zip(sums, ("every", "target"), strict=True):
        np.add.at(s, inverse, np.concatenate([unpack(x.as_py(), 8) for x in rows.column(name)]))
    return keys, sums, inverse, np.cumsum([len(x) for x in asked])[:-1]


def _reply(rows: pa.Table, sums, inverse, cuts) -> Iterator[pa.RecordBatch]:
    back = [np.split(s[inverse], cuts) for s in sums]
    for i in range(0, len(rows), 256):
        cols = [rows.column(c).slice(i, 256).combine_chunks() for c in ("sender", "slot")]
        yield pa.RecordBatch.from_arrays([*cols, *(pa.array([pack(x, 8) for x in b[i : i + 256]], pa.binary()) for b in back)], ["sender", "slot", "every", "target"])


def _ask_on(below: int, buckets: int, group: int):
    """Nodes of a level with so many buckets a group ask those of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):  # the rows of one node, here
            keys, sums, _, _ = _add(rows)
            node = rows.column(0)[0].as_py()
            yield _send(node, node // below // group, buckets, keys, sums)
        give_back()

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _by_block(batches):
        _, sums, inverse, cuts = _add(rows)
        yield from _reply(rows, sums, inverse, cuts)
    give_back()


def _sums(answers: pa.Table) -> list[np.ndarray]:
    """What was answered to a sender, in the order of its keys."""
    answers = answers.sort_by("slot")
    return [np.concatenate([np.zeros(0, np.uint64), *(unpack(x.as_py(), 8) for x in answers.column(c))]) for c in ("every", "target")]


def _pass_on(rows: pa.Table, answers: pa.Table) -> pa.Table:
    _, _, inverse, cuts = _add(rows)
    return pa.Table.from_batches(_reply(rows, _sums(answers), inverse, cuts))


def _finish(totals: Totals):
    names = ["doc_id", "n_tokens", "loss_target", "loss_background", "score"]

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        at, sizes, target, words, pairs = _gather(rows)
        n, both = len(words), np.concatenate([words, pairs])
        keys, inverse = np.unique(both, return_inverse=True)
        sums = [x.astype(float)[inverse] for x in _sums(answers)]
        in_doc = np.tile(np.repeat(np.arange(len(sizes)), sizes), 2) * len(keys) + inverse
        _, back, many = np.unique(in_doc, return_inverse=True, return_counts=True)
        own = many[back]
        sums[0] -= own
        sums[1] -= own * np.tile(np.repeat(target, sizes), 2)
        begin = np.cumsum(sizes) - sizes
        before = []
        for s, first in zip(sums, (totals.texts - 1, totals.target_texts - target[sizes > 0]), strict=True):
            c = np.r_[0.0, s[: n - 1]] if n else np.zeros(0)
            c[begin[sizes > 0]] = first
            before.append(c)
        losses = totals.losses([s[:n] for s in sums], [s[n:] for s in sums], before)
        some = np.nonzero(sizes)[0]
        mean = [np.full(len(sizes), np.nan) for _ in losses]
        for m, x in zip(mean, losses, strict=True):
            m[some] = np.add.reduceat(x, begin[some]) / sizes[some] if len(some) else 0
        score = np.where(sizes > 0, mean[1] - mean[0], 0.0)
        return pa.Table.from_arrays([rows.column("doc_id").take(pa.array(at, pa.int64())), pa.array(sizes), *(pa.array(m, pa.float64(), mask=sizes == 0) for m in mean), pa.array(score, pa.float64())], names)

    return run


def score(docs: DataFrame, target: DataFrame, block: int = BLOCK, bucket: int = BUCKET, group: int = GROUP) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background, score of every row of docs.

    target: doc_id of the target's documents; the background is all of docs. A text without
    words (null, empty, blank) has 0 tokens, null losses and score 0. Without target
    documents every word is as likely in the target. Repeated rows count and are scored each, and
    only a row's own counts are left out: its copies stay in both models. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = utf8(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("k"), text.alias("text"), word_count(F.col("text")).alias("n"))
    sizes = rows.select("doc_id", "k", F.octet_length("text").cast("long").alias("size"), "n")
    aimed = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("t", F.lit(1))
    sizes = materialise(sizes.join(aimed, "doc_id", "left").select("k", "size", "n", F.coalesce("t", F.lit(0)).alias("t")), "sizes")
    some = F.when(F.col("n") > 0, 1).otherwise(0)
    zero = F.lit(0).cast("long")
    size, *sums = sizes.agg(*[F.coalesce(F.sum(c), zero) for c in (F.col("size"), F.col("n"), some, F.col("n") * F.col("t"), some * F.col("t"))]).first()
    totals = Totals(*sums)
    blocks = max(1, -(-size // block))

    copies = materialise(sizes.groupBy("k").agg(F.count("*").alias("copies"), F.max("t").alias("t")).where((F.col("copies") > HOT) | (F.col("t") == 1)), "marks")
    hot = copies.where(F.col("copies") > HOT).select("k", F.lit(True).alias("hot"))
    of = F.pmod(F.xxhash64("k"), F.lit(blocks).cast("long"))
    marks = copies.where("t = 1 and copies <= " + str(HOT)).select(of.alias("block"), "k")
    dealt = rows.select("doc_id", "k", "text").withColumn("block", of)
    if not hot.isEmpty():  # copies of one row go to all blocks, its mark as well
        by_row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks).cast("long"))
        dealt = dealt.withColumn("r", by_row).join(hot, "k", "left").withColumn("block", F.when(F.col("hot"), F.col("r")).otherwise(F.col("block")))
        every = copies.where("t = 1 and copies > " + str(HOT)).select(F.explode(F.sequence(zero, F.lit(blocks - 1).cast("long"))).alias("block"), "k")
        marks = marks.union(every)
    dealt = dealt.select("block", "doc_id", "k", "text", F.lit(False).alias("mark"))
    dealt = dealt.union(marks.select("block", F.lit(None).cast("long"), "k", F.lit(None).cast("binary"), F.lit(True)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(PARTITIONS, -(-blocks // 2)))
    dealt = dealt.repartition(parts, "block")
    groups, tokens = -(-blocks // group), -(-totals.tokens * min(blocks, group) // blocks)
    buckets = max(1, -(-tokens // bucket))
    asked = dealt.sortWithinPartitions("block").mapInArrow(_ask(buckets, group), ASKED)
    levels = []
    while groups > 1:
        levels.append(materialise(asked, "asked"))
        below, tokens = buckets, min(totals.tokens, tokens * group)
        groups, buckets = -(-groups // group), max(1, -(-tokens // bucket))
        asked = levels[-1].repartition("node").sortWithinPartitions("node").mapInArrow(_ask_on(below, buckets, group), ASKED)
    answers = asked.repartition("node").sortWithinPartitions("node").mapInArrow(_answer, ANSWERS)
    for level in reversed(levels):
        answers = level.groupBy("node").cogroup(answers.groupBy("sender")).applyInArrow(_pass_on, ANSWERS)
    answers = answers.repartition(parts, "sender")
    discard(sizes)
    return dealt.groupBy("block").cogroup(answers.groupBy("sender")).applyInArrow(_finish(totals), "doc_id long, n_tokens long, loss_target double, loss_background double, score double")
