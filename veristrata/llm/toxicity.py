"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Fitted on at most SAMPLE labelled rows (those with the smallest hash of doc_id): their
words with the strongest tie to the label make the lexicon (LEXICON words at most), a
table of dense features is sent to the driver, and the trees are grown there. The scores that
the calibration is fitted on come from folds: rows of a fold are scored by trees that were
grown, with a lexicon that was learned, on the other folds only. All texts are then scored
where they lie, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

SAMPLE, LEXICON = 20_000, 200
TREES, DEPTH, RATE, BINS, FOLDS = 60, 3, 0.15, 32, 5
THRESHOLD = 0.3
#: Words to either side of a second-person word that count as near it.
NEAR = 4

# Second-person words of the languages in the corpus.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine tu te toi ton ta tes vous votre vos tú usted ti tus".split())
STRIP = ".,;:!?\"'()[]{}<>|-–—…«»„“”‘’`~_"
DISGUISE = str.maketrans("013457@$!*", "oieastasi?", "")
_ODD = re.compile(r"[^\W\d_][@$*!0-9]+[^\W\d_]|^[@$][^\W\d_]")
_CAPS = re.compile(r"\b[A-Z]{3,}\b")
_RUN = re.compile(r"([^\W\d_])\1\1")

FEATURES = ["lexicon_density", "lexicon_hits", "lexicon_kinds", "lexicon_weight", "second_density", "second_near_lexicon",
            "capital_share", "capital_words", "exclaim_share", "punctuation_share", "digit_share", "disguised_words", "disguised_lexicon", "long_runs", "log_words"]

_upper, _punct, _digit, _alpha = (np.zeros(256, bool) for _ in range(4))
_upper[65:91] = True
_digit[48:58] = True
_alpha[65:91] = _alpha[97:123] = _alpha[128:] = True
_punct[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def words_of(text: str) -> list[str]:
    return [w.strip(STRIP) for w in text.lower().split()]


class Reading:
    """What the features of a text need, whatever the lexicon."""

    def __init__(self, text: str):
        self.words = words = words_of(text)
        n = len(words)
        if not n:
            return
        odd = [w for w in words if not w.isalpha() and _ODD.search(w)]
        self.plain = [w.translate(DISGUISE) for w in odd]
        self.second = np.array([i for i, w in enumerate(words) if w in SECOND])
        data = text.encode()
        counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        size, letters = len(data), max(1, int(counts[_alpha].sum()))
        self.rates = [
            counts[_upper].sum() / letters, len(_CAPS.findall(text)) / n, counts[33] / size, counts[_punct].sum() / size,
            counts[_digit].sum() / size, len(odd) / n, len(_RUN.findall(text)) / n, math.log1p(n),
        ]

    def features(self, lexicon: dict[str, float]) -> list[float]:
        words, n = self.words, len(self.words)
        if not n:
            return [0.0] * len(FEATURES)
        hits = [i for i, w in enumerate(words) if w in lexicon]
        hidden = 0
        for w in self.plain:
            if "?" in w:
                shape = re.compile(re.escape(w).replace(r"\?", "."))
                hidden += any(len(x) == len(w) and shape.fullmatch(x) for x in lexicon)
            else:
                hidden += w in lexicon
        near = sum(bool(np.abs(self.second - i).min() <= NEAR) for i in hits) if len(self.second) else 0
        found = [words[i] for i in hits]
        capitals, caps, exclaim, punctuation, digits, odd, runs, size = self.rates
        return [
            len(hits) / n, math.log1p(len(hits)), len(set(found)), sum(lexicon[w] for w in found) / n,
            len(self.second) / n, near / n, capitals, caps, exclaim, punctuation, digits, odd, math.log1p(hidden), runs, size,
        ]


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a whole text; all zero for an empty one."""
    return Reading(text).features(lexicon)


@dataclass
class Trees:
    """Boosted trees of one depth: split feature and edge per inner node, value per leaf."""

    base: float
    feature: np.ndarray
    edge: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, e, v in zip(self.feature, self.edge, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > e[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Histogram boosting of the logistic loss with Newton leaves."""
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    code = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], 1)
    rate = min(max(y.mean(), 1e-4), 1 - 1e-4) if n else 0.0
    base = math.log(rate / (1 - rate)) if n else -9.0
    if not n:
        return Trees(base, *(np.zeros((0, 1), t) for t in (np.int64, float, float)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feats, cuts, vals = [], [], []
    score = np.full(n, base)
    slot = code + np.arange(k) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p) + 1e-9
        f, e = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            lo, width = 2**depth - 1, 2**depth
            where = ((at - lo)[:, None] * (k * BINS) + slot).ravel()
            sums = [np.bincount(where, np.repeat(w, k), width * k * BINS).reshape(width, k, BINS).cumsum(2) for w in (g, h, np.ones(n))]
            G, H, N = (s[:, :, -1:] for s in sums)
            gl, hl, nl = sums
            gain = gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1)
            gain[(nl < 5) | (N - nl < 5)] = -1
            for node in range(width):
                j, b = divmod(int(gain[node].argmax()), BINS)
                if gain[node, j, b] > 1e-6 and b < len(edges[j]):
                    f[lo + node], e[lo + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > e[at])
        leaf = at - inner
        v = RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        score += v[leaf]
        feats.append(f)
        cuts.append(e)
        vals.append(v)
    return Trees(base, np.array(feats), np.array(cuts), np.array(vals))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit (pool adjacent violators)."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, t in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([t, 1.0, r])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            a, b = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, (a[2] * a[1] + b[2] * b[1]) / w])
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        raw = self.trees.raw(np.array([features(t, self.lexicon) for t in texts]))
        level = np.interp(raw, *self.knots) if len(self.knots[0]) else np.zeros(len(raw))
        return np.clip(level * (1 - 1e-6) + 1e-6 / (1 + np.exp(-raw)), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, text, toxic, fold: at most sample rows, each (doc_id, text) once, whatever is
    repeated; which they are depends on their content only."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(*order).limit(sample)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    rows = rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "t").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = materialise(rows, "labelled")
    first = rows.select("doc_id", "t").orderBy(*order, "t").limit(sample)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int")
    return materialise(rows.join(F.broadcast(first), ["doc_id", "t"]).select("doc_id", "text", "toxic", fold.alias("fold")), "sample")


def _lexicons(rows: DataFrame) -> list[dict[str, float]]:
    """A lexicon of all rows, and one without the rows of each fold."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(w, t, f) for text, t, f in zip(*(c.to_pylist() for c in b.columns), strict=True) for w in set(words_of(text)) if w.isalpha() and len(w) < 40]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.string()), *(pa.array([p[i] for p in found], pa.int32()) for i in (1, 2))], ["w", "toxic", "fold"])

    words = rows.select("text", "toxic", "fold").mapInArrow(split, "w string, toxic int, fold int")
    per = words.groupBy("w", "fold").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    outside = lambda c, f: F.coalesce(F.sum(F.when(F.col("fold") != f, F.col(c))), F.lit(0))
    per = per.groupBy("w").agg(*[outside(c, f).alias(f"{c}{f}") for f in range(-1, FOLDS) for c in "tn"])
    per = materialise(per.toDF(*[c.replace("-1", "all") for c in per.columns]).where("tall >= 3"), "words")
    sizes = {r["fold"]: (r["t"], r["n"]) for r in rows.groupBy("fold").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()}  # FOLDS rows
    out = []
    for f in range(-1, FOLDS):
        toxic, total = (sum(v[i] for k, v in sizes.items() if k != f) for i in (0, 1))
        t, n = (F.col(f"{c}{'all' if f < 0 else f}") for c in "tn")
        odds = F.log((t + 0.5) / (toxic + 1.0)) - F.log((n - t + 0.5) / (total - toxic + 1.0))
        top = per.where(t >= 3).withColumn("odds", odds).where(F.col("odds") >= math.log(4))
        top = top.select("w", "odds", (F.col("odds") * F.sqrt(t)).alias("rank")).orderBy(F.desc("rank"), "w").limit(LEXICON).collect()
        out.append({r["w"]: float(r["odds"]) for r in top})
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows that are not held out. Null or other labels than 0 and 1 are
    ignored; a doc_id with several labels counts as toxic if one says so; null texts are empty;
    repeated rows count once. Without rows of both labels every score is the rate of toxic
    ones (0 without rows)."""
    rows = _labelled(docs, labels, sample)
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < total:
        rate = toxic / total if total else 0.0
        empty = np.zeros((TREES, 0))
        return Model({}, Trees(0.0, empty[:0], empty[:0], empty[:0]), (np.array([0.0]), np.array([rate])))
    lexicons = _lexicons(rows)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [[v for lexicon in lexicons for v in r.features(lexicon)] for r in map(Reading, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64())), b.column(2), b.column(3)], ["doc_id", "x", "y", "fold"])

    got = rows.select("doc_id", "text", "toxic", "fold").mapInArrow(table, "doc_id long, x array<double>, y int, fold int").toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), len(lexicons), -1)
    y, fold = np.array([r["y"] for r in got], float), np.array([r["fold"] for r in got])
    raw = np.zeros(len(y))
    for i in range(FOLDS):
        if (fold == i).any():
            raw[fold == i] = grow(x[fold != i, i + 1], y[fold != i]).raw(x[fold == i, i + 1])
    return Model(lexicons[0], grow(x[:, 0], y), isotonic(raw, y))


def score(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """doc_id, the carried columns, score and predicted of every row. Null texts are empty, and
    an empty text has the score that its features, all zero, get; equal texts have equal scores;
    a text of any length is read whole; an empty table gives no rows. A carried column must not be
    named doc_id, score or predicted: put it into a struct."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = 1 + len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = shared.value.score([t or "" for t in b.column(k).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", *carry, "score", "predicted"])

    src = docs.select("doc_id", *carry, F.col("text").alias("_text"))
    out = T.StructType([*src.schema.fields[:k], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return src.mapInArrow(run, out)
