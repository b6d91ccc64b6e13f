"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors are scaled to length 1 and quantised to int8 with a scale of their own, once. With
u = v + r, v the quantised vector and e = |r| measured in double precision, the product of
two vectors differs from that of their quantised forms by at most e1 * (1 + e2) + e2. A
tile multiplies two blocks of quantised vectors: pairs that reach the threshold even at the
lower end of the bound are links, pairs that don't at the upper end are none. Vectors with
a pair in between go to the same tile once more, in full precision, and only those pairs are
computed again. So tiles receive a byte a component, and doubles for doubtful vectors only.

Equal vectors form one class first, so a group of copies is one row. A tile gives each
class the number of its links and a spanning forest of them, never its pairs. All pairs of a
label are compared, so work and the bytes sent to tiles grow with the square of a label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise
from .components import connected_components, stars

THRESHOLD = 0.93
#: Classes of a block on average; a tile holds two blocks.
BLOCK = 2048
#: Rounding of the double-precision sums that the bound itself rests on.
SLACK = 1e-9
_CHUNK = 200_000


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, step of each vector, and its quantisation error (Euclidean)."""
    step = np.abs(unit).max(1) / 127
    codes = np.rint(unit / step[:, None]).astype(np.int8)
    return codes, step, np.linalg.norm(unit - codes * step[:, None], axis=1)


def products(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Products of quantised vectors, and how far the true ones can be from them."""
    (p, s, e), (q, t, f) = a, b
    kind = np.float32 if p.shape[1] * 127 * 127 < 1 << 24 else np.float64  # sums are exact integers
    near = (p.astype(kind) @ q.astype(kind).T) * s[:, None] * t[None, :]
    return near, e[:, None] * (1 + f[None, :]) + f[None, :] + SLACK


def unit_rows(raw: np.ndarray) -> np.ndarray:
    big = np.abs(raw).max(1, keepdims=True)
    return raw / (np.linalg.norm(raw / big, axis=1, keepdims=True) * big)


def tile_pairs(codes, n: int, same: bool, threshold: float):
    """(i, j, sure): index pairs of a tile (i of the first n rows, j of the others, or i < j if
    the tile is one block with itself) that reach the threshold surely, or perhaps."""
    right = codes if same else tuple(c[n:] for c in codes)
    for i in range(0, n, 512):
        at = slice(i, min(i + 512, n))
        near, bound = products(tuple(c[at] for c in codes), right)
        rows, cols = np.nonzero(near + bound >= threshold)
        sure = (near - bound)[rows, cols] >= threshold
        rows = rows + i
        if same:
            keep = cols > rows
            rows, cols, sure = rows[keep], cols[keep], sure[keep]
        yield rows, cols if same else cols + n, sure


class _Links:
    """Number of links of each row of a tile, and a forest of them."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.count, self.tree = copies, np.zeros(len(copies), np.int64), {}

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for k in range(0, len(i), _CHUNK):
            a, b = i[k : k + _CHUNK], j[k : k + _CHUNK]
            np.add.at(self.count, a, self.copies[b])
            np.add.at(self.count, b, self.copies[a])
            self.tree = stars([*self.tree.items(), *zip(a.tolist(), b.tolist(), strict=True)])

    def rows(self, rep: np.ndarray) -> list[tuple[int, int, int]]:
        return [(int(rep[i]), int(self.count[i]), int(rep[self.tree[i]])) for i in np.nonzero(self.count)[0].tolist()]


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, int, bool]:
    """The rows of a tile, those of its first block before the others; their number; whether it has one block."""
    left = pdf["block"].to_numpy() == pdf["ti"].iloc[0]
    order = np.r_[np.nonzero(left)[0], np.nonzero(~left)[0]]
    return pdf.iloc[order], int(left.sum()), pdf["ti"].iloc[0] == pdf["tj"].iloc[0]


def _quantised(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sure links, and a row without links for each vector that has doubtful pairs."""
        pdf, n, same = _sides(pdf)
        rep = pdf["rep"].to_numpy()
        codes = np.frombuffer(b"".join(pdf["codes"]), np.int8).reshape(len(pdf), -1)
        links, doubt = _Links(pdf["copies"].to_numpy()), np.zeros(len(pdf), bool)
        for i, j, sure in tile_pairs((codes, pdf["step"].to_numpy(), pdf["error"].to_numpy()), n, same, threshold):
            links.add(i[sure], j[sure])
            doubt[i[~sure]] = doubt[j[~sure]] = True
        first, block = int(pdf["ti"].iloc[0]), pdf["block"].to_numpy()
        last = int(pdf["tj"].iloc[0])
        rows = [(*r, None, None, None) for r in links.rows(rep)] + [(int(rep[i]), 0, None, first, last, int(block[i])) for i in np.nonzero(doubt)[0].tolist()]
        return pd.DataFrame(rows, columns=["rep", "links", "root", "ti", "tj", "block"]).astype({"rep": "int64", "links": "int64", **dict.fromkeys(["root", "ti", "tj", "block"], "Int64")})

    return run


def _exact(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of the doubtful vectors of a tile, the pairs that the quantised products left open."""
        pdf, n, same = _sides(pdf)
        unit, links = unit_rows(np.stack(pdf["v"].to_numpy()).astype(np.float64)), _Links(pdf["copies"].to_numpy())
        for i, j, sure in tile_pairs(quantise(unit), n, same, threshold):
            i, j = i[~sure], j[~sure]
            for k in range(0, len(i), _CHUNK):
                a, b = i[k : k + _CHUNK], j[k : k + _CHUNK]
                reached = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                links.add(a[reached], b[reached])
        return pd.DataFrame(links.rows(pdf["rep"].to_numpy()), columns=["rep", "links", "root"], dtype="int64")

    return run


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column(b.schema.get_field_index("v"))
        flat, at, dim = v.values.to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(v.offsets), b.column(b.schema.get_field_index("dim")).to_numpy()
        codes, step, error = [b""] * len(dim), np.zeros(len(dim)), np.zeros(len(dim))
        for d in np.unique(dim).tolist():
            rows = np.nonzero(dim == d)[0]
            got, step[rows], error[rows] = quantise(unit_rows(flat[at[rows][:, None] + np.arange(d)]))
            for i, c in zip(rows.tolist(), got, strict=True):
                codes[i] = c.tobytes()
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.binary()), pa.array(step), pa.array(error)], [*b.schema.names, "codes", "step", "error"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors.

    Vectors of one label and one length link at cosine >= threshold. Null, empty, zero or
    non-finite vectors, those with a null or non-finite component, a null label or a null
    vec_id link with nothing: n_links 0, component_id = vec_id. Rows with a repeated vec_id
    are vectors of their own, and link if equal. An empty table gives no rows. Other columns are
    not read, so their names never clash.
    """
    v = F.col("embedding").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~F.exists(v, odd) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("v"), fit.alias("fit"))
    classes = rows.where("fit").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = classes.select(F.monotonically_increasing_id().alias("rep"), "least", "label", "v", "copies", F.size("v").alias("dim"))
    coded = T.StructType([*classes.schema.fields, *[T.StructField(n, t) for n, t in (("codes", T.BinaryType()), ("step", T.DoubleType()), ("error", T.DoubleType()))]])
    classes = materialise(classes.mapInArrow(_encode, coded), "vectors")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = classes.join(materialise(sizes, "labels"), ["label", "dim"])
    own = own.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = ["label", "dim", "ti", "tj"]
    tiles = own.select("label", "dim", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"), "block", "rep", "copies", "codes", "step", "error")
    found = tiles.groupBy(*tile).applyInPandas(_quantised(threshold), "rep long, links long, root long, ti int, tj int, block int")
    found = materialise(found, "tiles")
    doubtful = found.where("ti is not null").select("rep", "ti", "tj", "block").join(classes.select("rep", "label", "dim", "copies", "v"), "rep")
    exact = doubtful.groupBy(*tile).applyInPandas(_exact(threshold), "rep long, links long, root long")
    found = found.where("root is not null").select("rep", "links", "root").union(materialise(exact, "exact"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select("rep", "root"))
    comp = materialise(classes.select("rep", "least").join(comp, F.col("rep") == F.col("node")).select("rep", "least", "root"), "components")
    least = comp.groupBy("root").agg(F.min("least").alias("c"))
    of = classes.join(links, "rep", "left").join(comp.select("rep", "root"), "rep", "left").join(least, "root", "left")
    of = materialise(of.select(F.col("label").alias("c_label"), F.col("v").alias("c_v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "least").alias("c")), "links")
    out = rows.join(of, F.col("fit") & (F.col("label") == F.col("c_label")) & (F.col("v") == F.col("c_v")), "left")
    comp_id = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))
