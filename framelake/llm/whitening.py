"""Embedding whitening: MLlib's distributed singular values of centred rows, total variance from exact deviations.

Vectors are laid on an integer grid, x = floor(scale * c) + offset, so that their sums per dimension are exact. A row is
centred as (x - S div n) - (S mod n) / n: the integer part without rounding, however large the sums are. MLlib's RowMatrix
adds up the Gramian of the centred rows in a tree over the executors and decomposes it; all d singular values are asked
for, as MLlib takes a direct decomposition then, not an iteration that stops at a tolerance (beyond DIRECT numbers a vector
only the leading ones, by that iteration). A variance is a singular value's square over n. The total variance doesn't come
from them, but from the rows' deviations, exact integers.

Vectors of different widths have no covariance, so each width is whitened on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import ready, stored

SCALE, OFFSET = 1024, 100_000
#: Grid values at most, so that they are exact as doubles.
LARGEST = 2**52
#: Singular values below this share of the largest are not told from rounding of a Gramian.
LEAST_SHARE = 1e-6
DIGITS = 10**38
#: Widest vectors whose Gramian is decomposed directly; of wider ones MLlib iterates for the leading components.
DIRECT = 4096


@dataclass
class Axes:
    """Whitening of one width: rows it was fitted on, their sums, unit axes as columns, and the variance along each."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    @property
    def shift(self) -> np.ndarray:
        return np.array([r / self.n for r in self.rest])


def usable(vector: str, scale: int) -> str:
    """SQL: the array has components, none null, non-finite or beyond the grid."""
    return f"coalesce(size({vector}) > 0 AND NOT exists({vector}, c -> c IS NULL OR isnan(c) OR abs(c) * {scale}D >= {LARGEST}D), false)"


def _rows(df: DataFrame, ident: str, vector: str, scale: int) -> DataFrame:
    """(id, d, v) of the rows that take part."""
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.where(usable("v", scale)).select("id", F.size("v").alias("d"), "v")


def _grid(batch: pa.RecordBatch, scale: int, offset: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, x) for each width in a batch of (d, v)."""
    widths = batch.column("d").to_numpy()
    for d in np.unique(widths):
        at = np.flatnonzero(widths == d)
        v = batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(d))
        yield int(d), at, np.floor(v * scale).astype(np.int64) + offset


def _sums(rows: DataFrame, scale: int, offset: int) -> dict[int, tuple[int, list[int]]]:
    """Per width: rows and exact sums of each dimension. A partition sends a row a dimension; d of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[int]] = {}
        for batch in batches:
            for d, _, x in _grid(batch, scale, offset):
                small = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
                own = (x if small else x.astype(object)).sum(axis=0).tolist()
                before = found.setdefault(d, [0] * (d + 1))
                found[d] = [a + b for a, b in zip(before, [len(x), *own], strict=True)]
        for d, own in found.items():
            at = np.arange(-1, d)  # -1: the number of rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d + 1, d, np.int32)), pa.array(at.astype(np.int32)), pa.array([Decimal(s) for s in own], pa.decimal128(38, 0))], ["d", "at", "s"]
            )

    sums = rows.select("d", "v").mapInArrow(run, "d int, at int, s decimal(38,0)").groupBy("d", "at").agg(F.sum("s").alias("s"))
    out: dict[int, dict[int, int]] = {}
    for r in sums.collect():
        out.setdefault(r["d"], {})[r["at"]] = int(r["s"])
    return {d: (own[-1], [own[k] for k in range(d)]) for d, own in sorted(out.items())}


def _centred(own: Axes, scale: int, offset: int) -> Column:
    """v on the grid, less its mean."""
    base, shift = F.lit(own.base.tolist()), F.lit(own.shift.tolist())
    return F.transform("v", lambda c, i: (F.floor(c * F.lit(float(scale))) + F.lit(offset) - F.get(base, i)).cast("double") - F.get(shift, i))


def fit(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> dict[int, Axes]:
    """Per width, the leading principal axes of all usable vectors on the grid; an empty table gives none.

    An axis's sign makes its largest entry positive. Axes whose variance isn't told from rounding are left out: there are
    fewer than `components` then, or none, as of a single row or of equal ones.
    """
    ready(df.sparkSession)
    rows, found = _rows(df, ident, vector, scale), {}
    for d, (n, sums) in _sums(rows, scale, offset).items():
        own = Axes(n, sums, np.zeros((d, 0)), np.zeros(0))
        matrix = rows.where(F.col("d") == d).select(array_to_vector(_centred(own, scale, offset)).alias("v"))
        svd = RowMatrix(MLUtils.convertVectorColumnsFromML(matrix, "v")).computeSVD(d if d <= DIRECT else components, rCond=LEAST_SHARE)
        s, v = svd.s.toArray(), svd.V.toArray()
        s = s[s > 0][:components]
        v = v[:, : len(s)]
        sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(len(s))]) if len(s) else 1.0
        own.axes, own.variances = v * sign, s * s / n
        found[d] = own
    return found


def _deviations(x: np.ndarray, own: Axes) -> list[int]:
    """sum over dimensions of (n x - S)^2, exact."""
    off = x - own.base
    rest = own.rest
    if (float(np.abs(off).max(initial=0)) + 1) ** 2 * own.n**2 * len(own.sums) < 2**62:
        gap = off * own.n - np.array(rest, np.int64)
    else:
        gap = off.astype(object) * own.n - np.array(rest, object)
    return (gap * gap).sum(axis=1).tolist()


def apply(df: DataFrame, model: dict[int, Axes], ident: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """df's usable rows of fitted widths -> (ident, d, n, deviation decimal(38,0), spread, whitened array<double>).

    deviation is n^2 times the squared distance to the mean, exact, or null beyond 38 digits; spread that distance's
    square as a double; whitened has a number an axis.
    """
    spark = df.sparkSession
    ready(spark)
    rows, sent = _rows(df, ident, vector, scale), spark.sparkContext.broadcast(model)  # d x components numbers a width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _grid(batch, scale, offset):
                if d not in sent.value:
                    continue
                own = sent.value[d]
                centred = (x - own.base).astype(np.float64) - own.shift
                w = centred @ own.axes / np.sqrt(own.variances)
                deviation = pa.array([Decimal(v) if v < DIGITS else None for v in _deviations(x, own)], pa.decimal128(38, 0))
                ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(at)), pa.array(np.full(len(at), d, np.int32)), pa.array(np.full(len(at), own.n)), deviation,
                        pa.array((centred * centred).sum(axis=1)), pa.ListArray.from_arrays(ends, pa.array(w.ravel())),
                    ],
                    [ident, "d", "n", "deviation", "spread", "whitened"],
                )

    kind = df.schema[ident].dataType.simpleString()
    return rows.mapInArrow(run, f"`{ident}` {kind}, d int, n long, deviation decimal(38,0), spread double, whitened array<double>")


def summary(applied: DataFrame, components: int = 8) -> DataFrame:
    """(d, trace, error) of rows from `apply` on the table that was fitted: total variance, from exact deviations where all
    have 38 digits at most, and the largest entry of the whitened covariance minus the identity, in absolute value."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    at = lambda i: F.get("whitened", F.lit(i))
    exact = F.when(F.count("deviation") == F.count("*"), F.expr("try_sum(deviation)").cast("double") / F.pow(F.max("n").cast("double"), 3))
    sums = applied.groupBy("d").agg(F.coalesce(exact, F.sum(F.col("spread") / F.col("n"))).alias("trace"), *[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs])
    off = [F.coalesce(F.abs(F.col(f"c{i}_{j}") - F.lit(float(i == j))), F.lit(0.0)) for i, j in pairs]
    return sums.select("d", "trace", F.greatest(*off, F.lit(0.0)).alias("error"))


def whitened(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """df -> (ident, component, n, deviation, whitened, explained, identity_error), a row for each usable row and component.

    Rows whose vector is null, empty, or holds a null, a non-finite entry or one beyond the grid (2^52 / scale) are
    dropped; all others are fitted on and whitened, repeated rows and rows with null or equal ids each for itself.
    component counts from 1 by falling variance; equal variances come in the order of the decomposition. n is the number
    of rows of the vector's width, explained the component's share of the total variance, identity_error the largest over
    all widths. Columns of other names are left out, whatever they are called. An empty table gives an empty result.
    """
    spark = df.sparkSession
    model = fit(df, ident, vector, components, scale, offset)
    applied, _ = stored(apply(df, model, ident, vector, scale, offset), "whitened")
    stats = {r["d"]: r for r in summary(applied, components).collect()}  # a row a width
    error = max((r["error"] for r in stats.values()), default=0.0)
    shares = [(d, [float(e) / stats[d]["trace"] for e in own.variances], error) for d, own in model.items() if len(own.variances)]
    shares = F.broadcast(spark.createDataFrame(shares, "d int, shares array<double>, identity_error double"))
    rows = applied.join(shares, "d").select(f"`{ident}`", "n", "deviation", "shares", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(f"`{ident}`", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("shares", F.col("at")).alias("explained"), "identity_error")
