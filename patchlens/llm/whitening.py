"""Whitening of embeddings by polarisation covariance.

Every entry c becomes the integer x = floor(1024 c) + 100000, so all sums are exact.

1. One aggregation gives n and the sums S of each dimension.
2. With m the integer nearest to S / n, a second one gives the sum of squares of
   y = x - m for every dimension and of y_i + y_j for every pair of dimensions.
   n^2 times a variance is n * (sum of squares) - (sum)^2, an integer, and
       2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j)
   gives all covariances exactly; only the last division rounds.
3. The matrix (as many rows as a vector has entries) goes to ``eigh``, and a third
   pass projects the rows.  What is left of the covariance of the whitened rows
   beside the identity is measured on those rows.

Partial sums leave a task as two limbs below and above 2^62, so they are exact for
any number of rows; a task keeps one matrix of sums whatever its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.common import settle

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
_LIMB = 62
#: Rows of a batch that are squared at a time.
ROWS = 2048
_SUMS = "dim int, i int, j int, n long, hi decimal(38,0), lo decimal(38,0)"
_ROWS = "vec_id long, dim int, deviation decimal(38,0), whitened array<double>"


def integers(v: np.ndarray) -> np.ndarray:
    """x of every entry."""
    return np.floor(v * SCALE).astype(np.int64) + SHIFT


def _wide(a: np.ndarray, most: int) -> np.ndarray:
    """``a`` in Python integers if results up to ``most`` could pass 64 bits."""
    return a if most < 1 << 62 else a.astype(object)


def _top(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def _centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x minus ``middle``, in Python integers where 64 bits could overflow."""
    wide = _wide(x, _top(x) + max(map(abs, middle), default=0))
    return wide - np.array(middle, wide.dtype)


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the rows whose vector and entries are there and finite, entries as doubles.

    An entry whose x passes 64 bits has no x; its row is left out like one that is not finite.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    d = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 62) / SCALE))
    return d.filter((F.size("v") > 0) & fits)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, x) for the vectors of each length, a bounded number of rows at a time."""
    lists = batch.column(1)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
    for dim in map(int, np.unique(sizes)):
        mine = np.flatnonzero(sizes == dim)
        for at in range(0, len(mine), ROWS):
            rows = mine[at: at + ROWS]
            yield dim, rows, integers(flat[(ends[rows] - dim)[:, None] + np.arange(dim)[None, :]])


def _limbs(rows: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    """A batch of (dim, i, j, n, sum), the sum split into limbs."""
    kinds = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64()),
                       ("hi", pa.decimal128(38, 0)), ("lo", pa.decimal128(38, 0))])
    split = [(d, i, j, n, Decimal(s >> _LIMB), Decimal(s & ((1 << _LIMB) - 1))) for d, i, j, n, s in rows]
    cols = list(zip(*split)) if split else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], schema=kinds)


def _collect(parts: DataFrame) -> dict[int, tuple[int, dict[tuple[int, int], int]]]:
    """dim -> (n, exact sums by (i, j)); one number per dimension pair, however many rows there are."""
    total = parts.groupBy("dim", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "hi", "lo")])
    out: dict = {}
    for r in total.collect():
        n, sums = out.setdefault(r["dim"], (r["n"], {}))
        sums[r["i"], r["j"]] = (int(r["hi"]) << _LIMB) + int(r["lo"])
    return out


def sums(v: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dim -> n and the sum of x in each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for b in batches:
            for dim, rows, x in _blocks(b):
                n, s = held.get(dim, (0, [0] * dim))
                add = _wide(x, _top(x) * len(x)).sum(axis=0)
                held[dim] = n + len(rows), [a + int(c) for a, c in zip(s, add)]
        yield _limbs([(dim, i, i, n, s) for dim, (n, all_s) in held.items() for i, s in enumerate(all_s)])

    found = _collect(v.mapInArrow(run, _SUMS))
    return {dim: (n, [s[i, i] for i in range(dim)]) for dim, (n, s) in found.items()}


def squares(v: DataFrame, middles: dict[int, list[int]]) -> dict[int, dict[tuple[int, int], int]]:
    """dim -> exact sums of (y_i + y_j)^2 by (i, j), i < j, and of y_i^2 by (i, i), with y = x - middle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[np.ndarray]]] = {}
        for b in batches:
            for dim, rows, x in _blocks(b):
                y = _centred(x, middles[dim])
                y = _wide(y, (2 * _top(y)) ** 2 * len(y))
                n, so_far = held.get(dim, (0, [np.zeros(dim - i, object) for i in range(dim)]))
                for i in range(dim):
                    z = y[:, i:] + y[:, i: i + 1]
                    z[:, 0] = y[:, i]
                    so_far[i] = so_far[i] + (z * z).sum(axis=0).astype(object)
                held[dim] = n + len(rows), so_far
        for dim, (n, found) in held.items():
            for i in range(dim):
                yield _limbs([(dim, i, i + k, n, int(s)) for k, s in enumerate(found[i])])

    return {dim: s for dim, (_, s) in _collect(v.mapInArrow(run, _SUMS)).items()}


class Fit:
    """Mean, components and eigenvalues of the vectors of one length."""

    def __init__(self, n: int, s: list[int], middle: list[int], square: dict[tuple[int, int], int], components: int):
        dim = len(s)
        self.n, self.s, self.middle = n, s, middle
        self.rest = [a - n * m for a, m in zip(s, middle)]  # the sum of y

        def variance(i: int, j: int) -> int:
            """n^2 times the variance of x_i + x_j (of x_i, if they are one)."""
            r = self.rest[i] if i == j else self.rest[i] + self.rest[j]
            return n * square[i, j] - r * r

        own = [variance(i, i) for i in range(dim)]
        v = np.zeros((dim, dim))
        for i in range(dim):
            v[i, i] = own[i] / (n * n)
            for j in range(i + 1, dim):
                v[i, j] = v[j, i] = (variance(i, j) - own[i] - own[j]) / (2 * n * n)
        self.covariance = v
        values, columns = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        self.values, self.columns = values[order], columns[:, order]
        self.trace = sum(own) / (n * n)
        #: Eigenvalues that are zero to double precision have no whitened component.
        self.sound = self.values > max(self.trace, 0.0) * dim * np.finfo(np.float64).eps

    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if self.trace > 0 else None for e in self.values]

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exactly, from sums of y^2 and of (sum of y) * y."""
        y = _centred(x, self.middle)
        most = max(_top(y), max(map(abs, self.rest), default=0))
        y = _wide(y, _top(y) * most * max(1, x.shape[1]))
        a, b = (y * y).sum(axis=1), (y * np.array(self.rest, y.dtype)).sum(axis=1)
        c, n = sum(r * r for r in self.rest), self.n
        return [n * n * int(p) - 2 * n * int(q) + c for p, q in zip(a, b)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """(x - S / n) projected on the components, over the roots of their eigenvalues; NaN where there is none."""
        centred = _centred(x, self.middle).astype(np.float64) - np.array([r / self.n for r in self.rest])
        with np.errstate(invalid="ignore", divide="ignore"):
            return centred @ self.columns / np.where(self.sound, np.sqrt(np.abs(self.values)), np.nan)


def fit(v: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """One fit for every vector length among the rows."""
    first = sums(v)
    middles = {dim: [(2 * a + n) // (2 * n) for a in s] for dim, (n, s) in first.items()}
    second = squares(v, middles)
    return {dim: Fit(n, s, middles[dim], second[dim], components) for dim, (n, s) in first.items()}


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """dim -> largest absolute entry of the whitened rows' covariance minus the identity, measured on the rows."""
    out = {}
    for dim, f in fits.items():
        mine, sound = rows.filter(F.col("dim") == dim), [i for i in range(len(f.values)) if f.sound[i]]
        if not sound:
            out[dim] = 0.0
            continue
        mean = mine.agg(*[F.avg(F.col("whitened")[i]) for i in sound]).first()
        c = {i: F.col("whitened")[i] - F.lit(m) for i, m in zip(sound, mean)}
        pairs = [(i, j) for i in sound for j in sound if i <= j]
        got = mine.agg(*[F.avg(c[i] * c[j]) for i, j in pairs]).first()
        out[dim] = max(abs(x - (i == j)) for x, (i, j) in zip(got, pairs))
    return out


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, dim.

    Vectors that are null or hold null, non-finite or (beyond 64 bits) unscalable
    entries are left out.  Vectors of each length are whitened among
    themselves; ``n`` counts those.  There are min(components, length)
    components, so empty vectors give no row.  A component whose eigenvalue is
    zero to double precision has a null ``whitened`` and is left out of
    ``identity_error``; ``explained`` is null where all rows agree.  Null ids
    stay null, repeated rows count and appear each, further columns are
    ignored, an empty table gives no row.  ``deviation`` is a decimal, null
    beyond 38 digits.
    """
    v = vectors(table, id_col, vector_col)
    fits = fit(v, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("deviation", pa.decimal128(38, 0)),
                           ("whitened", pa.list_(pa.float64()))])
        limit = 10**38
        for b in batches:
            for dim, rows, x in _blocks(b):
                f = fits[dim]
                w = f.whiten(x)
                flat = pa.array(w.reshape(-1), mask=~np.isfinite(w.reshape(-1)))
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(rows)), pa.array([dim] * len(x), pa.int32()),
                    pa.array([Decimal(d) if d < limit else None for d in f.deviations(x)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, flat)], schema=kinds)

    rows = settle(v.mapInArrow(run, _ROWS))
    errors = identity_errors(rows, fits)
    out = None
    for dim, f in fits.items():
        facts = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col("whitened")[i].alias("whitened"),
                                   F.lit(e).cast("double").alias("explained"), F.lit(float(f.values[i])).alias("eigenvalue"))
                          for i, e in enumerate(f.explained())])
        mine = rows.filter(F.col("dim") == dim).select("vec_id", "dim", "deviation", F.inline(facts)).select(
            "vec_id", "component", F.lit(f.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
            F.lit(errors[dim]).alias("identity_error"), "eigenvalue", "dim")
        out = mine if out is None else out.unionByName(mine)
    if out is None:
        schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
                  "identity_error double, eigenvalue double, dim int")
        return table.sparkSession.createDataFrame([], schema)
    return out
