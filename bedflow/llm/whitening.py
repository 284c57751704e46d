"""Whitening of embeddings by an incremental eigendecomposition.

An entry c becomes the integer ``floor(1024 c) + 100000``.  Every partition
keeps the spectrum (eigenvectors, eigenvalues) of its scatter matrix about its
own mean and takes in its vectors by centred rank-one updates: the new
eigenvalues are the roots of a secular equation, after deflating the directions
that a vector does not touch and those whose eigenvalues coincide.  A block of
more vectors than dimensions is first turned, by QR, into as many rows as
dimensions with the same scatter matrix, so that it costs dims + 1 updates.
Spectra meet in rounds of ``FAN_IN``: one takes up the other's eigenvectors as
successive rank-one updates, and the difference of the means as a last one.
The basis so found is refined by one distributed Rayleigh-Ritz step: the
covariance in that basis is summed over all vectors, centred with the exact
integer sums, and diagonalised (it has dims x dims entries).  The whitened rows
are written, and their own covariance is taken from the written rows.

The work a vector costs is bounded by its length; a task holds one spectrum
(dims x dims) and a slice of rows; the driver sees one spectrum and one matrix
of that size, never a vector of the table.

Rows without a vector, with a null or non-finite entry (or one of 2^50 and
more), and rows whose vector has another length than the commonest (ties: the
longer), take no part.  Repeated rows and
ids count as often as they occur.  Other columns are ignored, whatever their
names; a null id stays null.  A component without variance has a null
``whitened``, and ``explained`` 0 (null if no component has any).  An empty
table, or empty vectors, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import SLICE, stage

COMPONENTS = 8
#: The integer that an entry c becomes: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Vectors that are turned into rows of updates together.
BLOCK = 4096
#: Spectra that one task combines.
FAN_IN = 8
#: Entries from this size on have no integer of 62 bits and count as infinite.
LIMIT = float(2**50)
EPS = float(np.finfo(float).eps)
#: Steps of the root finder; each at least halves a root's bracket.
STEPS = 100
#: Eigenvalues below this share of the largest are no variance.
RANK_TOLERANCE = 1e-13

SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors array<double>"


# --- secular equation ----------------------------------------------------------

def secular_roots(d: np.ndarray, w2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(w2 / (d - x)) = 0 for rising, distinct ``d``,
    positive ``w2`` of sum 1 and positive ``rho``, as (origin, offset): root j
    lies between d[j] and d[j + 1] (the last below d[-1] + rho) and is measured
    from the nearer end, so that its distance to every ``d`` keeps its digits.

    All roots advance together.  A step fits a simple rational function to the
    poles on either side of a root; a step that leaves the root's bracket is
    replaced by halving it.
    """
    k = len(d)
    gaps = np.append(np.diff(d), rho)
    right = np.append(d[1:], d[-1] + rho)
    at = np.arange(k)

    weights = rho * w2
    below = np.tril(np.ones((k, k)))

    def parts(origin, x, rows):
        """psi, phi (poles up to and beyond a root) and their slopes."""
        dist = d - d[origin][:, None]
        dist -= x[:, None]
        if not dist.all():
            dist[dist == 0] = EPS * max(1.0, abs(d[-1]))
        term = weights / dist
        slope = term / dist
        mask = below if len(rows) == k else below[rows]
        psi, dpsi = np.einsum("ij,ij->i", term, mask), np.einsum("ij,ij->i", slope, mask)
        return psi, term.sum(1) - psi, dpsi, slope.sum(1) - dpsi

    half = gaps / 2
    psi, phi, _, _ = parts(at, half, at)
    near_right = (1 + psi + phi < 0) & (at < k - 1)
    origin = np.where(near_right, at + 1, at)
    # the bracket of a root, from its origin
    low = np.where(near_right, -half, np.where(1 + psi + phi < 0, half, 0.0))
    high = np.where(near_right, 0.0, np.where(1 + psi + phi < 0, gaps, half))
    x = (low + high) / 2
    todo = at.copy()
    for _ in range(STEPS):
        o, y = origin[todo], x[todo]
        psi, phi, dpsi, dphi = parts(o, y, todo)
        f = 1 + psi + phi
        open_ = np.abs(f) > 4 * EPS * (1 + np.abs(psi) + np.abs(phi)) * np.sqrt(k)
        low[todo] = np.where(f < 0, y, low[todo])
        high[todo] = np.where(f < 0, high[todo], y)
        open_ &= (high[todo] - low[todo]) > 2 * EPS * np.maximum(np.abs(low[todo]), np.abs(high[todo]))
        if not open_.any():
            break
        f, psi, phi, dpsi, dphi = (v[open_] for v in (f, psi, phi, dpsi, dphi))
        todo = todo[open_]
        o, y = origin[todo], x[todo]
        left = (d[todo] - d[o]) - y
        right_ = (right[todo] - d[o]) - y
        with np.errstate(all="ignore"):
            a = (left + right_) * f - left * right_ * (dpsi + dphi)
            b = left * right_ * f
            c = f - left * dpsi - right_ * dphi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            last = left + left * left * dpsi / (f - left * dpsi)
            step = np.where(todo == k - 1, last, step)
        new = y + step
        inside = np.isfinite(new) & (new > low[todo]) & (new < high[todo])
        x[todo] = np.where(inside, new, (low[todo] + high[todo]) / 2)
    return origin, x


def rank_one(d: np.ndarray, basis: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of basis diag(d) basis' + rho z z', for rising ``d``
    and ``rho`` >= 0; the values rise again."""
    w = basis.T @ z
    size = float(w @ w)
    if rho * size <= 0 or not np.isfinite(size):
        return d, basis
    w, rho = w / np.sqrt(size), rho * size
    top = max(abs(float(d[-1])), abs(float(d[0])), rho)
    kept = rho * np.abs(w) > EPS * top  # the others are eigenvectors as they are
    if not kept.any():
        return d, basis
    d, basis = d.copy(), basis
    # coinciding eigenvalues: turn their plane until the vector touches one of them only
    where = np.flatnonzero(kept)
    if len(where) > 1 and (np.diff(d[where]) <= 8 * EPS * top).any():
        basis, w = basis.copy(), w.copy()
        before = where[0]
        for i in where[1:]:
            r = np.hypot(w[before], w[i])
            c, s = w[i] / r, w[before] / r
            if (d[i] - d[before]) * abs(c * s) <= 8 * EPS * top:
                w[i], w[before] = r, 0.0
                basis[:, [before, i]] = basis[:, [before, i]] @ np.array([[c, s], [-s, c]])
                kept[before] = False
            before = i
        where = np.flatnonzero(kept)
    dk, wk = d[where], w[where]
    wk = wk / np.linalg.norm(wk)
    origin, x = secular_roots(dk, wk * wk, rho)
    k = len(dk)
    # distance of root j from eigenvalue i, without cancellation
    dist = (dk[origin] - dk[:, None]) + x[None, :]
    # the vector for which these roots are exact: keeps the new vectors orthogonal
    i, j = np.arange(k)[:, None], np.arange(k)[None, :]
    pole = np.where(j < i, dk[j], dk[np.minimum(j + 1, k - 1)]) - dk[i]
    pole[:, -1] = np.where(np.arange(k) == k - 1, 1.0, pole[:, -1])
    ratio = np.where(j < i, dist / np.where(pole == 0, 1.0, pole),
                     np.where(j < k - 1, dist / np.where(pole == 0, 1.0, pole), 1.0))
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1) * dist[:, -1] / rho))
    turn = np.where(wk < 0, -exact, exact)[:, None] / np.where(dist == 0, EPS * top, dist)
    turn /= np.linalg.norm(turn, axis=0)
    values = d.copy()
    values[where] = dk[origin] + x
    vectors = basis.copy()
    vectors[:, where] = basis[:, where] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Eigenvalues (rising) and eigenvectors of the scatter matrix of the
    vectors seen, about their mean."""

    def __init__(self, dims: int) -> None:
        self.n, self.mean = 0, np.zeros(dims)
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def add(self, x: np.ndarray) -> None:
        """Takes in the rows of ``x``.  More rows than dimensions are turned
        into as many rows as dimensions first (the triangle of their QR form),
        with the same scatter matrix about the same mean."""
        mean = x.mean(0)
        rows = x - mean
        if len(x) > len(mean):
            rows = np.linalg.qr(rows, mode="r")
        self.join(len(x), mean, rows, np.ones(len(rows)))

    def join(self, n: int, mean: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> None:
        """Takes up ``n`` vectors with this ``mean`` and the scatter matrix
        sum(weight * row row'): a rank-one update a row, and one for the means."""
        for row, weight in zip(rows, weights):
            if weight > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, row, float(weight))
        delta, both = mean - self.mean, self.n + n
        self.values, self.vectors = rank_one(self.values, self.vectors, delta, self.n * n / both)
        self.mean, self.n = self.mean + delta * (n / both), both

    def join_row(self, row) -> None:
        dims = len(self.mean)
        self.join(int(row["n"]), np.array(row["mean"]), np.array(row["vectors"]).reshape(dims, dims).T,
                  np.array(row["values"]))

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "mean": self.mean.tolist(), "values": self.values.tolist(),
                "vectors": self.vectors.ravel().tolist()}


# --- Spark ---------------------------------------------------------------------

def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column whose lists all have ``dims`` entries as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def integers(vec: Column) -> Column:
    return F.transform(vec, lambda c: (F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET)).cast("long"))


def _clean(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows that take part, x still of any length."""
    finite = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LIMIT)))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & finite).select("vec_id", integers(F.col("v")).alias("x")))


def entry_sums(fit: DataFrame, dims: int) -> list[int]:
    """Exact sums of the entries of x, one row of aggregates; as decimals if 64 bits do not hold them."""
    row = fit.agg(*[F.try_sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]).first()
    if any(s is None for s in row):
        row = fit.agg(*[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dims)]).first()
    return [int(s) for s in row]


def partition_spectra(fit: DataFrame, dims: int) -> DataFrame:
    """One spectrum a partition of ``fit`` (x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        found = Spectrum(dims)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                found.add(matrix(batch.column("x").slice(at, BLOCK), dims).astype(float))
        if found.n:
            yield pa.RecordBatch.from_pylist([found.row(TaskContext.get().partitionId())], schema=arrow_schema())
    return fit.select("x").mapInArrow(run, SPECTRUM)


def arrow_schema() -> pa.Schema:
    doubles = pa.list_(pa.float64())
    return pa.schema([("part", pa.int64()), ("n", pa.int64()), ("mean", doubles), ("values", doubles),
                      ("vectors", doubles)])


def combined(spectra: DataFrame, dims: int) -> Spectrum:
    """All spectra as one, in rounds of ``FAN_IN`` a task; each round is staged."""
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        out = Spectrum(dims)
        for row in group.to_dict("records"):
            out.join_row(row)
        return pd.DataFrame([out.row(int(group["part"].iloc[0]) // FAN_IN)])

    spectra = stage(spectra, "whitening-spectra")
    while spectra.limit(2).count() > 1:
        spectra = stage(spectra.groupBy((F.col("part") / FAN_IN).cast("long").alias("_g")).applyInPandas(
            merge, SPECTRUM), "whitening-round")
    out = Spectrum(dims)
    out.join_row(spectra.first())
    return out


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The means sums / n as integers and what is left of them below 1."""
    return np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=float) / n


def rayleigh_ritz(fit: DataFrame, basis: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of the covariance over ``fit``
    (divisor n, about sums / n) in the space of ``basis``: its columns are made
    orthonormal, the covariance in them is summed over all rows, and
    diagonalised.  Partial sums are one row a partition, added up entry by entry."""
    dims = len(sums)
    basis, _ = np.linalg.qr(basis)
    width = basis.shape[1]
    whole, rest = centre(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                y = ((matrix(batch.column("x").slice(at, SLICE), dims) - whole) - rest) @ basis
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"at": np.arange(width * width), "value": total.ravel()})
    parts = fit.select("x").mapInArrow(run, "at long, value double")
    cells = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()  # width x width
    ritz = np.zeros(width * width)
    for cell in cells:
        ritz[cell["at"]] = cell["value"]
    values, turn = np.linalg.eigh((ritz.reshape(width, width) + ritz.reshape(width, width).T) / (2 * n))
    return values[::-1], (basis @ turn)[:, ::-1]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exactly, for every row of ``x``.
    Where the differences fit 62 bits, their squares are added in halves of 31
    bits, and those in halves of 32."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    if (int(np.abs(x - base).max(initial=0)) + 1) * n >= 2**62:
        return [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    a = np.abs((x - base) * n - rest)
    high, low = a >> 31, a & (2**31 - 1)
    parts = []
    for p in (high * high, high * low, low * low):
        parts.append([int(u) * 2**32 + int(v) for u, v in zip((p >> 32).sum(1), (p & (2**32 - 1)).sum(1))])
    return [h * 2**62 + m * 2**32 + s for h, m, s in zip(*parts)]


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_text: one row per vector that takes part and component, from 1 by
    falling eigenvalue.

    ``deviation`` is null where it does not fit 64 bits (it grows with the
    square of the rows); ``deviation_text`` has all its digits.
    ``identity_error`` is measured on the whitened rows as written, over the
    components that have variance.
    """
    spark = rows.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, deviation_text string")
    clean = stage(_clean(rows, id_col, vec_col), "whitening-vectors")
    most = clean.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("dims")).first()
    if most is None or not most["dims"]:
        return spark.createDataFrame([], schema)
    dims, n = most["dims"], most["n"]
    fit = clean.where(F.size("x") == dims)
    sums = entry_sums(fit, dims)
    found = combined(partition_spectra(fit, dims), dims)
    values, vectors = rayleigh_ritz(fit, found.vectors, n, sums)
    total = float(values.sum())
    shown = min(components, dims)
    values, vectors = values[:shown], vectors[:, :shown]
    real = values > max(RANK_TOLERANCE * float(values[0]), 0.0)
    scaled = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)
    explained = [float(v) / total if r else 0.0 for v, r in zip(values, real)] if total > 0 else [None] * shown
    whole, rest = centre(n, sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                x = matrix(part.column("x"), dims)
                dev = deviations(x, n, sums)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id"),
                    pa.array([d if d < 2**63 else None for d in dev], pa.int64()),
                    pa.array([str(d) for d in dev], pa.string()),
                    pa.array(list(((x - whole) - rest) @ scaled), pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "deviation_text", "w"])
    white = stage(fit.mapInArrow(project, "vec_id long, deviation long, deviation_text string, w array<double>"),
                  "whitening-rows")
    error = identity_error(white, [i for i in range(shown) if real[i]], n)
    parts = F.array(*[F.struct(
        F.lit(i + 1).alias("component"), (F.col("w")[i] if real[i] else F.lit(None).cast("double")).alias("whitened"),
        F.lit(explained[i]).cast("double").alias("explained")) for i in range(shown)])
    return white.select("vec_id", "deviation", "deviation_text", F.explode(parts).alias("c")).select(
        "vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(error).cast("double").alias("identity_error"), "deviation_text")


def identity_error(white: DataFrame, used: list[int], n: int) -> float | None:
    """Largest absolute entry of the covariance of the written ``w`` minus the
    identity; null without components."""
    if not used:
        return None
    means = white.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in used]).first()
    centred = {i: F.col("w")[i] - F.lit(float(m)) for i, m in zip(used, means)}
    cells = [(i, j) for i in used for j in used if i <= j]
    got = white.agg(*[F.sum(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in cells]).first()
    return max(abs(c / n - (i == j)) for (i, j), c in zip(cells, got))
