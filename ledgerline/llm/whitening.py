"""Whitening of embeddings: principal axes of the covariance, refined from single to double precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Components become whole numbers floor(SCALE * c) + SHIFT.
SCALE = 64
SHIFT = 1_000_000

#: A whole number may be this far from SHIFT; a row with one beyond it counts as not finite.
REACH = 1 << 30

#: Components returned for each row.
COMPONENTS = 32

#: Refinement steps end at the latest here; each squares the error, so single precision needs two or three.
STEPS = 30

#: Rows whose products are summed at a time.
ROWS = 1 << 14

EPSILON = float(np.finfo(np.float64).eps)
ROOT = EPSILON**0.5

#: Clusters inside clusters that start in single precision; a deeper one, of which no digits are left, in double.
DEPTH = 4


def scaled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, x): vectors as whole numbers, little-endian 64-bit. Null, empty, null-holding or non-finite vectors go."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, blobs = [], [], []
            for k, vector in enumerate(batch.column(1)):
                if not vector.is_valid or vector.values.null_count or not len(vector.values):
                    continue
                value = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False))
                if np.isfinite(value).all() and np.abs(value).max() <= REACH:
                    ids.append(k)
                    dims.append(len(value))
                    blobs.append((value.astype("<i8") + SHIFT).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())], ["vec_id", "dim", "x"])

    kind = dict(embeddings.dtypes)["vec_id"]
    return embeddings.select("vec_id", F.col("embedding").cast("array<double>")).mapInArrow(work, f"vec_id {kind}, dim int, x binary")


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows of the batch, their vectors), at most ROWS rows at a time."""
    dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
    blobs = batch.column(batch.schema.get_field_index("x"))
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        for k in range(0, len(own), ROWS):
            rows = own[k : k + ROWS]
            yield dim, rows, np.frombuffer(b"".join(blobs.take(pa.array(rows)).to_pylist()), "<i8").reshape(len(rows), dim)


def exact_product(a: np.ndarray) -> np.ndarray:
    """a.T @ a of whole numbers, exactly: as doubles where sums stay below 2^53, else as 64-bit numbers of fewer rows."""
    top = int(np.abs(a).max(initial=0))
    if top * top * len(a) < 1 << 53:
        wide = a.astype(np.float64)
        return (wide.T @ wide).astype(np.int64)
    return a.T @ a


def _summed(df: DataFrame, make) -> dict[int, list[tuple[int, int, int]]]:
    """Sums by (dim, i, j) of what ``make`` yields for each part of a batch; i = -2 counts, i = -1 sums.

    A task sums its own batches first; the driver gets one row per entry. Sums are of whole numbers and hence exact in any order.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                for i, j, v in make(dim, x):
                    full = np.full(len(v), dim, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(v)], ["dim", "i", "j", "v"])

    parts = df.select("dim", "x").mapInArrow(work, "dim int, i int, j int, v long")
    out: dict[int, list[tuple[int, int, int]]] = {}
    for r in parts.groupBy("dim", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out.setdefault(r["dim"], []).append((r["i"], r["j"], int(r["v"])))
    return out


def totals(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each dimension the number of vectors and the sums of their coordinates."""

    def make(dim: int, x: np.ndarray):
        yield np.r_[-2, np.full(dim, -1)], np.r_[0, np.arange(dim)], np.r_[len(x), x.sum(axis=0)]

    found = {}
    for dim, rows in _summed(vectors, make).items():
        sums = dict(((i, j), v) for i, j, v in rows)
        found[dim] = (sums[-2, 0], [sums[-1, j] for j in range(dim)])
    return found


def covariances(vectors: DataFrame, known: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Covariances, divisor n, each entry the exact value rounded once.

    Vectors are centred at the whole number next to the mean before they are multiplied; what is left to the mean, at
    most a half, is taken off the exact sums of the products.
    """
    centres = {dim: np.array([(2 * s + n) // (2 * n) for s in sums], np.int64) for dim, (n, sums) in known.items()}

    def make(dim: int, x: np.ndarray):
        z = x - centres[dim]
        top = int(np.abs(z).max(initial=1)) or 1
        rows = max(1, (1 << 62) // (top * top))
        i, j = np.triu_indices(dim)
        for k in range(0, len(z), rows):
            yield i, j, exact_product(z[k : k + rows])[i, j]

    out = {}
    for dim, rows in _summed(vectors, make).items():
        n, sums = known[dim]
        left = [s - n * int(c) for s, c in zip(sums, centres[dim])]
        matrix = np.zeros((dim, dim))
        for i, j, v in rows:
            matrix[i, j] = matrix[j, i] = (n * v - left[i] * left[j]) / (n * n)
        out[dim] = matrix
    return out


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of neighbouring eigenvalues that lie no further apart, for each chain of two or more."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > apart) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def refined(matrix: np.ndarray, vectors: np.ndarray, floor: float, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix of entries up to 1, from approximate vectors, by Ogita-Aishima steps.

    A step takes R = I - X'X and S = X'AX, eigenvalues S_ii / (1 - R_ii), and corrects X by X E, where E mixes two columns in
    proportion to S_ij over the gap of their eigenvalues. Where the gap is too small for that (a cluster), E only makes columns
    orthogonal. When the steps have settled, every cluster is solved as a matrix of its own, shifted to the cluster's
    mean and scaled, so that its gaps are large again: single-precision vectors, refined the same way, turn the
    cluster's columns. Eigenvalues closer than ``floor`` count as equal, and any basis of theirs will do.
    """
    values, vectors, apart = _settled(matrix, vectors, 0.0)
    for part in _clusters(values, apart):
        own, shift = vectors[:, part], float(values[part].mean())
        inner = own.T @ (matrix @ own - shift * own)
        inner = (inner + inner.T) / 2
        size = float(np.abs(inner).max())
        if size <= floor:
            continue
        _, turn = np.linalg.eigh((inner / size).astype(np.float32 if depth < DEPTH else np.float64))
        if depth < DEPTH:
            _, turn = refined(inner / size, turn.astype(np.float64), floor / size, depth + 1)
        vectors[:, part] = own @ turn
    values, vectors, _ = _settled(matrix, vectors, apart)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _settled(matrix: np.ndarray, vectors: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, vectors after steps until corrections stop shrinking, and the gap below which columns were not parted.

    No gap is used below the root of the precision: there the square of a rounding error would be seen.
    """
    norm, before, kept = float(np.abs(matrix).sum(axis=1).max()), np.inf, None
    for _ in range(STEPS):
        r = np.eye(len(matrix)) - vectors.T @ vectors
        s = vectors.T @ matrix @ vectors
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        apart = max(2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(r, 2)), norm * ROOT, least)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > apart
        error = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1.0), r / 2)
        size = float(np.abs(error).max())
        if size >= before and size < ROOT:
            return values, kept, apart
        kept, before = vectors, size
        vectors = vectors + vectors @ error
        if size <= 4 * EPSILON:
            break
    return values, vectors, apart


def principal_axes(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors in double precision, starting from single precision."""
    size = float(np.abs(covariance).max(initial=0.0))
    if size == 0.0:
        return np.zeros(len(covariance)), np.eye(len(covariance))
    whole = covariance / size
    _, first = np.linalg.eigh(whole.astype(np.float32))
    values, vectors = refined(whole, first[:, ::-1].astype(np.float64), 4 * EPSILON * len(whole))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values * size, vectors * signs


@dataclass
class Whitening:
    """One dimension's fit: whitened = (x - mean) @ axes, where the mean is total / n."""

    n: int
    total: list[int]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.total], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.total])
        return ((x - whole) - rest) @ self.axes

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact sums of (n x - S)^2. A sum beyond 64 bits ends the job."""
        total = np.array(self.total, object)
        whole = np.array([s // self.n for s in self.total], np.int64)
        top = (int(np.abs(x - whole).max(initial=0)) + 1) * self.n
        if top * top * x.shape[1] < 1 << 63:
            rest = (total - self.n * whole.astype(object)).astype(np.int64)
            return ((self.n * (x - whole) - rest) ** 2).sum(axis=1)
        found = ((self.n * x.astype(object) - total) ** 2).sum(axis=1)
        if len(found) and max(found) >= 1 << 63:
            raise OverflowError("a deviation does not fit a long")
        return found.astype(np.int64)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each dimension that vectors have. Axes without variance (to rounding) cannot be whitened and are left out."""
    known = totals(vectors)
    out = {}
    for dim, matrix in covariances(vectors, known).items():
        values, axes = principal_axes(matrix)
        live = int((values[:components] > 8 * EPSILON * dim * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
        trace = float(np.trace(matrix))
        out[dim] = Whitening(*known[dim], axes[:, :live] / np.sqrt(values[:live]), values[:live] / trace if live else np.zeros(0))
    return out


def with_identity_error(vectors: DataFrame, models: dict[int, Whitening]) -> dict[int, Whitening]:
    """Measures, over all rows, how far the covariance of what the models return is from the identity.

    A batch is centred at its own mean; batches' counts, means and products are put together by Spark as sums.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                w = models[dim].project(x)
                mean = w.mean(axis=0)
                centred = w - mean
                i, j = np.triu_indices(w.shape[1])
                inside = (centred.T @ centred)[i, j]
                between = len(x) * mean[i] * mean[j]
                first = np.r_[np.full(len(mean), -1), i]
                second = np.r_[np.arange(len(mean)), j]
                value = np.r_[len(x) * mean, inside + between]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), dim, np.int32)), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), pa.array(value)], ["dim", "i", "j", "v"]
                )

    sums = vectors.select("dim", "x").mapInArrow(work, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    for dim, model in models.items():
        own = {(r["i"], r["j"]): r["v"] / model.n for r in sums if r["dim"] == dim}
        errors = [abs(v - own[-1, i] * own[-1, j] - (i == j)) for (i, j), v in own.items() if i >= 0]
        model.identity_error = max(errors, default=0.0)
    return models


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Left out are vectors that are null or empty, hold null or non-finite entries, or entries that scaled lie beyond REACH. Vectors of
    different dimensions are fitted apart, each list with its own n. Components without variance cannot be whitened and
    have no rows, so a single vector or equal vectors give none. Repeated rows and rows without a vec_id count like any
    other. Equal eigenvalues leave the axes free inside their space. An empty table gives an empty table. Other columns are
    not read. The driver holds one matrix per dimension; tasks send it dim * (dim + 1) / 2 sums.
    """
    vectors = scaled(embeddings)
    models = with_identity_error(vectors, fit(vectors, components))
    sent = embeddings.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _by_dim(batch):
                model = sent.value[dim]
                w = model.project(x)
                count = w.shape[1]
                number = np.tile(np.arange(count, dtype=np.int32), len(rows))
                columns = [
                    batch.column(0).take(pa.array(np.repeat(rows, count))), pa.array(number + np.int32(1)), pa.array(np.full(len(number), model.n)),
                    pa.array(np.repeat(model.deviations(x), count)), pa.array(w.ravel()), pa.array(model.explained[number]),
                    pa.array(np.full(len(number), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = dict(embeddings.dtypes)["vec_id"]
    return vectors.mapInArrow(work, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
