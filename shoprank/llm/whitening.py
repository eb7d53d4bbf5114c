"""Whitening of embeddings by spectral divide-and-conquer over QDWH polar decompositions.

Every entry c becomes the integer x = floor(1024 c) + 100000. Two passes gather the fit:
counts and sums of x, then the products of x minus its rounded mean. Both are exact integer
sums (matrix products of small integers in doubles, Python's integers beyond them), so the
covariance is right to the last bit of a double whatever the order of rows and tasks.

The covariance's eigenvectors come without an eigenvalue solver. ``qdwh`` finds the
orthogonal polar factor U of the covariance minus a shift by dynamically weighted Halley
steps; (U + I) / 2 projects on the eigenvectors above the shift, (I - U) / 2 on those below;
bases of both subspaces split the matrix into two smaller ones, and so on to single
components. Only blocks that hold one of the wanted components are split further. The
matrices are as wide as the vectors, whatever the number of rows, and the mean and the
components (``components`` vectors) are all that is sent to the tasks.

Rows without a vector, or with a null, NaN or infinite entry, or one beyond 2**52 in size
(its x would not be exact) are left out, and so are those whose vectors differ in length from
the most frequent length (of equally frequent ones the longer). Repeated rows count each;
ties between eigenvalues give any orthonormal basis of their space, the same for all rows.
Components without variance (an eigenvalue below RANK_EPS of the largest) are not returned,
so one row alone or equal rows give none. Other columns are ignored; an empty table gives no
rows. ``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
RANK_EPS = 1e-12
#: Rows of one exact matrix product: 2**40 * 2**12 is below 2**53.
ROWS, SMALL = 1 << 12, 1 << 20
LIMB = 1 << 60


# ---------------------------------------------------------------- divide and conquer

def qdwh(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf))
    try:
        least = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        least = 0.0
    least = min(1.0, max(least, np.finfo(float).eps))
    for _ in range(16):
        sq = least * least
        d = np.cbrt(4 * (1 - sq) / (sq * sq))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            step = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            step = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        step = (step + step.T) / 2
        moved = np.linalg.norm(step - x)
        x = step
        least = min(1.0, least * (wa + wb * sq) / (1 + wc * sq))
        if moved < 1e-8 and 1 - least < 1e-14:  # convergence is cubic
            break
    return x


def _split(a: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the two spaces of eigenvectors above and below a shift."""
    n = len(a)
    size = np.linalg.norm(a)
    best = None
    low, high = a.diagonal().min(), a.diagonal().max()
    for shift in [np.median(a.diagonal()), np.trace(a) / n, *(low + (high - low) * rng.random(6))]:
        polar = qdwh(a - shift * np.eye(n))
        above = (polar + np.eye(n)) / 2
        rank = round(np.trace(above))
        if not 0 < rank < n:
            continue
        basis = np.linalg.qr(above @ rng.standard_normal((n, rank)))[0]
        basis = np.linalg.qr(above @ basis, mode="complete")[0]
        upper, lower = basis[:, :rank], basis[:, rank:]
        off = np.linalg.norm(lower.T @ a @ upper)
        if best is None or off < best[0]:
            best = off, upper, lower
        if off <= 1e-14 * n * size:
            break
    if best is None:  # all eigenvalues agree to rounding
        return np.eye(n)[:, :1], np.eye(n)[:, 1:]
    return best[1], best[2]


def components_of(a: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` eigenvectors of a symmetric matrix, as columns by falling eigenvalue."""
    rng = np.random.default_rng(7)

    def down(m: np.ndarray, wanted: int) -> np.ndarray:
        n = len(m)
        rest = m - np.trace(m) / n * np.eye(n)
        if n == 1 or np.linalg.norm(rest) <= 4 * np.finfo(float).eps * np.linalg.norm(m):
            return np.eye(n)[:, :wanted]
        upper, lower = _split(m, rng)
        parts = []
        for basis, left in ((upper, wanted), (lower, wanted - upper.shape[1])):
            if left > 0:
                own = basis.T @ m @ basis
                parts.append(basis @ down((own + own.T) / 2, min(left, len(own))))
        return np.hstack(parts)

    found = down((a + a.T) / 2, min(most, len(a)))
    values = np.einsum("ij,ij->j", found, a @ found)
    found = found[:, np.argsort(-values, kind="stable")]
    largest = np.abs(found).argmax(axis=0)
    return found * np.where(found[largest, range(found.shape[1])] < 0, -1.0, 1.0)


# ---------------------------------------------------------------- passes over the rows

def _valid(batch: pa.RecordBatch, dim: int | None = None):
    """(ids, x) of the valid rows of a batch, by vector length."""
    vectors = batch.column("vector")
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for own in (np.unique(lengths).tolist() if dim is None else [dim]):
        if own == 0:
            continue
        rows = np.flatnonzero(lengths == own)
        scaled = np.floor(SCALE * entries[starts[rows][:, None] + np.arange(own)])
        with np.errstate(invalid="ignore"):
            good = (np.abs(scaled) <= 1 << 52).all(axis=1)  # NaN and infinite entries fail as well
        x = scaled[good].astype(np.int64) + SHIFT
        if len(x):
            yield own, batch.column("id").take(pa.array(rows[good])), x


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(batches):
    total: dict[int, list] = {}
    for batch in batches:
        for dim, _, x in _valid(batch):
            own = total.setdefault(dim, [0, np.zeros(dim, object)])
            own[0] += len(x)
            for lo in range(0, len(x), 256):  # 256 * 2**53 stays a long
                own[1] += x[lo:lo + 256].sum(axis=0).astype(object)
    for dim, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                                          pa.array([n] * dim, pa.int64()), _decimals(s)], ["dim", "i", "n", "s"])


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y.T @ y as Python's integers."""
    total = np.zeros((y.shape[1],) * 2, object)
    for lo in range(0, len(y), ROWS):
        part = y[lo:lo + ROWS]
        if np.abs(part).max() < SMALL:
            part = part.astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
        else:
            part = part.astype(object)
            total += part.T @ part
    return total


def _products(dim: int, centre: np.ndarray):
    def run(batches):
        total = np.zeros((dim, dim), object)
        for batch in batches:
            for _, _, x in _valid(batch, dim):
                total += _exact_products(x - centre)
        i, j = np.triu_indices(dim)
        high, low = zip(*(divmod(int(v), LIMB) for v in total[i, j]))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(high),
                                          _decimals(low)], ["i", "j", "high", "low"])

    return run


@dataclass
class Whitening:
    """The fit: all that tasks need. Its size depends on the vectors' length alone."""
    n: int
    sums: list[int]
    components: np.ndarray  # columns
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        mean, rest = zip(*(divmod(s, self.n) for s in self.sums))
        centred = (x - np.array(mean, np.int64)) - np.array([r / self.n for r in rest])
        return centred @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list:
        sums = np.array(self.sums, object)
        if self.n * int(np.abs(x).max()) < 1 << 62:
            z = self.n * x - sums.astype(np.int64)
            if float(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 62:
                return (z * z).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> Whitening | None:
    """The whitening of all valid rows; None where there are none."""
    vectors = _vectors(rows, id_col, vector_col)
    by_entry = vectors.mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0)").groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"))
    most = (by_entry.groupBy("dim").agg(F.max("n").alias("n"), F.collect_list(F.struct("i", "s")).alias("sums"))
            .orderBy(F.desc("n"), F.desc("dim")).limit(1).collect())
    if not most:
        return None
    dim, n, sums = most[0]["dim"], most[0]["n"], [int(s["s"]) for s in sorted(most[0]["sums"])]
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    pairs = (vectors.mapInArrow(_products(dim, centre), "i int, j int, high decimal(38,0), low decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    v = np.zeros((dim, dim))
    for r in pairs:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * (int(r["high"]) * LIMB + int(r["low"])) - rest[i] * rest[j]) / (n * n)
    found = components_of(v, components)
    values = np.einsum("ij,ij->j", found, v @ found)
    kept = values > RANK_EPS * max(values[0], 0) if values[0] > 0 else np.zeros(len(values), bool)
    return Whitening(n, sums, found[:, kept], values[kept], float(np.trace(v)))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest distance of an entry of the whitened rows' covariance from the identity."""
    k, dim = len(model.values), len(model.sums)

    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for _, _, x in _valid(batch, dim):
                w = np.hstack([model.project(x), np.ones((len(x), 1))])
                total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "s"])

    sums = np.zeros((k + 1, k + 1))
    for r in vectors.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r["i"], r["j"]] = sums[r["j"], r["i"]] = r["s"]
    mean = sums[:k, k] / model.n
    return float(np.abs(sums[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for every
    valid row and component."""
    model = fit(rows, id_col, vector_col, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], WHITENED)
    vectors, dim, k = _vectors(rows, id_col, vector_col), len(model.sums), len(model.values)
    error = identity_error(vectors, model)
    names = [f.split()[0] for f in WHITENED.split(", ")]

    def run(batches):
        for batch in batches:
            for _, ids, x in _valid(batch, dim):
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(each),
                    pa.array(model.project(x).ravel()), pa.array(np.tile(model.values / model.trace, m)),
                    pa.array(np.full(m * k, error))], names)

    return vectors.mapInArrow(run, WHITENED)
