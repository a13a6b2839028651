"""Embedding whitening by spectrum slicing.

Each entry c becomes the long floor(64 c) + 1000000. Spark sums the vectors and then, centred on
the rounded mean, their products: whole numbers that are exact in any order, so that the
covariance is the same on every partitioning and right to the last bit. The covariance, as large
as the vectors are wide whatever their number, is taken apart on the driver:

* an LDL' factorisation of the covariance less a shift has as many positive pivots as there are
  eigenvalues above the shift; bisecting shifts by these counts isolates each leading eigenvalue;
* Rayleigh quotient iteration from the isolated interval converges cubically to the eigenpair, and
  is turned down, and the interval halved, when it leaves the interval;
* two more counts, just below and just above the value, certify its number. Values too close to
  part are one cluster, whose space comes from inverse iteration on a block.

Defined results: rows whose vector is null or empty, holds null or non-finite entries, or entries
of 2**44 and more in size, are left out; where lengths differ the commonest one counts (of equally
common ones the longest) and other rows are left out; rows that repeat count each time; null ids
stay; directions without variance (below 1e-9 of the largest eigenvalue) are no components, so one
row, or rows all alike, have none; an empty table gives no rows; the largest entry of a component
is positive; other columns are returned by ``transform`` and it renames nothing of the caller's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import fresh_name, refuse_clashes, tidy

SCALE, OFFSET, LARGEST = 64, 1_000_000, 2.0**50
ROWS = 4096  # rows at a time: products of entries below 2**20 then add up exactly in doubles
RANK = 1e-9  # eigenvalues below this part of the largest one count as none
LONG = 2**63 - 1


@dataclass
class Spectrum:
    """Exact sums of ``n`` vectors and the leading eigenpairs of their covariance, by falling value."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray  # one column a component
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries as scaled longs, and where each row's start and how many there are (0: not usable)."""
    sizes = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(entries * SCALE)
        bad = ~(np.abs(scaled) < LARGEST)
    ends, spoilt = np.cumsum(sizes), np.concatenate([[0], np.cumsum(bad)])
    starts = ends - sizes
    sizes = np.where(spoilt[ends] > spoilt[starts], 0, sizes)
    return np.where(bad, 0, scaled).astype(np.int64) + OFFSET, starts, sizes


def _blocks(batch: pa.RecordBatch, column: str, width: int):
    """(rows of the batch, their x-vectors), up to ``ROWS`` usable rows at a time."""
    x, starts, sizes = _usable(batch.column(batch.schema.get_field_index(column)))
    rows = np.flatnonzero(sizes == width)
    for k in range(0, len(rows), ROWS):
        part = rows[k : k + ROWS]
        yield part, x[starts[part][:, None] + np.arange(width)]


def _whole(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.decimal128(38, 0))


def _sums(column: str):
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            _, _, sizes = _usable(batch.column(batch.schema.get_field_index(column)))
            for width in np.unique(sizes[sizes > 0]).tolist():
                own = held.setdefault(width, [0, np.zeros(width, object)])
                for rows, x in _blocks(batch, column, width):
                    own[0], own[1] = own[0] + len(rows), own[1] + x.sum(0).astype(object)
        for width, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([width] * (width + 1)), pa.array(range(-1, width)), _whole([n, *sums])], ["width", "i", "v"])

    return tidy(run)


def _products(column: str, mean: list[int]):
    at, width = np.array(mean), len(mean)
    i, j = np.triu_indices(width)

    def run(batches):
        total = np.zeros((width, width), object)
        for batch in batches:
            for _, x in _blocks(batch, column, width):
                d = x - at
                small = np.abs(d).max() < 2**20
                d = d.astype(np.float64) if small else d.astype(object)
                total = total + (d.T @ d).astype(np.int64 if small else object).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), _whole(total[i, j])], ["i", "j", "v"])

    return tidy(run)


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: the positive pivots of LDL' with Bunch and Kaufman's pivoting."""
    a, n, k, above = matrix - shift * np.eye(len(matrix)), len(matrix), 0, 0
    limit = (1 + 17**0.5) / 8

    def swap(p: int, q: int) -> None:
        a[[p, q]] = a[[q, p]]
        a[:, [p, q]] = a[:, [q, p]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max() if len(below) else 0.0
        pair = False
        if abs(a[k, k]) < limit * most:
            r = k + 1 + int(below.argmax())
            other = np.abs(a[k:, r])
            other[r - k] = 0
            if abs(a[k, k]) * other.max() < limit * most**2:
                pair = abs(a[r, r]) < limit * other.max()
                swap(k + 1 if pair else k, r)
        if pair:
            block, c = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2]
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            above += 1 if det < 0 else 2 * int(block[0, 0] > 0)
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(block, c.T)
            k += 2
        else:
            d = a[k, k]
            above += int(d > 0)
            if d:
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / d, a[k + 1 :, k])
            k += 1
    return above


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, nudge: float) -> np.ndarray:
    """Shifted solution, of length one; an exactly singular shift is nudged."""
    for step in (0.0, nudge, 4 * nudge):
        try:
            y = np.linalg.solve(matrix - (shift + step) * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise ArithmeticError("no shift near the eigenvalue could be solved for")


def _without(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in found:
            x = x - np.outer(v, v @ x) if x.ndim == 2 else x - v * (v @ x)
    return x


def leading_eigenpairs(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling) and unit eigenvectors (columns) of a covariance, numbers certified."""
    n, norm = len(matrix), float(np.abs(matrix).sum(1).max(initial=0.0))
    if not norm:
        return np.zeros(0), np.zeros((n, 0))
    fine = 16 * n * np.finfo(float).eps * norm
    known = {norm + fine: 0, -fine: n}
    random = np.random.default_rng(11)

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = eigenvalues_above(matrix, shift)
        return known[shift]

    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < min(components, n):
        k = len(values) + 1
        low, high = max(s for s, c in known.items() if c >= k), min(s for s, c in known.items() if c < k)
        pair = None
        while pair is None and high - low > fine:
            middle = (low + high) / 2
            if known[low] == k and known[high] == k - 1:
                pair = _rayleigh(matrix, low, high, random.standard_normal(n), fine, [v for v, e in zip(vectors, values) if e - high < 1e-3 * norm])
            if pair is None:
                low, high = (middle, high) if above(middle) >= k else (low, middle)
        if pair:
            new = [pair]
        else:  # one value to the last bits: a space of as many dimensions as the counts differ by
            size = above(low) - (k - 1)
            space = random.standard_normal((n, size))
            for _ in range(4):
                space = np.linalg.qr(_without(_solve(matrix, (low + high) / 2, np.linalg.qr(_without(space, vectors))[0], fine), vectors))[0]
            new = [(float(v @ matrix @ v), v) for v in space.T]
        if values and new[0][0] < RANK * values[0]:
            break
        for value, vector in new:
            if not (above(value - 2 * fine) >= len(values) + 1 and above(value + 2 * fine) <= k - 1):
                raise ArithmeticError(f"eigenvalue {len(values) + 1} could not be certified")
            values.append(value)
            vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
    keep = [e > RANK * values[0] for e in values][:components]
    return np.array(values[: len(keep)])[keep], np.array(vectors[: len(keep)]).T[:, keep]


def _rayleigh(matrix, low, high, x, fine, near):
    """The eigenpair in an interval that holds one eigenvalue, or None if the iteration leaves it. ``near``: eigenvectors of close values."""
    x = _without(x, near)
    for _ in range(2):
        x = _solve(matrix, (low + high) / 2, x / np.linalg.norm(x), fine)
    for _ in range(12):
        x = _without(x / np.linalg.norm(x), near)
        x /= np.linalg.norm(x)
        value = float(x @ matrix @ x)
        if not low < value < high:
            return None
        if np.linalg.norm(matrix @ x - value * x) < fine / 64:
            x = _solve(matrix, value, x, fine / 256)  # once more, for the vector's last digits
            x = _without(x / np.linalg.norm(x), near)
            x /= np.linalg.norm(x)
            return float(x @ matrix @ x), x
        x = _solve(matrix, value, x, fine)
    return None


def fit(vectors: DataFrame, vector_col: str, components: int = 32) -> Spectrum | None:
    """The spectrum of all usable vectors; None if there are none."""
    column = vectors.select(F.col(vector_col).alias("x"))
    sums = column.mapInArrow(_sums("x"), "width long, i long, v decimal(38,0)")
    sizes = sums.where("i = -1").groupBy("width").agg(F.sum("v").alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1)
    if not (best := sizes.first()):
        return None
    width, n = best["width"], int(best["n"])
    got = {r["i"]: int(r["v"]) for r in sums.where(F.col("width") == width).groupBy("i").agg(F.sum("v").alias("v")).collect()}
    total = [got[i] for i in range(width)]  # as many numbers as a vector is wide
    mean = [s // n for s in total]
    products = column.mapInArrow(_products("x", mean), "i long, j long, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    covariance = np.zeros((width, width))
    rest = [s - n * m for s, m in zip(total, mean)]
    trace = 0
    for r in products.collect():  # a number for each two dimensions
        i, j = r["i"], r["j"]
        exact = n * int(r["v"]) - rest[i] * rest[j]
        covariance[i, j] = covariance[j, i] = exact / n**2
        trace += exact * (i == j)
    values, axes = leading_eigenpairs(covariance, components)
    return Spectrum(n, total, values, axes, trace / n**2)


def _project(x: np.ndarray, model: Spectrum) -> tuple[np.ndarray, list]:
    """Whitened coordinates, and the exact sums of (n x - S)**2."""
    sums = np.array(model.sums, object)
    wide = max([abs(s) for s in model.sums] + [1]) + model.n * int(np.abs(x).max(initial=0)) >= LONG
    scaled = model.n * x.astype(object) - sums if wide else model.n * x - sums.astype(np.int64)
    fits = not wide and len(model.sums) * int(np.abs(scaled).max(initial=0)) ** 2 <= LONG
    squares = (scaled * scaled if fits else scaled.astype(object) ** 2).sum(1)
    centred = (scaled / model.n).astype(np.float64)
    return centred @ (model.vectors / np.sqrt(model.values)), squares.tolist()


def _whitened(column: str, model: Spectrum, names: list[str]):
    def run(batches):
        for batch in batches:
            for rows, x in _blocks(batch, column, model.width):
                out, squares = _project(x, model)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, lists, pa.array([s if s <= LONG else None for s in squares], pa.int64())], [*kept.schema.names, *names])

    return tidy(run)


def _moments(column: str, model: Spectrum):
    size = len(model.values)
    i, j = np.triu_indices(size)

    def run(batches):
        total, sums = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for _, x in _blocks(batch, column, model.width):
                out, _ = _project(x, model)
                total, sums = total + out.T @ out, sums + out.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, np.arange(size)]), pa.array(np.r_[j, np.full(size, -1)]), pa.array(np.r_[total[i, j], sums])], ["i", "j", "v"])

    return tidy(run)


def identity_error(vectors: DataFrame, vector_col: str, model: Spectrum) -> float:
    """The largest entry of the whitened vectors' covariance less the identity. They are centred already;
    what rounding leaves of their mean is taken off."""
    column = vectors.select(F.col(vector_col).alias("x"))
    rows = column.mapInArrow(_moments("x", model), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    mean = {r["i"]: r["v"] / model.n for r in rows if r["j"] < 0}
    return max((abs(r["v"] / model.n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in rows if r["j"] >= 0), default=0.0)


def transform(vectors: DataFrame, vector_col: str, model: Spectrum, whitened_col: str = "whitened", deviation_col: str = "deviation") -> DataFrame:
    """The usable rows of ``vectors`` with their whitened coordinates, by component, and n**2 times their squared
    distance from the mean (null where that is no long). A column named as a result is refused (ValueError)."""
    refuse_clashes(vectors, [whitened_col, deviation_col])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema] + [f"`{whitened_col}` array<double>", f"`{deviation_col}` long"])
    return vectors.mapInArrow(_whitened(vector_col, model, [whitened_col, deviation_col]), ddl)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """A row for each usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"))
    model = fit(slim, "x", components)
    if model is None or not len(model.values):
        model, error = Spectrum(0, [0], np.zeros(0), np.zeros((1, 0)), 1.0), 0.0
        slim = slim.limit(0)
    else:
        error = identity_error(slim, "x", model)
    share = F.array(*[F.lit(float(e) / model.trace) for e in model.values]).cast("array<double>")
    rows = transform(slim, "x", model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(F.col("id").alias(fresh_name(rows.drop("id"), id_col)), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
