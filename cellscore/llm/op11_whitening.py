"""Whitening of vectors by the leading eigenvectors of their covariance, found by a Jacobi-Davidson iteration.

The covariance is never formed: a product with a block of vectors is one pass over the rows, each of which is centred and then
multiplied; tasks yield sums that Spark adds up by place, so the driver sees as many values as a vector has components, times the
width of the block. The search space is expanded by corrections t of the leading Ritz vectors u that are still open, the solutions of
(I - QQ')(A - rI)(I - QQ') t = -(A - r)u with Q the locked and the leading vectors, for which MINRES takes some steps, for all open
vectors in the same passes. A Rayleigh-Ritz step in the search space follows; vectors whose residual is as small as double
precision allows are locked, and the rest of the space stays orthogonal to them. In the end a block of random vectors
orthogonal to all locked ones is driven upwards, to see that no larger eigenvalue was passed over.

Entries are whole numbers, so their sums are exact, and n x - S is centred without rounding before it is divided by n.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped; a null id is a row like any other;
repeated rows count as often as they are there; equal eigenvalues have any orthonormal vectors of theirs; components whose
eigenvalue is 0, to rounding, are not returned (none for a single row or equal rows); fewer dimensions than components give
as many as there are; an empty table gives no row; other columns are ignored, whatever their names; vectors of different lengths,
and deviations that exceed a long, are errors, as is an iteration that does not end within MOST_ROUNDS.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded
from cellscore.plans import cut_lineage

#: Components; steps of MINRES in a round; the search space's least and greatest width, in components.
COMPONENTS, INNER, NARROW, WIDE = 8, 12, 2, 5
#: A residual counts as double precision below so many units of rounding of the greatest eigenvalue.
UNITS = 32
MOST_ROUNDS = 300


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def gathered(rows: DataFrame, kind: str, shape: tuple[int, int], work: Callable) -> np.ndarray:
    """The sum, of the given shape, of work(x) over all batches x of rows (arrays of longs); added up in tasks, then by place."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches):
        total, any_ = np.zeros(shape, dtype), False
        for batch in batches:
            if batch.num_rows:
                total += work(_whole(batch))
                any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["place", "v"])

    out = np.zeros(shape[0] * shape[1], dtype)
    found = bounded(rows).select("x").mapInArrow(run, f"place int, v {kind}").groupBy("place").agg(F.sum("v").alias("v")).toArrow()
    out[found.column("place").to_numpy()] = found.column("v").to_numpy()
    return out.reshape(shape)


def _centred(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """x -> n x - S, exact."""
    bound = np.abs(sums).max(initial=0)

    def centred(x: np.ndarray) -> np.ndarray:
        if (float(np.abs(x).max(initial=0)) * n + float(bound)) >= 2.0**63:
            raise OverflowError("n times a component exceeds a long")
        return x * n - sums

    return centred


class Covariance:
    """The covariance of rows as an operator; counts the passes over them."""

    def __init__(self, rows: DataFrame, n: int, sums: np.ndarray):
        self.rows, self.n, self.sums, self.passes = rows, n, sums, 0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        n, centred = self.n, _centred(self.n, self.sums)

        def work(x: np.ndarray) -> np.ndarray:
            c = centred(x) / n
            return c.T @ (c @ block)

        self.passes += 1
        return gathered(self.rows, "double", block.shape, work) / n


def minres(apply: Callable, b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Columns x with apply(x) near b, column by column, each over its own Krylov space; apply is symmetric in each."""
    x, old, v = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    size = np.linalg.norm(b, axis=0)
    goal = tolerance * size
    open_ = size > 0
    v[:, open_] = b[:, open_] / size[open_]
    beta, eta = np.zeros(b.shape[1]), size.copy()
    cos0, cos1, sin0, sin1 = np.ones(b.shape[1]), np.ones(b.shape[1]), np.zeros(b.shape[1]), np.zeros(b.shape[1])
    w0, w1 = np.zeros_like(b), np.zeros_like(b)
    for _ in range(steps):
        if not open_.any():
            break
        z = apply(v)
        delta = (v * z).sum(axis=0)
        z = z - delta * v - beta * old
        following = np.linalg.norm(z, axis=0)
        r0 = cos1 * delta - cos0 * sin1 * beta
        r1 = np.hypot(r0, following)
        r2 = sin1 * delta + cos0 * cos1 * beta
        r3 = sin0 * beta
        open_ &= r1 > 0
        safe = np.where(r1 > 0, r1, 1)
        cos0, cos1, sin0, sin1 = cos1, r0 / safe, sin1, following / safe
        w0, w1 = w1, (v - r3 * w0 - r2 * w1) / safe
        x[:, open_] += (cos1 * eta * w1)[:, open_]
        eta = -sin1 * eta
        open_ &= (np.abs(eta) > goal) & (following > 1e-14 * size)
        old, v, beta = v, z / np.where(following > 0, following, 1), following
    return x


@dataclass
class Components:
    """Orthonormal columns with falling eigenvalues, and how they were found."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    rounds: int
    passes: int


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the part of t that is orthogonal to the orthonormal columns of against."""
    for _ in range(3):
        t = t - against @ (against.T @ t)
        t = t / np.maximum(np.linalg.norm(t, axis=0), 1e-300)
    kept = []
    for column in t.T:
        for _ in range(2):
            for basis in (against, *([np.array(kept).T] if kept else [])):
                column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.zeros((t.shape[0], 0))


def jacobi_davidson(a, d: int, k: int = COMPONENTS, seed: int = 11) -> Components:
    """The k leading eigenpairs of the symmetric operator a (which has @ for blocks) of d dimensions."""
    k = min(k, d)
    rng = np.random.default_rng(seed)
    locked, values, residuals = np.zeros((d, 0)), np.zeros(0), np.zeros(0)
    space = _orthonormal(rng.normal(size=(d, min(d, NARROW * k))), locked)
    product = a @ space
    best, rounds, checked = np.full(k, np.inf), 0, False
    while True:
        rounds += 1
        if rounds > MOST_ROUNDS:
            raise ArithmeticError(f"no double precision after {MOST_ROUNDS} rounds; residuals {best}")
        small = space.T @ product
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        space, product = space @ y, product @ y
        want = k - locked.shape[1]
        lead, of = space[:, :want], product[:, :want]
        r = of - lead * theta[:want]
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        top = max(values.max(initial=0), theta.max(initial=0), 1e-300)
        done = size <= UNITS * np.finfo(float).eps * top
        first = int(np.argmin(np.append(done, False)))  # locked in order, so that none is passed over
        if space.shape[1] == d - locked.shape[1]:
            first = want  # the space is all there is
        if first:
            locked = np.concatenate([locked, lead[:, :first]], axis=1)
            values, residuals = np.append(values, theta[:first]), np.append(residuals, size[:first])
            space, product = space[:, first:], product[:, first:]
            theta = theta[first:]
            lead, r, size = lead[:, first:], r[:, first:], size[first:]
        if locked.shape[1] == k:
            if checked or locked.shape[1] == d or not space.shape[1] and d == k:
                break
            missed = _upwards(a, locked, rng, d)
            if missed is None or missed[1] <= values.min() * (1 + 1e-9) + UNITS * np.finfo(float).eps * top:
                break
            # the smallest one gives way to what it had hidden
            order = np.argsort(-values)[:-1]
            locked, values, residuals = locked[:, order], values[order], residuals[order]
            space = _orthonormal(np.concatenate([missed[0], rng.normal(size=(d, k))], axis=1), locked)
            product = a @ space
            continue
        if space.shape[1] + lead.shape[1] > WIDE * k:  # start again from the best of the space
            space, product = space[:, : NARROW * k], product[:, : NARROW * k]
        q = np.concatenate([locked, lead], axis=1)
        aside = lambda t: t - q @ (q.T @ t)  # noqa: B023, E731
        shift = theta[: lead.shape[1]]

        def corrected(v: np.ndarray) -> np.ndarray:
            v = aside(aside(v))
            return aside(a @ v - shift * v)  # noqa: B023

        t = minres(corrected, -aside(r), INNER, 2.0 ** -min(rounds + 1, 10))
        more = _orthonormal(np.concatenate([t, rng.normal(size=(d, 1))], axis=1) if not np.any(t) else t, np.concatenate([locked, space], axis=1))
        if not more.shape[1]:
            more = _orthonormal(rng.normal(size=(d, 1)), np.concatenate([locked, space], axis=1))
        product = np.concatenate([product, a @ more], axis=1) if more.shape[1] else product
        space = np.concatenate([space, more], axis=1)
        best[: len(size)] = size
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None, :], axis=0) < 0, -1, 1)
    return Components(vectors, values[order], residuals[order], rounds, getattr(a, "passes", 0))


def _upwards(a, locked: np.ndarray, rng, d: int) -> tuple[np.ndarray, float] | None:
    """The best vector, and its Ritz value, of a few block Krylov steps orthogonal to locked."""
    space = _orthonormal(rng.normal(size=(d, min(4, d - locked.shape[1]))), locked)
    if not space.shape[1]:
        return None
    last, product = space, np.zeros((d, 0))
    for _ in range(4):
        grown = a @ last
        product = np.concatenate([product, grown], axis=1)
        last = _orthonormal(grown, np.concatenate([locked, space], axis=1))
        if not last.shape[1]:
            break
        space = np.concatenate([space, last], axis=1)
    space = space[:, : product.shape[1]]
    small = space.T @ product
    theta, y = np.linalg.eigh((small + small.T) / 2)
    return space @ y[:, -1:], float(theta[-1])


def whitened(rows: DataFrame, key: str, components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error of rows (key, and x: an array of longs), as the module says.

    rows are written once to the shared folder, as each product passes over them.
    """
    kept = cut_lineage(rows.select(key, "x").where(F.size("x") > 0))
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, width, least = kept.agg(F.count("*"), F.max(F.size("x")), F.min(F.size("x"))).first()
    if not n:
        return kept.sparkSession.createDataFrame([], schema)
    if width != least:
        raise ValueError(f"vectors have {least} to {width} entries")
    sums = gathered(kept, "long", (1, width), lambda x: x.sum(axis=0)[None, :])[0]
    centred = _centred(n, sums)
    spread = gathered(kept, "double", (1, width), lambda x: ((centred(x) / n) ** 2).sum(axis=0)[None, :])[0]
    trace = spread.sum() / n
    found = jacobi_davidson(Covariance(kept, n, sums), width, components)
    real = found.values > 1e-12 * trace
    basis, values = found.vectors[:, real], found.values[real]
    k = len(values)
    if not k:
        return kept.sparkSession.createDataFrame([], schema)
    scale = basis / np.sqrt(values)
    mean = gathered(kept, "double", (1, k), lambda x: (centred(x) / n @ scale).sum(axis=0)[None, :])[0] / n

    def products(x: np.ndarray) -> np.ndarray:
        w = centred(x) / n @ scale - mean
        return w.T @ w

    identity_error = float(np.abs(gathered(kept, "double", (k, k), products) / n - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = centred(_whole(batch))
            if float((c.astype(np.float64) ** 2).sum(axis=1).max()) >= 2.0**63:
                raise OverflowError("a deviation exceeds a long")
            m = batch.num_rows
            again = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat((c * c).sum(axis=1), k)),
                pa.array((c / n @ scale).ravel()), pa.array(np.tile(values / trace, m)), pa.array(np.full(m * k, identity_error)),
            ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return bounded(kept).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all rows of embeddings, their entries in whole numbers, on their eight leading components."""
    doubles = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(doubles, lambda c: F.floor(c * 1024) + 100_000)
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("embedding").isNotNull() & finite)
    return whitened(e.select("vec_id", x.alias("x")), "vec_id")
