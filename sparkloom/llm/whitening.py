"""Whitening of vectors along their leading principal directions.

Vectors become whole numbers, ``x = floor(1024 c) + 100000``. Their covariance V
is never built: a pass over the rows gives ``X'(X Q)`` for a block Q of a few
columns, where X are the rows less their mean, and the leading eigenvectors come
from Chebyshev-filtered subspace iteration. A round applies a Chebyshev polynomial
of V to the block, a pass for each degree, which damps the part of the spectrum
from its lower edge, estimated once, to the block's smallest Ritz value and lets the
part above grow; then QR makes
the block orthonormal and Rayleigh-Ritz, one more pass, gives eigenvalues, vectors
and residuals. Rounds go on until every wanted pair is certified by its residual
``|V q - e q|``, which bounds the error of e and, over the distance to the other
eigenvalues, that of q: it must be below ``RESIDUAL`` of the largest eigenvalue,
or have stopped falling, at the rounding of the sums, below ``ROUNDING`` of it.

A pass reads blocks of rows as binary matrices. A task adds up its products and
gives out a row for each dimension, Spark adds these up by dimension, and the
driver gets dimensions times columns numbers, whatever the number of rows; the
small QR and the small eigenproblem are solved there. The mean comes from exact
sums of whole numbers and is taken off each row as its whole part and its
fraction, so nothing is lost to the size of the offset.

Defined results: rows whose vector is null, empty, or holds a null or an entry that
is not finite are dropped. Entries of 2^38 and beyond in size have no whole number
here that double precision can hold; rows with one count as not finite. If vectors
differ in length, those of the commonest length are taken, of equally common ones
the longest, and the others dropped. Repeated rows, also with one id, are rows
each. Directions without variance (an eigenvalue of ``RANK`` of the largest or
less, so all of them if all rows are equal) cannot be whitened and have no rows;
an empty table gives an empty result. Equal eigenvalues have any basis of their
space. A deviation beyond a bigint is null. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import keep, ship

SCALE = 1024
OFFSET = 100_000
LARGEST = 2.0**38
COMPONENTS = 8
# Columns of the block beyond the wanted ones: the more, the fewer rounds.
MORE = 24
DEGREE = 8
EDGE_STEPS = 6
ROUNDS = 200
RESIDUAL = 1e-14
ROUNDING = 1e-10
RANK = 1e-12
BLOCK_ROWS = 4096
# How much faster the largest eigenvalue's part may grow than the smallest wanted one's.
RANGE = 1e8


def usable(table: DataFrame, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    return table.filter(
        F.coalesce(
            (F.size(v) > 0)
            & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)),
            F.lit(False),
        )
    )


def _whole(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as rows of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + OFFSET).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            x = _whole(whole.slice(at, BLOCK_ROWS).column("vector"))
            yield pa.RecordBatch.from_pydict({"x": [x.tobytes()]})


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column("x"):
            yield np.frombuffer(block.as_buffer(), dtype=np.int64).reshape(-1, d)


class Centred:
    """The rows of a table less their mean, and passes over them."""

    def __init__(self, table: DataFrame, vector_col: str, dimension: int):
        self.d = d = dimension
        named = table.select(F.col(vector_col).alias("vector"))
        self.blocks = keep(named.mapInArrow(_blocks, "x binary"), "whitening-blocks")

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, [0] * d
            for x in _matrices(batches, d):
                n += len(x)
                sums = [a + b for a, b in zip(sums, x.sum(axis=0).tolist())]
            if n:
                yield pa.RecordBatch.from_pydict({
                    "d": pa.array([*range(d), -1], pa.int32()),
                    "s": pa.array([*sums, n]).cast(pa.decimal128(38, 0)),
                })

        parts = self.blocks.mapInArrow(add_up, "d int, s decimal(38,0)")
        found = {r["d"]: int(r["s"]) for r in parts.groupBy("d").agg(F.sum("s").alias("s")).collect()}
        self.n = found.pop(-1)
        self.sums = [found[i] for i in range(d)]
        # The mean as whole numbers and what is left of it, below one.
        self.low = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % self.n / self.n for s in self.sums])

    def add(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """``work`` of all centred blocks, added up: arrays of one shape, rows few enough
        for the driver."""
        d, low, rest = self.d, self.low, self.rest
        rows, cols = work(np.zeros((1, d))).shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, any_row = np.zeros((rows, cols)), False
            for x in _matrices(batches, d):
                total += work((x - low) - rest)
                any_row = True
            if any_row:
                columns = {"row": pa.array(np.arange(rows, dtype=np.int32))}
                columns |= {f"c{j}": pa.array(total[:, j]) for j in range(cols)}
                yield pa.RecordBatch.from_pydict(columns)

        names = [f"c{j}" for j in range(cols)]
        fields = "row int, " + ", ".join(f"{c} double" for c in names)
        sums = self.blocks.mapInArrow(run, fields).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
        total = np.zeros((rows, cols))
        for r in sums.collect():
            total[r["row"]] = r[1:]
        return total

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        """V Q, by one pass."""
        return self.add(lambda z: z.T @ (z @ q)) / self.n

    def variances(self) -> np.ndarray:
        return self.add(lambda z: (z * z).sum(axis=0)[:, None])[:, 0] / self.n


def lower_edge(times: Callable[[np.ndarray], np.ndarray], dimension: int, steps: int = EDGE_STEPS) -> float:
    """About the smallest eigenvalue, from below: a few Lanczos steps, one column each.

    It only says where the filter need not be small, so an estimate will do.
    """
    basis = np.zeros((dimension, 0))
    v = np.random.default_rng(7).standard_normal(dimension)
    v /= np.linalg.norm(v)
    alphas, betas = [], []
    for _ in range(min(steps, dimension)):
        basis = np.column_stack([basis, v])
        w = times(v[:, None])[:, 0]
        alphas.append(float(v @ w))
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * abs(alphas[0]):
            break
        v = w / betas[-1]
    small = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(small)[0]) - betas[-1])


def filtered(
    times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, cut: float, top: float
) -> np.ndarray:
    """The Chebyshev polynomial that is small on [low, cut], applied to a block.

    It is scaled to one at ``top``, so numbers stay small.
    """
    half, middle = (cut - low) / 2, (cut + low) / 2
    sigma = half / (top - middle)
    twice = 2 / sigma
    before, now = q, (times(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        next_sigma = 1 / (twice - sigma)
        image = times(now) - middle * now
        before, now = now, image * (2 * next_sigma / half) - sigma * next_sigma * before
        sigma = next_sigma
    return now


def leading_pairs(
    times: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int = COMPONENTS, more: int = MORE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, their vectors as columns, and the residuals.

    ``times`` multiplies the matrix, symmetric and without negative eigenvalues,
    by a block of columns.
    """
    size = min(dimension, wanted + more)
    wanted = min(wanted, dimension)
    q = np.linalg.qr(np.random.default_rng(20240917).standard_normal((dimension, size)))[0]
    last, edge = math.inf, None
    for _ in range(ROUNDS):
        image = times(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = values[0]
        if not top > 0:
            return np.zeros(0), q[:, :0], np.zeros(0)
        residuals = np.linalg.norm(image - q * values, axis=0)[:wanted]
        rank = int((values[:wanted] > RANK * top).sum())
        worst = residuals[:rank].max() / top
        if worst <= RESIDUAL or (worst <= ROUNDING and worst > last / 2):
            return values[:rank], q[:, :rank], residuals[:rank]
        last = worst
        cut = max(values[-1], 0.1 * values[rank - 1])
        if cut >= top:
            # All of the block's eigenvalues are one: nothing to tell apart.
            cut = 0.5 * top
        if edge is None:
            edge = lower_edge(times, dimension)
        low = min(edge, 0.9 * cut)

        def growth(value: float) -> float:
            t = max((2 * value - cut - low) / (cut - low), 1.0)
            return t + math.sqrt(t * t - 1)

        ratio = growth(top) / growth(values[rank - 1])
        degree = DEGREE if ratio <= 1 else max(2, min(DEGREE, int(math.log(RANGE) / math.log(ratio))))
        q = np.linalg.qr(filtered(times, q, degree, low, cut, top))[0]
        q = np.linalg.qr(q)[0]
    raise ArithmeticError(f"no certified eigenvectors after {ROUNDS} rounds: residual {worst}")


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the sum of (n x - S)^2, exact."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if reach < 2**62:
        off = n * x - np.array(sums, dtype=np.int64)
        if x.shape[1] * int(np.abs(off).max(initial=0)) ** 2 < 2**63:
            return (off * off).sum(axis=1).tolist()
        off = off.astype(object)
    else:
        off = n * x.astype(object) - np.array(sums, dtype=object)
    return [v if v < 2**63 else None for v in (off * off).sum(axis=1).tolist()]


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error)."""
    ship(table.sparkSession)
    spark = table.sparkSession
    kind = table.schema[id_col]
    schema = T.StructType([
        T.StructField(id_col, kind.dataType, kind.nullable),
        *T.StructType.fromDDL(
            "component int, n bigint, deviation bigint, whitened double, explained double,"
            "identity_error double"
        ),
    ])
    good = usable(table, vector_col).select(F.col(id_col).alias("_id"), F.col(vector_col).alias("vector"))
    lengths = good.groupBy(F.size("vector").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    d = common["d"]
    rows = good.filter(F.size("vector") == d)
    centred = Centred(rows, "vector", d)
    values, vectors, _ = leading_pairs(centred.covariance_times, d, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    n, sums, low, rest = centred.n, centred.sums, centred.low, centred.rest
    explained = values / centred.variances().sum()
    onto = vectors / np.sqrt(values)
    r = len(values)

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ onto
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = centred.add(moments) / n
    error = float(np.abs(found[:r] - np.outer(found[r], found[r]) - np.eye(r)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = _whole(batch.column("vector"))
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), r))
                w = ((x - low) - rest) @ onto
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(each),
                        pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * r, n)),
                        pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                        pa.array(w.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * r, error)),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(project, schema)
