"""Least squares by normal equations, or by orthogonal factors where these lose too much.

The rows are read once, and one row of k * (k + 1) / 2 + k sums comes out, k
being the number of features, whatever the input holds. Decimal features give
exact sums. For hundreds of features take the Gram matrix as a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.numbers import from_units, sum_of_units, whole_units
from sparkloom.operators.matrix import coo_multiply, transpose


def gram_join(coo: DataFrame) -> DataFrame:
    """X'X of a coordinate matrix: its transpose times itself."""
    return coo_multiply(transpose(coo), coo)


def _product_sum(a: Column, b: Column, scale: int | None) -> Column:
    if scale is None:
        return F.sum(a * b).cast("double")
    units = whole_units(a, scale) * whole_units(b, scale)
    return from_units(sum_of_units(units), 2 * scale).cast("double")


def _cell(i: int, j: int, value: Column) -> Column:
    return F.struct(
        F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"), value.alias("v")
    )


def gram(df: DataFrame, features: dict[str, Column], scale: int | None = None) -> DataFrame:
    """X'X as cells (i, j, v), each product summed once for both triangles.

    With ``scale`` the features have at most that many decimals and the sums
    do not depend on the order of the rows.
    """
    columns = list(features.values())
    k = len(columns)
    sums = df.agg(
        *[
            _product_sum(columns[a], columns[b], scale).alias(f"s{a}_{b}")
            for a in range(k)
            for b in range(a, k)
        ]
    )
    cells = [
        _cell(i, j, F.col(f"s{min(i, j)}_{max(i, j)}")) for i in range(k) for j in range(k)
    ]
    return sums.select(F.inline(F.array(*cells)))


def xty(
    df: DataFrame, features: dict[str, Column], target: Column, scale: int | None = None
) -> DataFrame:
    """X'y as (i, v)."""
    columns = list(features.values())
    sums = df.agg(
        *[_product_sum(c, target, scale).alias(f"s{i}") for i, c in enumerate(columns)]
    )
    cells = [_cell(i, 0, F.col(f"s{i}")) for i in range(len(columns))]
    return sums.select(F.inline(F.array(*cells))).select("i", "v")


def ols(
    df: DataFrame, features: dict[str, Column], target: Column, scale: int | None = None
) -> DataFrame:
    """theta = pinv(X'X) X'y as (term, theta), one row per feature.

    Rows with a NULL in a feature or the target are left out. One task solves
    the k by k system, given the single row of sums.
    """
    names = list(features)
    k = len(names)
    x = [F.col(f"x{i}") for i in range(k)]
    y = F.col("y")
    rows = df.select(
        *[c.alias(f"x{i}") for i, c in enumerate(features.values())], target.alias("y")
    ).dropna()
    upper = [(a, b) for a in range(k) for b in range(a, k)]
    sums = rows.agg(
        F.count("*").alias("n"),
        F.array(*[_product_sum(x[a], x[b], scale) for a, b in upper]).alias("gram"),
        F.array(*[_product_sum(c, y, scale) for c in x]).alias("xty"),
    ).filter("n > 0")

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                normal = np.zeros((k, k))
                for (a, b), value in zip(upper, row.gram):
                    normal[a, b] = normal[b, a] = value
                theta = np.linalg.pinv(normal) @ np.asarray(row.xty)
                yield pd.DataFrame({"term": names, "theta": theta})

    return sums.mapInPandas(solve, "term string, theta double")


# Factors merged by one task of the upper level of the tree.
FAN_IN = 256


def triangular_factor(df: DataFrame, columns: list[Column], fan_in: int = FAN_IN) -> DataFrame:
    """R of the QR factorisation of the rows, a matrix as tall as it must be: (r binary, n).

    Rows with a NULL are left out. A task factors its rows a batch at a time, each
    batch stacked below the factor so far, and gives out one small factor; these
    are merged the same way, by ``fan_in`` tasks and then by one. So a task holds a
    batch and one factor, the last task reads ``fan_in`` factors at most, and what
    moves is k * k numbers for each task. R'R is X'X without ever being computed:
    its condition is not squared.
    """
    k = len(columns)
    rows = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).dropna()

    def merged(r: np.ndarray, more: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, more]), mode="r")

    def result(r: np.ndarray, n: int) -> pa.RecordBatch:
        full = np.zeros((k, k))
        full[: len(r)] = r
        return pa.RecordBatch.from_pydict({"r": [full.tobytes()], "n": pa.array([n], pa.int64())})

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((0, k)), 0
        for batch in batches:
            if batch.num_rows:
                r = merged(r, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
                n += batch.num_rows
        if n:
            yield result(r, n)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((0, k)), 0
        for batch in batches:
            for value, count in zip(batch.column("r"), batch.column("n").to_pylist()):
                r = merged(r, np.frombuffer(value.as_buffer()).reshape(k, k))
                n += count
        if n:
            yield result(r, n)

    fields = "r binary, n bigint"
    leaves = rows.mapInArrow(factor, fields).withColumn("_part", F.spark_partition_id())
    # One task's factor goes where its number says, so the tree is the same each time.
    middle = leaves.repartition(fan_in, F.col("_part") % fan_in).sortWithinPartitions("_part")
    tops = middle.select("r", "n").mapInArrow(merge, fields).withColumn("_part", F.spark_partition_id())
    last = tops.repartition(1).sortWithinPartitions("_part")
    return last.select("r", "n").mapInArrow(merge, fields)


def ols_qr(
    df: DataFrame, features: dict[str, Column], target: Column, tolerance: float | None = None
) -> DataFrame:
    """Least squares without the normal equations: (term, theta, rank), a row per feature.

    The rows' triangular factor, target as its last column, is all that the
    solution needs. Directions whose singular value is ``tolerance`` of the largest
    or less count as dependent, by default the machine's precision times the number
    of rows or features; the solution is then the shortest one, as that of numpy's
    ``lstsq``. Where ``ols`` sees a condition number squared, beyond some 10^8, and
    loses all digits, this keeps them up to some 10^15. Rows with a NULL are left
    out; no rows, no result.
    """
    names = list(features)
    k = len(names)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, n in zip(batch.column("r"), batch.column("n").to_pylist()):
                r = np.frombuffer(value.as_buffer()).reshape(k + 1, k + 1)
                u, s, vt = np.linalg.svd(r[:k, :k])
                cut = np.finfo(float).eps * max(n, k) if tolerance is None else tolerance
                rank = int((s > cut * s[0]).sum())
                theta = vt[:rank].T @ ((u[:, :rank].T @ r[:k, k]) / s[:rank])
                yield pa.RecordBatch.from_pydict(
                    {"term": names, "theta": theta, "rank": pa.array([rank] * k, pa.int32())}
                )

    factor = triangular_factor(df, [*features.values(), target])
    return factor.mapInArrow(solve, "term string, theta double, rank int")
