"""Rows that do not come from a file: literals, ranges, random pairs and cells.

The generators build on ``spark.range`` or on a given id column, so the rows
appear on the executors and never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# 26 letters from A as keys, digits as values, cells below ten.
KEY_COUNT = 26
VALUE_COUNT = 10
CELL_MAX = 10


def literal_rows(
    spark: SparkSession, rows: Sequence, schema: str | StructType | list[str] | None = None
) -> DataFrame:
    """A small table written out in the program; ``_1, _2, ...`` without a schema."""
    return spark.createDataFrame(rows, schema)


def id_range(spark: SparkSession, start: int, end: int, inclusive: bool = False) -> DataFrame:
    """``id`` from start up to end, end left out unless ``inclusive``."""
    return spark.range(start, end + 1 if inclusive else end)


def key_bounds(df: DataFrame, column: str) -> tuple[int, int]:
    """Smallest and largest value of an integer column: one row to the driver."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return low, high


def pairs_from_ids(ids: DataFrame, column: str = "id") -> DataFrame:
    """A key A-Z and a value 0-9 for each id, by arithmetic, so they repeat."""
    id_ = F.col(column).cast("bigint")
    return ids.select(
        F.char(F.lit(65) + F.pmod(id_ * 7919, F.lit(KEY_COUNT))).alias("k"),
        F.pmod(id_ * 104729, F.lit(VALUE_COUNT)).alias("v"),
    )


def random_pairs(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` pairs of a uniform key A-Z and a uniform value 0-9."""
    return spark.range(n).select(
        F.char(F.lit(65) + F.floor(F.rand(seed) * KEY_COUNT)).alias("k"),
        F.floor(F.rand(seed + 1) * VALUE_COUNT).cast("int").alias("v"),
    )


def cells_from_keys(df: DataFrame, row: str, column: str) -> DataFrame:
    """A matrix (i, j, v) with a cell for each pair of keys a table holds.

    The value is below ten and made by arithmetic, so it repeats.
    """
    i, j = F.col("i"), F.col("j")
    pairs = df.select(F.col(row).alias("i"), F.col(column).alias("j")).distinct()
    return pairs.withColumn("v", F.pmod(i * 31 + j * 17, F.lit(CELL_MAX)))


def grid_cells(spark: SparkSession, n: int, m: int) -> DataFrame:
    """All positions (i, j) of an n by m matrix, from one range over n * m."""
    return spark.range(n * m).select(
        F.expr(f"id div {m}").alias("i"), F.expr(f"id % {m}").alias("j")
    )


def random_coo(spark: SparkSession, n: int, m: int, seed: int = 0) -> DataFrame:
    """A full n by m matrix as cells (i, j, v) with v uniform in [0, 10)."""
    return grid_cells(spark, n, m).withColumn("v", F.rand(seed) * CELL_MAX)


# Bits of a hash that a double holds exactly.
UNIFORM_BITS = 52


def uniform(seed: int, *ids: Column | str) -> Column:
    """Uniform in [0, 1), drawn by a counter: a mixing hash of the seed and the ids.

    The same seed and ids give the same number in any partition, order and
    attempt of a task, and different ids give independent ones; ``rand`` depends
    on how the rows lie. The first 52 bits of MD5 are the number's, so other
    engines can draw it too. A NULL id counts as left out.
    """
    ids = [F.col(i) if isinstance(i, str) else i for i in ids]
    text = F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIFORM_BITS // 4), 16, 10)
    return bits.cast("bigint") / F.lit(float(1 << UNIFORM_BITS))


def uniform_below(n: int, seed: int, *ids: Column | str) -> Column:
    """A whole number from 0 to n - 1, each as likely, drawn by a counter."""
    return F.floor(uniform(seed, *ids) * n).cast("bigint")


def drawn_pairs(ids: DataFrame, column: str = "id", seed: int = 0) -> DataFrame:
    """A random key A-Z and a random value 0-9 for each id, the same ones each time."""
    return ids.select(
        F.char(F.lit(65) + uniform_below(KEY_COUNT, seed, column)).alias("k"),
        uniform_below(VALUE_COUNT, seed + 1, column).alias("v"),
    )


def drawn_cells(df: DataFrame, row: str, column: str, seed: int = 0) -> DataFrame:
    """A matrix (i, j, v) with a cell for each pair of keys a table holds, v random below ten."""
    pairs = df.select(F.col(row).alias("i"), F.col(column).alias("j")).distinct()
    return pairs.withColumn("v", uniform_below(CELL_MAX, seed, "i", "j"))
