"""User-defined functions, for the DataFrame API and for SQL text.

The SQL ones are Spark SQL functions: the optimizer puts their body in the
place of the call, so a predicate still reaches the Parquet reader and no row
visits a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: what the filter compares with.
FILTER_ABOVE = 5


def register_functions(spark: SparkSession) -> None:
    """Make ``plus_one(x)`` and ``one_arg_filter(n)`` callable from SQL."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION plus_one(x INT) RETURNS INT RETURN x + 1")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION one_arg_filter(n BIGINT) RETURNS BOOLEAN "
        f"RETURN n > {FILTER_ABOVE}"
    )


def plus_one(x: Column) -> Column:
    return x + 1


def one_arg_filter(n: Column) -> Column:
    return n > FILTER_ABOVE


def random_value(seed: int | None = None) -> Column:
    """Uniform in [0, 1), drawn anew for each row."""
    return F.rand(seed)


def my_average(x: Column) -> Column:
    """Average of a numeric column over its sum and count, as a double.

    Both are built-in aggregates over the column as it is, so each map task
    sends one (sum, count) per group; decimals add up exactly. NULLs are skipped
    and an empty group gives NULL.
    """
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def my_average_sql(expression: str) -> str:
    """The same aggregate as SQL text, to put into a query.

    A SQL function may not hold an aggregate, and a pandas grouped aggregate
    would load a whole group into one Python worker.
    """
    return f"try_divide(CAST(sum({expression}) AS DOUBLE), CAST(count({expression}) AS DOUBLE))"
