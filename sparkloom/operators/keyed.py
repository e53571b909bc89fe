"""Work by key: value lists, sums, averages, word counts, cogroups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.numbers import exact_sum
from sparkloom.functions.text import tokens

def _sign_of_zero(value: Column, type_: T.DataType) -> Column:
    """Whether the value is -0.0, which grouping would turn into 0.0."""
    if not isinstance(type_, (T.FloatType, T.DoubleType)):
        return F.lit(False)
    return F.coalesce((value == 0) & (value.cast("string") == "-0.0"), F.lit(False))


def _entry(value: str, minus: str, copies: str, type_: T.DataType) -> Column:
    """A list entry that sorts by value, NULL last and -0.0 before 0.0."""
    restored = F.col(value)
    if isinstance(type_, (T.FloatType, T.DoubleType)):
        restored = F.when(F.col(minus), F.lit(-0.0).cast(type_)).otherwise(restored)
    return F.struct(
        F.col(value).isNull().alias("none"),
        F.col(value).alias("order"),
        (~F.col(minus)).alias("plus"),
        F.struct(restored.alias("value"), F.col(copies).alias("copies")).alias("entry"),
    )


def _sorted_entries(entries: Column) -> Column:
    return F.transform(F.array_sort(entries), lambda e: e["entry"])


def group_values(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    slice_of: Column | int = 0,
    alias: str = "values",
) -> DataFrame:
    """The values of each key as sorted lists of (value, copies): (keys, slice, values).

    ``slice_of`` is a function of the value that never falls as the value grows,
    such as ``value div width``; each slice of a key is one list, always, so the
    slices in order give the sorted bag of the key. The caller chooses it such
    that a slice has no more distinct values than one task should hold; the
    default is one slice. Copies are counted before a list is made, so they
    cost nothing; NULLs come last in the slice the function gives them, -0.0 and
    NaN are kept. The input is read once, and no key is looked at before.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    type_ = df.schema[value].dataType
    slice_ = slice_of if isinstance(slice_of, Column) else F.lit(slice_of)
    counted = (
        df.select(
            *keys,
            slice_.cast("bigint").alias("slice"),
            F.col(value).alias("_value"),
            _sign_of_zero(F.col(value), type_).alias("_minus"),
        )
        .groupBy(*keys, "slice", "_value", "_minus")
        .agg(F.count("*").alias("_copies"))
    )
    entries = F.collect_list(_entry("_value", "_minus", "_copies", type_))
    return counted.groupBy(*keys, "slice").agg(_sorted_entries(entries).alias(alias))


def cogroup_values(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    left_slice: Column | int = 0,
    right_slice: Column | int = 0,
) -> DataFrame:
    """Both sides' values for each key of either: (key, slice, left_values, right_values).

    Lists and slices are those of ``group_values``. A side without a value in a
    slice has an empty list there, one without the key in all of its slices.
    NULL is a key like others. Both sides go through one grouping, without a
    join.
    """
    left_type = left.schema[left_value].dataType
    right_type = right.schema[right_value].dataType

    def side(df: DataFrame, value: str, slice_of: Column | int, is_left: bool) -> DataFrame:
        slice_ = slice_of if isinstance(slice_of, Column) else F.lit(slice_of)
        type_ = left_type if is_left else right_type
        mine = F.col(value)
        return df.select(
            F.col(key),
            slice_.cast("bigint").alias("slice"),
            F.lit(is_left).alias("_is_left"),
            (mine if is_left else F.lit(None).cast(left_type)).alias("_left"),
            (F.lit(None).cast(right_type) if is_left else mine).alias("_right"),
            _sign_of_zero(mine, type_).alias("_minus"),
        )

    counted = (
        side(left, left_value, left_slice, True)
        .unionByName(side(right, right_value, right_slice, False))
        .groupBy(key, "slice", "_is_left", "_left", "_right", "_minus")
        .agg(F.count("*").alias("_copies"))
    )
    lefts = F.when(F.col("_is_left"), _entry("_left", "_minus", "_copies", left_type))
    rights = F.when(~F.col("_is_left"), _entry("_right", "_minus", "_copies", right_type))
    return counted.groupBy(key, "slice").agg(
        _sorted_entries(F.collect_list(lefts)).alias("left_values"),
        _sorted_entries(F.collect_list(rights)).alias("right_values"),
    )


def sum_by_key(df: DataFrame, keys: str | Sequence[str], value: str, alias: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def average_state(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str | Column,
    total: str = "total",
    n: str = "n",
    scale: int | None = None,
) -> DataFrame:
    """(sum, count) of a value by key: what an average needs, and can be merged.

    With ``scale`` the value has at most that many decimals and its sum is an
    exact decimal.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    value = F.col(value) if isinstance(value, str) else value
    sum_ = F.sum(value) if scale is None else exact_sum(value, scale)
    return df.groupBy(*keys).agg(sum_.alias(total), F.count(value).alias(n))


def merge_average_state(
    state: DataFrame, keys: str | Sequence[str], total: str = "total", n: str = "n"
) -> DataFrame:
    """The states of finer groups added up to coarser ones."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return state.groupBy(*keys).agg(F.sum(total).alias(total), F.sum(n).alias(n))


def finish_average(total: str | Column = "total", n: str | Column = "n") -> Column:
    """The average of a state; NULL where no value was counted."""
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    return F.try_divide(total.cast("double"), n.cast("double"))


def word_count(lines: DataFrame, line: str, delimiter: str = " ") -> DataFrame:
    """How often each token occurs in all lines: (word, occurrences)."""
    return (
        lines.select(F.explode(tokens(F.col(line), delimiter)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("occurrences"))
    )
