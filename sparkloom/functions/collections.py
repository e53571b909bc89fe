"""Column functions over array and map columns, one collection per row.

All are built-in higher-order functions: they run in the JVM, row by row, and
need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_to_each(values: Column, amount: int = 1) -> Column:
    return F.transform(values, lambda x: x + amount)


def total(values: Column) -> Column:
    """Sum of the elements as a bigint; 0 for an empty array."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def odd_only(values: Column) -> Column:
    """Elements not divisible by two; ``%`` keeps the sign, so -3 is odd too."""
    return F.filter(values, lambda x: x % 2 != 0)


def first_of(values: Column) -> Column:
    """First element; NULL for an empty array."""
    return F.try_element_at(values, F.lit(1))


def last_of(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def add_to_firsts(pairs: Column, field: str, amount: int = 1) -> Column:
    """From an array of structs, one field of each plus an amount."""
    return F.transform(pairs, lambda p: p[field] + amount)


def map_get(entries: Column, key: Column) -> Column:
    """Value of a key; NULL where the map has no such key."""
    return F.try_element_at(entries, key)


def map_put(entries: Column, key: Column, value: Column) -> Column:
    """The map with one key set; an older value of that key is replaced."""
    others = F.map_filter(entries, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(key, value))


def thousandths(values: Column) -> Column:
    """Floats as whole thousandths (floor), so that sums do not depend on order."""
    return F.transform(values, lambda x: F.floor(x.cast("double") * 1000).cast("bigint"))
