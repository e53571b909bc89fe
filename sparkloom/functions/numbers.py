"""Exact sums of columns that hold few decimals, money above all.

A sum of doubles depends on the order of the rows, which a shuffle does not
keep. Whole numbers add up exactly, and several times faster than decimals
made from doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_units(x: Column, scale: int = 2) -> Column:
    """A column of at most ``scale`` decimals as a bigint of its smallest unit."""
    return F.rint(x * 10**scale).cast("bigint")


def from_units(units: Column, scale: int = 2) -> Column:
    """Whole units, a bigint or decimal of up to 30 digits, as the decimal they stand for."""
    return units.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))


# Sums of bigints are made of two parts, so that neither passes a bigint.
PART = 10**9


def sum_of_units(units: Column) -> Column:
    """The sum of a bigint column as a decimal of 30 digits, whatever the number of rows.

    High and low parts are summed as bigints, which is several times faster than
    a sum of decimals, and put together once.
    """
    low, high = units % PART, F.call_function("div", units, F.lit(PART))
    return (
        F.sum(high).cast("decimal(19,0)") * F.lit(Decimal(PART)) + F.sum(low).cast("decimal(19,0)")
    ).cast("decimal(30,0)")


def exact_sum(x: Column, scale: int = 2) -> Column:
    """The sum as a decimal, exact in any order and at any number of rows."""
    return from_units(sum_of_units(whole_units(x, scale)), scale)
