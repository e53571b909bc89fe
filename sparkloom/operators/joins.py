"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.keyed import finish_average, merge_average_state
from sparkloom.operators.scan import running_sums


def pair_counts(
    left: DataFrame, right: DataFrame, on: str, left_group: str, right_group: str
) -> DataFrame:
    """Matches of a many-to-many join, counted by a column of each side.

    The result is that of joining the rows, grouping and counting, but each
    side is first counted by (key, group) and the join multiplies the counts.
    A key held by a third of both tables then adds a few rows, not the product
    of its rows. ``pairs`` is a decimal of 38 digits, as such a product may
    pass the largest bigint.
    """
    lefts = left.groupBy(on, left_group).agg(F.count("*").alias("_left_rows"))
    rights = right.groupBy(on, right_group).agg(F.count("*").alias("_right_rows"))
    return (
        lefts.join(rights, on)
        .groupBy(left_group, right_group)
        .agg(
            F.sum(F.col("_left_rows").cast("decimal(19,0)") * F.col("_right_rows"))
            .cast("decimal(38,0)")
            .alias("pairs")
        )
    )


def _sliced(cells: DataFrame, keys: list[str], band: str, near: Column, width: Column) -> DataFrame:
    """(keys, band, total, n) around each cell, by slices of the axis worked on apart."""

    def slice_of(position: Column) -> Column:
        # Any never-falling function will do: both sides use the same one.
        return F.floor(position / width).cast("bigint")

    place = F.col(band)
    low, high = slice_of(place - near), slice_of(place + near)
    # Point 0 asks for the states below the tolerance, point 1 for those up to its
    # end; the others are the cell's own state in each slice it reaches. At one
    # position the order is 0, state, 1.
    last = F.when(F.col("_n") > 0, high - low + 2).otherwise(F.lit(1).cast("bigint"))
    k = F.col("_k")
    points = (
        cells.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .withColumn("_slice", F.when(k < 2, slice_of(place)).otherwise(low + k - 2))
        .withColumn("_at", F.when(k == 0, place - near).when(k == 1, place + near).otherwise(place))
        .withColumn("_order", F.when(k < 2, 2 * k).otherwise(F.lit(1)))
        .withColumn("_sign", F.when(k == 0, -1).when(k == 1, 1).otherwise(0))
        .withColumn("_part", F.when(k > 1, F.col("_total")))
        .withColumn("_count", F.when(k > 1, F.col("_n")))
    )
    upto = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_at", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        points.select(
            *keys,
            "_slice",
            band,
            "_sign",
            (F.coalesce(F.sum("_part").over(upto), F.lit(0)) * F.col("_sign")).alias("_sum"),
            (F.coalesce(F.sum("_count").over(upto), F.lit(0)) * F.col("_sign")).alias("_rows"),
        )
        .filter("_sign <> 0")
        .groupBy(*keys, "_slice", band)
        .agg(F.sum("_sum").alias("total"), F.sum("_rows").alias("n"))
        .filter("n > 0")
        .drop("_slice")
    )

def _scanned(
    cells: DataFrame, keys: list[str], band: str, near: Column, pieces: int | None
) -> DataFrame:
    """(keys, band, total, n) around each cell, by one scan of all cells' points."""
    # A cell asks for the states below the tolerance (0), is a state (1), and asks
    # for those up to the tolerance's end (2); at one position in this order.
    place = F.col(band)
    points = (
        cells.withColumn("_order", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .withColumn(
            "_at", F.when(F.col("_order") == 0, place - near).when(F.col("_order") == 2, place + near).otherwise(place)
        )
        .withColumn("_state", F.col("_order") == 1)
    )
    sums = {
        "_sum": F.when(F.col("_state"), F.col("_total")),
        "_rows": F.when(F.col("_state"), F.col("_n")),
    }
    sign = F.col("_order") - 1
    return (
        running_sums(points, keys, ["_at", "_order", band], sums, pieces)
        .filter(~F.col("_state"))
        .groupBy(*keys, band)
        .agg(
            F.sum(F.coalesce("_sum", F.lit(0)) * sign).alias("total"),
            F.sum(F.coalesce("_rows", F.lit(0)) * sign).alias("n"),
        )
        .filter("n > 0")
    )


def band_average(
    rows: DataFrame,
    keys: Sequence[str],
    band: str,
    tolerance: Decimal | str,
    group: str,
    total: str = "total",
    n: str = "n",
    alias: str = "average",
    unique_groups: bool = False,
    long_axis: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Average over the rows that have equal keys and a near band value, by group.

    Each row stands on both sides: it asks for the average around its decimal
    ``band``, and it offers an average state (``total``, ``n``; NULL where it has
    none), see ``average_state``. A row takes in the states of all rows of its
    keys whose band differs by ``tolerance`` at most. The result has one row for
    each group that took in any state; with ``unique_groups`` the caller says
    that no two rows have one group, which saves a shuffle. Decimals keep their
    scale, of the band and of the tolerance.

    Rows never meet pairwise. They shrink to their distinct (keys, band) cells
    with the sum of their states. Along the band axis of a key the sums up to
    ``band + tolerance``, less those below ``band - tolerance``, are what a cell
    asks for, so one sort and running sums give all cells their answers, however
    wide the tolerance. The axis is cut in slices twice the tolerance wide; a
    cell's state also stands in the neighbouring slice that its tolerance
    reaches, so slices are worked on apart.

    A slice of a key is one task. Where a single slice may hold a large share of
    all cells, as with a tolerance as wide as the axis and few keys, say
    ``long_axis``: the axis is then cut by the number of cells into ``pieces``,
    and a scan of two levels gives the running sums (``running_sums``). It costs a
    write and another shuffle, so it is the caller's choice and not the default.
    """
    keys = list(keys)
    near = F.lit(Decimal(tolerance))
    width = F.lit(2 * Decimal(tolerance) or Decimal(1))
    cells = (
        rows.filter(F.col(band).isNotNull())
        .groupBy(*keys, band)
        .agg(F.sum(total).alias("_total"), F.sum(n).alias("_n"))
    )
    sums = (
        _scanned(cells, keys, band, near, pieces) if long_axis else _sliced(cells, keys, band, near, width)
    )
    answers = rows.select(*keys, band, group).join(sums, [*keys, band])
    if not unique_groups:
        answers = merge_average_state(answers, group)
    return answers.select(group, finish_average().alias(alias))
