"""Measured sizes, and broadcasts that depend on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Broadcast at most this much: a table is built whole on the driver and again
# in every executor.
BROADCAST_BYTES = 50 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values, 16 more per value for the row around them."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    return (sum(widths[1:], widths[0]) + 16 * len(widths)).cast("bigint")


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a frame, from one job with one row of result."""
    rows, size = df.agg(F.count("*"), F.sum(_row_bytes(df))).first()
    return rows, size or 0


def broadcast_if_small(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The frame marked for broadcast, if its measured size allows.

    Otherwise it comes back unmarked and the join shuffles.
    """
    rows, size = measured(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
