"""Running sums along an axis of any length, in parallel."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.session import shared_root


def in_pieces(rows: DataFrame, by: Sequence[str], pieces: int | None = None) -> DataFrame:
    """The rows with ``_piece``, so that pieces follow each other along ``by``.

    The rows are dealt by ranges of the columns, found from a sample of them, so
    pieces are about even however the values lie; rows equal in all columns share
    one. They are written to the shared folder, and with them the numbers of their
    pieces: whatever reads them again, also after a loss of executors, finds each
    row in the piece it had.
    """
    if "_piece" in rows.columns:
        raise ValueError("the rows have a column _piece already")
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*([pieces] if pieces else []), *by)
    path = f"{shared_root(spark)}/pieces-{uuid.uuid4().hex}"
    numbered = ranged.withColumn("_piece", F.spark_partition_id())
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def running_sums(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column],
    pieces: int | None = None,
) -> DataFrame:
    """The rows and, under the names of ``sums``, running sums along ``order`` by key.

    A row's sum is that of all rows of its keys up to and with itself; rows equal
    in ``order`` come in any order among each other, so let it tell a key's rows
    apart. NULL counts as nothing, and the sum of nothing is NULL.

    A window over the key would be one task for each key. Here the axis of all
    keys is cut in pieces by ranges, and the scan has two levels: sums within each
    piece, and for each (piece, keys) the sum of the pieces before it. The second
    level has one row for each piece a key reaches into, so its window holds at
    most as many rows as there are pieces.
    """
    keys, order = list(keys), list(order)
    cut = in_pieces(rows, [*keys, *order], pieces)
    names = list(sums)
    parts = cut.groupBy("_piece", *keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_piece",
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        *[F.sum(name).over(before).alias(f"_before_{name}") for name in names],
    )
    upto = Window.partitionBy("_piece", *keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inner = cut.withColumns({f"_in_{name}": F.sum(c).over(upto) for name, c in sums.items()})
    same = inner["_piece"] == offsets["_piece"]
    for i, k in enumerate(keys):
        same &= inner[k].eqNullSafe(offsets[f"_key{i}"])
    zero = F.lit(0)

    def together(name: str) -> Column:
        a, b = F.col(f"_in_{name}"), F.col(f"_before_{name}")
        both = F.coalesce(a, zero) + F.coalesce(b, zero)
        return F.when(a.isNotNull() | b.isNotNull(), both)

    return inner.join(offsets, same).select(
        *[F.col(c) for c in rows.columns], *[together(name).alias(name) for name in names]
    )
