"""Where rows are: placing them by key, and looking at the placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def place_by_key(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Hash placement: equal keys share one of ``partitions`` partitions.

    Two frames placed by the same number and keys join without another
    shuffle. All rows of a key land in one task, so reduce a frame with hot
    keys first, or use ``distribute_by`` with pieces.
    """
    return df.repartition(partitions, *keys)


def place_for_join(
    many: DataFrame, few: DataFrame, partitions: int, keys: Sequence[str], pieces: int,
    spread_by: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Two frames placed so that they join on ``[*keys, "_piece"]`` without another shuffle.

    An explicit placement is never split at run time, so with ``place_by_key`` a hot
    key is one task of the join. Here the rows of ``many`` are dealt to ``pieces``
    places for each key by a hash of the ``spread_by`` columns, and each row of
    ``few`` stands in all of them: a key with a third of the rows is ``pieces`` tasks.
    It costs ``pieces`` copies of ``few``. For an inner join, or an outer one that
    keeps ``many``; a row of ``few`` without a partner would appear more than once.
    """
    if pieces < 1:
        raise ValueError("there must be a piece")
    piece = F.pmod(F.xxhash64(*spread_by), F.lit(pieces)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    return (
        many.withColumn("_piece", piece).repartition(partitions, *keys, "_piece"),
        few.withColumn("_piece", copies).repartition(partitions, *keys, "_piece"),
    )


def distribute_by(
    df: DataFrame, keys: Sequence[str], pieces: int = 1, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of a key together, as DISTRIBUTE BY does, or in ``pieces`` places.

    By default all rows of a key share a partition. With more pieces, every
    key's rows are dealt over that many places by a hash of the ``spread_by``
    columns, so that a key with a large share of the rows is not one task. It is
    the caller who decides; the data are not looked at, and the rows stay as
    they are. Columns that tell a key's rows apart spread them evenly.
    """
    keys = list(keys)
    if pieces < 1 or (pieces > 1) != bool(spread_by):
        raise ValueError("pieces and spread_by go together")
    if pieces == 1:
        return df.repartition(*keys)
    place = F.pmod(F.xxhash64(*spread_by), F.lit(pieces))
    return df.repartition(*keys, place)


def cluster_by(
    df: DataFrame, keys: Sequence[str], pieces: int = 1, spread_by: Sequence[str] = ()
) -> DataFrame:
    """``distribute_by`` and then sorted by the keys inside each partition."""
    return distribute_by(df, keys, pieces, spread_by).sortWithinPartitions(*keys)


def rows_by_partition(df: DataFrame, key: str) -> DataFrame:
    """How many rows of each key sit in which partition."""
    return (
        df.select(key, F.spark_partition_id().alias("partition"))
        .groupBy(key, "partition")
        .agg(F.count("*").alias("rows"))
    )
