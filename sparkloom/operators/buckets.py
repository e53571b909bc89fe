"""Placement that lasts: tables written by bucket, so that later joins need no shuffle."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparkloom.session import shared_root

# Buckets are files; a bucket of a join is one task and should fit in its memory.
BUCKETS = 8


def write_bucketed(
    df: DataFrame, label: str, keys: Sequence[str], buckets: int = BUCKETS, source: str = ""
) -> str:
    """Write a table whose rows lie in buckets by a hash of the keys, sorted by them.

    Two tables with the same keys, types and number of buckets join, and group by
    the keys, without an exchange, however often and in whichever query of the
    session: the shuffle is paid once, when the table is written. Rows are placed
    by key before the write, so each bucket is one file and needs no sort when it
    is read. All rows of a key are in one bucket.

    The table gets a name of its own below ``label``; ``source`` tells inputs
    apart, and writing the same input again replaces the table. Its files lie in
    the shared folder. Returns the name.
    """
    spark = df.sparkSession
    keys = list(keys)
    mark = f"{spark.sparkContext.applicationId}/{source}"
    name = f"sparkloom_{label}_{zlib.crc32(mark.encode()):08x}"
    path = f"{shared_root(spark)}/buckets/{name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    return name


def drop_bucketed(spark, name: str) -> None:
    """Forget the table. Its files go with ``sparkloom.session.release_scratch``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
