"""Exact duplicates by progressive refinement.

Rows are grouped by length, the groups that survive (two rows or more) by a
hash of a prefix, and those that survive again by a hash of the full text. The
full text is read only for rows of surviving groups. Between two levels the
surviving groups travel as a bitmap, a bit for each hash of a group key, so a row
finds out by itself whether to go on and no text moves. The bitmap has
``BITS_PER_ROW`` bits for each row of the table, so few groups share one, and at
most ``BITMAP_MOST`` bits, 64 MB, as every executor gets it. Two groups on one bit
let a row on that need not go on; the next level sorts it out, so the result does
not depend on the size of the bitmap. Beyond some hundred million surviving groups
the largest one fills up: rows are then hashed where they lie that need not be,
which costs time and no shuffle.

Defined results: a null text counts as empty, and empty texts are equal; texts
are equal when identical after lower-casing A-Z only. Of equal texts the
largest id stays (a null id below all others). The same row twice is a group of
two, one of which stays. Texts of any length are hashed whole; their length is that
in bytes. An empty table gives an empty result. Other columns, whatever their names,
are not looked at, and pass ``drop_exact_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import boxed, join_groups, keep, resident, ship, text_of

# The bitmap of surviving groups is in pieces of Spark's own bitmap size.
BITMAP_PIECE = 32768
BITMAP_LEAST = 1 << 18
BITMAP_MOST = 1 << 29
BITS_PER_ROW = 16
PREFIX = 256


@F.pandas_udf(T.StringType())
def folded_sha256(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """SHA-256 of each text in UTF-8, A-Z lower-cased, as lowercase hex."""
    import hashlib

    resident("digests")
    for batch in texts:
        # bytes.lower changes A-Z and no other byte.
        yield pd.Series([hashlib.sha256(t.encode().lower()).hexdigest() for t in batch], dtype=object)


def prefix_hash(text: Column, length: int = PREFIX) -> Column:
    """A hash of the first characters, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.xxhash64(F.translate(F.substring(text, 1, length), upper, upper.lower()))


def bitmap_bits(rows: int) -> int:
    """The bits of the bitmap for a table: a power of two within the bounds."""
    wanted = 1 << max(0, rows * BITS_PER_ROW - 1).bit_length()
    return min(BITMAP_MOST, max(BITMAP_LEAST, wanted))


def surviving(rows: DataFrame, keys: list[Column], bits: int) -> DataFrame:
    """The bitmap of group keys that two rows or more have."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(bits)).alias("_bit")
    groups = rows.groupBy(bit).count().filter("count > 1")
    position = (F.col("_bit") % BITMAP_PIECE).cast("bigint")
    return groups.groupBy(F.floor(F.col("_bit") / BITMAP_PIECE).cast("bigint").alias("_piece")).agg(
        F.bitmap_construct_agg(position).alias("_bitmap")
    )


def only_surviving(
    rows: DataFrame, keys: list[Column], bitmap: DataFrame, bits: int, wanted: bool = True
) -> DataFrame:
    """The rows whose group key has its bit set, or with ``wanted`` false the others."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(bits))
    pieces = F.broadcast(bitmap.withColumnRenamed("_bitmap", "_bits"))
    position = F.pmod(bit, F.lit(BITMAP_PIECE).cast("bigint"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(
        F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0, F.lit(False)
    )
    columns = rows.columns
    return (
        rows.withColumns(
            {"_piece": F.floor(bit / BITMAP_PIECE).cast("bigint"), "_at": position}
        )
        .join(pieces, "_piece", "left")
        .filter(hit if wanted else ~hit)
        .select(*columns)
    )


class Refined:
    """The two bitmaps of a table, and what they say of a row. ``text`` is never null."""

    def __init__(self, docs: DataFrame, text: Column, bits: int | None = None):
        self.text = text
        self.length = F.octet_length(self.text)
        self.head = prefix_hash(self.text)
        self.total = docs.count()
        self.bits = bits = bits or bitmap_bits(self.total)
        self.by_length = keep(surviving(docs, [self.length], bits), "lengths")
        maybe = only_surviving(docs, [self.length], self.by_length, bits)
        self.by_prefix = keep(surviving(maybe, [self.length, self.head], bits), "prefixes")

    def survivors(self, docs: DataFrame) -> DataFrame:
        """Rows that may have an equal: same length, then same prefix as another row."""
        rows = only_surviving(docs, [self.length], self.by_length, self.bits)
        return only_surviving(rows, [self.length, self.head], self.by_prefix, self.bits)

    def settled(self, docs: DataFrame) -> DataFrame:
        """The other rows, each without an equal."""
        short = only_surviving(docs, [self.length], self.by_length, self.bits, wanted=False)
        rows = only_surviving(docs, [self.length], self.by_length, self.bits)
        return short.unionByName(
            only_surviving(rows, [self.length, self.head], self.by_prefix, self.bits, wanted=False)
        )


def _groups(hashed: DataFrame) -> DataFrame:
    """For each full hash: the id that stays and the rows."""
    return hashed.groupBy("_sha").agg(
        F.max("_id").alias("keep_id"), F.count("*").alias("group_size")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", all_digests: bool = False
) -> DataFrame:
    """One row per row: the id, keep_id, group_size, kept and full_hash.

    ``full_hash`` is null where the refinement ended before the full text was
    read; with ``all_digests`` it is computed there too.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    refined = Refined(rows, F.col("_text"))
    sha = folded_sha256("_text")
    hashed = keep(refined.survivors(rows).select("_id", sha.alias("_sha")), "hashes")
    # Rows of one id and text are told apart by a number.
    copies = hashed.groupBy("_id", "_sha").agg(F.count("*").alias("_n"))
    groups = keep(_groups(hashed), "groups")
    grouped = join_groups(copies, groups, ["_sha"], "group_size", refined.total).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.explode(F.expr("sequence(1L, _n)")).alias("_copy"),
        F.col("_sha").alias("full_hash"),
    )
    grouped = grouped.select(
        id_col,
        "keep_id",
        "group_size",
        (F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        "full_hash",
    )
    alone = refined.settled(rows).select(
        F.col("_id").alias(id_col),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        (sha if all_digests else F.lit(None).cast("string")).alias("full_hash"),
    )
    return grouped.unionByName(alone)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table without the rows of equal texts that do not stay.

    Rows outside the surviving groups pass without a shuffle. The full hashes of the
    others are written once, without their texts; a row then meets the one that
    stays by id, length and a second hash of its text. Of a hot group only one such
    key exists, and its other rows are spread by their ids.
    """
    ship(docs.sparkSession)
    box = boxed(docs, _id=id_col)
    text = F.coalesce(F.col("_doc")[text_col], F.lit(""))
    refined = Refined(box, text)
    key = F.struct("_id", F.xxhash64(text).alias("_x"), F.octet_length(text).alias("_bytes"))
    survivors = refined.survivors(box).withColumn("_key", key)
    hashed = keep(survivors.select("_key", folded_sha256(text).alias("_sha")), "hashes")
    # The largest id first; a null one is below all others.
    stays = hashed.groupBy("_sha").agg(F.max("_key").alias("_key")).select("_key").distinct()
    kept = (
        survivors.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select("_doc.*")
    )
    return refined.settled(box).select("_doc.*").unionByName(kept)
