"""Best-fit packing of token sequences, by partitions and then up a tree.

Documents become token ids and, with the end mark, pieces of at most
``CAPACITY`` tokens; only longer documents are cut. A full piece is a sequence by
itself. The others are dealt to parts of a bounded size by a hash of their row
number, and each part packs its pieces best-fit, longest first. Bins are items of
the next round, packed best-fit as wholes, until one part is left.

Of two bins of a part that best-fit filled, no two fit together, so one at most
is half full or less, and any later merge takes such a small bin. Hence a round
leaves as many small bins as it has parts at most, and the next one needs no more
than these and as many of the roomiest others that can still take the smallest:
of any bins that take them, each can be replaced by a roomier one. All others are
done. So the items fall by about half of ``PART_ITEMS`` a round whatever the
lengths, also where nothing fits together, and there is always a part for each
``PART_ITEMS`` items left. What moves after the first round are (bin, fill) pairs.

A part holds ``PART_ITEMS`` items on average, dealt by a hash, so its memory is
bounded whatever the input, in each round. Parts, bins and offsets depend on the written table
of pieces alone, so a task that runs again packs as before.

Defined results: a null text counts as empty; an empty document is its end mark
alone; repeated rows are packed each; texts of any length are cut whole into pieces;
an empty table gives an empty result; columns other than the id and the text,
whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import keep, map_texts, ship, text_of
from sparkloom.llm.words import tokenizer

CAPACITY = 4096
END = 1
PART_ITEMS = 100_000
NEARLY_FULL = 4032  # of CAPACITY


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end: int = END,
) -> DataFrame:
    """Rows (item, id, piece, start, length, ids_crc32); ``item`` numbers them."""
    mark = np.array([end], dtype="<u4").tobytes()

    def cut(texts: list[str]) -> tuple[list[int], dict]:
        rows, number, start, length, crc = [], [], [], [], []
        for row, ids in enumerate(tokenizer(path).texts(texts)):
            ids += mark
            for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                rows.append(row)
                number.append(n)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        return rows, {"piece": number, "start": start, "length": length, "ids_crc32": crc}

    named = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    # The numbers become fixed when the caller writes the table.
    return map_texts(
        named, cut, "piece int, start bigint, length bigint, ids_crc32 bigint"
    ).withColumn("item", F.monotonically_increasing_id())


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each length, in the order given, and the fill of each bin.

    The bin with the least room that is enough takes the item; of equal ones the
    latest. Bins by their room are stacks; a bit set tells which are not empty.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    fills: list[int] = []
    bins, offsets = [], []
    for length in lengths:
        enough = open_rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                open_rooms &= ~(1 << room)
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins.append(b)
        offsets.append(fills[b])
        fills[b] += length
        room -= length
        if room:
            stacks[room].append(b)
            open_rooms |= 1 << room
    return bins, offsets, fills


def _round(items: DataFrame, number: int, parts: int, capacity: int) -> DataFrame:
    """(item, length) packed in parts: (item, bin, offset, fill)."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "item"], ascending=[False, True], kind="stable")
        bins, offsets, fills = best_fit(group["length"].tolist(), capacity)
        bins = np.array(bins, dtype=np.int64)
        first = number << 57 | int(group["part"].iloc[0]) << 28
        return pd.DataFrame(
            {
                "item": group["item"].to_numpy(),
                "bin": bins + first,
                "offset": np.array(offsets, dtype=np.int64),
                "fill": np.array(fills, dtype=np.int64)[bins],
            }
        )

    part = F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part")
    return (
        items.select("item", "length", part)
        .groupBy("part")
        .applyInPandas(pack, "item bigint, bin bigint, offset bigint, fill bigint")
    )


def _open(packed: DataFrame, done: int, capacity: int) -> DataFrame:
    """The bins that the next round packs, as (item, length).

    These are the bins half full or less, and about as many others, the roomiest.
    What comes to the driver has at most a row for each fill.
    """
    first = packed.filter((F.col("offset") == 0) & (F.col("fill") < done))
    bins = first.select(F.col("bin").alias("item"), F.col("fill").alias("length"))
    counts = sorted((r["length"], r["count"]) for r in bins.groupBy("length").count().collect())
    need = sum(n for fill, n in counts if 2 * fill <= capacity)
    whole, share, below = capacity // 2, 0, 0
    for fill, n in counts:
        if 2 * fill <= capacity:
            continue
        if need <= 0 or fill + counts[0][0] > capacity:
            break
        if n > need:
            # A share of this fill by hash, with some to spare.
            share, below = fill, min(1 << 30, ((need + need // 8 + 8) << 30) // n)
            break
        whole = fill
        need -= n
    by_hash = F.pmod(F.xxhash64("item", F.lit(1)), F.lit(1 << 30)) < below
    return bins.filter((F.col("length") <= whole) | ((F.col("length") == share) & by_hash))


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end: int = END, part_items: int = PART_ITEMS,
    nearly_full: int | None = None,
) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id, offset.

    ``nearly_full`` is the fill from which a bin is done, 63 parts in 64 by default.
    """
    ship(docs.sparkSession)
    done = nearly_full if nearly_full is not None else capacity * NEARLY_FULL // CAPACITY
    cut = keep(pieces(docs, path, id_col, text_col, capacity, end), "pieces")
    left = cut.filter(F.col("length") < capacity).select("item", "length")
    parts = max(1, -(-left.count() // part_items))
    rounds = []
    while True:
        packed = keep(_round(left, len(rounds) + 1, parts, capacity), "packed")
        rounds.append(packed)
        if parts == 1:
            break
        left = _open(packed, done, capacity)
        # Half the parts are enough even where a part holds a few items only.
        parts = min(-(-parts // 2), -(-left.count() // part_items))
        if not parts:
            break
    # From the last round back: where each item of a round ends up.
    placed = rounds.pop().select("item", "bin", "offset")
    while rounds:
        above = placed.select(
            F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_more")
        )
        placed = rounds.pop().join(above, "bin", "left").select(
            "item",
            F.coalesce("_bin", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("_more", F.lit(0))).alias("offset"),
        )
    columns = ["piece", "start", "length", "ids_crc32"]
    full = cut.filter(F.col("length") == capacity).select(
        "_id", *columns, F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    packed = cut.filter(F.col("length") < capacity).join(placed, "item").select(
        "_id", *columns, F.col("bin").alias("sequence_id"), "offset"
    )
    return full.unionByName(packed).withColumnRenamed("_id", id_col)
