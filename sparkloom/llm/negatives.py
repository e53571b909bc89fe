"""Hard negatives of anchor vectors, found through summaries of vector segments.

Vectors become whole numbers and a row's score is its inner product with the
anchor. Vectors are cut into segments at several levels, and for each segment its
mean and standard deviation are stored with the row. Of two segments of length l
the inner product is ``l (mean mean')`` plus at least ``-l (dev dev')`` and at most
``+l (dev dev')``, so a score lies between two sums over segments. The first level
bounds all pairs of a cell by two small matrix products; pairs that may still be
among the best go on to finer segments, and those left are scored exactly.

Rows are dealt to slices and anchors to groups of a bounded size, and each anchor
group meets each slice in a task of its own: a cell. So memory does not grow with
the table, and no cell depends on labels or on how alike vectors are. A cell works
through its rows in parts, and what it has found so far says which bounds still
matter. It gives out the best few rows of each anchor; the best over all cells are
the answer. Two passes of this kind find the positives, which have the anchor's
label, and then the negatives, which have another and a score within limits set by
each positive.

Defined results: rows with a null label, or whose vector is null or holds a null or
a component that is not finite take no part, and rows with a null id only if
``nameless`` says so; of equal scores theirs come last. Finite components of any
size count, and scores are exact; where the numbers of two rows may pass a bigint
they are multiplied as Python integers. Vectors of different lengths have no inner
product: each meets those of its own length. Rows are told apart by their place in
the table, so repeated rows, also with one id, are rows each, and an anchor is not
its own positive; equal scores come by smaller id, then by that place. An anchor
without a positive, and a positive without a negative within its limits, have no
rows; an empty table gives an empty result; other columns are not looked at. A
positive whose score does not fit a bigint is an error if a row of another label has a
score of four fifths of the largest bigint or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import keep, ship

POSITIVES = 5
NEGATIVES = 5
LOWEST, HIGHEST = 80, 100  # percent of the positive's score
SCALE = 256
SLICE_ROWS = 8192
GROUP_ANCHORS = 4096
# Rows and anchors whose pairs are bounded in one matrix.
ROWS_AT_ONCE = 2048
ANCHORS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 15
# Segments at each level, for vectors long enough.
LEVELS = (4, 16)
# Scores beyond these count as these.
FLOOR, CEILING = -(2**63 - 1), 2**63 - 1
# Products of lengths below this make scores that fit a bigint.
SURE = 2.0**62
# Larger numbers are bounded as this one, in a row whose length is so great that
# its bounds leave nothing out.
BOUNDED, BEYOND = 2.0**400, 1e150


def levels_of(dimension: int) -> list[int]:
    """How many segments each level has; a segment has two components at least."""
    return [s for s in LEVELS if 2 * s <= dimension] or [1]


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row, all levels side by side.

    Both are multiplied by the root of the segment's length.
    """
    d = x.shape[1]
    if not d:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1))
    x = np.clip(x, -BOUNDED, BOUNDED)
    means, deviations = [], []
    for s in levels_of(d):
        starts = [i * d // s for i in range(s)]
        lengths = np.diff([*starts, d])
        mean = np.add.reduceat(x, starts, axis=1) / lengths
        off = x - np.repeat(mean, lengths, axis=1)
        means.append(mean * np.sqrt(lengths))
        deviations.append(np.sqrt(np.add.reduceat(off * off, starts, axis=1)))
    return np.hstack(means), np.hstack(deviations)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _dense(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def prepared(
    table: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str, scale: int,
    nameless: bool = False,
) -> DataFrame:
    """Rows (row, id, label, anchor, d, x, means, deviations) of those that take part."""
    v = F.col(vector_col)
    takes_part = (
        (F.lit(nameless) | F.col(id_col).isNotNull())
        & F.col(label_col).isNotNull()
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    named = table.filter(F.coalesce(takes_part, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.size(v).alias("d"),
        v.cast("array<double>").alias("vector"),
    )

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ["id", "label", "anchor", "d"]
        for whole in batches:
            lengths = whole.column("d").to_numpy()
            for d in np.unique(lengths).tolist():
                mine = np.nonzero(lengths == d)[0]
                for at in range(0, len(mine), 4096):
                    batch = whole.take(pa.array(mine[at : at + 4096]))
                    # Whole numbers, kept as doubles: those of any size are exact.
                    with np.errstate(over="ignore"):
                        x = np.floor(scale * _dense(batch.column("vector")))
                    x = np.nan_to_num(x)  # beyond a double: the largest one
                    means, deviations = summaries(x)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c) for c in kept), _lists(x), _lists(means), _lists(deviations)],
                        [*kept, "x", "means", "deviations"],
                    )

    rows = named.mapInArrow(
        summarize,
        "id bigint, label bigint, anchor boolean, d int, x array<double>,"
        "means array<double>, deviations array<double>",
    )
    # The numbers become fixed as the table is written.
    return keep(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


class Side:
    """The vectors of one side of a cell."""

    def __init__(self, table: pa.Table):
        self.row = table.column("row").to_numpy()
        # Rows without an id come last of those with equal scores.
        self.nameless = table.column("id").is_null().to_numpy()
        self.id = table.column("id").fill_null(CEILING).to_numpy()
        self.label = table.column("label").to_numpy()
        self.number = _dense(table.column("x"))
        size = np.abs(self.number)
        # Larger ones are never multiplied as bigints.
        self.x = np.where(size < SURE, self.number, 0).astype(np.int64)
        self.means = _dense(table.column("means"))
        self.deviations = _dense(table.column("deviations"))
        fits = (size <= BOUNDED).all(axis=1)
        self.length = np.full(len(self), BEYOND)
        self.length[fits] = np.sqrt((size[fits] ** 2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.row)


def _exact(anchors: Side, rows: Side, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    scores = np.empty(len(a), dtype=np.int64)
    for at in range(0, len(a), PAIRS_AT_ONCE):
        i, j = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
        scores[at : at + PAIRS_AT_ONCE] = np.einsum("ij,ij->i", anchors.x[i], rows.x[j])
        most = anchors.length[i] * rows.length[j]
        for place in np.nonzero(most >= SURE)[0].tolist():
            # Doubles tell the sign of what is far beyond, whole numbers the rest.
            one, other = anchors.number[i[place]], rows.number[j[place]]
            with np.errstate(all="ignore"):
                score = float(one @ other)
            if most[place] >= BEYOND or abs(score) < 1e-9 * most[place] + 2.0**63:
                score = sum(int(p) * int(q) for p, q in zip(one.tolist(), other.tolist()))
            scores[at + place] = int(min(max(score, FLOOR), CEILING))
    return scores


def _finer(
    anchors: Side, rows: Side, a: np.ndarray, b: np.ndarray, first: int, last: int,
    floor: np.ndarray, ceiling: np.ndarray,
) -> np.ndarray:
    """Which pairs may lie between floor and ceiling by the segments first to last."""
    left = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), PAIRS_AT_ONCE):
        i, j = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
        middle = np.einsum("ij,ij->i", anchors.means[i, first:last], rows.means[j, first:last])
        spread = np.einsum("ij,ij->i", anchors.deviations[i, first:last], rows.deviations[j, first:last])
        spread += 1e-9 * anchors.length[i] * rows.length[j] + 1
        left[at : at + PAIRS_AT_ONCE] = (middle + spread >= floor[i]) & (middle - spread <= ceiling[i])
    return left


class Best:
    """For each anchor and each of its limits the best rows so far: score, id and row."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low, high, most
        self.found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        # The least score that still matters for each anchor and limit.
        self.floor = low.copy()

    def add(self, a: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        """Pairs of anchors, given by their numbers, with rows and exact scores."""
        order = np.lexsort((row, ids, -score, a))
        a, score, ids, row = a[order], score[order], ids[order], row[order]
        starts = np.nonzero(np.diff(a, prepend=-1))[0].tolist()
        for begin, end in zip(starts, [*starts[1:], len(a)]):
            i = int(a[begin])
            falling = -score[begin:end]
            for p in range(self.low.shape[1]):
                top = begin + int(np.searchsorted(falling, -self.high[i, p], "left"))
                bottom = begin + int(np.searchsorted(falling, -self.floor[i, p], "right"))
                bottom = min(bottom, top + self.most)
                if top >= bottom:
                    continue
                new = [
                    (-s, n, r)
                    for s, n, r in zip(
                        score[top:bottom].tolist(), ids[top:bottom].tolist(), row[top:bottom].tolist()
                    )
                ]
                best = sorted([*self.found.get((i, p), []), *new])[: self.most]
                self.found[i, p] = best
                if len(best) == self.most:
                    self.floor[i, p] = max(self.floor[i, p], -best[-1][0])


def search(anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, same: bool, most: int) -> Best:
    """The best ``most`` rows of each anchor with a score from low to high, for each limit.

    ``low`` and ``high`` have a row for each anchor and a column for each limit; a
    limit with low above high takes nothing. ``same``: rows of the anchor's label
    other than itself, else those of other labels.
    """
    best = Best(low, high, most)
    levels = levels_of(anchors.x.shape[1])
    ends = np.cumsum(levels).tolist()
    for top in range(0, len(anchors), ANCHORS_AT_ONCE):
        mine = slice(top, min(top + ANCHORS_AT_ONCE, len(anchors)))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            part = slice(at, min(at + ROWS_AT_ONCE, len(rows)))
            floor = np.where(low <= high, best.floor, CEILING).min(axis=1).astype(np.float64)
            ceiling = np.where(low <= high, high, FLOOR).max(axis=1).astype(np.float64)
            ceiling[ceiling >= CEILING] = np.inf  # scores beyond count as this one
            first = slice(0, ends[0])
            middle = anchors.means[mine, first] @ rows.means[part, first].T
            spread = anchors.deviations[mine, first] @ rows.deviations[part, first].T
            spread += 1e-9 * np.outer(anchors.length[mine], rows.length[part]) + 1
            alike = anchors.label[mine, None] == rows.label[None, part]
            wanted = alike & (anchors.row[mine, None] != rows.row[None, part]) if same else ~alike
            wanted &= middle + spread >= floor[mine, None]
            wanted &= middle - spread <= ceiling[mine, None]
            a, b = np.nonzero(wanted)
            a, b = a + top, b + at
            if not len(a):
                continue
            if same or len(a) > 4 * most * ANCHORS_AT_ONCE:
                # The rows with the highest bounds first: their scores raise the floor.
                likely = np.argpartition(np.where(wanted, -(middle + spread), np.inf), min(most, wanted.shape[1] - 1), axis=1)
                i = np.repeat(np.arange(wanted.shape[0]), min(most, wanted.shape[1]))
                j = likely[:, :most].ravel()
                real = wanted[i, j]
                wanted[i[real], j[real]] = False
                i, j = i[real] + top, j[real] + at
                best.add(i, _exact(anchors, rows, i, j), rows.id[j], rows.row[j])
                floor = np.where(low <= high, best.floor, CEILING).min(axis=1).astype(np.float64)
                wanted &= middle + spread >= floor[mine, None]
                a, b = np.nonzero(wanted)
                a, b = a + top, b + at
            for begin, end in zip(ends, ends[1:]):
                left = _finer(anchors, rows, a, b, begin, end, floor, ceiling)
                a, b = a[left], b[left]
            best.add(a, _exact(anchors, rows, a, b), rows.id[b], rows.row[b])
    return best


_COLUMNS = ["row", "id", "label", "x", "means", "deviations"]
_FOUND = (
    "anchor_row bigint, anchor_id bigint, place int, score bigint, id bigint, row bigint"
)


def _cells(rows: DataFrame, anchors: DataFrame, slices: int, groups: int, same: bool, most: int) -> DataFrame:
    """The best rows of each anchor and limit in each cell.

    ``anchors`` have the limits as arrays ``low`` and ``high``.
    """
    # Of one type on both sides: a cogroup casts nothing, and an int and a bigint of
    # the same value are sent to different tasks.
    slice_ = F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice")
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int").alias("group")
    # New columns, as both sides of the cogroup come from one table.
    kept = [F.col(c).alias(c) for c in ["d", *_COLUMNS, "low", "high"]]
    left = anchors.select(
        group, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), *kept
    )
    right = rows.select(
        "d", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), slice_, *_COLUMNS
    )

    def cell(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(6)]
        if ours.num_rows and theirs.num_rows:
            ours = ours.sort_by("row")
            anchors_, rows_ = Side(ours), Side(theirs.sort_by("row"))
            best = search(
                anchors_, rows_, _dense(ours.column("low")), _dense(ours.column("high")), same, most
            )
            nameless = set(rows_.row[rows_.nameless].tolist())
            for (i, p), found in best.found.items():
                anchor = None if anchors_.nameless[i] else int(anchors_.id[i])
                for score, name, row in found:
                    values = (int(anchors_.row[i]), anchor, p, -score, None if row in nameless else name, row)
                    for column, value in zip(columns, values):
                        column.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_row", "anchor_id", "place", "score", "id", "row"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    keys = ["d", "group", "slice"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, _FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """Of each anchor and limit the best ``most``, numbered from one."""
    from pyspark.sql import Window

    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    table: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label",
    vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
    lowest: int = LOWEST, highest: int = HIGHEST, scale: int = SCALE,
    slice_rows: int = SLICE_ROWS, group_anchors: int = GROUP_ANCHORS, nameless: bool = False,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors. A negative's score is from ``lowest``
    to ``highest`` percent of the positive's. ``nameless`` rows have no id.
    """
    ship(table.sparkSession)
    rows = prepared(table, anchors, id_col, label_col, vector_col, scale, nameless)
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    slices, groups = max(1, -(-n // slice_rows)), max(1, -(-n_anchors // group_anchors))
    bigints = "array<bigint>"
    asking = rows.filter("anchor").select(
        "d", *_COLUMNS,
        F.array(F.lit(FLOOR)).cast(bigints).alias("low"),
        F.array(F.lit(CEILING)).cast(bigints).alias("high"),
    )
    first = keep(_first(_cells(rows, asking, slices, groups, True, positives), positives), "negatives-positives")
    # Limits as whole numbers, rounded inwards; decimals hold the products.
    wide = F.col("score").cast("decimal(20,0)")
    first = first.withColumn("low", F.ceil(wide * lowest / F.lit(100)).cast("bigint")).withColumn(
        "high", F.floor(wide * highest / F.lit(100)).cast("bigint")
    )
    # Each anchor's limits by the rank of the positive; places without one take nothing.
    listed = first.groupBy(F.col("anchor_row").alias("row")).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", F.struct("low", "high")))).alias("limits")
    )
    ranks = F.sequence(F.lit(1), F.lit(positives))
    limits = listed.select(
        "row",
        F.transform(ranks, lambda p: F.coalesce(F.try_element_at("limits", p)["low"], F.lit(CEILING))).alias("low"),
        F.transform(ranks, lambda p: F.coalesce(F.try_element_at("limits", p)["high"], F.lit(FLOOR))).alias("high"),
    )
    limited = rows.filter("anchor").select("d", *_COLUMNS).join(limits, "row")
    second = _first(_cells(rows, limited, slices, groups, False, negatives), negatives)
    named = first.select(
        "anchor_row", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    beyond = F.raise_error(F.lit("a score is beyond a bigint")).cast("bigint")
    fitting = F.when(F.col("positive_score") < CEILING, F.col("positive_score")).otherwise(beyond)
    return second.join(named, ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), fitting.alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
