"""Matrices as tables: coordinate cells (i, j, v), and blocks of such cells.

Indices count from 0. A cell that is absent is zero and yields no row; a cell
without a value counts as absent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
# Cells multiplied in one numpy call, and cells of output blocks a Python worker
# adds to before it sends them on; both bound its memory.
CELLS_AT_ONCE = 1 << 19
CELLS_HELD = 1 << 22
# Left blocks with fewer cells than one place in so many are multiplied cell by cell.
SPARSE = 16


def dense_to_coo(df: DataFrame, row: str, values: str) -> DataFrame:
    """Cells from one array per matrix row."""
    return df.select(F.col(row).alias("i"), F.posexplode(values).alias("j", "v")).select(
        F.col("i").cast("bigint"), F.col("j").cast("bigint"), "v"
    )


def transpose(coo: DataFrame) -> DataFrame:
    return coo.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def coo_multiply(left: DataFrame, right: DataFrame) -> DataFrame:
    """Product of two coordinate matrices, for sparse ones.

    Cells meet on the inner index, and the products go straight into a partial
    sum by (i, j); they are shuffled as sums only. Cells given more than once
    add up, as the product is linear in each. A dense inner index makes one
    product for every multiplication there is: use ``block_multiply`` for it.
    """
    lefts = left.select("i", F.col("j").alias("k"), F.col("v").alias("_left"))
    rights = right.select(F.col("i").alias("k"), "j", F.col("v").alias("_right"))
    lefts, rights = lefts.dropna(subset=["_left"]), rights.dropna(subset=["_right"])
    return (
        lefts.join(rights, "k")
        .groupBy("i", "j")
        .agg(F.sum(F.col("_left") * F.col("_right")).alias("v"))
    )


def to_blocks(
    coo: DataFrame, rows: int = BLOCK, cols: int = BLOCK, unique: bool = False
) -> DataFrame:
    """Blocks (bi, bj, at, v) of rows by cols cells, for the cells there are.

    ``at`` is a cell's place in its block, counted row by row. Repeated cells
    are added up first, so a block has at most rows * cols entries; ``unique``
    says that there are none and saves the shuffle.
    """
    cells = coo.select("i", "j", F.col("v").cast("double").alias("v")).dropna(subset=["v"])
    if not unique:
        cells = cells.groupBy("i", "j").agg(F.sum("v").alias("v"))
    place = (F.col("i") % rows * cols + F.col("j") % cols).cast("int")
    return (
        cells.groupBy(F.expr(f"i div {rows}").alias("bi"), F.expr(f"j div {cols}").alias("bj"))
        .agg(F.collect_list(F.struct(place.alias("at"), "v")).alias("cells"))
        .select("bi", "bj", F.col("cells.at").alias("at"), F.col("cells.v").alias("v"))
    )


def block_layout(coo: DataFrame, rows: int = BLOCK, cols: int = BLOCK) -> DataFrame:
    """Cells per block: (bi, bj, cells)."""
    return coo.groupBy(
        F.expr(f"i div {rows}").alias("bi"), F.expr(f"j div {cols}").alias("bj")
    ).agg(F.count("*").alias("cells"))


def invalid_blocks(blocks: DataFrame, rows: int = BLOCK, cols: int = BLOCK) -> DataFrame:
    """Blocks that break the layout: a place outside the block, or taken twice."""
    places = F.col("at")
    outside = F.exists(places, lambda p: (p < 0) | (p >= rows * cols))
    repeated = F.size(F.array_distinct(places)) != F.size(places)
    return blocks.filter(outside | repeated | (F.col("bi") < 0) | (F.col("bj") < 0))


def block_grid(blocks: DataFrame) -> DataFrame:
    """Row and column blocks of a matrix, from its blocks or their layout."""
    return blocks.agg(
        (F.max("bi") + 1).alias("row_blocks"), (F.max("bj") + 1).alias("col_blocks")
    )


def block_multiply(
    left: DataFrame,
    right: DataFrame,
    rows: int = BLOCK,
    inner: int = BLOCK,
    cols: int = BLOCK,
    unique: bool = False,
) -> DataFrame:
    """Product of two coordinate matrices by blocks, for dense ones.

    Blocks meet on the inner block index; numpy multiplies them in batches and a
    task adds its products up by output block. Left blocks that are mostly empty are
    multiplied cell by cell, so they take time by their cells and not by their places. What it then sends is one row for
    each output block it touched, the block's cells as two arrays, to the task
    that owns the block, which adds the blocks up as they come, one at a time in
    memory. So the shuffle has at most output blocks times tasks rows (more only
    where a task touches more blocks than it may hold), where ``coo_multiply``
    moves a row for each cell and joins one for each multiplication. The result
    has the same rows.
    """
    return block_sums(
        block_products(left, right, rows, inner, cols, unique), rows, cols
    )


def block_products(
    left: DataFrame,
    right: DataFrame,
    rows: int = BLOCK,
    inner: int = BLOCK,
    cols: int = BLOCK,
    unique: bool = False,
) -> DataFrame:
    """Partial output blocks (bi, bj, at, v) of a product, one for each block and task."""
    return _multiplied(
        to_blocks(left, rows, inner, unique), to_blocks(right, inner, cols, unique), rows, inner, cols
    )


def _multiplied(left: DataFrame, right: DataFrame, rows: int, inner: int, cols: int) -> DataFrame:
    lefts = left.select(
        "bi", F.col("bj").alias("bk"), F.col("at").alias("left_at"), F.col("v").alias("left_v")
    )
    rights = right.select(
        F.col("bi").alias("bk"), "bj", F.col("at").alias("right_at"), F.col("v").alias("right_v")
    )

    pairs_at_once = max(1, CELLS_AT_ONCE // max(rows * inner, inner * cols, rows * cols))
    blocks_held = max(pairs_at_once, CELLS_HELD // (rows * cols))

    # Nested, so that they travel to the workers with the job.
    def dense(batch: pa.RecordBatch, at: str, values: str, height: int, width: int):
        """The blocks of a batch as one array each of values and of presence."""
        places = batch.column(at)
        size = height * width
        block = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
        place = block * size + places.flatten().to_numpy()
        weights = batch.column(values).flatten().to_numpy()
        value = np.bincount(place, weights, batch.num_rows * size)
        present = np.zeros(batch.num_rows * size, dtype=np.float32)
        present[place] = 1
        shape = (batch.num_rows, height, width)
        return value.reshape(shape), present.reshape(shape)

    def by_cells(batch: pa.RecordBatch, slots: np.ndarray, right_v: np.ndarray, right_p: np.ndarray):
        """Sums of the products of single left cells: output rows, each once, and their cells."""
        places = batch.column("left_at")
        pair = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
        row, k = np.divmod(places.flatten().to_numpy(), inner)
        at = slots[pair] * rows + row
        order = np.argsort(at, kind="stable")
        at, pair, k = at[order], pair[order], k[order]
        weights = batch.column("left_v").flatten().to_numpy()[order]
        touched = right_p[pair, k] > 0
        products = np.where(touched, weights[:, None] * right_v[pair, k], 0.0)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        if not len(first):
            return at, products, touched
        return at[first], np.add.reduceat(products, first), np.logical_or.reduceat(touched, first)

    def sparse(targets: np.ndarray, value: np.ndarray, present: np.ndarray) -> pa.RecordBatch:
        n = len(targets)
        block, place = np.nonzero(present.reshape(n, -1))
        ends = np.cumsum(np.bincount(block, minlength=n))
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(targets[:, 0]),
                pa.array(targets[:, 1]),
                pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(value.reshape(n, -1)[block, place])),
            ],
            ["bi", "bj", "at", "v"],
        )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up a task's products by output block, in bounded memory."""
        held: dict[tuple[int, int], int] = {}
        value = np.zeros((blocks_held, rows, cols))
        present = np.zeros((blocks_held, rows, cols), dtype=bool)
        for whole in batches:
            for start in range(0, whole.num_rows, pairs_at_once):
                batch = whole.slice(start, pairs_at_once)
                if len(held) + batch.num_rows > blocks_held:
                    yield sparse(np.array(list(held)), value[: len(held)], present[: len(held)])
                    value[: len(held)] = 0
                    present[: len(held)] = False
                    held = {}
                right_v, right_p = dense(batch, "right_at", "right_v", inner, cols)
                targets = zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist())
                slots = [held.setdefault(target, len(held)) for target in targets]
                if len(batch.column("left_at").flatten()) * SPARSE < batch.num_rows * rows * inner:
                    at, sums, touched = by_cells(batch, np.array(slots), right_v, right_p)
                    value.reshape(-1, cols)[at] += sums
                    present.reshape(-1, cols)[at] |= touched
                    continue
                left_v, left_p = dense(batch, "left_at", "left_v", rows, inner)
                products = left_v @ right_v
                touched = left_p @ right_p > 0
                for pair, slot in enumerate(slots):
                    value[slot] += products[pair]
                    present[slot] |= touched[pair]
        if held:
            yield sparse(np.array(list(held)), value[: len(held)], present[: len(held)])

    return (
        lefts.join(rights, "bk")
        .select("bi", "bj", "left_at", "left_v", "right_at", "right_v")
        .mapInArrow(multiply, "bi bigint, bj bigint, at array<int>, v array<double>")
    )


def block_sums(parts: DataFrame, rows: int = BLOCK, cols: int = BLOCK) -> DataFrame:
    """Cells (i, j, v) of the sums of blocks with the same (bi, bj)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        value, present = np.zeros(rows * cols), np.zeros(rows * cols, dtype=bool)

        def cells() -> pa.RecordBatch:
            place = np.nonzero(present)[0]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(now[0] * rows + place // cols),
                    pa.array(now[1] * cols + place % cols),
                    pa.array(value[place]),
                ],
                ["i", "j", "v"],
            )

        for batch in batches:
            at, v = batch.column("at"), batch.column("v")
            places, values = at.flatten().to_numpy(), v.flatten().to_numpy()
            ends = np.cumsum(np.asarray(at.value_lengths())).tolist()
            begin = 0
            targets = zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist())
            for target, end in zip(targets, ends):
                if target != now:
                    if now is not None:
                        yield cells()
                    now = target
                    value[:] = 0
                    present[:] = False
                value[places[begin:end]] += values[begin:end]
                present[places[begin:end]] = True
                begin = end
        if now is not None:
            yield cells()

    return (
        parts.repartition("bi", "bj")
        .sortWithinPartitions("bi", "bj")
        .mapInArrow(add_up, "i bigint, j bigint, v double")
    )


@dataclass(frozen=True)
class BlockMatrix:
    """Blocks (bi, bj, at, v), see ``to_blocks``, and the size of their matrix.

    The size is declared and not read off the cells, so rows and columns at the
    end count that hold nothing, and so do the blocks they fill.
    """

    blocks: DataFrame
    rows: int
    cols: int
    block_rows: int = BLOCK
    block_cols: int = BLOCK

    def __post_init__(self) -> None:
        if min(self.rows, self.cols) < 0 or min(self.block_rows, self.block_cols) < 1:
            raise ValueError("a matrix has no negative size and no empty blocks")

    @classmethod
    def of_cells(
        cls, coo: DataFrame, rows: int, cols: int, block_rows: int = BLOCK,
        block_cols: int = BLOCK, unique: bool = False,
    ) -> BlockMatrix:
        return cls(to_blocks(coo, block_rows, block_cols, unique), rows, cols, block_rows, block_cols)

    @property
    def row_blocks(self) -> int:
        return -(-self.rows // self.block_rows)

    @property
    def col_blocks(self) -> int:
        return -(-self.cols // self.block_cols)

    def grid(self) -> DataFrame:
        """One row: the grid's row and column blocks, and how many of them hold cells."""
        inside = (F.col("bi") < self.row_blocks) & (F.col("bj") < self.col_blocks)
        counted = self.blocks.filter(inside & (F.col("bi") >= 0) & (F.col("bj") >= 0))
        return counted.select("bi", "bj").distinct().agg(F.count("*").alias("filled")).select(
            F.lit(self.row_blocks).cast("bigint").alias("row_blocks"),
            F.lit(self.col_blocks).cast("bigint").alias("col_blocks"),
            "filled",
        )

    def invalid(self) -> DataFrame:
        """Blocks that break the layout: (bi, bj, reason), a row for each reason.

        ``outside the grid``; ``given twice``: there is another block of its place;
        ``places and values differ in number``; ``outside the matrix``: a cell
        outside its block, or in a last block beyond the matrix; ``place taken
        twice``. The check is one pass over the blocks and a count by place.
        """
        bi, bj, at = F.col("bi"), F.col("bj"), F.col("at")
        outside = (bi < 0) | (bj < 0) | (bi >= self.row_blocks) | (bj >= self.col_blocks)
        # The last blocks may be lower or narrower than the others.
        height = F.least(F.lit(self.block_rows), F.lit(self.rows) - bi * self.block_rows)
        width = F.least(F.lit(self.block_cols), F.lit(self.cols) - bj * self.block_cols)
        row = lambda p: F.floor(p / F.lit(self.block_cols))
        beyond = F.exists(at, lambda p: (p < 0) | (row(p) >= height) | (p % self.block_cols >= width))
        reasons = {
            "outside the grid": outside,
            "places and values differ in number": F.size(at) != F.size("v"),
            "outside the matrix": ~outside & beyond,
            "place taken twice": F.size(F.array_distinct(at)) != F.size(at),
        }
        found = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in reasons.items()]))
        broken = self.blocks.select("bi", "bj", F.explode(found).alias("reason"))
        twice = self.blocks.groupBy("bi", "bj").count().filter("count > 1")
        return broken.unionByName(twice.select("bi", "bj", F.lit("given twice").alias("reason")))

    def multiply(self, other: BlockMatrix) -> DataFrame:
        """Cells of the product; the sizes and blocks must fit."""
        if (self.cols, self.block_cols) != (other.rows, other.block_rows):
            raise ValueError("the inner sizes differ")
        parts = _multiplied(
            self.blocks, other.blocks, self.block_rows, self.block_cols, other.block_cols
        )
        return block_sums(parts, self.block_rows, other.block_cols)
