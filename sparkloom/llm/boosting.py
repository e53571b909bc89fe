"""Small gradient-boosted trees on binned features.

The trees grow from sums over all examples, by feature, bin and node: numpy makes
the sums of a block of examples, and blocks may lie in this process or in the
tasks of a Spark job. The fitted trees are plain arrays and travel with a task.
"""

from __future__ import annotations

from collections.abc import Callable
from operator import add

import numpy as np
from pyspark import RDD, StorageLevel

BINS = 32
# Where the cuts between the bins lie among the values of a feature.
QUANTILES = np.linspace(0, 1, BINS + 1)[1:-1]
# Gradients are summed in whole units, so no sum depends on the order of examples.
UNIT = 1 << 24
# Scores of the examples are written down after so many trees.
TREES_AT_ONCE = 6
# Up to so many partial sums, of some 70 kB, come to the driver as they are.
SUMS_AT_ONCE = 64

# Bins (examples by features), labels, copies and scores of some examples.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Here:
    """One block of examples in this process."""

    def __init__(self, block: Block):
        self.block = block

    def total(self, work: Callable[[Block], np.ndarray]) -> np.ndarray:
        return work(self.block)

    def rescore(self, work: Callable[[Block], Block]) -> None:
        self.block = work(self.block)


class Spread:
    """Blocks of examples in Spark's tasks; only sums over them come to the driver."""

    def __init__(self, blocks: RDD):
        self.blocks = self._kept(blocks)

    @staticmethod
    def _kept(blocks: RDD) -> RDD:
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
        return blocks

    def total(self, work: Callable[[Block], np.ndarray]) -> np.ndarray:
        few = self.blocks.getNumPartitions() <= SUMS_AT_ONCE
        return self.blocks.map(work).treeReduce(add, 1 if few else 2)

    def rescore(self, work: Callable[[Block], Block]) -> None:
        before, self.blocks = self.blocks, self._kept(self.blocks.map(work))
        before.unpersist()

    def release(self) -> None:
        self.blocks.unpersist()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _walk(binned: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each example after some levels of a tree."""
    rows = np.arange(len(binned))
    node = np.zeros(len(binned), np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
    return node


class Boosted:
    """Log-loss boosting of trees of fixed depth. Ties go to the first feature and cut."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0):
        self.trees, self.depth, self.rate, self.l2 = trees, depth, rate, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(column, QUANTILES)) for column in x.T]
        return self.grow(Here(self.block(x, y, np.ones(len(y), np.int64))))

    def block(self, x: np.ndarray, y: np.ndarray, copies: np.ndarray) -> Block:
        """Examples of which there are ``copies`` each, equal bins taken together."""
        labelled = np.column_stack([self._bin(x), y.astype(np.uint8)])
        rows = np.ascontiguousarray(labelled).view(f"V{labelled.shape[1]}").ravel()
        _, first, which = np.unique(rows, return_index=True, return_inverse=True)
        labelled = labelled[first]
        copies = np.bincount(which.ravel(), copies, len(first))
        binned = np.asfortranarray(labelled[:, :-1])
        return binned, labelled[:, -1].astype(float), copies, np.zeros(len(first))

    def grow(self, blocks: Here | Spread) -> Boosted:
        """Trees of all examples in the blocks, by the cuts that are set."""
        right, n = blocks.total(lambda b: np.array([(b[1] * b[2]).sum(), b[2].sum()]))
        share = min(max(right / n if n else 0.5, 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.forest = []
        # Trees that the scores in the blocks hold already.
        scored = 0
        for _ in range(self.trees):
            if len(self.forest) - scored == TREES_AT_ONCE:
                late = self.forest[scored:]
                blocks.rescore(lambda b: (*b[:3], b[3] + self._sum(b[0], late)))
                scored = len(self.forest)
            self.forest.append(self._tree(blocks, self.forest[scored:]))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        # There are fewer bins than a byte has values.
        binned = np.empty(x.shape, dtype=np.uint8, order="F")
        for i, (c, v) in enumerate(zip(self.cuts, x.T)):
            binned[:, i] = np.searchsorted(c, v, side="right")
        return binned

    def _tree(self, blocks: Here | Spread, late: list):
        base, d = self.base, len(self.cuts)
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level

            def sums(block: Block) -> np.ndarray:
                """Units of gradient and curvature, by node, feature and bin."""
                binned, y, copies, score = block
                p = _sigmoid(base + score + self._sum(binned, late))
                g = np.rint((p - y) * UNIT) * copies
                h = np.rint(p * (1 - p) * UNIT) * copies
                node = _walk(binned, feature, cut, level) - first
                out = np.empty((2, count, d, BINS), np.int64)
                for f in range(d):
                    cell = node * BINS + binned[:, f]
                    for k, values in enumerate((g, h)):
                        out[k, :, f] = np.bincount(cell, values, count * BINS).reshape(count, BINS)
                return out

            gs, hs = blocks.total(sums).cumsum(axis=-1) / UNIT
            best = np.full(count, 1e-6)
            for f in range(d):
                gl, hl = gs[:, f], hs[:, f]
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = (
                    gl**2 / (hl + self.l2)
                    + (gt - gl) ** 2 / (ht - hl + self.l2)
                    - gt**2 / (ht + self.l2)
                )[:, :-1]
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = top > best + 1e-12
                best[better] = top[better]
                feature[first : first + count][better] = f
                cut[first : first + count][better] = at[better]
        # The last level's sums on both sides of its cuts are those of the leaves.
        nodes, f, at = np.arange(count), feature[first:], np.minimum(cut[first:], BINS - 1)
        sides = []
        for total in (gs, hs):
            left = total[nodes, f, at]
            sides.append(np.column_stack([left, total[nodes, f, -1] - left]).ravel())
        return feature, cut, -self.rate * sides[0] / (sides[1] + self.l2)

    def _sum(self, binned: np.ndarray, forest: list) -> np.ndarray:
        score = np.zeros(len(binned))
        for feature, cut, value in forest:
            score += value[_walk(binned, feature, cut, self.depth) - len(feature)]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.base + self._sum(self._bin(x), self.forest))
