"""Near-duplicate vectors by binary codes of random rotations.

A vector is rotated by ``ROTATIONS`` random orthogonal matrices; the signs of the
rotated components are its codes, one bit a component, and with each code a
correction factor is stored, the absolute sum of the rotated components. The
inner product of a rotated vector with another's code, divided by the other's
factor, is an unbiased estimate of their inner product, whose error has a known
spread.

Candidates are vectors that agree in a key of ``KEY_BITS`` code bits; each code
gives several keys. The rows of a key come together by a shuffle, the vectors
with them. There a pair is estimated, from a rotation other than the key's,
with four-bit components of one vector against the code of the other, so by bit
operations alone. Pairs whose confidence bound stays below the wanted cosine go;
the others are recomputed in double precision. So every link is exact, and a
pair is missed only if all its keys differ or a bound fails: the recall over the
test tables is in the README.

A pair counts in the first key that its two vectors share, which their codes
tell. A key puts out, for each of its rows, the number of its links, and a
spanning forest of them, never all pairs. Keys with more than ``TILE`` rows are
cut into tiles, each a pair of groups of the key's rows, so no task holds more
than two groups; all tiles together hold all pairs.

Equal vectors are one from the start, with a count.

Defined results: a null vector, one that holds a null or a component that is not
finite, an empty one and one of zeros link with nothing and are their own
component; vectors of different lengths do not link; labels and other columns
are not looked at. Rows with the same id and different vectors are different
vectors; an id's row says what the row's vector has. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.components import components
from sparkloom.llm.shared import join_groups, keep, runs, ship, spread

COSINE = 0.95
KEYS = 24
KEY_BITS = 16
BOUND = 4.0  # standard deviations of the estimate
TILE = 2048
SHORT = 24
WORD = 64


def words_of(dimension: int) -> int:
    return -(-dimension // WORD)


def rotations_of(dimension: int) -> int:
    """As many as give ``KEYS`` keys, two at least: one to find, one to estimate."""
    return max(2, -(-KEYS * KEY_BITS // (WORD * words_of(dimension))))


@cache
def rotations(dimension: int) -> np.ndarray:
    """Random orthogonal matrices over the padded dimension, the same in each task."""
    size = words_of(dimension) * WORD
    random = np.random.default_rng(20240917 + dimension)
    made = []
    for _ in range(rotations_of(dimension)):
        q, r = np.linalg.qr(random.standard_normal((size, size)))
        made.append(q * np.sign(np.diag(r)))
    return np.stack(made)


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors (n, d) under each rotation: (n, rotations, padded d)."""
    n, d = x.shape
    all_of_them = rotations(d)
    padded = np.zeros((n, all_of_them.shape[1]))
    padded[:, :d] = x
    return np.einsum("nd,rkd->nrk", padded, all_of_them, optimize=True)


def codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits (n, rotations, words) and correction factors (n, rotations)."""
    bits = np.packbits(turned > 0, axis=2, bitorder="little")
    packed = np.ascontiguousarray(bits).view(np.uint64)
    return packed, np.abs(turned).sum(axis=2)


def keys_of(packed: np.ndarray) -> np.ndarray:
    """The keys of codes, 16 bits each: (n, keys)."""
    return np.ascontiguousarray(packed).reshape(len(packed), -1).view(np.uint16)[:, :KEYS]


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _dense(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length, without nulls, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(column: str):
    """Whether a vector can link: finite, not empty, not zero."""
    v = F.col(column)
    return F.coalesce(
        (F.size(v) > 0)
        & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        & F.exists(v, lambda c: c != 0),
        F.lit(False),
    )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key of a vector."""
    for batch in batches:
        lengths = np.asarray(batch.column("vector").value_lengths())
        for d in np.unique(lengths).tolist():
            mine = np.nonzero(lengths == d)[0]
            for at in range(0, len(mine), 1024):
                part = batch.take(pa.array(mine[at : at + 1024]))
                packed, _ = codes(rotated(unit(_dense(part.column("vector")))))
                keys = keys_of(packed)
                n, k = keys.shape
                rows = pa.array(np.repeat(np.arange(n), k))
                number = (d << 32) | (np.arange(k, dtype=np.int64) << 16)
                key = (number[None, :] | keys.astype(np.int64)).ravel()
                more = part.take(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *(more.column(c) for c in ("node", "copies", "vector"))],
                    ["key", "node", "copies", "vector"],
                )


class Group:
    """Vectors of one dimension with what is needed to compare them."""

    def __init__(self, vectors: np.ndarray, copies: np.ndarray, cosine: float):
        self.x = unit(vectors)
        self.copies = copies
        turned = rotated(self.x)
        self.packed, self.factors = codes(turned)
        self.keys = keys_of(self.packed)
        self.turned = turned
        self.cosine = cosine

    def prepare(self, key_number: int) -> None:
        """Choose the rotation to estimate with, and cut its components to four bits."""
        n, r, size = self.turned.shape
        own = key_number * KEY_BITS // size
        other = (own + 1) % r
        t = self.turned[:, other]
        self.code, self.factor = self.packed[:, other], self.factors[:, other]
        self.low = t.min(axis=1)
        self.step = np.maximum((t.max(axis=1) - self.low) / 15, 1e-300)
        levels = np.rint((t - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        planes = np.stack([(levels >> p) & 1 for p in range(4)])
        bits = np.packbits(planes, axis=2, bitorder="little")
        self.planes = np.ascontiguousarray(bits).view(np.uint64)
        self.total = self.low * size + self.step * levels.sum(axis=1)
        self.ones = np.bitwise_count(self.code).sum(axis=1).astype(np.float64)
        # Share of a unit vector that its code holds, and the spread that leaves.
        held = np.minimum(self.factor / np.sqrt(size), 1.0)
        spread_ = np.sqrt((1 - held**2) / (held**2 * max(1, size - 1)))
        self.error = BOUND * spread_
        # Roundings of up to half a step, adding up like a random walk.
        self.rounding = BOUND * self.step * np.sqrt(size / 12)

    def upper(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Upper confidence bound of the cosine of pairs, i against the codes of j."""
        weighted = np.zeros(len(i))
        for p in range(4):
            both = np.bitwise_count(self.planes[p][i] & self.code[j]).sum(axis=1)
            weighted += (1 << p) * both
        inner = 2 * (self.low[i] * self.ones[j] + self.step[i] * weighted) - self.total[i]
        return (inner + self.rounding[i]) / self.factor[j] + self.error[j]

    def links(self, i: np.ndarray, j: np.ndarray, key_number: int) -> np.ndarray:
        """Which of the pairs are links that count under this key."""
        near = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            a, b = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            maybe = np.nonzero(self.upper(a, b) >= self.cosine)[0]
            a, b = a[maybe], b[maybe]
            first = (self.keys[a] == self.keys[b]).argmax(axis=1) == key_number
            maybe, a, b = maybe[first], a[first], b[first]
            exact = np.einsum("ij,ij->i", self.x[a], self.x[b]) >= self.cosine
            near[at + maybe[exact]] = True
        return near


def forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs that connect what the pairs i-j of n rows connect, fewer than n."""
    parent = list(range(n))
    kept = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = a, b
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, links): the links of a node (b null), and links that connect."""
    for table in runs(batches, ["key", "tile"], rows=1 << 13):
        key, tile = table.column("key").to_numpy(), table.column("tile").to_numpy()
        side = table.column("side").to_numpy()
        edges = np.nonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))[0] + 1
        starts = np.concatenate([[0], edges, [len(key)]])
        sizes = np.diff(starts)
        numbers = (key >> 16).astype(np.int64)
        # Rows alone under their key have nobody to meet.
        crowd = np.repeat(sizes > 1, sizes)
        for number in np.unique(numbers[crowd]).tolist():
            rows = np.nonzero(crowd & (numbers == number))[0]
            part = table.take(pa.array(rows))
            nodes = part.column("node").to_numpy()
            group = Group(_dense(part.column("vector")), part.column("copies").to_numpy(), cosine)
            slot = number & 0xFFFF
            group.prepare(slot)
            yield from _of_key(group, nodes, key[rows], tile[rows], side[rows], slot)


def _of_key(group, nodes, key, tile, side, slot) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each (key, tile), sorted and together."""
    n = len(nodes)
    counts = np.zeros(n, dtype=np.int64)
    trees: list[tuple[int, int]] = []

    def compare(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # In a tile of two groups only pairs across them count.
        fits = (side[i] < 0) | (side[i] != side[j])
        i, j = i[fits], j[fits]
        near = group.links(i, j, slot)
        i, j = i[near], j[near]
        np.add.at(counts, i, group.copies[j])
        np.add.at(counts, j, group.copies[i])
        return i, j

    change = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
    starts = np.concatenate([[0], np.nonzero(change)[0] + 1])
    sizes = np.diff(np.concatenate([starts, [n]]))
    run = np.repeat(np.arange(len(starts)), sizes)
    short = sizes[run] <= SHORT
    found_i, found_j = [], []
    for step in range(1, int(sizes[sizes <= SHORT].max(initial=0))):
        i = np.nonzero(short[:-step] & (run[:-step] == run[step:]))[0]
        if not len(i):
            break
        a, b = compare(i, i + step)
        found_i.append(a)
        found_j.append(b)
    if found_i:
        trees += forest(np.concatenate(found_i), np.concatenate(found_j), n)
    for r in np.nonzero(sizes > SHORT)[0].tolist():
        begin, size = int(starts[r]), int(sizes[r])
        root = list(range(size))
        for at in range(0, size - 1, 64):
            top = min(at + 64, size - 1)
            i = np.concatenate([np.full(size - 1 - k, k) for k in range(at, top)])
            j = np.concatenate([np.arange(k + 1, size) for k in range(at, top)])
            a, b = compare(i + begin, j + begin)
            # Of each row's links to this block one for each block row would do;
            # rows already connected are dropped before the tree is grown.
            if len(a):
                label = np.array(root)
                apart = label[a - begin] != label[b - begin]
                a, b = a[apart], b[apart]
                pairs = forest(a - begin, b - begin, size)
                trees += [(x + begin, y + begin) for x, y in pairs]
                for x, y in pairs:
                    rx, ry = root[x], root[y]
                    if rx != ry:
                        low, high = min(rx, ry), max(rx, ry)
                        label = np.array(root)
                        label[label == high] = low
                        root = label.tolist()
    some = np.nonzero(counts)[0]
    schema = ["a", "b", "links"]
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.nulls(len(some), pa.int64()), pa.array(counts[some])], schema
        )
    if trees:
        pairs = np.array(trees, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[pairs[:, 0]]), pa.array(nodes[pairs[:, 1]]), pa.nulls(len(pairs), pa.int64())],
            schema,
        )


def tiled(listed: DataFrame, tile: int) -> DataFrame:
    """Rows with ``tile`` and ``side``; rows of long keys stand in several tiles.

    A key with n groups has a tile for each group (side -1) and for each pair of
    groups (sides 0 and 1).
    """
    long_keys = (
        listed.groupBy("key")
        .count()
        .filter(F.col("count") > tile)
        .select("key", F.ceil(F.col("count") / tile).cast("int").alias("groups"))
    )
    long_keys = keep(long_keys, "long-keys")
    rows = listed.join(long_keys, "key", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    mine = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    places = F.expr(
        """transform(sequence(0, groups - 1), g -> struct(
               least(g, mine) * groups + greatest(g, mine) as tile,
               case when g = mine then -1 when mine < g then 0 else 1 end as side))"""
    )
    return mine.select("key", "node", "copies", "vector", F.explode(places).alias("place")).select(
        "key", "node", "copies", "vector", "place.tile", "place.side"
    )


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    cosine: float = COSINE, tile: int = TILE,
) -> DataFrame:
    """One row per row: the id, n_links, component_id and kept."""
    ship(table.sparkSession)
    named = table.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("vector"))
    good = named.filter(usable("vector"))
    # Equal vectors are one node; -0.0 and 0.0 are equal here.
    classes = keep(
        good.groupBy("vector").agg(F.min("_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    kind = classes.schema["vector"]
    listed = spread(classes.select("node", "copies", "vector"), "node").mapInArrow(
        _indexed,
        T.StructType(
            [
                T.StructField("key", T.LongType()),
                T.StructField("node", T.LongType()),
                T.StructField("copies", T.LongType()),
                kind,
            ]
        ),
    )
    found = keep(
        tiled(listed, tile)
        .repartition("key", "tile")
        .sortWithinPartitions("key", "tile", "node")
        .mapInArrow(lambda batches: _compared(batches, cosine), "a bigint, b bigint, links bigint"),
        "vector-links",
    )
    links = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = components(found.filter("b is not null").select("a", "b"), "vectors")
    whole = keep(
        classes.select("node", "least", "copies")
        .join(links, "node", "left")
        .join(parts, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "vector-parts",
    )
    least = whole.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("size")
    )
    # A component may hold a large share of the vectors.
    named_classes = keep(
        join_groups(whole.drop("least"), least, ["root"], "size", whole.count()).select(
            "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        ),
        "vector-names",
    )
    answers = keep(
        classes.select("node", "vector", "copies").join(named_classes, "node").drop("node"),
        "vector-answers",
    )
    total = answers.agg(F.sum("copies")).first()[0] or 0
    linked = join_groups(good, answers, ["vector"], "copies", total).select(
        "_id", "n_links", "component_id"
    )
    alone = named.filter(~usable("vector")).select(
        "_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_col),
        "n_links",
        "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
