"""Near-duplicates by SimHash fingerprints that differ in a few bits.

A fingerprint has 64 bits: bit b is 1 if more than half of the hashes of the
text's shingles have it. Fingerprints that differ in four bits or fewer are
linked, and documents belong to the component of their fingerprint.

Equal fingerprints are one node from the start, so a group of copies of any size
costs one row. To find the links, a fingerprint is cut into segments of 22, 21
and 21 bits. If two fingerprints differ in four bits, two of the three segments
differ in two bits or fewer, so the two fingerprints share a Golay key (see
``golay``) in both. Each fingerprint is therefore listed under its pairs of keys
for each pair of segments, some 80 keys of 26 bits, the lists are gathered by a
shuffle, and the fingerprints of a list are compared on all 64 bits. A list
puts out a spanning forest of its links, less than one link for each of its
rows, and never all pairs.

Fingerprints of a templated source share most bits and may fill a list without
being linked. A list of more than ``LONG_LIST`` rows is therefore not compared where
it was gathered, nor held there: its rows go on, are dealt to groups of some
``LIST_TILE``, and each two groups are compared in a task of their own, so no task
holds or compares more than two groups. All tiles together hold all pairs.

Defined results: a null text is empty; a text without words has fingerprint
zero and is linked like any other; a text with fewer words than a shingle has
one shingle, the whole sequence. Rows with the same id and different texts keep
their own fingerprints; the component's name is the smallest id. Texts of any length
are read whole; an empty table gives an empty result; columns other than the id and
the text, whatever their names, are not looked at and pass ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import golay
from sparkloom.llm.components import components
from sparkloom.llm.shared import boxed, join_groups, keep, resident, runs, ship, spread, text_of

SHINGLE = 4
MAX_BITS = 4  # the segments below are made for four
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and bits
PAIRS = ((0, 1), (0, 2), (1, 2))
# Lists up to this long are compared pair by pair at once, longer ones by search.
SHORT_LIST = 48
LONG_LIST = 1 << 16
LIST_TILE = 1 << 13
ROWS_AT_ONCE = 1 << 18

# For each byte value the eight bits.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    import xxhash

    # bytes.lower changes A-Z only; bytes.split parts at space and 09-0D.
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, 42)]
    else:
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0] + [e + 1 for e in ends[:-shingle]]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])]
    columns = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(c, minlength=256) @ _BITS for c in columns.T])
    return int(sum(1 << b for b in np.nonzero(ones * 2 > len(hashes))[0].tolist()))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """The id, the fingerprint as a signed bigint ``fp``, and a hash of the text."""

    @F.pandas_udf("bigint")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        resident("fingerprints")
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("_id"), prints(text).alias("fp"), F.xxhash64(text).alias("text_hash")
    )


def list_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, position in ``prints``) of unsigned fingerprints."""
    segments = [
        golay.keys((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1), bits)
        for at, bits in SEGMENTS
    ]
    all_keys, positions = [], []
    for number, (i, j) in enumerate(PAIRS):
        (left, has_left), (right, has_right) = segments[i], segments[j]
        both = has_left[:, :, None] & has_right[:, None, :]
        key = (number << 24) | (left[:, :, None] << 12) | right[:, None, :]
        at = np.broadcast_to(np.arange(len(prints))[:, None, None], both.shape)
        all_keys.append(key[both])
        positions.append(at[both])
    return np.concatenate(all_keys), np.concatenate(positions)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signed = batch.column("fp").to_numpy()
        for at in range(0, len(signed), 4096):
            part = np.ascontiguousarray(signed[at : at + 4096])
            key, position = list_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype(np.int32)), pa.array(part[position])], ["key", "fp"]
            )


def _search(prints: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links of a list: visited ones leave the list."""
    a, b = [], []
    left = prints
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            node = front.pop()
            near = np.bitwise_count(left ^ node) <= most
            if near.any():
                met = left[near]
                left = left[~near]
                a.extend([node] * len(met))
                b.extend(met)
                front.extend(met)
    return a, b


def linked(key: np.ndarray, prints: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Links within each run of equal keys, as rows of two unsigned fingerprints."""
    starts = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
    lengths = np.diff(np.concatenate([starts, [len(key)]]))
    run = np.repeat(np.arange(len(starts)), lengths)
    a, b, owner = [], [], []
    longest = int(lengths[lengths <= SHORT_LIST].max(initial=0))
    in_short = lengths[run] <= SHORT_LIST
    for step in range(1, longest):
        same = in_short[:-step] & (run[:-step] == run[step:])
        if not same.any():
            break
        at = np.nonzero(same)[0]
        near = np.bitwise_count(prints[at] ^ prints[at + step]) <= most
        at = at[near]
        a.append(prints[at])
        b.append(prints[at + step])
        owner.append(run[at])
    found = [np.zeros((0, 2), np.uint64)]
    searched = set(np.nonzero(lengths > SHORT_LIST)[0].tolist())
    if a:
        pairs = np.stack([np.concatenate(a), np.concatenate(b)], axis=1)
        owners = np.concatenate(owner)
        # Lists with as many links as rows go by search too: a forest has fewer.
        dense = np.bincount(owners, minlength=len(starts)) >= lengths
        searched.update(np.nonzero(dense)[0].tolist())
        found.append(pairs[~dense[owners]])
    for r in sorted(searched):
        x, y = _search(prints[starts[r] : starts[r] + lengths[r]], most)
        if x:
            found.append(np.array([x, y], dtype=np.uint64).T)
    return np.unique(np.concatenate(found), axis=0)


def _lists(
    batches: Iterator[pa.RecordBatch], long_list: int
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows sorted by key, as keys and signed fingerprints, and whether they are part of
    a long list; other lists come whole. No more is held than two long lists' rows."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held, passing = 0, None
    for batch in batches:
        key, fp = (batch.column(c).to_numpy() for c in ("key", "fp"))
        if passing is not None:
            more = int(np.searchsorted(key, passing, side="right"))
            if more:
                yield key[:more], fp[:more], True
            key, fp = key[more:], fp[more:]
        if not len(key):
            continue
        passing = None
        waiting.append((key, fp))
        held += len(key)
        if held < min(ROWS_AT_ONCE, 2 * long_list):
            continue
        key, fp = (np.concatenate(c) for c in zip(*waiting))
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield key[:cut], fp[:cut], False
        waiting, held = [(key[cut:], fp[cut:])], len(key) - cut
        if held > long_list:
            yield key[cut:], fp[cut:], True
            waiting, held, passing = [], 0, key[-1]
    if waiting:
        key, fp = (np.concatenate(c) for c in zip(*waiting))
        yield key, fp, False


def _found(key: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows (key, a, b): links without a key, or rows of long lists without b."""
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        n = len(a[part])
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(n, pa.int32()) if key is None else pa.array(key[part]),
                pa.array(a[part]),
                pa.nulls(n, pa.int64()) if b is None else pa.array(b[part]),
            ],
            ["key", "a", "b"],
        )


def _links(batches: Iterator[pa.RecordBatch], long_list: int) -> Iterator[pa.RecordBatch]:
    for key, fp, is_long in _lists(batches, long_list):
        if not is_long:
            starts = np.nonzero(np.diff(key, prepend=key[0] - 1))[0]
            lengths = np.diff(np.append(starts, len(key)))
            long = np.repeat(lengths > long_list, lengths)
            if not long.all():
                prints = np.ascontiguousarray(fp[~long]).view(np.uint64)
                signed = np.ascontiguousarray(linked(key[~long], prints).T).view(np.int64)
                yield from _found(None, signed[0], signed[1])
            key, fp = key[long], fp[long]
        yield from _found(key, fp, None)


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, ["key", "tile"], rows=1 << 14):
        key, tile = table.column("key").to_numpy(), table.column("tile").to_numpy()
        prints = np.ascontiguousarray(table.column("fp").to_numpy()).view(np.uint64)
        edges = np.nonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))[0] + 1
        for part in np.split(prints, edges):
            x, y = (np.array(side, dtype=np.uint64).view(np.int64) for side in _search(part, MAX_BITS))
            yield from _found(None, x, y)


def fingerprint_links(
    distinct: DataFrame, long_list: int = LONG_LIST, tile: int = LIST_TILE
) -> DataFrame:
    """Links that connect all fingerprints within ``MAX_BITS`` of one another."""
    fields = "key int, a bigint, b bigint"
    found = keep(
        spread(distinct.select("fp"), "fp")
        .mapInArrow(_listed, "key int, fp bigint")
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(lambda batches: _links(batches, long_list), fields),
        "fingerprint-lists",
    )
    rows = found.filter("key is not null").select("key", F.col("a").alias("fp"))
    total = rows.count()
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    groups = F.greatest(F.lit(2), F.ceil(F.col("n") / tile)).cast("bigint")
    tiled = (
        join_groups(rows, sizes, ["key"], "n", total)
        .select("key", "fp", groups.alias("groups"))
        .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("groups")))
        .withColumn("other", F.explode(F.expr("sequence(0L, groups - 1)")))
        .filter("mine <> other")
        .select(
            "key", "fp",
            (F.least("mine", "other") * F.col("groups") + F.greatest("mine", "other")).alias("tile"),
        )
    )
    in_tiles = (
        tiled.repartition("key", "tile")
        .sortWithinPartitions("key", "tile", "fp")
        .mapInArrow(_tile_links, fields)
    )
    return found.filter("key is null").select("a", "b").unionByName(in_tiles.select("a", "b")).distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One row per row: the id, ``fp`` (signed), ``component_id``, and the root
    fingerprint of the component and a hash of the text, which tell apart rows
    that share an id."""
    ship(docs.sparkSession)
    prints = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    total = prints.count()
    nodes = keep(
        prints.groupBy("fp").agg(F.min("_id").alias("least"), F.count("*").alias("copies")),
        "fingerprint-nodes",
    )
    parts = components(fingerprint_links(nodes), "simhash").withColumnRenamed("node", "fp")
    placed = keep(
        nodes.join(parts, "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "fingerprint-parts",
    )
    least = placed.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("size")
    )
    # A component may hold a large share of the fingerprints.
    named = join_groups(placed.drop("least"), least, ["root"], "size", placed.count())
    named = keep(named.drop("size"), "fingerprint-names")
    return join_groups(prints, named, ["fp"], "copies", total).select(
        F.col("_id").alias(id_col), "fp", "component_id", "root", "text_hash"
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """The table with one document of each group, the one with the smallest id.

    Where that id stands in several rows of the group, the one whose text has
    the least hash stays, and of equal rows one.
    """
    groups = near_groups(docs, id_col, text_col, shingle)
    stays = (
        groups.filter(F.col(id_col).eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))).alias("_key"))
        .select("_key")
        .distinct()
    )
    text = F.coalesce(F.col("_doc")[text_col], F.lit(""))
    return (
        boxed(docs, _id=id_col)
        .withColumn("_key", F.struct("_id", F.xxhash64(text).alias("_hash")))
        .join(stays, "_key", "left_semi")
        .dropDuplicates(["_key"])
        .select("_doc.*")
    )
