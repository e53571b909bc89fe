"""Packing in corpus order: windows over the stream of tokens, cut by dynamic programming.

Documents become token ids and an end mark, and stand one behind the other in the
order of the rows of each input partition. A window is a stretch of that stream
of at most ``CAPACITY`` tokens and becomes a sequence. A window pays for its
padding: up to the capacity, or nothing where its length is a power of two. A cut
between two windows pays nothing at the end of a document, ``SENTENCE`` tokens at
the end of a sentence inside of one, and ``WORD`` tokens elsewhere. Places
elsewhere are offered only where no document or sentence ends within ``STRETCH``
tokens, so every window can be closed.

The cheapest cuts up to a place ``p`` cost ``f(p) = cut(p) + min f(q) + padding(p -
q)``. As the padding is ``capacity - (p - q)``, the best ``q`` is the one with the
least ``f(q) + q`` of the places up to a capacity back: the front of a queue whose
values rise, from whose end the places go that a later and cheaper one beats. The
lengths that are powers of two are looked up besides. So a place costs a few steps
whatever the capacity.

A task plans some ``BLOCK`` tokens at a time, gives out the windows but for the
last two, and plans these again with what follows, so a block's end forces no cut
and memory is bounded: a task holds one block and one document's ids. Rows are not
shuffled; a task's last window is the only one that has to take what is left. With
``order`` the rows are first sorted by these columns over the whole table.

Defined results: a null text counts as empty; an empty document is its end mark
alone; repeated rows, also with one id, are documents each; a document of any
length is cut into as many windows as it needs; of equal costs the later place
before a cut wins; an empty table gives an empty result; other columns, whatever
their names, are not looked at. The result depends on how the rows lie in the
partitions, which reading files again does not change.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import resident, ship, text_of
from sparkloom.llm.words import WordTokenizer

CAPACITY = 4096
END = 2
SENTENCE = 16  # tokens of padding that a cut between sentences is worth
WORD = 128
STRETCH = 256
BLOCK = 1 << 20
TEXTS_AT_ONCE = 256
_SENTENCE_END = re.compile("[.!?…。！？][\"'”’)\\]»]*(</w>)?$")


class Sentences:
    """A tokenizer, and which of its ids end a sentence."""

    def __init__(self, path: str):
        self.words = WordTokenizer(path)
        vocab = self.words.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocab.items() if _SENTENCE_END.search(token)]] = True


def places(ends: np.ndarray, costs: np.ndarray, total: int, stretch: int, word: int):
    """Where the stream may be cut: positions from 0 to ``total``, and what each costs.

    ``ends`` rise and have their ``costs``; between two that are further apart than
    ``stretch`` there are others, so many tokens apart, at ``word`` tokens each.
    """
    if not len(ends) or ends[-1] != total:
        ends, costs = np.append(ends, total), np.append(costs, 0)
    ends, costs = np.concatenate([[0], ends]), np.concatenate([[0], costs])
    wide = np.nonzero(np.diff(ends) > stretch)[0]
    if len(wide):
        more = np.concatenate([np.arange(ends[i] + stretch, ends[i + 1], stretch) for i in wide])
        at = np.searchsorted(ends, more)
        ends, costs = np.insert(ends, at, more), np.insert(costs, at, word)
    return ends, costs


def best_cuts(ends: np.ndarray, costs: np.ndarray, capacity: int) -> list[int]:
    """The places of the cheapest windows over all of ``ends``, as indices, without the first.

    No two neighbours may be further apart than ``capacity``.
    """
    n = len(ends)
    # Windows whose length is a power of two: for each place, the places they start at.
    index = np.full(int(ends[-1]) + 1, -1, dtype=np.int32)
    index[ends] = np.arange(n)
    afters, befores = [], []
    length = 1
    while length <= capacity:
        later = np.searchsorted(ends, length)
        start = index[ends[later:] - length]
        hit = np.nonzero(start >= 0)[0]
        afters.append(hit + later)
        befores.append(start[hit])
        length *= 2
    after, before = np.concatenate(afters), np.concatenate(befores)
    order = np.argsort(after, kind="stable")
    before = before[order].tolist()
    bounds = np.searchsorted(after[order], np.arange(n + 1)).tolist()
    position, cost = ends.tolist(), costs.tolist()
    # value[i] is f + position; the window before i starts at came[i].
    value, came = [0] * n, [0] * n
    queue, front = [0], 0
    lower = bounds[1]
    for i in range(1, n):
        here = position[i]
        first = here - capacity
        while position[queue[front]] < first:
            front += 1
        start = queue[front]
        best = value[start] + capacity
        upper = bounds[i + 1]
        while lower < upper:
            j = before[lower]
            lower += 1
            full = value[j] + here - position[j]
            if full < best:
                best, start = full, j
        best += cost[i]
        value[i], came[i] = best, start
        while len(queue) > front and value[queue[-1]] >= best:
            queue.pop()
        queue.append(i)
    cuts, i = [], n - 1
    while i:
        cuts.append(i)
        i = came[i]
    return cuts[::-1]


class _Stream:
    """The tokens of a task that are not in a sequence yet, and the sequences made."""

    FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def __init__(self, first: int, capacity: int, sentence: int, word: int, stretch: int, last: np.ndarray):
        self.sequence, self.capacity = first, capacity
        self.sentence, self.word, self.stretch = sentence, word, stretch
        self.last = last
        # Parts of documents: id, start in the document, ids, tokens of the document, is the end.
        self.parts: list[tuple[object, int, bytes, int, bool]] = []
        self.tokens = 0

    def add(self, name: object, start: int, ids: bytes, doc_tokens: int) -> None:
        size = len(ids) // 4
        self.parts.append((name, start, ids, doc_tokens, start + size == doc_tokens))
        self.tokens += size

    def windows(self, finish: bool) -> list[int]:
        """Lengths of the next windows; unless it is the end, all but the last two."""
        ends, costs, at = [], [], 0
        for _, _, ids, _, whole in self.parts:
            values = np.frombuffer(ids, dtype="<u4")
            found = np.nonzero(self.last[np.minimum(values, len(self.last) - 1)])[0] + 1
            cost = np.full(len(found), self.sentence)
            if whole:
                # The end mark is not a sentence of its own.
                inner = found < len(values) - 1
                found, cost = np.append(found[inner], len(values)), np.append(cost[inner], 0)
            ends.append(found + at)
            costs.append(cost)
            at += len(values)
        spots, prices = places(np.concatenate(ends), np.concatenate(costs), at, self.stretch, self.word)
        cuts = spots[best_cuts(spots, prices, self.capacity)]
        lengths = np.diff(cuts, prepend=0)
        return (lengths if finish else lengths[:-2]).tolist()

    def take(self, finish: bool) -> tuple[list, dict[str, list]]:
        names: list = []
        rows: dict[str, list] = {f: [] for f in self.FIELDS}
        k, used = 0, 0  # the part at the front, and its tokens already given out
        for length in self.windows(finish):
            offset = 0
            while offset < length:
                name, start, ids, doc_tokens, _ = self.parts[k]
                size = min(length - offset, len(ids) // 4 - used)
                piece = ids[4 * used : 4 * (used + size)]
                # A document's parts that meet in a window are one piece.
                if offset and used == 0 and start and rows["sequence_id"][-1] == self.sequence:
                    rows["length"][-1] += size
                    rows["ids_crc32"][-1] = zlib.crc32(piece, rows["ids_crc32"][-1])
                else:
                    names.append(name)
                    values = (start + used, size, zlib.crc32(piece), doc_tokens, self.sequence, offset)
                    for field, value in zip(self.FIELDS, values):
                        rows[field].append(value)
                offset += size
                used += size
                if 4 * used == len(ids):
                    k, used = k + 1, 0
            self.tokens -= length
            self.sequence += 1
        self.parts = self.parts[k:]
        if used:
            name, start, ids, doc_tokens, whole = self.parts[0]
            self.parts[0] = (name, start + used, ids[4 * used :], doc_tokens, whole)
        return names, rows


def pack_windows(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end: int = END, sentence: int = SENTENCE, word: int = WORD,
    stretch: int = STRETCH, block: int = BLOCK, order: Sequence[str] = (),
) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` names the tokenizer's file. ``order`` sorts the table by columns
    first, rows with equal ones by their id and text.
    """
    ship(docs.sparkSession)
    stretch = min(stretch, capacity)
    block = max(block, 4 * capacity)
    named = docs.select(
        F.col(id_col).alias("_id"), text_of(text_col).alias("_text"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)],
    )
    if order:
        by = [*[f"_by{i}" for i in range(len(order))], "_id", F.xxhash64("_text")]
        named = named.repartitionByRange(*by).sortWithinPartitions(*by, "_text")
    named = named.select("_id", "_text")
    kind = named.schema["_id"]
    schema = T.StructType([
        T.StructField(id_col, kind.dataType, kind.nullable),
        *T.StructType.fromDDL(
            "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
            "sequence_id bigint, offset bigint"
        ),
    ])
    mark = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = resident(("sentences", path), lambda: Sentences(path))
        first = TaskContext.get().partitionId() << 33
        stream = _Stream(first, capacity, sentence, word, stretch, own.last)
        id_type = None

        def taken(finish: bool) -> pa.RecordBatch:
            names, rows = stream.take(finish)
            columns = [pa.array(names, id_type), *[pa.array(rows[f], pa.int64()) for f in stream.FIELDS]]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for whole in batches:
            id_type = whole.column("_id").type
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = own.words.texts(batch.column("_text").to_pylist())
                for name, ids in zip(batch.column("_id").to_pylist(), texts):
                    ids += mark
                    for begin in range(0, len(ids), 4 * block):
                        stream.add(name, begin // 4, ids[begin : begin + 4 * block], len(ids) // 4)
                        if stream.tokens >= block:
                            yield taken(finish=False)
        if stream.tokens:
            yield taken(finish=True)

    return named.mapInArrow(run, schema)
