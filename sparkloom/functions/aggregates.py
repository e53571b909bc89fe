"""Aggregates of one's own that SQL calls by name.

A SQL function may not hold an aggregate, and a pandas grouped aggregate loads a
whole group into one worker. Here an aggregate is a class that says how values
become a state, how states merge and what a state gives in the end, all over Arrow
columns; ``register_aggregate`` makes two table functions of it:

    SELECT * FROM my_average(
        TABLE(SELECT * FROM my_average_states(TABLE(SELECT k, x FROM t))) PARTITION BY k)

``..._states`` runs over the rows where they are and puts out one state for each
key and task, so a hot key is reduced by all tasks that hold rows of it. Only
states are shuffled, and the outer function merges those of a key. It may as well
be partitioned by anything that keeps the states of a key together, given as a last
column: with many keys by buckets of them, as each part costs a call.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

# The classes travel to the workers with the job, which need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys whose states a task holds before it puts them out.
KEYS_HELD = 100_000
# States that it lets grow before it merges those of the same keys.
MERGED_AT = 50_000


class Aggregate:
    """Value, state and result of an aggregate, and the steps between them.

    A state is a tuple, its columns written as DDL in ``state``; ``result`` is the
    type of what ``finish`` returns. The steps must not keep anything between calls.

    ``reduce_keys``, ``merge_keys`` and ``finish_keys`` do the same for all keys of a
    table at once. They need not be written: they go from key to key by the other
    four. Where there are many keys, whole columns are much faster.
    """

    state: str
    result: str

    def zero(self) -> tuple:
        """The state of no values."""
        raise NotImplementedError

    def reduce(self, values: pa.Array, state: tuple) -> tuple:
        """The state with more values, NULLs among them."""
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def finish(self, state: tuple) -> object:
        raise NotImplementedError

    def reduce_keys(self, keys: pa.Array, values: pa.Array, states: pa.Schema) -> pa.Table:
        """A state (k, state columns) for each key."""
        return _table(
            [(k, *self.reduce(values.take(pa.array(places)), self.zero())) for k, places in _by_key(keys)],
            states,
        )

    def merge_keys(self, table: pa.Table) -> pa.Table:
        """One state for each key, of a table with any number of them."""
        held: dict = {}
        for k, *state in zip(*[c.to_pylist() for c in table.columns]):
            held[k] = self.merge(held[k], tuple(state)) if k in held else tuple(state)
        return _table([(k, *state) for k, state in held.items()], table.schema)

    def finish_keys(self, table: pa.Table, results: pa.Schema) -> pa.Table:
        """The results (k, result) of a table with one state for each key."""
        rows = zip(*[c.to_pylist() for c in table.columns])
        return _table([(k, self.finish(tuple(state))) for k, *state in rows], results)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Average(Aggregate):
    """Average of whole or decimal numbers, NULLs left out; of none it is NULL.

    The sum is a decimal of 38 digits, so it is exact in any order.
    """

    state = "total decimal(38,6), n bigint"
    result = "double"

    def zero(self) -> tuple:
        return Decimal(0), 0

    def reduce(self, values: pa.Array, state: tuple) -> tuple:
        import pyarrow.compute as pc

        if not pa.types.is_decimal(values.type):
            values = values.cast(pa.decimal128(25, 6))
        total = pc.sum(values).as_py()
        return state[0] + (total or 0), state[1] + len(values) - values.null_count

    def merge(self, a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1]

    def finish(self, state: tuple) -> float | None:
        return float(state[0]) / state[1] if state[1] else None

    def reduce_keys(self, keys: pa.Array, values: pa.Array, states: pa.Schema) -> pa.Table:
        if not pa.types.is_decimal(values.type):
            values = values.cast(pa.decimal128(25, 6))
        found = pa.table({"k": keys, "v": values}).group_by("k", use_threads=False).aggregate([("v", "sum"), ("v", "count")])
        return self._states(found, "v_sum", "v_count", states)

    def merge_keys(self, table: pa.Table) -> pa.Table:
        found = table.group_by("k", use_threads=False).aggregate([("total", "sum"), ("n", "sum")])
        return self._states(found, "total_sum", "n_sum", table.schema)

    @staticmethod
    def _states(found: pa.Table, total: str, n: str, states: pa.Schema) -> pa.Table:
        import pyarrow.compute as pc

        # The sum of no values is no NULL.
        sums = pc.fill_null(found[total].cast(states.field("total").type), Decimal(0))
        return pa.Table.from_arrays([found["k"].cast(states.field("k").type), sums, found[n]], schema=states)


def _by_key(keys: pa.Array) -> Iterator[tuple[object, np.ndarray]]:
    """Each key of a column with the places of its rows; a NULL is a key."""
    coded = keys.dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
    begin = 0
    for key, end in zip(coded.dictionary.to_pylist(), ends.tolist()):
        if end > begin:
            yield key, order[begin:end]
        begin = end


def register_aggregate(
    spark: SparkSession, name: str, aggregate: Aggregate, key: str = "bigint", keys_held: int = KEYS_HELD
) -> None:
    """Make ``name`` and ``name_states`` callable from SQL, for keys of the type ``key``.

    ``name_states`` takes a table of (key, value) and gives (k, state columns);
    ``name`` takes these and gives (k, result). The aggregate's module travels
    with the job and need not be installed on the executors.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    cloudpickle.register_pickle_by_value(sys.modules[type(aggregate).__module__])
    states = to_arrow_schema(T.StructType.fromDDL(f"k {key}, {aggregate.state}"))
    results = to_arrow_schema(T.StructType.fromDDL(f"k {key}, result {aggregate.result}"))

    # Nested, so that they travel to the workers with the job.
    class Held:
        """Tables of states, merged whenever they have grown to twice the keys."""

        def __init__(self):
            self.tables: list[pa.Table] = []
            self.rows = self.keys = 0

        def add(self, table: pa.Table) -> None:
            self.tables.append(table)
            self.rows += table.num_rows
            if self.rows > max(2 * self.keys, MERGED_AT):
                self.merged()

        def merged(self) -> pa.Table | None:
            if len(self.tables) > 1:
                self.tables = [aggregate.merge_keys(pa.concat_tables(self.tables))]
            self.rows = self.keys = sum(t.num_rows for t in self.tables)
            return self.tables[0] if self.tables else None

    @arrow_udtf(returnType=f"k {key}, {aggregate.state}")
    class States:
        def __init__(self):
            self.held = Held()

        def eval(self, batch: pa.RecordBatch):
            self.held.add(aggregate.reduce_keys(batch.column(0), batch.column(1), states))
            if self.held.keys > keys_held:
                yield self.held.merged()
                self.held = Held()

        def terminate(self):
            if self.held.rows:
                yield self.held.merged()

    @arrow_udtf(returnType=f"k {key}, result {aggregate.result}")
    class Merged:
        def __init__(self):
            self.held = Held()

        def eval(self, batch: pa.RecordBatch):
            # What the states were partitioned by may follow them.
            columns = batch.columns[: len(states)]
            self.held.add(pa.Table.from_arrays(columns, schema=states))

        def terminate(self):
            if self.held.rows:
                yield aggregate.finish_keys(aggregate.merge_keys(self.held.merged()), results)

    spark.udtf.register(f"{name}_states", States)
    spark.udtf.register(name, Merged)
