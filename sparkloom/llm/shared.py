"""What several operators of this package need."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import sparkloom
from sparkloom.session import shared_root

# A key that holds one row in this many is hot, so there are fewer hot keys
# than this, whatever the size of the table: they may be broadcast.
HOT_ONE_IN = 1000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this library, once for each application.

    Its sources go as an archive to the shared folder and from there to every
    worker, so executors need no copy of the repository. Operators that run
    Python call this first.
    """
    context = spark.sparkContext
    root = Path(sparkloom.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for path in sorted(root.rglob("*.py")):
            target.write(path, str(path.relative_to(root.parent)))
    name = f"{shared_root(spark)}-sources/sparkloom_sources.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(archive.getvalue()))
    out.close()
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def text_of(column: str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def boxed(docs: DataFrame, **named: str) -> DataFrame:
    """Each row as the struct ``_doc``, with some of its columns under given names.

    A step that adds columns of its own to such a frame cannot meet a column of
    the input; ``select("_doc.*")`` gives the rows back.
    """
    return docs.select(
        F.expr("struct(*)").alias("_doc"), *[F.col(c).alias(name) for name, c in named.items()]
    )


def crc_mod(column: str, modulus: int) -> Column:
    """CRC-32 of the value written as text, modulo ``modulus``; a null counts as empty."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def keep(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    What is built on the result does not run the steps before it again, also
    after a loss of executors, and the reader can prune columns. Each call has
    a folder of its own; ``sparkloom.session.release_scratch`` deletes them.
    """
    path = f"{shared_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """The rows dealt evenly over the session's number of shuffle partitions.

    For small tables whose rows take long: read back from a file they would
    come in one task. The deal follows a hash of the columns, so a task that
    runs again puts each row where it was.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Inner join of rows to one row for each group, safe against hot groups.

    ``size`` is the column of ``groups`` with the rows of the group, out of
    ``total``. Groups above one row in ``HOT_ONE_IN`` are fewer than that many
    and meet their rows by broadcast; the rest joins as usual.
    """
    hot = groups.filter(F.col(size) * HOT_ONE_IN > total)
    cold = groups.filter(F.col(size) * HOT_ONE_IN <= total)
    few = F.broadcast(hot)
    return rows.join(few, on).unionByName(
        rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    )


_resident: dict[object, object] = {}


def resident(key: object, make: Callable[[], object] | None = None) -> object:
    """What ``make`` builds, kept in this Python worker until another key is asked for.

    Workers serve one job after the other. Each operator that runs Python names
    what it needs here, so a worker never holds the tables of two operators.
    """
    if key not in _resident:
        _resident.clear()
        pa.default_memory_pool().release_unused()
        _resident[key] = make() if make else None
    return _resident[key]


# Texts that are taken out of an Arrow batch at a time.
TEXTS_AT_ONCE = 1024


def map_texts(df: DataFrame, work: Callable, fields: str) -> DataFrame:
    """The other columns of ``df`` and what ``work`` makes of its column ``_text``.

    ``work`` gets the texts of a batch as a list and returns, for each output
    row, the number of its text (None: one row for each text) and a dictionary
    of columns of ``fields``, written as DDL. The other columns pass as Arrow
    arrays, so nulls and large numbers stay what they are.
    """
    ship(df.sparkSession)
    others = [c for c in df.columns if c != "_text"]
    schema = T.StructType([df.schema[c] for c in others])
    added = T.StructType.fromDDL(fields)
    types = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                rows, columns = work(batch.column("_text").to_pylist())
                kept = [batch.column(c) for c in others]
                if rows is not None:
                    kept = [c.take(pa.array(rows, pa.int64())) for c in kept]
                made = [
                    made if isinstance(made := columns[f.name], pa.Array) else pa.array(made, f.type)
                    for f in types
                ]
                yield pa.RecordBatch.from_arrays([*kept, *made], [*others, *added.names])

    return df.select(*others, "_text").mapInArrow(run, T.StructType([*schema.fields, *added.fields]))


def runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 18
) -> Iterator[pa.Table]:
    """Rows sorted by integer ``keys``, in pieces that never part the rows of a key.

    A piece has about ``rows`` rows, or those of one key where these are more.
    """
    import numpy as np

    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        table = pa.Table.from_batches(waiting)
        last = np.ones(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            last &= column == column[-1]
        cut = int(np.argmax(last))
        if cut:
            yield table.slice(0, cut)
        waiting = table.slice(cut).to_batches()
        held = table.num_rows - cut
        # The rest is one key: let it double before it is looked at again.
        rows = max(rows, 2 * held)
    if waiting:
        yield pa.Table.from_batches(waiting)
