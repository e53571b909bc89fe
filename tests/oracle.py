"""Runs a query in Spark and its SQL in DuckDB and compares the results."""

import glob
import math
import os

import duckdb
import pyarrow as pa


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(table):
    names = sorted(table.column_names)
    columns = [[_normal(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns), key=repr)


def _type_names(table):
    return {
        f.name: str(pa.string() if pa.types.is_large_string(f.type) else f.type)
        for f in table.schema
    }


def compare(connection, frame, sql):
    """A list of differences, empty when both agree to the last bit."""
    ours = frame.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    if _type_names(ours) != _type_names(theirs):
        return [f"types: {_type_names(ours)} against {_type_names(theirs)}"]
    ours, theirs = _sorted_rows(ours), _sorted_rows(theirs)
    if len(ours) != len(theirs):
        return [f"rows: {len(ours)} against {len(theirs)}"]
    return [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b][:5]
