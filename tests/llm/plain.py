"""Plain versions and fixtures for the tests of this folder."""

import itertools

from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, extra=()):
    """Documents from (doc_id, text, lang); more columns hold nulls and clashing names."""
    schema = T.StructType.fromDDL(DOCS)
    for name in extra:
        schema = schema.add(name, T.StringType())
    full = [
        (i, text, lang, None, None if text is None else len(text), *[None] * len(extra))
        for i, text, lang in rows
    ]
    return spark.createDataFrame(full, schema)


def union_find(nodes, pairs):
    """For each node the smallest one that can be reached."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def pairs(items):
    return itertools.combinations(items, 2)
