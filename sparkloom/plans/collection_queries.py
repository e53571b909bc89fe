"""Array and map functions, over the embeddings and over row-wise collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import collections as c
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table

# The embedding as whole thousandths, so that both engines sum the same numbers.
INTEGERS_SQL = """
    ints AS (SELECT vec_id, list_transform(embedding, lambda x:
                 cast(floor(cast(x AS double) * 1000) AS bigint)) AS a
             FROM embeddings)
"""


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = read_table(spark, folder, "embeddings")
    return embeddings.select("vec_id", c.thousandths(F.col("embedding")).alias("a"))


def _joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


@query(f"""
    WITH {INTEGERS_SQL}
    SELECT vec_id, array_to_string(list_transform(a, lambda x: x + 1), ',') AS plus_one FROM ints
""")
def array_increment(spark: SparkSession, folder: str) -> DataFrame:
    plus_one = c.add_to_each(F.col("a"))
    return _vectors(spark, folder).select("vec_id", _joined(plus_one).alias("plus_one"))


@query(f"WITH {INTEGERS_SQL} SELECT vec_id, cast(list_sum(a) AS bigint) AS total FROM ints")
def array_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("vec_id", c.total(F.col("a")).alias("total"))


@query(f"""
    WITH {INTEGERS_SQL}
    SELECT vec_id, array_to_string(list_filter(a, lambda x: x % 2 <> 0), ',') AS odd FROM ints
""")
def array_filter_odd(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("vec_id", _joined(c.odd_only(F.col("a"))).alias("odd"))


@query(f"""
    WITH {INTEGERS_SQL}
    SELECT vec_id, cast(len(a) AS int) AS length, a[1] AS head, a[3] AS third, a[-1] AS last
    FROM ints
""")
def array_access(spark: SparkSession, folder: str) -> DataFrame:
    a = F.col("a")
    return _vectors(spark, folder).select(
        "vec_id",
        F.size(a).alias("length"),
        c.first_of(a).alias("head"),
        F.get(a, F.lit(2)).alias("third"),
        c.last_of(a).alias("last"),
    )


@query(f"""
    WITH {INTEGERS_SQL}
    SELECT vec_id, array_to_string(list_concat(a, [5, 6]), ',') AS longer FROM ints
""")
def array_concat(spark: SparkSession, folder: str) -> DataFrame:
    more = F.array(F.lit(5).cast("bigint"), F.lit(6).cast("bigint"))
    longer = F.concat("a", more)
    return _vectors(spark, folder).select("vec_id", _joined(longer).alias("longer"))


@query(f"""
    WITH {INTEGERS_SQL}
    SELECT vec_id, array_to_string(list_transform(a, lambda x: abs(x) + 1), ',') AS firsts
    FROM ints
""")
def array_struct_project(spark: SparkSession, folder: str) -> DataFrame:
    pairs = F.transform(
        "a",
        lambda x: F.struct(
            F.abs(x).alias("size"), F.when(x < 0, "minus").otherwise("plus").alias("sign")
        ),
    )
    return _vectors(spark, folder).select(
        "vec_id", _joined(c.add_to_firsts(pairs, "size")).alias("firsts")
    )


@query("""
    SELECT p_partkey, p_type AS two, cast(p_size AS varchar) AS three, cast(NULL AS varchar) AS four
    FROM part
""")
def map_lookup_update(spark: SparkSession, folder: str) -> DataFrame:
    one, two, three, four = (F.lit(n) for n in (1, 2, 3, 4))
    entries = F.create_map(
        one, F.col("p_brand"), three, F.col("p_name"), two, F.col("p_type")
    )
    updated = c.map_put(entries, three, F.col("p_size").cast("string"))
    return read_table(spark, folder, "part").select(
        "p_partkey",
        c.map_get(updated, two).alias("two"),
        c.map_get(updated, three).alias("three"),
        c.map_get(updated, four).alias("four"),
    )


@query(f"WITH {INTEGERS_SQL} SELECT vec_id, unnest(a) AS element FROM ints")
def explode_array(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("vec_id", F.explode("a").alias("element"))
