"""Aggregation by key, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import keyed
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table


def _written(values: str) -> Column:
    """A value list as text: each value with its copies."""
    entry = F.transform(values, lambda e: F.concat_ws("x", e["value"], e["copies"]))
    return F.array_join(entry, ",")


@query("""
    WITH counted AS (
        SELECT l_suppkey, l_partkey // 1000 AS slice, l_partkey, count(*) AS copies
        FROM lineitem GROUP BY l_suppkey, l_partkey)
    SELECT l_suppkey, cast(slice AS bigint) AS slice,
           string_agg(l_partkey || 'x' || copies, ',' ORDER BY l_partkey) AS parts
    FROM counted GROUP BY l_suppkey, slice
""")
def group_values(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    groups = keyed.group_values(lineitem, "l_suppkey", "l_partkey", F.expr("l_partkey div 1000"))
    return groups.select("l_suppkey", "slice", _written("values").alias("parts"))


@query("SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey")
def sum_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    return keyed.sum_by_key(lineitem, "l_suppkey", "l_quantity", "quantity")


AVERAGE_SQL = "SELECT l_suppkey, avg(l_quantity) AS average FROM lineitem GROUP BY l_suppkey"


@query(AVERAGE_SQL)
def avg_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    return lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("average"))


@query(AVERAGE_SQL)
def avg_by_key_combine(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    state = keyed.average_state(lineitem, "l_suppkey", "l_quantity")
    return state.select("l_suppkey", keyed.finish_average().alias("average"))


@query("SELECT p_brand, p_type, count(*) AS parts FROM part GROUP BY p_brand, p_type")
def count_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").groupBy("p_brand", "p_type").agg(
        F.count("*").alias("parts")
    )


@query("""
    WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
    words AS (
        SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                      ELSE string_split(rtrim(line, ' '), ' ') END) AS word
        FROM lines)
    SELECT word, count(*) AS occurrences FROM words GROUP BY word
""")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line"))
    return keyed.word_count(lines, "line")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("""
    WITH c AS (SELECT nullif(c_nationkey, 0) AS nation, c_custkey // 500 AS slice,
                      string_agg(c_custkey || 'x1', ',' ORDER BY c_custkey) AS customers
               FROM customer GROUP BY ALL),
    s AS (SELECT nullif(s_nationkey, 0) AS nation, s_suppkey // 500 AS slice,
                 string_agg(s_suppkey || 'x1', ',' ORDER BY s_suppkey) AS suppliers
          FROM supplier GROUP BY ALL)
    SELECT coalesce(c.nation, s.nation) AS nation,
           cast(coalesce(c.slice, s.slice) AS bigint) AS slice,
           coalesce(customers, '') AS customers, coalesce(suppliers, '') AS suppliers
    FROM c FULL JOIN s ON c.nation IS NOT DISTINCT FROM s.nation AND c.slice = s.slice
""")
def cogroup_lists(spark: SparkSession, folder: str) -> DataFrame:
    # One nation is made NULL, which is a key like others.
    def nation(column: str) -> Column:
        return F.nullif(F.col(column), F.lit(0))

    customer = read_table(spark, folder, "customer").withColumn("nation", nation("c_nationkey"))
    supplier = read_table(spark, folder, "supplier").withColumn("nation", nation("s_nationkey"))
    groups = keyed.cogroup_values(
        customer,
        supplier,
        "nation",
        "c_custkey",
        "s_suppkey",
        F.expr("c_custkey div 500"),
        F.expr("s_suppkey div 500"),
    )
    return groups.select(
        "nation",
        "slice",
        _written("left_values").alias("customers"),
        _written("right_values").alias("suppliers"),
    )


@query("""
    SELECT p_brand, p_type, count(*) AS parts FROM part
    GROUP BY p_brand, p_type ORDER BY parts DESC, p_brand, p_type
""")
def sort_groups(spark: SparkSession, folder: str) -> DataFrame:
    return count_by_group(spark, folder).orderBy(F.desc("parts"), "p_brand", "p_type")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey")
def sort_rows(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey")


@query("""
    SELECT l_suppkey, count(*) AS lines FROM lineitem
    GROUP BY l_suppkey ORDER BY lines DESC, l_suppkey LIMIT 10
""")
def top_k_groups(spark: SparkSession, folder: str) -> DataFrame:
    counts = read_table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("lines")
    )
    return counts.orderBy(F.desc("lines"), "l_suppkey").limit(10)
