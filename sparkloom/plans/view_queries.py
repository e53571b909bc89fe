"""Views and user-defined functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import user_defined as u
from sparkloom.functions.aggregates import Average, register_aggregate
from sparkloom.operators.views import as_global_view, query_frames
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 18")
def temp_view_sql(spark: SparkSession, folder: str) -> DataFrame:
    return query_frames(
        spark,
        "SELECT c_custkey, c_name FROM {people} WHERE c_acctbal > 18",
        people=read_table(spark, folder, "customer"),
    )


@query("SELECT c_custkey, c_name FROM customer")
def global_view_other_session(spark: SparkSession, folder: str) -> DataFrame:
    view = as_global_view(read_table(spark, folder, "customer"), "sparkloom_customers")
    return spark.newSession().sql(f"SELECT c_custkey, c_name FROM {view}")


@query("SELECT o_orderkey, true AS in_range FROM orders")
def random_column(spark: SparkSession, folder: str) -> DataFrame:
    drawn = read_table(spark, folder, "orders").select(
        "o_orderkey", u.random_value(seed=42).alias("r")
    )
    return drawn.select("o_orderkey", ((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_range"))


@query("SELECT p_partkey, p_size + 1 AS next_size FROM part")
def udf_plus_one(spark: SparkSession, folder: str) -> DataFrame:
    u.register_functions(spark)
    return query_frames(
        spark,
        "SELECT p_partkey, plus_one(p_size) AS next_size FROM {part}",
        part=read_table(spark, folder, "part"),
    )


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 5")
def udf_filter(spark: SparkSession, folder: str) -> DataFrame:
    u.register_functions(spark)
    return query_frames(
        spark,
        "SELECT p_partkey, p_size FROM {part} WHERE one_arg_filter(p_size)",
        part=read_table(spark, folder, "part"),
    )


@query("""
    SELECT cast(sum(l_linenumber) AS double) / count(l_linenumber) AS average FROM lineitem
""")
def udaf_my_average(spark: SparkSession, folder: str) -> DataFrame:
    return query_frames(
        spark,
        f"SELECT {u.my_average_sql('l_linenumber')} AS average FROM {{lineitem}}",
        lineitem=read_table(spark, folder, "lineitem"),
    )


@query("""
    SELECT l_suppkey, cast(sum(l_linenumber) AS double) / count(l_linenumber) AS average
    FROM lineitem GROUP BY l_suppkey
""")
def udaf_my_average_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        u.my_average(F.col("l_linenumber")).alias("average")
    )


@query("""
    SELECT l_suppkey, cast(sum(l_linenumber) AS double) / count(l_linenumber) AS average
    FROM lineitem GROUP BY l_suppkey
""")
def udaf_called_from_sql(spark: SparkSession, folder: str) -> DataFrame:
    register_aggregate(spark, "exact_average", Average())
    # By buckets of keys: each part costs a call, whatever it holds.
    return query_frames(
        spark,
        """
        SELECT k AS l_suppkey, result AS average FROM exact_average(
            TABLE(SELECT *, pmod(xxhash64(k), 1024) AS bucket FROM exact_average_states(
                TABLE(SELECT l_suppkey, l_linenumber FROM {lineitem})))
            PARTITION BY bucket)
        """,
        lineitem=read_table(spark, folder, "lineitem"),
    )
