"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.joins import band_average, pair_counts
from sparkloom.operators.keyed import average_state
from sparkloom.operators.views import query_frames
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table


@query("""
    SELECT o_orderkey AS k, o_custkey AS v, l_linenumber AS w
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def inner_join_multiplicity(spark: SparkSession, folder: str) -> DataFrame:
    x = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")
    )
    y = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("w")
    )
    return x.join(y, "k")


@query("""
    SELECT s_name || ' ' || n_name AS names FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def emp_dept_names(spark: SparkSession, folder: str) -> DataFrame:
    employees = read_table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "dno")
    departments = read_table(spark, folder, "nation").withColumnRenamed("n_nationkey", "dno")
    return employees.join(departments, "dno").select(
        F.concat("s_name", F.lit(" "), "n_name").alias("names")
    )


@query("""
    SELECT o_orderkey, o_custkey, c_custkey, c_name
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def inner_join_expr(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        "o_orderkey", "o_custkey", "c_custkey", "c_name"
    )


@query("""
    SELECT o_orderkey, count(l_orderkey) AS lines
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def left_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    # Counting before the join leaves one row per key on the side that may be
    # skewed; AQE cannot split that side of an outer join.
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    lines = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines")
    )
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_outer")
    return joined.select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("""
    SELECT o_orderkey, o_custkey, c_name
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
""")
def left_outer_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    in_credit = read_table(spark, folder, "customer").filter("c_acctbal > 0")
    return orders.join(
        in_credit, orders["o_custkey"] == in_credit["c_custkey"], "left_outer"
    ).select("o_orderkey", "o_custkey", "c_name")


@query("""
    SELECT c_custkey, count(o_orderkey) AS urgent
    FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT')
    RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey
""")
def right_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    urgent = (
        read_table(spark, folder, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("urgent"))
    )
    customer = read_table(spark, folder, "customer").select("c_custkey")
    joined = urgent.join(customer, urgent["o_custkey"] == customer["c_custkey"], "right_outer")
    return joined.select("c_custkey", F.coalesce("urgent", F.lit(0)).alias("urgent"))


@query("""
    SELECT c_name, o_orderkey, o_custkey
    FROM (SELECT * FROM customer WHERE c_acctbal > 0) RIGHT JOIN orders ON c_custkey = o_custkey
""")
def right_outer_rows(spark: SparkSession, folder: str) -> DataFrame:
    in_credit = read_table(spark, folder, "customer").filter("c_acctbal > 0")
    orders = read_table(spark, folder, "orders")
    return in_credit.join(
        orders, in_credit["c_custkey"] == orders["o_custkey"], "right_outer"
    ).select("c_name", "o_orderkey", "o_custkey")


@query("""
    SELECT c_custkey, c_name, c_nationkey AS nationkey, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey ORDER BY c_custkey LIMIT 4
""")
def using_join_limit(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").withColumnRenamed("c_nationkey", "nationkey")
    nation = read_table(spark, folder, "nation").withColumnRenamed("n_nationkey", "nationkey")
    return (
        customer.join(nation, "nationkey")
        .select("c_custkey", "c_name", "nationkey", "n_name")
        .orderBy("c_custkey")
        .limit(4)
    )


KEY_FILTER_SQL = """
    SELECT c.c_name, n.n_nationkey
    FROM customer c INNER JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE c.c_nationkey = 7
"""


@query(KEY_FILTER_SQL)
def join_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    return query_frames(
        spark,
        KEY_FILTER_SQL.replace("FROM customer", "FROM {customer}").replace("JOIN nation", "JOIN {nation}"),
        customer=read_table(spark, folder, "customer"),
        nation=read_table(spark, folder, "nation"),
    )


@query("""
    SELECT p_partkey AS registration,
           cast(sum(cast(l_extendedprice AS decimal(28,6))) AS double) / count(l_extendedprice)
               AS average_price
    FROM part t1
    JOIN (SELECT p_brand AS make, p_type AS model, p_retailprice AS engine_size, l_extendedprice
          FROM part JOIN lineitem ON p_partkey = l_partkey) t2
      ON t1.p_brand = t2.make AND t1.p_type = t2.model
     AND abs(cast(t1.p_retailprice AS decimal(24,8)) - cast(t2.engine_size AS decimal(24,8))) <= 0.1
    GROUP BY p_partkey
""")
def comparable_price_avg(spark: SparkSession, folder: str) -> DataFrame:
    # The sales of each part are summed before they meet the part, which then is
    # read and joined once. Decimals with room for six places add up exactly.
    sales = average_state(
        read_table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "registration"),
        "registration",
        "l_extendedprice",
        scale=6,
    )
    cars = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("registration"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
        F.col("p_retailprice").cast("decimal(24,8)").alias("engine_size"),
    )
    return band_average(
        cars.join(sales, "registration", "left"),
        keys=["make", "model"],
        band="engine_size",
        tolerance="0.1",
        group="registration",
        alias="average_price",
        unique_groups=True,
    )


@query("""
    SELECT o_orderpriority AS category, l_returnflag AS district,
           cast(count(*) AS decimal(38,0)) AS pairs
    FROM orders JOIN lineitem ON strftime(o_orderdate, '%m-%d') = strftime(l_shipdate, '%m-%d')
    GROUP BY o_orderpriority, l_returnflag
""")
def many_to_many_join(spark: SparkSession, folder: str) -> DataFrame:
    incidents = read_table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "MM-dd").alias("day"),
        F.col("o_orderpriority").alias("category"),
    )
    others = read_table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "MM-dd").alias("day"),
        F.col("l_returnflag").alias("district"),
    )
    return pair_counts(incidents, others, "day", "category", "district")


@query("""
    SELECT l_suppkey, cast(sum(near) AS double) / cast(sum(lines) AS double) AS average_quantity
    FROM (SELECT l_suppkey, sum(cast(l_quantity AS decimal(18,2))) OVER around AS near,
                 count(*) OVER around AS lines
          FROM lineitem
          WINDOW around AS (PARTITION BY l_returnflag
                            ORDER BY cast(l_extendedprice AS decimal(15,2))
                            RANGE BETWEEN 20000 PRECEDING AND 20000 FOLLOWING))
    GROUP BY l_suppkey
""")
def wide_band_average(spark: SparkSession, folder: str) -> DataFrame:
    # Three keys and a tolerance of a fifth of the prices: a key's axis is cut by
    # the scan, as slices of the tolerance would be a handful of tasks.
    lines = read_table(spark, folder, "lineitem").select(
        "l_returnflag",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("total"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return band_average(
        lines,
        keys=["l_returnflag"],
        band="price",
        tolerance="20000",
        group="l_suppkey",
        alias="average_quantity",
        long_axis=True,
    )
