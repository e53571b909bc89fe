"""Row placement and join directives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import buckets, placement
from sparkloom.operators.keyed import average_state, finish_average, merge_average_state
from sparkloom.operators.sizes import broadcast_if_small
from sparkloom.operators.persisted import Checkpointed, Persisted
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table


# What ``persisted_two_aggs`` holds in the executors; ``KEPT.release()`` lets go of it.
KEPT = Persisted()
# What ``checkpointed_two_aggs`` holds on storage.
SAVED = Checkpointed()


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("""
    SELECT o_orderkey, o_custkey, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    UNION ALL
    SELECT o_orderkey, -1, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey % 3 = 0
""")
def copartitioned_join(spark: SparkSession, folder: str) -> DataFrame:
    # Keys repeat on both sides: some orders stand twice.
    n = _partitions(spark)
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    again = orders.filter("o_custkey % 3 = 0").select(
        "o_orderkey", F.lit(-1).cast("bigint").alias("o_custkey")
    )
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"
    )
    return placement.place_by_key(orders.unionByName(again), n, "o_orderkey").join(
        placement.place_by_key(lines, n, "o_orderkey"), "o_orderkey"
    )


@query("""
    SELECT c_custkey, c_nationkey, o_orderkey, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def spread_copartitioned_join(spark: SparkSession, folder: str) -> DataFrame:
    # A customer may hold a large share of the orders: those are in four places.
    orders = read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    many, few = placement.place_for_join(
        orders, customers, _partitions(spark), ["c_custkey"], pieces=4, spread_by=["o_orderkey"]
    )
    return many.join(few.hint("merge"), ["c_custkey", "_piece"]).select(
        "c_custkey", "c_nationkey", "o_orderkey", "o_totalprice"
    )


@query("""
    SELECT user_id, cast(1 AS bigint) AS partitions, count(*) AS events
    FROM events GROUP BY user_id
""")
def keys_per_partition(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("user_id")
    return _partitions_of_keys(placement.place_by_key(events, _partitions(spark), "user_id"), "user_id")


def _partitions_of_keys(placed: DataFrame, key: str) -> DataFrame:
    """In how many partitions the rows of each key are, and how many they are."""
    return (
        placement.rows_by_partition(placed, key)
        .groupBy(key)
        .agg(F.count("*").alias("partitions"), F.sum("rows").alias("events"))
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def distribute_by(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # Each customer's orders in four places, told apart by their key.
    return placement.distribute_by(orders, ["o_custkey"], pieces=4, spread_by=["o_orderkey"])


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def cluster_by(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # A customer with many orders is four tasks and four sorts, not one.
    return placement.cluster_by(orders, ["o_custkey"], pieces=4, spread_by=["o_orderkey"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_type
    FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def broadcast_join(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    part = read_table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    return lineitem.join(
        broadcast_if_small(part), lineitem["l_partkey"] == part["p_partkey"]
    ).drop("p_partkey")


@query("""
    SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
""")
def merge_join(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    supplier = read_table(spark, folder, "supplier")
    return lineitem.join(
        supplier.hint("merge"), lineitem["l_suppkey"] == supplier["s_suppkey"]
    ).select("l_orderkey", "l_linenumber", "s_name")


@query("""
    WITH lines AS (
        SELECT CASE WHEN l_suppkey < 0.8 * (SELECT max(s_suppkey) FROM supplier) THEN 0
                    ELSE l_suppkey END AS hot_key, l_extendedprice
        FROM lineitem)
    SELECT s_nationkey,
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) / count(*) AS average_price
    FROM lines JOIN supplier ON hot_key = s_suppkey
    WHERE l_extendedprice > 5 * s_acctbal GROUP BY s_nationkey
""")
def skew_join_avg(spark: SparkSession, folder: str) -> DataFrame:
    # The condition on both sides keeps the lines from being summed before the
    # join; the key that holds most of them is split by AQE as it is read.
    supplier = read_table(spark, folder, "supplier")
    last = supplier.agg(F.max("s_suppkey").alias("last")).scalar()
    lines = read_table(spark, folder, "lineitem").select(
        F.when(F.col("l_suppkey") < F.lit(0.8) * last, F.lit(0).cast("bigint"))
        .otherwise(F.col("l_suppkey"))
        .alias("s_suppkey"),
        "l_extendedprice",
    )
    matched = lines.join(supplier, "s_suppkey").filter("l_extendedprice > 5 * s_acctbal")
    state = average_state(matched, "s_nationkey", "l_extendedprice", scale=2)
    return state.select("s_nationkey", finish_average().alias("average_price"))


@query("""
    SELECT l_suppkey, sum(l_quantity) AS quantity, avg(l_quantity) AS average
    FROM lineitem GROUP BY l_suppkey
""")
def persisted_two_aggs(spark: SparkSession, folder: str) -> DataFrame:
    # What is kept is the sums by supplier and line number, not the lines; the
    # entry of the last call is released before there is another.
    KEPT.release()
    state = average_state(
        read_table(spark, folder, "lineitem"), ["l_suppkey", "l_linenumber"], "l_quantity"
    )
    KEPT.keep(state)
    sums = state.groupBy("l_suppkey").agg(F.sum("total").alias("quantity"))
    averages = merge_average_state(state, "l_suppkey").select(
        "l_suppkey", finish_average().alias("average")
    )
    return sums.join(averages, "l_suppkey")


@query("""
    SELECT o_orderkey, o_custkey, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    # Both tables are written by bucket; what is returned joins them from there,
    # and so would any later query.
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"
    )
    n = max(buckets.BUCKETS, _partitions(spark))
    names = [
        buckets.write_bucketed(table, label, ["o_orderkey"], n, folder)
        for label, table in (("orders", orders), ("lines", lines))
    ]
    left, right = (spark.table(name) for name in names)
    # A merge join reads both as they lie; a broadcast would not use the buckets.
    return left.join(right.hint("merge"), "o_orderkey")


@query("""
    SELECT l_suppkey, sum(l_quantity) AS quantity, avg(l_quantity) AS average
    FROM lineitem GROUP BY l_suppkey
""")
def checkpointed_two_aggs(spark: SparkSession, folder: str) -> DataFrame:
    # As persisted_two_aggs, with the shared frame on storage instead of in the
    # executors; the files of the last call go before there are others.
    SAVED.release()
    state = SAVED.keep(
        average_state(
            read_table(spark, folder, "lineitem"), ["l_suppkey", "l_linenumber"], "l_quantity"
        )
    )
    sums = state.groupBy("l_suppkey").agg(F.sum("total").alias("quantity"))
    averages = merge_average_state(state, "l_suppkey").select(
        "l_suppkey", finish_average().alias("average")
    )
    return sums.join(averages, "l_suppkey")
