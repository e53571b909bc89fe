"""Projections, filters and row-wise expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.text import describe_age, parse_fields, tokens
from sparkloom.plans.registry import query
from sparkloom.sources.files import delimited, read_table


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 18")
def filter_numeric(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customer.filter(F.col("c_acctbal") > 18)


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_string_eq(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "customer")
        .where("c_mktsegment == 'MACHINERY'")
        .select("c_custkey", "c_name")
    )


@query("""
    SELECT event_id, event_type, value FROM events
    WHERE contains(event_type, 'error') ORDER BY event_id LIMIT 20
""")
def log_error_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "event_type", "value")
    return events.filter(F.col("event_type").contains("error")).orderBy("event_id").limit(20)


@query("SELECT o_orderkey AS key, o_totalprice AS price FROM orders")
def parse_delimited(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    lines = orders.select(delimited("o_orderkey", "o_totalprice").alias("line"))
    return parse_fields(lines, "line", {"key": "bigint", "price": "double"})


@query("""
    WITH lines AS (
        SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
               unnest(string_split(text, chr(10))) AS line
        FROM documents)
    SELECT doc_id, cast(line_no AS int) AS line_no,
           cast(CASE WHEN line = '' THEN 1 WHEN rtrim(line, ' ') = '' THEN 0
                ELSE len(string_split(rtrim(line, ' '), ' ')) END AS int) AS tokens
    FROM lines
""")
def line_tokens(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select("doc_id", "line_no", F.size(tokens(F.col("line"))).alias("tokens"))


@query("""
    SELECT p_partkey,
           CASE WHEN nullif(p_size, 50) IS NULL THEN 'None'
                WHEN p_size < 18 THEN p_name || ' is a minor.'
                WHEN p_size < 40 THEN p_name || ' is an adult.'
                ELSE p_name || ' is a senior citizen.' END AS description
    FROM part
""")
def classify_guarded(spark: SparkSession, folder: str) -> DataFrame:
    age = F.nullif(F.col("p_size"), F.lit(50))
    return read_table(spark, folder, "part").select(
        "p_partkey",
        describe_age(F.col("p_name"), age, adult_from=18, senior_from=40).alias("description"),
    )


@query("""
    SELECT o_orderkey,
           cast(cast(o_totalprice AS decimal(18,2)) * (SELECT max(p_size) FROM part) AS double)
               AS scaled
    FROM orders
""")
def scale_by_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    factor = read_table(spark, folder, "part").agg(F.max("p_size").alias("factor")).scalar()
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return read_table(spark, folder, "orders").select(
        "o_orderkey", (price * factor).cast("double").alias("scaled")
    )


@query("SELECT o_orderkey, o_totalprice AS price FROM orders")
def nested_field(spark: SparkSession, folder: str) -> DataFrame:
    nested = read_table(spark, folder, "orders").select(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.col("o_orderstatus").alias("status"),
            F.struct(
                F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer")
            ).alias("sale"),
        ).alias("order")
    )
    return nested.select(
        F.col("order.key").alias("o_orderkey"), F.col("order.sale.price").alias("price")
    )


@query("""
    SELECT cast(sum(cast(l_orderkey AS decimal(38,0))) AS decimal(38,0)) AS total
    FROM lineitem WHERE l_orderkey > 100
""")
def range_filter_sum(spark: SparkSession, folder: str) -> DataFrame:
    # A sum of keys passes a bigint at a few billion rows.
    return (
        read_table(spark, folder, "lineitem")
        .filter("l_orderkey > 100")
        .selectExpr("cast(sum(cast(l_orderkey as decimal(28,0))) as decimal(38,0)) AS total")
    )
