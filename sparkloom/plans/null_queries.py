"""Null handling, over orders with nulls put in by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table

NULLS_SQL = """
    gaps AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
                    CASE WHEN o_totalprice <= 250000 THEN o_custkey END AS custkey
             FROM orders)
"""


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") <= 250000, F.col("o_custkey")).alias("custkey"),
    )


@query(f"WITH {NULLS_SQL} SELECT * FROM gaps WHERE status IS NOT NULL AND custkey IS NOT NULL")
def na_drop_any(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).dropna()


@query(f"""
    WITH {NULLS_SQL}
    SELECT status, custkey FROM gaps WHERE status IS NOT NULL OR custkey IS NOT NULL
""")
def na_drop_all(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).select("status", "custkey").dropna("all")


@query(f"WITH {NULLS_SQL} SELECT * FROM gaps WHERE custkey IS NOT NULL")
def na_drop_subset(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).dropna(subset=["custkey"])


@query(f"""
    WITH {NULLS_SQL} SELECT o_orderkey, status, coalesce(custkey, 0) AS custkey FROM gaps
""")
def na_fill_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).fillna(0)


@query(f"""
    WITH {NULLS_SQL}
    SELECT o_orderkey, coalesce(status, 'Unknown') AS status, coalesce(custkey, 0) AS custkey
    FROM gaps
""")
def na_fill_map(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).fillna({"custkey": 0, "status": "Unknown"})


@query(f"""
    WITH {NULLS_SQL}
    SELECT o_orderkey, CASE WHEN status = 'O' THEN 'Open' ELSE status END AS status, custkey
    FROM gaps
""")
def na_replace(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps(spark, folder).replace({"O": "Open"}, subset=["status"])
