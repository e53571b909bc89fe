"""Matrix products and least squares."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.collections import thousandths
from sparkloom.operators import matrix, regression
from sparkloom.plans.registry import query
from sparkloom.sources.files import read_table

DENSE_SQL = """
    dense AS (SELECT vec_id AS i, cast(unnest(range(len(embedding))) AS bigint) AS j,
                     unnest(list_transform(embedding, lambda x:
                         cast(floor(cast(x AS double) * 1000) AS bigint))) AS v
              FROM embeddings)
"""

# Part by supplier, and supplier by line number: quantities sold. The first
# grows in both directions with the data and stays sparse.
SPARSE_SQL = """
    m AS (SELECT l_partkey AS i, l_suppkey AS j, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
    n AS (SELECT l_suppkey AS i, cast(l_linenumber AS bigint) AS j, sum(l_quantity) AS v
          FROM lineitem GROUP BY ALL)
"""

PRODUCT_SQL = f"""
    WITH {SPARSE_SQL}
    SELECT m.i, n.j, sum(m.v * n.v) AS v FROM m JOIN n ON m.j = n.i GROUP BY m.i, n.j
"""


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = read_table(spark, folder, "embeddings")
    return matrix.dense_to_coo(
        embeddings.select("vec_id", thousandths(F.col("embedding")).alias("a")), "vec_id", "a"
    )


def _quantities(spark: SparkSession, folder: str, row: str, col: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    return lineitem.groupBy(
        F.col(row).cast("bigint").alias("i"), F.col(col).cast("bigint").alias("j")
    ).agg(F.sum("l_quantity").alias("v"))


def _part_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    return _quantities(spark, folder, "l_partkey", "l_suppkey")


def _supplier_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return _quantities(spark, folder, "l_suppkey", "l_linenumber")


@query(f"WITH {DENSE_SQL} SELECT i, j, v FROM dense")
def dense_to_coo(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder)


@query(f"WITH {DENSE_SQL} SELECT j AS i, i AS j, v FROM dense")
def coo_transpose(spark: SparkSession, folder: str) -> DataFrame:
    return matrix.transpose(_dense(spark, folder))


@query(PRODUCT_SQL)
def coo_multiply(spark: SparkSession, folder: str) -> DataFrame:
    return matrix.coo_multiply(
        _part_by_supplier(spark, folder), _supplier_by_line(spark, folder)
    )


@query(PRODUCT_SQL)
def block_multiply(spark: SparkSession, folder: str) -> DataFrame:
    # Line numbers go up to seven: blocks of eight columns are not mostly empty.
    return matrix.block_multiply(
        _part_by_supplier(spark, folder), _supplier_by_line(spark, folder), cols=8, unique=True
    )


@query(f"""
    WITH {DENSE_SQL}
    SELECT a.j AS i, b.j, cast(sum(a.v * b.v) AS double) AS v
    FROM dense a JOIN dense b ON a.i = b.i GROUP BY a.j, b.j
""")
def block_multiply_dense(spark: SparkSession, folder: str) -> DataFrame:
    x = _dense(spark, folder)
    return matrix.block_multiply(matrix.transpose(x), x, unique=True)


@query(f"""
    WITH {SPARSE_SQL}
    SELECT i // 64 AS bi, j // 64 AS bj, count(*) AS cells FROM m GROUP BY 1, 2
""")
def block_layout(spark: SparkSession, folder: str) -> DataFrame:
    return matrix.block_layout(_part_by_supplier(spark, folder))


@query(f"""
    WITH {SPARSE_SQL}
    SELECT i // 64 AS bi, j // 64 AS bj, cast(count(*) AS int) AS cells, sum(v) AS total
    FROM m GROUP BY 1, 2
""")
def coo_to_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = matrix.to_blocks(_part_by_supplier(spark, folder), unique=True)
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return blocks.select("bi", "bj", F.size("at").alias("cells"), total.alias("total"))


@query(f"""
    WITH {SPARSE_SQL}
    SELECT max(i) // 64 + 1 AS row_blocks, max(j) // 64 + 1 AS col_blocks FROM m
""")
def block_grid(spark: SparkSession, folder: str) -> DataFrame:
    return matrix.block_grid(matrix.block_layout(_part_by_supplier(spark, folder)))


def _sold(spark: SparkSession, folder: str) -> matrix.BlockMatrix:
    """Part by supplier as blocks, with the size that the dimension tables declare."""
    last = read_table(spark, folder, "part").agg(F.max("p_partkey"))
    rows = (last.first()[0] or 0) + 1
    cols = (read_table(spark, folder, "supplier").agg(F.max("s_suppkey")).first()[0] or 0) + 1
    cells = _part_by_supplier(spark, folder)
    return matrix.BlockMatrix.of_cells(cells, rows, cols, unique=True)


@query(f"""
    WITH {SPARSE_SQL},
    size AS (SELECT (SELECT max(p_partkey) FROM part) + 1 AS r,
                    (SELECT max(s_suppkey) FROM supplier) + 1 AS c)
    SELECT (r + 63) // 64 AS row_blocks, (c + 63) // 64 AS col_blocks,
           (SELECT count(*) FROM (SELECT DISTINCT i // 64, j // 64 FROM m)) AS filled
    FROM size
""")
def sized_matrix_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _sold(spark, folder).grid()


@query(f"""
    WITH {SPARSE_SQL},
    size AS (SELECT ((SELECT max(p_partkey) FROM part) + 1) // 2 AS r,
                    (SELECT max(s_suppkey) FROM supplier) + 1 AS c)
    SELECT bi, bj, CASE WHEN bi >= (r + 63) // 64 THEN 'outside the grid'
                        ELSE 'outside the matrix' END AS reason
    FROM (SELECT DISTINCT i // 64 AS bi, j // 64 AS bj FROM m, size WHERE i >= r), size
""")
def invalid_blocks(spark: SparkSession, folder: str) -> DataFrame:
    # The same blocks in a matrix declared for the first half of the parts.
    whole = _sold(spark, folder)
    return dataclasses.replace(whole, rows=whole.rows // 2).invalid()


def _cells_sql(columns: list[str], table: str) -> str:
    """X'X of the given columns, one select per cell."""
    return " UNION ALL ".join(
        f"SELECT cast({i} AS bigint) AS i, cast({j} AS bigint) AS j, "
        f"cast(sum(cast({a} AS decimal(18,2)) * cast({b} AS decimal(18,2))) AS double) AS v "
        f"FROM {table}"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    )


def _features(columns: list[str]) -> dict[str, Column]:
    return {c: F.expr(c) for c in columns}


PART_FEATURES = ["1", "p_size", "p_retailprice"]
LINE_FEATURES = ["1", "l_quantity", "l_discount"]


@query(_cells_sql(PART_FEATURES, "part"))
def gram_join(spark: SparkSession, folder: str) -> DataFrame:
    decimals = [c.cast("decimal(18,2)") for c in _features(PART_FEATURES).values()]
    rows = read_table(spark, folder, "part").select("p_partkey", F.array(*decimals).alias("x"))
    x = matrix.dense_to_coo(rows, "p_partkey", "x")
    return regression.gram_join(x).withColumn("v", F.col("v").cast("double"))


@query(_cells_sql(LINE_FEATURES, "lineitem"))
def gram_outer(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    return regression.gram(lineitem, _features(LINE_FEATURES), scale=2)


@query(" UNION ALL ".join(
    f"SELECT cast({i} AS bigint) AS i, cast(sum(cast({c} AS decimal(18,2)) * "
    "cast(l_extendedprice AS decimal(18,2))) AS double) AS v FROM lineitem"
    for i, c in enumerate(LINE_FEATURES)
))
def xty(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    return regression.xty(lineitem, _features(LINE_FEATURES), F.col("l_extendedprice"), scale=2)


@query("""
    WITH s AS (
        SELECT count(*) AS n,
               cast(sum(x) AS double) AS sx, cast(sum(y) AS double) AS sy,
               cast(sum(x * x) AS double) AS sxx, cast(sum(x * y) AS double) AS sxy
        FROM (SELECT cast(l_quantity AS decimal(18,2)) AS x,
                     cast(l_extendedprice AS decimal(18,2)) AS y FROM lineitem)),
    t AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM s)
    SELECT 'l_quantity' AS term, round(slope, 6) AS theta FROM t
    UNION ALL SELECT 'intercept', round((sy - slope * sx) / n, 6) FROM t
""")
def ols_theta(spark: SparkSession, folder: str) -> DataFrame:
    features = {"intercept": F.lit(1), "l_quantity": F.col("l_quantity")}
    lineitem = read_table(spark, folder, "lineitem")
    theta = regression.ols(lineitem, features, F.col("l_extendedprice"), scale=2)
    return theta.withColumn("theta", F.round("theta", 6))


@query("""
    WITH s AS (
        SELECT count(*) AS n,
               cast(sum(x) AS double) AS sx, cast(sum(y) AS double) AS sy,
               cast(sum(x * x) AS double) AS sxx, cast(sum(x * y) AS double) AS sxy
        FROM (SELECT cast(p_size AS decimal(18,2)) AS x,
                     cast(p_retailprice AS decimal(18,2)) AS y FROM part)),
    t AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM s)
    SELECT 'p_size' AS term, round(slope, 6) AS theta FROM t
    UNION ALL SELECT 'intercept', round((sy - slope * sx) / n, 6) FROM t
""")
def ols_qr_theta(spark: SparkSession, folder: str) -> DataFrame:
    features = {"intercept": F.lit(1), "p_size": F.col("p_size")}
    part = read_table(spark, folder, "part")
    theta = regression.ols_qr(part, features, F.col("p_retailprice"))
    return theta.select("term", F.round("theta", 6).alias("theta"))
