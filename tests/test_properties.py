"""Operators that must agree with each other, or with numpy."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sparkloom.operators import matrix, regression
from sparkloom.sources import generated

FOLDER = "/root/testdata/sf0.001"


def bag(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def run(spark, name):
    return entry_module.queries()[name](spark, FOLDER)


@pytest.mark.parametrize(
    "one, other",
    [
        ("avg_by_key", "avg_by_key_combine"),
        ("coo_multiply", "block_multiply"),
        ("distribute_by", "cluster_by"),
    ],
)
def test_queries_agree(spark, one, other):
    assert bag(run(spark, one)) == bag(run(spark, other))


def test_sum_through_lists_is_the_sum(spark):
    from sparkloom.operators.keyed import group_values, sum_by_key

    lineitem = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    through = group_values(lineitem, "l_suppkey", "l_quantity").select(
        "l_suppkey",
        F.aggregate("values", F.lit(0.0), lambda a, e: a + e["value"] * e["copies"]).alias("s"),
    )
    assert bag(through) == bag(sum_by_key(lineitem, "l_suppkey", "l_quantity", "s"))


def test_left_join_has_no_fewer_rows(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    assert run(spark, "left_outer_rows").count() == orders.count()
    assert run(spark, "left_outer_rows").count() >= run(spark, "left_outer_rows").dropna().count()


def test_sorted_results_are_in_order(spark):
    groups = [(-r["parts"], r["p_brand"], r["p_type"]) for r in run(spark, "sort_groups").collect()]
    assert groups == sorted(groups)
    keys = [r["s_suppkey"] for r in run(spark, "sort_rows").collect()]
    assert keys == sorted(keys)


def dense(df, n, m):
    out = np.zeros((n, m))
    for r in df.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


@pytest.mark.parametrize("rows, inner, cols", [(64, 64, 64), (16, 50, 7), (1, 200, 3)])
def test_block_product_is_numpys(spark, rows, inner, cols):
    a = generated.random_coo(spark, 128, 100, seed=1)
    b = generated.random_coo(spark, 100, 70, seed=2)
    expected = dense(a, 128, 100) @ dense(b, 100, 70)
    for unique in (False, True):
        found = dense(matrix.block_multiply(a, b, rows, inner, cols, unique), 128, 70)
        np.testing.assert_allclose(found, expected, rtol=1e-9)


def test_block_product_of_more_blocks_than_a_worker_holds(spark, monkeypatch):
    monkeypatch.setattr(matrix, "CELLS_AT_ONCE", 64)
    monkeypatch.setattr(matrix, "CELLS_HELD", 128)
    a = generated.random_coo(spark, 60, 50, seed=1)
    b = generated.random_coo(spark, 50, 40, seed=2)
    found = dense(matrix.block_multiply(a, b, 4, 4, 4), 60, 40)
    np.testing.assert_allclose(found, dense(a, 60, 50) @ dense(b, 50, 40), rtol=1e-9)


def test_sparse_product_keeps_absent_cells_absent(spark):
    rng = np.random.default_rng(0)

    def sparse(n, m):
        cells = [
            (i, j, float(rng.integers(-2, 3)))
            for i in range(n) for j in range(m) if rng.random() < 0.05
        ]
        return spark.createDataFrame(cells + cells[:5], "i bigint, j bigint, v double")

    a, b = sparse(150, 90), sparse(90, 110)
    a = a.unionByName(spark.createDataFrame([(0, 0, None), (3, 5, None)], a.schema))
    expected = bag(matrix.coo_multiply(a, b))
    assert all(value is not None for _, _, value in expected)
    assert bag(matrix.block_multiply(a, b, 32, 32, 32)) == expected
    assert bag(matrix.block_multiply(a, b, 32, 32, 32, unique=True)) == expected


def test_block_grid_of_a_1024_matrix(spark):
    blocks = matrix.to_blocks(generated.random_coo(spark, 1024, 1024))
    assert matrix.block_grid(blocks).first() == (16, 16)
    assert matrix.invalid_blocks(blocks).count() == 0
    assert blocks.select(F.sum(F.size("at"))).first()[0] == 1024 * 1024


def test_invalid_blocks_are_found(spark):
    bad = [(0, 0, [0, 0], [1.0, 2.0]), (0, 1, [99], [1.0]), (1, 1, [3], [1.0])]
    blocks = spark.createDataFrame(bad, "bi bigint, bj bigint, at array<int>, v array<double>")
    assert {(r["bi"], r["bj"]) for r in matrix.invalid_blocks(blocks, 2, 2).collect()} == {
        (0, 0), (0, 1),
    }


def test_both_gram_forms_agree(spark):
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    features = {
        "one": F.lit(1).cast("decimal(18,2)"),
        "size": F.col("p_size").cast("decimal(18,2)"),
        "price": F.col("p_retailprice").cast("decimal(18,2)"),
    }
    assert bag(regression.gram(part, features)) == bag(run(spark, "gram_join"))


def test_ols_is_numpys_least_squares(spark):
    line = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    features = {
        "one": F.lit(1.0),
        "quantity": F.col("l_quantity"),
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax"),
    }
    theta = {
        r["term"]: r["theta"]
        for r in regression.ols(line, features, F.col("l_extendedprice")).collect()
    }
    local = line.toPandas()
    x = np.column_stack([np.ones(len(local)), local.l_quantity, local.l_discount, local.l_tax])
    expected, *_ = np.linalg.lstsq(x, local.l_extendedprice, rcond=None)
    assert [theta[t] for t in features] == pytest.approx(list(expected), rel=1e-6)


def test_ols_without_rows_or_with_nulls(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert regression.ols(df, {"x": F.col("x")}, F.col("y")).first()["theta"] == pytest.approx(2)
    assert regression.ols(df.filter("x > 9"), {"x": F.col("x")}, F.col("y")).count() == 0


def test_ols_of_a_rank_deficient_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    twice = {"a": F.col("x"), "b": F.col("x")}
    theta = [r["theta"] for r in regression.ols(df, twice, F.col("y")).collect()]
    assert theta == pytest.approx([1.0, 1.0])
