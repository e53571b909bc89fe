"""Physical plans: what is pushed down, broadcast, merged and split."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sparkloom.operators import matrix, placement
from sparkloom.plans.catalog import ORACLE_SQL
from sparkloom.session import scratch_dir
from spark_settings import settings

FOLDER = "/root/testdata/sf0.01"


def final_plan(df):
    """The plan after the action, as AQE left it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def plan_of(spark, name):
    return final_plan(entry_module.queries()[name](spark, FOLDER))


def test_key_filter_reaches_both_scans(spark):
    plan = plan_of(spark, "join_key_filter")
    assert "EqualTo(c_nationkey,7)" in plan
    assert "EqualTo(n_nationkey,7)" in plan
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in plan
    assert "ReadSchema: struct<n_nationkey:int>" in plan


def test_sql_function_is_inlined_and_pushed_down(spark):
    plan = plan_of(spark, "udf_filter")
    assert "GreaterThan(p_size,5)" in plan
    assert "Python" not in plan


def test_scan_reads_two_columns_only(spark):
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan_of(spark, "sum_by_key")


@pytest.mark.parametrize(
    "name", ["sum_by_key", "avg_by_key", "word_count", "udaf_my_average_by_key", "count_by_group"]
)
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "partial_" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "top_k_groups")


def test_broadcast_join(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" in plan_of(spark, "broadcast_join")


def test_merge_join(spark):
    plan = plan_of(spark, "merge_join")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.fixture(scope="module")
def hot_folder(spark):
    """Tables where one customer has a third of the orders, in several files.

    AQE cuts a partition between map outputs, so one file would not do.
    """
    folder = scratch_dir(spark, "tables")
    for name in ("lineitem", "orders", "supplier", "customer"):
        table = spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet").repartition(8)
        if name == "orders":
            hot = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
            table = table.withColumn("o_custkey", F.when(hot, 5).otherwise(F.col("o_custkey")))
        if name == "lineitem":
            hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
            table = table.withColumns(
                {c: F.when(hot, 5).otherwise(F.col(c)) for c in ("l_suppkey", "l_orderkey")}
            )
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "skew_join_avg", "inner_join_expr", "left_outer_rows", "right_outer_rows",
        "inner_join_multiplicity", "merge_join",
    ],
)
def test_skewed_join_is_split(spark, hot_folder, name):
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__advisoryPartitionSizeInBytes="10KB",
    ):
        # The hot partition is set against the median one.
        with settings(spark, shuffle__partitions="32"):
            plan = final_plan(entry_module.queries()[name](spark, hot_folder))
    assert "SortMergeJoin(skew=true)" in plan


def test_skewed_inner_index_is_split(spark):
    """A third of the left cells have one inner index, which the join splits."""
    left = spark.range(200_000).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 997).alias("j"),
        F.lit(1.0).alias("v"),
    )
    right = spark.range(997).select(F.col("id").alias("i"), (F.col("id") % 3).alias("j"), F.lit(1.0).alias("v"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__advisoryPartitionSizeInBytes="10KB",
        shuffle__partitions="32",
    ):
        plan = final_plan(matrix.coo_multiply(left.repartition(8), right.repartition(8)))
    assert "SortMergeJoin(skew=true)" in plan


def test_placed_tables_join_without_another_shuffle(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        left = placement.place_by_key(spark.range(1000), 3, "id")
        right = placement.place_by_key(spark.range(500).withColumn("v", F.lit(1)), 3, "id")
        plan = final_plan(left.join(right, "id"))
    assert plan.count("Exchange") == 2
    assert plan.count("REPARTITION_BY_NUM") == 2


def test_cogroup_and_groups_read_each_side_once_and_do_not_join(spark):
    for name, scans in (("cogroup_lists", 2), ("group_values", 1)):
        plan = plan_of(spark, name)
        assert plan.count("Exchange hashpartitioning") == 2
        assert plan.count("FileScan") == scans and "Join" not in plan


def test_flagship_shuffles(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(spark, "comparable_price_avg")
    assert plan.count("Exchange hashpartitioning") <= 6
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 4
    assert "Window" in plan and "NestedLoop" not in plan


def own_queries():
    """The queries of this part of the library; some others run work when built."""
    return {n: q for n, q in entry_module.queries().items() if n in ORACLE_SQL}


def test_no_query_has_a_cross_join(spark):
    for name, query in own_queries().items():
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_few_operators_run_python(spark):
    python = set()
    for name, query in own_queries().items():
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        if "InArrow" in plan or "InPandas" in plan or "Python" in plan:
            python.add(name)
    assert python == {
        "block_multiply", "block_multiply_dense", "ols_theta", "ols_qr_theta", "udaf_called_from_sql"
    }
