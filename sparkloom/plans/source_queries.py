"""Sources, sinks and row actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.text import parse_fields
from sparkloom.operators.keyed import average_state, finish_average, sum_by_key
from sparkloom.plans.registry import query
from sparkloom.session import scratch_dir
from sparkloom.sources import files, generated
from sparkloom.sources.files import read_table


@query("""
    WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT line, count(*) AS copies FROM lines GROUP BY line
""")
def text_source_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    path = files.write_text_lines(documents, "text", scratch_dir(spark, "documents-text", folder))
    lines = files.read_text_lines(spark, path).withColumnRenamed("value", "line")
    return lines.groupBy("line").agg(F.count("*").alias("copies"))


def _text_lines(
    spark: SparkSession, folder: str, label: str, rows: DataFrame, *columns: str
) -> DataFrame:
    """The columns as a text file of comma-separated lines, read back."""
    lines = rows.select(files.delimited(*columns).alias("line"))
    path = files.write_text_lines(lines, "line", scratch_dir(spark, label, folder))
    return files.read_text_lines(spark, path)


@query("SELECT l_suppkey AS k, avg(l_quantity) AS average FROM lineitem GROUP BY l_suppkey")
def text_avg_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    lines = _text_lines(spark, folder, "lineitem-text", lineitem, "l_suppkey", "l_quantity")
    pairs = parse_fields(lines, "value", {"k": "bigint", "v": "double"})
    return average_state(pairs, "k", "v").select("k", finish_average().alias("average"))


@query("""
    SELECT c_name || ' ' || n_name AS names FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def text_emp_dept_names(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = read_table(spark, folder, "customer"), read_table(spark, folder, "nation")
    employees = _text_lines(
        spark, folder, "customer-text", customer, "c_name", "c_nationkey", "c_acctbal"
    )
    departments = _text_lines(spark, folder, "nation-text", nation, "n_name", "n_nationkey")
    employees = parse_fields(
        employees, "value", {"name": "string", "dno": "int", "address": "string"}
    )
    departments = parse_fields(departments, "value", {"dept": "string", "dno": "int"})
    return employees.join(departments, "dno").select(
        F.concat("name", F.lit(" "), "dept").alias("names")
    )


@query("""
    SELECT cast(l_orderkey AS varchar) AS _c0, cast(l_partkey AS varchar) AS _c1,
           cast(l_suppkey AS varchar) AS _c2, cast(l_linenumber AS varchar) AS _c3,
           cast(l_quantity AS varchar) AS _c4, cast(l_extendedprice AS varchar) AS _c5,
           cast(l_discount AS varchar) AS _c6, cast(l_tax AS varchar) AS _c7,
           l_returnflag AS _c8, l_linestatus AS _c9,
           strftime(l_shipdate, '%Y-%m-%d') AS _c10
    FROM lineitem
""")
def csv_no_header(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    dated = lineitem.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    path = files.write_csv(dated, scratch_dir(spark, "lineitem-csv", folder))
    return files.read_csv_strings(spark, path, escaped=True)


@query("""
    SELECT cast(c_custkey AS varchar) AS c_custkey, c_name,
           cast(c_nationkey AS varchar) AS c_nationkey,
           cast(c_acctbal AS varchar) AS c_acctbal, c_mktsegment
    FROM customer
""")
def csv_header_strings(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    path = files.write_csv(customer, scratch_dir(spark, "customer-csv", folder), header=True)
    return files.read_csv_strings(spark, path, header=True, escaped=True)


@query("""
    SELECT s_suppkey, s_name, s_nationkey, cast(cast(s_acctbal AS float) AS double) AS s_acctbal
    FROM supplier
""")
def csv_ddl_schema(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier")
    path = files.write_csv(supplier, scratch_dir(spark, "supplier-csv", folder), header=True)
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal float"
    typed = files.read_csv(spark, path, schema, header=True, escaped=True)
    return typed.withColumn("s_acctbal", F.col("s_acctbal").cast("double"))


@query("""
    SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, p_brand, p_type,
           cast(p_size AS varchar) AS p_size, cast(p_retailprice AS varchar) AS p_retailprice
    FROM part
""")
def csv_struct_schema(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    path = files.write_csv(part, scratch_dir(spark, "part-csv", folder))
    return files.read_csv(spark, path, files.string_schema(*part.columns), escaped=True)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           'whole,string,whole,double,string' AS inferred
    FROM customer
""")
def csv_infer_schema(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    path = files.write_csv(customer, scratch_dir(spark, "inferred-csv", folder), header=True)
    inferred = files.read_csv_inferred(spark, path, escaped=True)
    # Whether a whole number fits an int depends on the data, not on inference.
    kinds = [{"int": "whole", "bigint": "whole"}.get(kind, kind) for _, kind in inferred.dtypes]
    return inferred.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in customer.schema.fields],
        F.lit(",".join(kinds)).alias("inferred"),
    )


@query("""
    SELECT s_nationkey, cast(sum(cast(s_acctbal AS decimal(18,2))) AS double) / count(*) AS average
    FROM supplier GROUP BY s_nationkey
""")
def json_source(spark: SparkSession, folder: str) -> DataFrame:
    path = files.write_json_lines(
        read_table(spark, folder, "supplier"), scratch_dir(spark, "supplier-json", folder)
    )
    suppliers = files.read_json_lines(spark, path)
    balance = F.col("s_acctbal").cast("decimal(18,2)")
    return suppliers.groupBy(F.col("s_nationkey").cast("int").alias("s_nationkey")).agg(
        (F.sum(balance).cast("double") / F.count("*")).alias("average")
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
""")
def parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.format("parquet").load(f"{folder}/orders.parquet")
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# The six people of the in-memory table.
PEOPLE = [
    (1, "Alice", 16, "Arlington"),
    (2, "Bob", 18, "Brownsville"),
    (3, "Carrol", 20, "Corpus Christi"),
    (4, "Dave", 26, "Dallas"),
    (5, "Eve", 24, "El Paso"),
    (6, "Frank", 22, "Fort Worth"),
]


@query("""
    WITH people(id, name, age, city) AS (VALUES
        (1, 'Alice', 16, 'Arlington'), (2, 'Bob', 18, 'Brownsville'),
        (3, 'Carrol', 20, 'Corpus Christi'), (4, 'Dave', 26, 'Dallas'),
        (5, 'Eve', 24, 'El Paso'), (6, 'Frank', 22, 'Fort Worth'))
    SELECT id, name, age, city, count(p_partkey) AS parts_of_that_size
    FROM people LEFT JOIN part ON p_size = age GROUP BY id, name, age, city
""")
def inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    people = generated.literal_rows(spark, PEOPLE, "id int, name string, age int, city string")
    sizes = (
        read_table(spark, folder, "part")
        .groupBy(F.col("p_size").alias("age"))
        .agg(F.count("*").alias("parts_of_that_size"))
    )
    return people.join(sizes, "age", "left").fillna(0, ["parts_of_that_size"])


@query("""
    SELECT id, count(c_custkey) AS customers
    FROM (SELECT unnest(range((SELECT min(n_nationkey) FROM nation),
                              (SELECT max(n_nationkey) + 1 FROM nation)))::BIGINT AS id)
    LEFT JOIN customer ON c_nationkey = id GROUP BY id
""")
def range_source(spark: SparkSession, folder: str) -> DataFrame:
    # A range over the keys of a dimension of fixed size.
    low, high = generated.key_bounds(read_table(spark, folder, "nation"), "n_nationkey")
    customers = (
        read_table(spark, folder, "customer")
        .groupBy(F.col("c_nationkey").cast("bigint").alias("id"))
        .agg(F.count("*").alias("customers"))
    )
    ids = generated.id_range(spark, low, high, inclusive=True)
    return ids.join(customers, "id", "left").fillna(0, ["customers"])


@query("""
    SELECT chr(cast(65 + (event_id * 7919) % 26 AS int)) AS k,
           cast(sum((event_id * 104729) % 10) AS bigint) AS total
    FROM events GROUP BY 1
""")
def gen_kv_sum(spark: SparkSession, folder: str) -> DataFrame:
    pairs = generated.pairs_from_ids(read_table(spark, folder, "events"), "event_id")
    return sum_by_key(pairs, "k", "v", "total")


@query("""
    SELECT l_partkey AS i, cast(sum((l_partkey * 31 + l_suppkey * 17) % 10) AS bigint) AS row_sum,
           count(*) AS cells
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) GROUP BY l_partkey
""")
def gen_coo(spark: SparkSession, folder: str) -> DataFrame:
    # A generated value for each cell that the lines name.
    cells = generated.cells_from_keys(read_table(spark, folder, "lineitem"), "l_partkey", "l_suppkey")
    return cells.groupBy("i").agg(F.sum("v").alias("row_sum"), F.count("*").alias("cells"))


def _drawn(n: int, seed: int, *ids: str) -> str:
    """SQL: a whole number below n, drawn by the hash of seed and ids."""
    text = f"concat_ws(':', '{seed}', {', '.join(ids)})"
    return f"cast(floor(('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496 * {n}) AS bigint)"


@query(f"""
    SELECT chr(cast(65 + {_drawn(26, 7, 'event_id')} AS int)) AS k, count(*) AS pairs,
           cast(sum({_drawn(10, 8, 'event_id')}) AS bigint) AS total
    FROM events GROUP BY 1
""")
def random_pairs_by_id(spark: SparkSession, folder: str) -> DataFrame:
    # A pair drawn for each event by its id, whatever partition it is in.
    pairs = generated.drawn_pairs(read_table(spark, folder, "events"), "event_id", seed=7)
    return pairs.groupBy("k").agg(F.count("*").alias("pairs"), F.sum("v").alias("total"))


@query(f"""
    SELECT i, j, {_drawn(10, 3, 'i', 'j')} AS v
    FROM (SELECT DISTINCT l_partkey AS i, l_suppkey AS j FROM lineitem)
""")
def random_cells_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return generated.drawn_cells(
        read_table(spark, folder, "lineitem"), "l_partkey", "l_suppkey", seed=3
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
""")
def csv_to_parquet(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    dated = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    csv = files.write_csv(dated, scratch_dir(spark, "orders-csv", folder))
    strings = files.read_csv(spark, csv, files.string_schema(*orders.columns), escaped=True)
    parquet = files.write_parquet(strings, scratch_dir(spark, "orders-parquet", folder))
    return spark.read.parquet(parquet).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderdate", "o_orderpriority"
    )


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").agg(F.count("*").alias("n"))


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 2
""")
def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_orderkey").limit(2)
