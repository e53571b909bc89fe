"""Small literal tables with answers worked out by hand.

The tables and answers are fixed values, those of FIXTURES.md.
"""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sparkloom.functions import collections as c
from sparkloom.functions import text
from sparkloom.functions import user_defined as u
from sparkloom.operators import keyed, matrix, placement, regression, views
from sparkloom.plans.source_queries import PEOPLE
from sparkloom.session import release_scratch, scratch_dir, shared_root
from sparkloom.sources import files, generated

PEOPLE_SCHEMA = "id int, name string, age int, city string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture
def people(spark):
    return generated.literal_rows(spark, PEOPLE, PEOPLE_SCHEMA)


@pytest.fixture
def people_nulls(spark):
    data = [
        (1, "Alice", None, "Arlington"),
        (2, "Bob", 20, "Brownsville"),
        (3, "Carrol", 30, None),
        (None, None, None, None),
    ]
    return generated.literal_rows(spark, data, PEOPLE_SCHEMA)


@pytest.fixture
def letters(spark):
    data = [("A", 1), ("B", 1), ("C", 1), ("B", 1), ("C", 1), ("D", 1), ("C", 1), ("A", 1)]
    return generated.literal_rows(spark, data, "k string, v int")


@pytest.fixture
def x_pairs(spark):
    data = [
        (3, "c"), (3, "f"), (1, "a"), (4, "d"), (1, "h"), (2, "b"), (5, "e"), (2, "g"),
    ]
    return generated.literal_rows(spark, data, "k int, v string")


@pytest.fixture
def y_pairs(spark):
    data = [
        (1, "A"), (2, "B"), (3, "C"), (2, "B"), (3, "C"), (4, "D"), (3, "C"), (1, "A"),
    ]
    return generated.literal_rows(spark, data, "k int, v string")


# Schemas


def test_tuples_get_default_names(spark):
    assert generated.literal_rows(spark, PEOPLE).columns == ["_1", "_2", "_3", "_4"]


def test_names_given(spark):
    df = generated.literal_rows(spark, PEOPLE).toDF("id", "name", "age", "city")
    assert df.columns == ["id", "name", "age", "city"]


def test_record_class(spark):
    person = Row("id", "name", "age", "city")
    df = generated.literal_rows(spark, [person(*p) for p in PEOPLE])
    assert df.columns == ["id", "name", "age", "city"]
    assert df.count() == 6


def test_struct_schema(spark):
    schema = StructType(
        [
            StructField("id", IntegerType(), True),
            StructField("name", StringType(), True),
            StructField("age", IntegerType(), True),
            StructField("city", StringType(), True),
        ]
    )
    assert generated.literal_rows(spark, PEOPLE, schema).schema == schema


# Filters


def test_four_spellings_of_a_filter_agree(spark, people):
    views.as_view(people, "people")
    spellings = [
        spark.sql("SELECT * FROM people WHERE age > 18"),
        people.filter(F.col("age") > 18),
        people.filter(people["age"] > 18),
        people.filter("age > 18"),
    ]
    for df in spellings:
        assert [r[0] for r in rows(df)] == [3, 4, 5, 6]


def test_select_where(people):
    found = people.select("id", "name", "city").where("city == 'Arlington'").drop("city")
    assert rows(found) == [(1, "Alice")]


def test_count_by_age(people):
    assert [r[1] for r in rows(people.groupBy("age").count())] == [1] * 6


def test_error_lines(spark):
    logs = [
        "INFO: Application started",
        "ERROR: Invalid input detected",
        "WARNING: Connection timed out",
        "ERROR: Database connection failed",
        "INFO: Request completed successfully",
        "ERROR: File not found",
    ]
    df = generated.literal_rows(spark, list(enumerate(logs)), "n int, line string")
    errors = df.filter(F.col("line").contains("ERROR"))
    assert errors.count() == 3
    first_two = [r["line"] for r in errors.orderBy("n").limit(2).collect()]
    assert first_two == ["ERROR: Invalid input detected", "ERROR: Database connection failed"]


def test_describe_age(spark):
    data = [("Alice", 25), ("Bob", 70), ("Carl", 17), ("Dora", 18), ("Ed", 65), ("Fay", None)]
    df = generated.literal_rows(spark, data, "name string, age int")
    told = df.select(text.describe_age(F.col("name"), F.col("age")).alias("t")).collect()
    assert [r["t"] for r in told] == [
        "Alice is an adult.",
        "Bob is a senior citizen.",
        "Carl is a minor.",
        "Dora is an adult.",
        "Ed is a senior citizen.",
        "None",
    ]


# Text


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a b", ["a", "b"]),
        ("a b  ", ["a", "b"]),
        ("  a", ["", "", "a"]),
        ("a  b", ["a", "", "b"]),
        ("", [""]),
        ("   ", []),
    ],
)
def test_tokens(spark, line, expected):
    assert value(spark, text.tokens(F.lit(line))) == expected


def test_tokens_on_a_regex_character(spark):
    assert value(spark, text.tokens(F.lit("a.b|c."), ".")) == ["a", "b|c"]
    assert value(spark, text.tokens(F.lit("a.b|c."), "|")) == ["a.b", "c."]


def test_parse_fields(spark):
    df = generated.literal_rows(spark, [("3,1.5",), ("4,2",)], "line string")
    parsed = text.parse_fields(df, "line", {"k": "int", "v": "double"})
    assert rows(parsed) == [(3, 1.5), (4, 2.0)]


def test_parse_fields_raises_or_is_lenient(spark):
    df = generated.literal_rows(spark, [("x,1.5",), ("4",)], "line string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
        text.parse_fields(df, "line", {"k": "int", "v": "double"}).collect()
    lenient = text.parse_fields(df, "line", {"k": "int", "v": "double"}, lenient=True)
    assert rows(lenient) == [(4, None), (None, 1.5)]


def test_word_count(spark):
    df = generated.literal_rows(spark, [("a b a",), ("b  ",), ("c",)], "line string")
    assert rows(keyed.word_count(df, "line")) == [("a", 2), ("b", 2), ("c", 1)]


# Arrays and maps


def test_array_functions(spark):
    a = F.array(*[F.lit(n) for n in (1, 2, 3, 4, 5, 6)])
    assert value(spark, c.add_to_each(a)) == [2, 3, 4, 5, 6, 7]
    assert value(spark, c.total(a)) == 21
    assert value(spark, F.size(a)) == 6
    assert value(spark, c.first_of(a)) == 1


def test_list_functions(spark):
    a = F.array(*[F.lit(n) for n in (1, 2, 3, 4)])
    assert value(spark, c.odd_only(a)) == [1, 3]
    assert value(spark, F.concat(a, F.array(F.lit(5), F.lit(6)))) == [1, 2, 3, 4, 5, 6]
    assert value(spark, c.last_of(a)) == 4


def test_odd_keeps_negative_numbers(spark):
    assert value(spark, c.odd_only(F.array(F.lit(-3), F.lit(-2)))) == [-3]


def test_empty_array(spark):
    empty = F.array().cast("array<int>")
    assert value(spark, c.total(empty)) == 0
    assert value(spark, c.first_of(empty)) is None


def test_firsts_of_pairs(spark):
    data = [(1, "a"), (2, "b"), (1, "c")]
    pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(s).alias("s")) for n, s in data])
    assert value(spark, c.add_to_firsts(pairs, "n")) == [2, 3, 2]


def test_map_functions(spark):
    m = F.create_map(
        F.lit(1), F.lit("one"), F.lit(3), F.lit("three"), F.lit(2), F.lit("two")
    )
    assert value(spark, c.map_get(m, F.lit(2))) == "two"
    assert value(spark, c.map_get(m, F.lit(9))) is None
    assert value(spark, c.map_put(m, F.lit(3), F.lit("3"))) == {1: "one", 2: "two", 3: "3"}


def test_explode_literal(spark):
    df = spark.range(1).select(F.explode(F.array(F.lit(10), F.lit(20))).alias("v"))
    assert rows(df) == [(10,), (20,)]


# Keys


def test_sums_and_groups(letters):
    assert rows(keyed.sum_by_key(letters, "k", "v", "total")) == [
        ("A", 2), ("B", 2), ("C", 3), ("D", 1),
    ]
    groups = keyed.group_values(letters, "k", "v")
    sizes = F.aggregate("values", F.lit(0).cast("bigint"), lambda n, e: n + e["copies"])
    assert rows(groups.select("k", sizes)) == [("A", 2), ("B", 2), ("C", 3), ("D", 1)]
    assert letters.distinct().count() == 4


def test_inner_join_multiplicity(x_pairs, y_pairs):
    joined = x_pairs.join(y_pairs.withColumnRenamed("v", "w"), "k")
    assert rows(joined.groupBy("k").count()) == [(1, 4), (2, 4), (3, 6), (4, 1)]


def test_cogroup(x_pairs, y_pairs):
    groups = keyed.cogroup_values(x_pairs, y_pairs, "k", "v", "v")
    assert rows(groups) == [
        (1, 0, [("a", 1), ("h", 1)], [("A", 2)]),
        (2, 0, [("b", 1), ("g", 1)], [("B", 2)]),
        (3, 0, [("c", 1), ("f", 1)], [("C", 3)]),
        (4, 0, [("d", 1)], [("D", 1)]),
        (5, 0, [("e", 1)], []),
    ]


def test_copartitioned_join(x_pairs, y_pairs):
    placed = placement.place_by_key(x_pairs, 3, "k").join(
        placement.place_by_key(y_pairs.withColumnRenamed("v", "w"), 3, "k"), "k"
    )
    assert rows(placed) == rows(x_pairs.join(y_pairs.withColumnRenamed("v", "w"), "k"))


def test_averages(spark):
    df = generated.literal_rows(spark, [(1, 2.0), (1, 4.0), (2, 5.0)], "k int, v double")
    state = keyed.average_state(df, "k", "v")
    assert rows(state.select("k", keyed.finish_average())) == [(1, 3.0), (2, 5.0)]


def test_average_of_nulls_is_null(spark):
    df = generated.literal_rows(spark, [(1, None), (2, 5.0), (2, None)], "k int, v double")
    state = keyed.average_state(df, "k", "v")
    assert rows(state.select("k", keyed.finish_average())) == [(1, None), (2, 5.0)]


# Joins of two small tables


@pytest.fixture
def people_v(spark):
    return generated.literal_rows(
        spark, [(1, "Alice"), (2, "Bob"), (3, "Carol")], "id int, v string"
    )


@pytest.fixture
def locations(spark):
    return generated.literal_rows(
        spark, [(1, "Central Texas"), (2, "South Texas")], "id int, v string"
    )


@pytest.mark.parametrize(
    "how, ids",
    [
        ("inner", [(1, 1), (2, 2)]),
        ("left_outer", [(1, 1), (2, 2), (3, None)]),
        ("right_outer", [(1, 1), (2, 2)]),
    ],
)
def test_joins(people_v, locations, how, ids):
    joined = people_v.join(locations, people_v["id"] == locations["id"], how)
    assert rows(joined.select(people_v["id"], locations["id"])) == ids


def test_filter_on_text_and_on_a_missing_column(locations):
    assert rows(locations.filter(F.col("v") == "South Texas")) == [(2, "South Texas")]
    with pytest.raises(AnalysisException):
        locations.filter(F.col("state") == "South Texas").collect()


# Nulls


def test_drop_nulls(people_nulls):
    assert [r[0] for r in rows(people_nulls.dropna())] == [2]
    assert people_nulls.dropna("all").count() == 3
    assert [r[0] for r in rows(people_nulls.dropna(subset=["age"]))] == [2, 3]


def test_fill_nulls(people_nulls):
    assert rows(people_nulls.fillna(0)) == sorted(
        [
            (1, "Alice", 0, "Arlington"),
            (2, "Bob", 20, "Brownsville"),
            (3, "Carrol", 30, None),
            (0, None, 0, None),
        ],
        key=repr,
    )
    assert rows(people_nulls.fillna({"age": 0, "city": "Unknown"})) == sorted(
        [
            (1, "Alice", 0, "Arlington"),
            (2, "Bob", 20, "Brownsville"),
            (3, "Carrol", 30, "Unknown"),
            (None, None, 0, "Unknown"),
        ],
        key=repr,
    )


def test_replace(people_nulls):
    replaced = people_nulls.replace({"Arlington": "New Name"}, subset=["city"])
    assert {r["city"] for r in replaced.collect()} == {"New Name", "Brownsville", None}


# Views and functions


def test_three_row_view(spark):
    df = generated.literal_rows(
        spark, [(1, "andy"), (2, "bob"), (2, "andy")], ["count", "name"]
    )
    views.as_view(df, "temp_view1")
    assert spark.sql("SELECT * FROM temp_view1").count() == 3


def test_global_view_is_seen_by_other_sessions(spark, people):
    name = views.as_global_view(people, "people_everywhere")
    assert spark.newSession().sql(f"SELECT * FROM {name}").count() == 6
    assert views.as_global_view(people, "people_everywhere") == name
    assert views.drop_global_view(spark, "people_everywhere")


def test_frames_in_sql_leave_no_view(spark, people):
    views.as_view(spark.range(3), "people")
    found = views.query_frames(spark, "SELECT * FROM {people} WHERE age > 18", people=people)
    assert found.count() == 4 and spark.table("people").count() == 3


def test_sql_functions(spark):
    u.register_functions(spark)
    assert spark.sql("SELECT plus_one(5) AS v").first()["v"] == 6
    assert spark.sql("SELECT plus_one(CAST(NULL AS INT)) AS v").first()["v"] is None
    views.as_view(generated.id_range(spark, 1, 10), "test")
    found = spark.sql("SELECT * FROM test WHERE one_arg_filter(id)")
    assert rows(found) == [(6,), (7,), (8,), (9,)]
    by_column = generated.id_range(spark, 1, 10).filter(u.one_arg_filter(F.col("id")))
    assert rows(by_column) == rows(found)
    assert value(spark, u.plus_one(F.lit(5))) == 6


def test_random_value(spark):
    df = spark.range(1000).select(u.random_value(7).alias("r"))
    low, high, distinct = df.agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
    assert 0 <= low < high < 1 and distinct > 990


def test_my_average(spark):
    salaries = generated.literal_rows(spark, [(3000,), (4500,), (None,)], "salary bigint")
    assert salaries.agg(u.my_average(F.col("salary")).alias("a")).first()["a"] == 3750.0
    views.as_view(salaries, "employees")
    sql = f"SELECT {u.my_average_sql('salary')} AS a FROM employees"
    assert spark.sql(sql).first()["a"] == 3750.0
    cents = generated.literal_rows(spark, [(10.9,), (11.9,), (None,)], "salary double")
    assert cents.agg(u.my_average(F.col("salary")).alias("a")).first()["a"] == pytest.approx(11.4)
    exact = cents.select(F.col("salary").cast("decimal(10,2)").alias("salary"))
    assert exact.agg(u.my_average(F.col("salary")).alias("a")).first()["a"] == 11.4
    empty = salaries.filter("salary > 10000")
    assert empty.agg(u.my_average(F.col("salary")).alias("a")).first()["a"] is None


# Ranges and generators


def test_range_sum(spark):
    total = generated.id_range(spark, 0, 1000).filter("id > 100").selectExpr("sum(id) AS s")
    assert total.first()["s"] == 494450
    assert generated.id_range(spark, 1, 10000, inclusive=True).count() == 10000


def test_scale_by_a_value_of_another_table(spark):
    numbers = generated.literal_rows(spark, [(n,) for n in (10, 20, 30, 40, 50)], "n int")
    factor = spark.range(10, 11).agg(F.max("id").alias("f")).scalar()
    assert rows(numbers.select(F.col("n") * factor)) == [(100,), (200,), (300,), (400,), (500,)]


def test_random_pairs(spark):
    pairs = generated.random_pairs(spark, 10_000, seed=3)
    assert pairs.count() == 10_000
    keys, low, high = pairs.agg(F.countDistinct("k"), F.min("v"), F.max("v")).first()
    assert (keys, low, high) == (26, 0, 9)
    assert pairs.agg(F.min("k"), F.max("k")).first() == ("A", "Z")


def test_random_coo(spark):
    cells = generated.random_coo(spark, 20, 30, seed=1)
    assert cells.select("i", "j").distinct().count() == 600
    low, high, i, j = cells.agg(F.min("v"), F.max("v"), F.max("i"), F.max("j")).first()
    assert 0 <= low < high < 10 and (i, j) == (19, 29)


# Matrices


@pytest.fixture
def m(spark):
    df = generated.literal_rows(
        spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0])], "r int, a array<double>"
    )
    return matrix.dense_to_coo(df, "r", "a")


@pytest.fixture
def n(spark):
    df = generated.literal_rows(
        spark, [(0, [5.0, 6.0]), (1, [7.0, 8.0])], "r int, a array<double>"
    )
    return matrix.dense_to_coo(df, "r", "a")


PRODUCT = [(0, 0, 19.0), (0, 1, 22.0), (1, 0, 43.0), (1, 1, 50.0)]


def test_products(m, n):
    assert rows(matrix.coo_multiply(m, n)) == PRODUCT
    assert rows(matrix.block_multiply(m, n)) == PRODUCT
    assert rows(matrix.block_multiply(m, n, 1, 1, 1)) == PRODUCT


def test_transpose(m):
    assert rows(matrix.transpose(m)) == [(0, 0, 1.0), (0, 1, 3.0), (1, 0, 2.0), (1, 1, 4.0)]


X = [(0, 1, 2, 2), (1, 2, 8, 2), (2, 4, 9, 2)]


def test_normal_equations_and_theta(spark):
    df = generated.literal_rows(spark, X, "r int, a int, b int, y int")
    features = {"a": F.col("a").cast("double"), "b": F.col("b").cast("double")}
    target = F.col("y").cast("double")
    gram = [(0, 0, 21.0), (0, 1, 54.0), (1, 0, 54.0), (1, 1, 149.0)]
    assert rows(regression.gram(df, features)) == gram
    coo = matrix.dense_to_coo(
        df.select("r", F.array(*features.values()).alias("x")), "r", "x"
    )
    assert rows(regression.gram_join(coo)) == gram
    assert rows(regression.xty(df, features, target)) == [(0, 14.0), (1, 38.0)]
    theta = dict(rows(regression.ols(df, features, target)))
    assert theta["a"] == pytest.approx(34 / 213)
    assert theta["b"] == pytest.approx(42 / 213)


# Files


def test_scratch_dir_is_the_sessions_and_stays(spark):
    path = scratch_dir(spark, "x", "/tables/a")
    assert path == scratch_dir(spark, "x", "/tables/a") != scratch_dir(spark, "x", "/tables/b")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_dir_without_a_checkpoint_folder_is_the_warehouse():
    class Conf:
        def get(self, key, *default):
            return default[0] if default else "file:/warehouse/"

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://somewhere", "applicationId": "app-1"})

    assert scratch_dir(Session(), "x") == "file:/warehouse/sparkloom-app-1/x"


def test_calls_of_a_query_leave_one_copy(spark):
    import os

    import __spark_entry__ as entry_module

    release_scratch(spark)
    for _ in range(3):
        entry_module.queries()["csv_to_parquet"](spark, "/root/testdata/sf0.001")
    found = os.listdir(shared_root(spark).removeprefix("file:"))
    assert len(found) == 2
    release_scratch(spark)
    assert not os.path.exists(shared_root(spark).removeprefix("file:"))


def test_csv_under_each_schema(spark, people):
    path = files.write_csv(people, scratch_dir(spark, "csv"), header=True)
    strings = files.read_csv_strings(spark, path, header=True)
    assert dict(strings.dtypes) == {c: "string" for c in people.columns}
    assert rows(files.read_csv(spark, path, PEOPLE_SCHEMA, header=True)) == rows(people)
    assert dict(files.read_csv_inferred(spark, path).dtypes)["age"] == "int"
    bare = files.write_csv(people, scratch_dir(spark, "csv-bare"))
    assert files.read_csv_strings(spark, bare).columns == ["_c0", "_c1", "_c2", "_c3"]
    assert rows(files.read_csv(spark, bare, files.string_schema(*people.columns))) == [
        tuple(str(v) for v in p) for p in PEOPLE
    ]


# Values that a careless file format loses.
HARD = [
    (1, "two\nlines", 1.5), (2, 'quo"te, comma', None), (3, "", 0.0), (None, None, -0.0),
    (5, "back\\slash \\n", 2.5), (6, "car\rriage", 3.5), (7, "  spaces  ", 1e300), (8, "\\N", 4.0),
    (9, "%0A %25", 5.0), (10, '"', 6.0), (11, "\r\n", 7.0), (12, "é\t日", 8.0), (13, "NULL", 9.0),
]
HARD_SCHEMA = "id int, t string, v double"


@pytest.mark.parametrize("header", [True, False])
def test_csv_keeps_hard_values(spark, header):
    df = generated.literal_rows(spark, HARD, HARD_SCHEMA)
    path = files.write_csv(df, scratch_dir(spark, f"hard-{header}"), header=header)
    back = files.read_csv(spark, path, HARD_SCHEMA, header=header, escaped=True)
    assert rows(back) == rows(df)
    strings = files.read_csv_strings(spark, path, header=header, escaped=True)
    assert sorted(map(str, (r[1] for r in rows(strings)))) == sorted(map(str, (r[1] for r in HARD)))
    if header:
        assert rows(files.read_csv_inferred(spark, path, escaped=True)) == rows(df)


def test_json_keeps_hard_values(spark):
    df = generated.literal_rows(spark, HARD, HARD_SCHEMA)
    path = files.write_json_lines(df, scratch_dir(spark, "hard-json"))
    assert rows(files.read_json_lines(spark, path, HARD_SCHEMA)) == rows(df)


def test_text_lines_keep_hard_values(spark):
    df = generated.literal_rows(spark, [("a\rb",), (None,), ("",), ("c\r",)], "t string")
    path = files.write_text_lines(df, "t", scratch_dir(spark, "hard-text"))
    assert rows(files.read_text_lines(spark, path)) == rows(df.filter("t is not null"))


def test_delimited_fields_keep_nulls(spark):
    df = generated.literal_rows(spark, [(None, 1.5), (2, None), (None, None)], "k int, v double")
    lines = df.select(files.delimited("k", "v").alias("line"))
    for lenient in (False, True):
        back = text.parse_fields(lines, "line", {"k": "int", "v": "double"}, lenient=lenient)
        assert rows(back) == rows(df)


def test_typed_reads_are_loud(spark):
    bad = generated.literal_rows(spark, [("1,x",), ("2,3.5",)], "line string")
    path = files.write_text_lines(bad, "line", scratch_dir(spark, "bad-csv"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_csv(spark, path, "k int, v double").collect()
    broken = generated.literal_rows(spark, [('{"k": 1}',), ('{"k": ',)], "line string")
    path = files.write_text_lines(broken, "line", scratch_dir(spark, "bad-json"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_json_lines(spark, path, "k int").collect()


def test_json_and_parquet(spark, people):
    path = files.write_json_lines(people, scratch_dir(spark, "json"))
    assert rows(files.read_json_lines(spark, path).select(*people.columns)) == rows(people)
    assert rows(files.read_json_lines(spark, path, PEOPLE_SCHEMA)) == rows(people)
    path = files.write_parquet(people, scratch_dir(spark, "parquet"))
    files.write_parquet(people, path)
    assert rows(spark.read.parquet(path)) == rows(people)


def test_text_lines(spark):
    df = generated.literal_rows(spark, [("one\ntwo",), ("three",), ("",)], "t string")
    path = files.write_text_lines(df, "t", scratch_dir(spark, "text"))
    assert rows(files.read_text_lines(spark, path)) == [("",), ("one",), ("three",), ("two",)]
