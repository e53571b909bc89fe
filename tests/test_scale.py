"""Skewed input: right and whole results, and no group left in one piece."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkloom.functions.numbers import exact_sum, sum_of_units
from sparkloom.operators import joins, keyed, placement, regression, sizes
from spark_settings import settings


def make(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture
def skewed():
    """A key with a third of the rows, one with many copies, NULLs as key and value."""
    rng = random.Random(5)
    rows = [("hot", rng.randrange(500)) for _ in range(1000)]
    rows += [("copies", 7)] * 500
    rows += [(None, rng.randrange(50)) for _ in range(300)]
    rows += [("gaps", None)] * 150 + [("gaps", 1)] * 3
    rows += [(f"k{rng.randrange(400)}", rng.randrange(9)) for _ in range(900)]
    return rows


def bags(rows):
    found = defaultdict(Counter)
    for key, value in rows:
        found[key][value] += 1
    return found


def unpacked(entries):
    return Counter({e["value"]: e["copies"] for e in entries})


def test_value_lists_in_slices_are_whole_and_sorted(spark, skewed):
    df = make(spark, skewed, "k string, v int")
    found, lists = defaultdict(Counter), defaultdict(dict)
    for row in keyed.group_values(df, "k", "v", F.expr("v div 100")).collect():
        found[row["k"]].update(unpacked(row["values"]))
        lists[row["k"]][row["slice"]] = [e["value"] for e in row["values"]]
    assert found == bags(skewed)
    assert len(lists["hot"]) == 5 and lists["copies"] == {0: [7]}
    assert lists["gaps"] == {None: [None], 0: [1]}
    for slices in lists.values():
        values = [v for s in sorted(slices, key=lambda s: (s is None, s)) for v in slices[s]]
        assert values == sorted(values, key=lambda v: (v is None, v))


def test_one_slice_by_default(spark, skewed):
    groups = keyed.group_values(make(spark, skewed, "k string, v int"), "k", "v").collect()
    assert {r["k"]: unpacked(r["values"]) for r in groups} == bags(skewed)
    assert all(r["slice"] == 0 and (r["values"][-1]["value"] is None) == (r["k"] == "gaps") for r in groups)


def test_value_lists_keep_odd_doubles(spark):
    values = [0.0, -0.0, -0.0, float("nan"), float("nan"), None, float("-inf"), 1.5, -0.0]
    df = make(spark, [("k", v) for v in values], "k string, v double")
    (row,) = keyed.group_values(df, "k", "v").collect()
    assert [(repr(e["value"]), e["copies"]) for e in row["values"]] == [
        ("-inf", 1), ("-0.0", 3), ("0.0", 1), ("1.5", 1), ("nan", 2), ("None", 1),
    ]
    both = keyed.cogroup_values(df, df, "k", "v", "v").first()
    assert repr(both["left_values"]) == repr(both["right_values"]) == repr(row["values"])


def test_hot_key_of_value_lists_equals_sql(spark):
    import duckdb

    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        (F.col("id") * 7919 % 65_537).alias("v"),
    )
    local = rows.toArrow()
    groups = keyed.group_values(rows.repartition(8), "k", "v", F.expr("v div 4096"))
    text = F.array_join(F.transform("values", lambda e: F.concat_ws("x", e["value"], e["copies"])), ",")
    ours = {tuple(r) for r in groups.select("k", "slice", text).collect()}
    theirs = duckdb.sql("""
        SELECT k, v // 4096, string_agg(v || 'x' || n, ',' ORDER BY v)
        FROM (SELECT k, v, count(*) AS n FROM local GROUP BY ALL) GROUP BY ALL
    """).fetchall()
    assert local.num_rows == 200_000 and ours == set(theirs)


def test_cogroup_of_sliced_groups_and_null_keys(spark, skewed):
    other = [("hot", f"w{i}") for i in range(250)] + [("only", "x"), ("k1", "y"), (None, "z")]
    groups = keyed.cogroup_values(
        make(spark, skewed, "k string, v int"),
        make(spark, other, "k string, w string"),
        "k", "v", "w", F.expr("v div 100"), F.expr("length(w)"),
    ).collect()
    lefts, rights = defaultdict(Counter), defaultdict(Counter)
    for row in groups:
        lefts[row["k"]].update(unpacked(row["left_values"]))
        rights[row["k"]].update(unpacked(row["right_values"]))
    assert {k: c for k, c in lefts.items() if c} == bags(skewed)
    assert {k: c for k, c in rights.items() if c} == bags(other)
    assert len({(r["k"], r["slice"]) for r in groups}) == len(groups)
    whole = keyed.cogroup_values(
        make(spark, [(None, 1), ("a", 2)], "k string, v int"),
        make(spark, [(None, "x"), ("b", "y")], "k string, w string"), "k", "v", "w",
    )
    found = {r["k"]: (unpacked(r["left_values"]), unpacked(r["right_values"])) for r in whole.collect()}
    assert found == {None: ({1: 1}, {"x": 1}), "a": ({2: 1}, {}), "b": ({}, {"y": 1})}
    assert whole.count() == 3


def test_pair_counts_are_those_of_the_join(spark):
    rng = random.Random(1)

    def key():
        return "t0" if rng.random() < 0.4 else f"t{rng.randrange(9)}"

    left = [(key(), rng.choice("abc")) for _ in range(400)]
    right = [(key(), rng.choice("xy")) for _ in range(300)]
    left.append((None, "a"))
    right.append((None, "x"))
    lefts = make(spark, left, "t string, g string")
    rights = make(spark, right, "t string, h string")
    expected = Counter((g, h) for t, g in left for s, h in right if t is not None and t == s)
    found = joins.pair_counts(lefts, rights, "t", "g", "h").collect()
    assert {(r["g"], r["h"]): r["pairs"] for r in found} == expected


def brute_band(rows, tolerance):
    pools = defaultdict(list)
    for group, model, size, _ in rows:
        for _, other_model, other_size, price in rows:
            if model is None or model != other_model or size is None or other_size is None:
                continue
            if price is not None and abs(size - other_size) <= Decimal(tolerance):
                pools[group].append(price)
    return {g: float(sum(p)) / len(p) for g, p in pools.items() if p}


@pytest.mark.parametrize("tolerance", ["0.1", "0.03", "2.5", "0", "0.0000001", "100"])
@pytest.mark.parametrize("unique", [False, True])
def test_band_average_against_brute_force(spark, tolerance, unique):
    rng = random.Random(int(Decimal(tolerance) * 100))
    rows = []
    for i in range(250):
        model = "hot" if rng.random() < 0.5 else rng.choice(["m1", "m2", "m3", None])
        size = Decimal("1.00") if rng.random() < 0.3 else Decimal(rng.randrange(-100, 400)) / 100
        price = rng.choice([None, Decimal(rng.randrange(10**4)) / 1000])
        rows.append((f"r{i if unique else rng.randrange(80)}", model, size, price))
    rows += [("null-size", "hot", None, Decimal("9.99")), ("alone", "nowhere", Decimal("1.00"), None)]
    df = make(spark, rows, "registration string, model string, size decimal(10,2), price decimal(18,3)")
    found = joins.band_average(
        df.withColumns({"total": F.col("price"), "n": F.col("price").isNotNull().cast("bigint")}),
        ["model"], "size", tolerance, "registration", unique_groups=unique,
    ).collect()
    assert len(found) == len({r["registration"] for r in found})
    assert {r["registration"]: r["average"] for r in found} == pytest.approx(brute_band(rows, tolerance))


def test_measure_of_the_band_average_is_not_rounded(spark):
    prices = spark.createDataFrame([("a", 10.004), ("a", 10.004)], "k string, x double")
    state = keyed.average_state(prices, "k", "x", scale=6)
    assert state.select(keyed.finish_average()).first()[0] == 10.004


def test_wide_tolerance_takes_no_longer(spark):
    """20,000 cells of one key."""
    import time

    rows = spark.range(20_000).select(
        "id", F.lit("m").alias("model"), (F.col("id") / 100).cast("decimal(10,2)").alias("size"),
        F.col("id").cast("decimal(18,0)").alias("total"), F.lit(1).cast("bigint").alias("n"),
    )
    took = {}
    for tolerance in ("0.1", "0.1", "100"):
        start = time.perf_counter()
        found = joins.band_average(rows, ["model"], "size", tolerance, "id", unique_groups=True)
        middle = found.filter("id = 10000").first()["average"]
        # At 100 all cells are near.
        assert middle == (9999.5 if tolerance == "100" else 10_000) and found.count() == 20_000
        took[tolerance] = time.perf_counter() - start
    assert took["100"] < 2 * took["0.1"] + 2


def test_distribute_by_deals_each_key_over_its_pieces(spark):
    rows = [("hot", float(i)) for i in range(2000)] + [(None, -0.0)] * 50 + [("nan", float("nan"))] * 3
    rows += [(f"k{i % 300}", float(i)) for i in range(3000)]
    df = make(spark, rows, "k string, v double")
    # AQE would merge the small partitions of a test into one.
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        for pieces in (1, 4):
            spread_by = ["v"] if pieces > 1 else []
            placed = placement.distribute_by(df, ["k"], pieces, spread_by)
            assert Counter(map(repr, placed.collect())) == Counter(map(repr, df.collect()))
            by_key = defaultdict(dict)
            for r in placement.rows_by_partition(placed, "k").collect():
                by_key[r["k"]][r["partition"]] = r["rows"]
            assert all(len(p) <= pieces for p in by_key.values())
            assert sum(by_key["hot"].values()) == 2000
            assert (max(by_key["hot"].values()) < 1500) == (pieces > 1)
    for pieces, spread_by in ((0, []), (1, ["v"]), (3, [])):
        with pytest.raises(ValueError):
            placement.distribute_by(df, ["k"], pieces, spread_by)


def test_keys_in_one_partition_is_a_real_check(spark):
    from sparkloom.plans.placement_queries import _partitions_of_keys

    df = make(spark, [(i % 40,) for i in range(4000)], "user_id int")
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        by_key = _partitions_of_keys(placement.place_by_key(df, 8, "user_id"), "user_id")
        assert {(r["partitions"], r["events"]) for r in by_key.collect()} == {(1, 100)}
        dealt = _partitions_of_keys(df.repartition(8), "user_id").collect()
        assert max(r["partitions"] for r in dealt) > 1


def test_cluster_by_sorts_within_partitions(spark, skewed):
    df = make(spark, skewed, "k string, v int")
    clustered = placement.cluster_by(df, ["k"], 3, ["v"])
    ranked = clustered.select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"), "k"
    ).collect()
    for p in {r["p"] for r in ranked}:
        keys = [r["k"] or "" for r in sorted(ranked, key=lambda r: r["at"]) if r["p"] == p]
        assert keys == sorted(keys)
    assert Counter(map(tuple, clustered.collect())) == Counter(skewed)


def test_broadcast_only_below_the_limit(spark):
    df = make(spark, [(i, "x" * 10) for i in range(1000)], "id int, t string")
    assert sizes.measured(df) == (1000, sum(len(str(i)) + 10 + 32 for i in range(1000)))
    assert sizes.measured(df.limit(0)) == (0, 0)
    other = spark.range(5000).withColumn("id", F.col("id") % 1000)

    def plan(side):
        return other.join(side, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(sizes.broadcast_if_small(df))
    assert "strategy=broadcast" not in plan(sizes.broadcast_if_small(df, max_rows=999))
    assert "strategy=broadcast" not in plan(sizes.broadcast_if_small(df, max_bytes=10_000))


def test_band_average_of_one_hot_cell(spark):
    # Joined row by row this would be over a trillion pairs.
    n = 1_200_000
    rows = spark.range(n).select(
        "id", F.lit("m").alias("model"), F.lit(Decimal("1.00")).alias("size"),
        (F.col("id") % 3).cast("decimal(18,2)").alias("total"), F.lit(1).cast("bigint").alias("n"),
    )
    found = joins.band_average(rows, ["model"], "size", "0.1", "id", unique_groups=True)
    count, low, high = found.agg(F.count("*"), F.min("average"), F.max("average")).first()
    assert (count, low, high) == (n, pytest.approx(1.0), pytest.approx(1.0))


def test_pair_counts_of_one_hot_key(spark):
    rows = spark.range(200_000).select(F.lit("t").alias("t"), (F.col("id") % 2).alias("g"))
    found = joins.pair_counts(rows, rows.withColumnRenamed("g", "h"), "t", "g", "h").collect()
    assert {(r["g"], r["h"]): r["pairs"] for r in found} == {
        (g, h): 100_000**2 for g in (0, 1) for h in (0, 1)
    }


def test_million_values_of_one_key(spark):
    rows = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    groups = keyed.group_values(rows, "k", "v", F.expr("v div 65536"))
    total = F.aggregate("values", F.lit(0).cast("bigint"), lambda a, e: a + e["value"] * e["copies"])
    lists, longest, values, sums = groups.select(F.size("values").alias("n"), total.alias("s")).agg(
        F.count("*"), F.max("n"), F.sum("n"), F.sum("s")
    ).first()
    assert (lists, longest, values, sums) == (16, 65_536, 1_000_000, 999_999 * 500_000)


def test_sums_beyond_a_bigint(spark):
    odd = [2**63 - 1, -(2**63), 9_223_372_036 * 10**9, -1, 999_999_999, -(10**9) - 1, 5] * 3
    frame = spark.createDataFrame([(v,) for v in [*odd, None]], "u bigint")
    assert frame.agg(sum_of_units(F.col("u"))).first()[0] == sum(odd)
    rows = spark.range(200).select((F.lit(9 * 10**16) + F.col("id") * 16).cast("double").alias("x"))
    units = spark.range(40).select((F.lit(9 * 10**18) + F.col("id")).alias("u"))
    assert units.agg(sum_of_units(F.col("u"))).first()[0] == sum(9 * 10**18 + i for i in range(40))
    minus = units.select((-F.col("u")).alias("u"))
    assert minus.agg(sum_of_units(F.col("u"))).first()[0] == -sum(9 * 10**18 + i for i in range(40))
    assert rows.agg(exact_sum(F.col("x"), 0)).first()[0] == sum(9 * 10**16 + i * 16 for i in range(200))
    products = regression.gram(
        spark.range(4000), {"a": F.lit(3e7), "b": F.lit(2e7)}, scale=2
    ).collect()
    assert {(r["i"], r["j"]): r["v"] for r in products}[0, 1] == 4000 * 6e14


def test_pair_counts_beyond_a_bigint(spark):
    rows = spark.range(10).select(F.lit("t").alias("t"), F.lit("g").alias("g"), F.lit("h").alias("h"))
    counted = joins.pair_counts(rows, rows, "t", "g", "h")
    assert dict(counted.dtypes)["pairs"] == "decimal(38,0)" and counted.first()["pairs"] == 100


def test_exact_sum_does_not_depend_on_the_order(spark):
    rng = random.Random(9)
    cents = [rng.randrange(-10**9, 10**9) for _ in range(5000)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "x double")
    for parts in (1, 7):
        total = df.repartition(parts).agg(exact_sum(F.col("x")).alias("s")).first()["s"]
        assert total == Decimal(sum(cents)) / 100
