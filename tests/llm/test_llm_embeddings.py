import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkloom.llm import negatives, queries, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, d int, x string, _id int"


def embeddings(spark, rows):
    """Vectors from (vec_id, embedding, label); the other columns have clashing names."""
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], y, "r", 7, "x", 3) for i, v, y in rows]
    return spark.createDataFrame(full, SCHEMA)


def plain_negatives(rows, is_anchor, k=5):
    """Brute force over (vec_id, vector, label); rows are told apart by position."""
    good = [
        (n, i, [math.floor(256 * c) for c in v], y)
        for n, (i, v, y) in enumerate(rows)
        if y is not None and i is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for n, i, a, y in good:
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(a, b)), j, m, z) for m, j, b, z in good if m != n and len(b) == len(a)
        )
        for ps, pid, *_ in [s for s in scored if s[3] == y][:k]:
            ps = -ps
            fitting = [(-s, j) for s, j, _, z in scored if z != y and 80 * ps <= -100 * s <= 100 * ps]
            out += [(i, pid, r, j, ps, s) for r, (s, j) in enumerate(fitting[:k], 1)]
    return sorted(out)


def found_in(frame):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.select(*names).collect())


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 70), st.integers(0, 10**6), st.sampled_from([1.0, 300.0, 1e6]))
def test_scores_lie_between_the_bounds_of_the_segments(d, seed, size):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.standard_normal((2, d)) * size + rng.integers(-2, 3) * size)
    means, deviations = negatives.summaries(x)
    at = 0
    for s in negatives.levels_of(d):
        part = slice(at, at + s)
        middle = means[0, part] @ means[1, part]
        spread = deviations[0, part] @ deviations[1, part]
        slack = 1e-9 * np.linalg.norm(x[0]) * np.linalg.norm(x[1]) + 1
        assert middle - spread - slack <= x[0] @ x[1] <= middle + spread + slack
        at += s


def test_negatives_of_the_table_equal_brute_force(spark):
    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ]
    expected = plain_negatives(rows, lambda i: i % 100 == 0)
    assert found_in(queries.QUERIES["op11_hard_negative_mining"](spark, SF)) == expected
    assert len(expected) > 0


@pytest.mark.parametrize("slice_rows,group_anchors", [(8192, 4096), (40, 7)])
def test_negatives_with_ties_copies_and_rows_that_take_no_part(spark, slice_rows, group_anchors):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((3, 12))
    rows = []
    for i in range(240):
        v = (centers[i % 3] + 0.3 * rng.standard_normal(12)).round(1)
        rows.append((i, v.tolist(), int(rng.integers(0, 3))))
    copies = [(i + 1000, rows[9][1], 1) for i in range(80)] + [rows[10]] * 3
    odd = [
        (500, None, 1), (501, [], 1), (502, [1.0] * 11 + [None], 1), (503, [float("nan")] * 12, 2),
        (504, [float("inf")] + [0.0] * 11, 1), (505, [1.0, 2.0], 0), (510, [1.0, 2.0], 0), (515, [1.5, 1.5], 1),
        (506, [0.0] * 12, 0), (507, rows[0][1], None), (510, [-1.0] * 12, 2), (None, rows[1][1], 2),
    ]
    rows += copies + odd
    expected = plain_negatives(rows, lambda i: i % 5 == 0)
    mined = negatives.hard_negatives(
        embeddings(spark, rows).repartition(3), anchors=F.col("vec_id") % 5 == 0,
        slice_rows=slice_rows, group_anchors=group_anchors,
    )
    assert found_in(mined) == expected
    assert len(expected) > 500


def test_negatives_of_many_tasks_equal_those_of_one(spark):
    """Cells meet whatever tasks their rows are in: nothing merges the partitions here."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(6).round(2).tolist(), int(rng.integers(0, 3))) for i in range(200)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mined = negatives.hard_negatives(
            embeddings(spark, rows), anchors=F.col("vec_id") % 5 == 0, slice_rows=30, group_anchors=9
        )
        assert found_in(mined) == plain_negatives(rows, lambda i: i % 5 == 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_negatives_of_large_components_are_exact(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(120):
        v = rng.standard_normal(40).tolist()
        # Anchors have no share in the large ones, or a small one.
        large = (0.01, 0.0) if i % 5 == 0 else (2.0**41, 1e300) if i % 7 == 3 else (1.0, -1.0)
        rows.append((i, [*v, *large], int(rng.integers(0, 2))))
    expected = plain_negatives(rows, lambda i: i % 5 == 0)
    mined = negatives.hard_negatives(embeddings(spark, rows), anchors=F.col("vec_id") % 5 == 0)
    assert found_in(mined) == expected
    assert any(r[5] > 2**40 for r in expected)


def test_nameless_rows_and_empty_vectors_take_part(spark):
    rows = [(5, [1.0], 1), (6, [1.0], 1), (None, [1.0], 2), (7, [1.0], 2), (10, [], 1), (11, [], 1), (12, [], 3)]
    mined = negatives.hard_negatives(embeddings(spark, rows), anchors=F.col("vec_id") % 5 == 0, nameless=True)
    assert [tuple(r) for r in mined.orderBy("anchor_id", "rank").collect()] == [
        (5, 6, 1, 7, 65536, 65536), (5, 6, 2, None, 65536, 65536), (10, 11, 1, 12, 0, 0),
    ]


def test_a_positive_beyond_a_bigint_is_an_error(spark):
    rows = [(5, [1e20], 1), (6, [1e20], 1), (7, [1e20], 2)]
    mined = negatives.hard_negatives(embeddings(spark, rows), anchors=F.col("vec_id") % 5 == 0)
    with pytest.raises(Exception, match="beyond a bigint"):
        mined.collect()


def test_no_rows_no_negatives(spark):
    none = negatives.hard_negatives(embeddings(spark, []), anchors=F.col("vec_id") % 5 == 0)
    assert none.count() == 0
    one = negatives.hard_negatives(embeddings(spark, [(5, [1.0, 2.0], 1)]), anchors=F.col("vec_id") % 5 == 0)
    assert one.count() == 0


def plain_whitening(x):
    """Eigenvalues, falling, and whitened rows of a covariance built whole."""
    z = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(z.T @ z / len(x))
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return values, z @ vectors / np.sqrt(values), np.trace(z.T @ z / len(x))


def check_whitening(found, ids, vectors):
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float64)) + 100000
    n = len(x)
    values, whitened, trace = plain_whitening(x)
    k = len(values)
    rows = found.sort_values(["vec_id", "component"]).reset_index(drop=True)
    assert len(rows) == n * k
    order = np.argsort(ids, kind="stable")
    ours = rows.whitened.to_numpy().reshape(n, k)
    theirs = whitened[order]
    theirs = theirs * np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - theirs).max() < 1e-7
    assert rows.component.tolist() == list(range(1, k + 1)) * n
    sums = [int(s) for s in x.astype(object).sum(axis=0)]
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x[order]]
    assert rows.deviation.tolist() == [v for v in exact for _ in range(k)]
    assert np.allclose(rows.explained.to_numpy().reshape(n, k), values / trace, rtol=1e-8)
    assert (rows.n == n).all() and rows.identity_error.nunique() == 1
    assert rows.identity_error.iloc[0] < 1e-9


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    found = queries.QUERIES["op13_embedding_whitening"](spark, SF).toPandas()
    check_whitening(found, table.vec_id.to_numpy(), table.embedding.tolist())


def test_whitening_with_copies_and_rows_that_are_dropped(spark):
    rng = np.random.default_rng(8)
    mixed = rng.standard_normal((150, 40)) @ rng.standard_normal((40, 40)) * 0.2
    good = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(1000 + i, mixed[3].tolist()) for i in range(70)]
    odd = [None, [], [0.5] * 39, [float("nan")] * 40, [float("-inf")] * 40, [None] * 40, [1e300] * 40]
    rows = [(i, v, 1) for i, v in good] + [(2000 + i, v, None) for i, v in enumerate(odd)]
    found = whitening.whiten(embeddings(spark, rows).repartition(4)).toPandas()
    check_whitening(found, np.array([i for i, _ in good]), [v for _, v in good])


def test_whitening_of_few_dimensions_and_of_nothing(spark):
    rows = [(i, [i * 0.5, (i % 3) * 1.0], 1) for i in range(20)]
    found = whitening.whiten(embeddings(spark, rows)).toPandas()
    check_whitening(found, np.arange(20), [v for _, v, _ in rows])
    # One direction only, and none.
    line = whitening.whiten(embeddings(spark, [(i, [i * 1.0, i * 2.0], 1) for i in range(9)]))
    assert line.count() == 9 and {r.component for r in line.collect()} == {1}
    assert whitening.whiten(embeddings(spark, [(1, [1.0, 2.0], 1)] * 3)).count() == 0
    assert whitening.whiten(embeddings(spark, [])).count() == 0


@pytest.mark.parametrize("spectrum", [[1e6, 1.0, 1e-3], [5.0] * 6, [3.0, 2.999, 2.998, 1.0], [1.0, 0.0, 0.0]])
def test_leading_pairs_of_uneven_spectra(spectrum):
    rng = np.random.default_rng(2)
    values = np.sort(np.concatenate([spectrum, np.full(60, 1e-4) * rng.random(60) * min(1, spectrum[0])]))[::-1]
    turn = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    matrix = turn * values @ turn.T
    found, vectors, residuals = whitening.leading_pairs(lambda q: matrix @ q, len(values))
    assert np.allclose(found, values[: len(found)], rtol=1e-8, atol=1e-13 * values[0])
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-9 * values[0]


def test_deviations_beyond_a_bigint_are_null():
    x = np.array([[2**40, 0], [0, 1]], dtype=np.int64)
    assert whitening._deviations(x, 2, [2**40, 1]) == [None, None]
    x = np.array([[2**30, 0], [0, 0]], dtype=np.int64)
    assert whitening._deviations(x, 2, [2**30, 0]) == [2**60, 2**60]
