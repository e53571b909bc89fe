import numpy as np
import pytest
from plain import union_find
from pyspark.sql import functions as F

from sparkloom.llm import vectors


def plain(rows):
    """(id, n_links, component_id, kept) of (id, vector) by comparing all pairs."""
    good = {}
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[at] = x / np.abs(x).max()
    links = []
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                    links.append((a, b))
    root = union_find(range(len(rows)), links)
    least = {}
    for at, (i, _) in enumerate(rows):
        least[root[at]] = min(least.get(root[at], i), i)
    count = np.bincount(np.array(links, dtype=int).ravel(), minlength=len(rows))
    return sorted((i, int(count[at]), least[root[at]], i == least[root[at]]) for at, (i, _) in enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns(
        {c: F.lit(None).cast("string") for c in ("label", "node", "vector", "key", "copies")}
    )


def floats(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


@pytest.mark.parametrize("tile", [2048, 16])
def test_groups_equal_plain_ones(spark, tile):
    rng = np.random.default_rng(3)
    rows = []
    for group, size in enumerate([90, 40, 5, 2, 1, 1, 1]):
        center = rng.standard_normal(64)
        for _ in range(size):
            v = center / np.linalg.norm(center) + rng.standard_normal(64) * 0.01
            rows.append((len(rows), floats(v)))
    rows += [(1000 + i, rows[3][1]) for i in range(25)]  # equal vectors
    rows += [(1100, floats(2 * np.array(rows[3][1]))), (1101, floats(-np.array(rows[3][1])))]
    rows += [
        (2000, None), (2001, []), (2002, [0.0] * 64), (2003, [float("nan")] * 64),
        (2004, [float("inf")] + [1.0] * 63), (2005, [None] + [1.0] * 63),
        (2006, [1.0] * 3), (2007, [1.0, 1.0, 1.0001]), (2008, [1e38] * 64), (2009, [1e-38] * 64),
        (2010, floats(rng.standard_normal(130))),
    ]
    rows += [(2011, rows[-1][1]), (2012, [2.0]), (2013, [3.0]), (2014, [-0.0, 1.0]), (2015, [0.0, 1.0])]
    found = vectors.near_vectors(frame(spark, rows), tile=tile)
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_empty_table(spark):
    assert vectors.near_vectors(frame(spark, [])).count() == 0


def test_recall_on_the_test_vectors(spark):
    """The given vectors, a part of them again with noise of several sizes."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.array(given.embedding.tolist(), dtype=np.float32)
    rng = np.random.default_rng(6)
    noise = rng.standard_normal((1200, 64)) * rng.choice([0.01, 0.025, 0.035, 0.04], (1200, 1))
    norm = np.linalg.norm(x[:300], axis=1).mean()
    x = np.concatenate([x, (x[np.arange(1200) % 300] + noise * norm).astype(np.float32)])
    rows = [(i, floats(v)) for i, v in enumerate(x)]
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    found = vectors.near_vectors(frame(spark, rows)).toPandas().set_index("vec_id").sort_index()
    expected = near.sum(axis=1)
    assert expected.sum() > 2000 and (found.n_links.to_numpy() <= expected).all()
    assert found.n_links.sum() >= 0.99 * expected.sum()
    roots = union_find(range(len(x)), np.argwhere(np.triu(near)).tolist())
    assert np.mean([found.component_id[i] == roots[i] for i in range(len(x))]) > 0.99


def test_keys_near_the_threshold():
    """Vectors at a cosine of 0.95 share a key nearly always."""
    rng = np.random.default_rng(11)
    a = vectors.unit(rng.standard_normal((2000, 64)))
    b = rng.standard_normal((2000, 64))
    b = vectors.unit(b - (b * a).sum(axis=1, keepdims=True) * a)
    near = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    keys = [vectors.keys_of(vectors.codes(vectors.rotated(x))[0]) for x in (a, near)]
    assert (keys[0] == keys[1]).any(axis=1).mean() > 0.97


def test_bound_holds_and_estimate_is_unbiased():
    rng = np.random.default_rng(12)
    a = vectors.unit(rng.standard_normal((1500, 64)))
    b = vectors.unit(a + rng.standard_normal((1500, 64)) * 0.1)
    group = vectors.Group(np.concatenate([a, b]), np.ones(3000, np.int64), 0.95)
    i, j = np.arange(1500), np.arange(1500) + 1500
    truth = (a * b).sum(axis=1)
    for slot in (0, 9, 23):
        group.prepare(slot)
        upper = group.upper(i, j)
        assert (upper >= truth).mean() > 0.999
        estimate = upper - group.error[j] - group.rounding[i] / group.factor[j]
        assert abs((estimate - truth).mean()) < 0.02
        far = group.upper(i, np.roll(j, 1))
        assert (far < 0.95).mean() > 0.9
