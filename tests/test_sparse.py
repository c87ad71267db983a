import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fadeclust.operators.assign import nearest_rows
from fadeclust.operators.sparse import SparseCenters, assign_sparse


def random_rows(rng, n, dim, most):
    rows = []
    for _ in range(n):
        at = np.sort(rng.choice(dim, rng.integers(0, most + 1), replace=False))
        rows.append((at, np.round(rng.normal(size=len(at)), rng.integers(0, 3))))
    return rows


def packed(rows):
    offsets = np.concatenate([[0], np.cumsum([len(a) for a, _ in rows])]).astype(np.int64)
    return offsets, np.concatenate([a for a, _ in rows]).astype(np.int64), np.concatenate([v for _, v in rows])


def dense(rows, dim):
    out = np.zeros((len(rows), dim))
    for i, (a, v) in enumerate(rows):
        out[i, a] = v
    return out


@pytest.mark.parametrize("seed", range(6))
def test_same_as_the_dense_form(seed):
    rng = np.random.default_rng(seed)
    dim = int(rng.integers(3, 60))
    rows = random_rows(rng, 300, dim, min(dim, 6))
    c = np.vstack([dense(rows[:4], dim), rng.integers(-1, 2, (8, dim)), np.zeros((1, dim))]).astype(float)     # many ties
    if seed == 5:
        c[2, 0] = np.nan
        rows[7] = (np.array([0]), np.array([np.inf]))
        rows[8] = (np.array([1]), np.array([np.nan]))
        rows[9] = (np.array([1]), np.array([1e200]))
    with np.errstate(all="ignore"):
        centers = SparseCenters(c)
        label, best = centers.nearest(*packed(rows))
        want_label, want = nearest_rows(dense(rows, dim), c)
    assert np.array_equal(label, want_label) and np.array_equal(best, want)


def test_few_exact_distances_and_large_offsets():
    rng = np.random.default_rng(9)
    rows = random_rows(rng, 500, 2000, 12)
    c = rng.normal(size=(40, 2000))
    centers = SparseCenters(c)
    label, best = centers.nearest(*packed(rows))
    want_label, want = nearest_rows(dense(rows, 2000), c)
    assert np.array_equal(label, want_label) and np.array_equal(best, want)
    assert centers.exact < 1.2 * len(rows)          # one each, and a few near ties
    c = rng.normal(size=(10, 50)) * 1e-4 + 1e6      # the expansion cancels: exact distances decide
    rows = random_rows(rng, 100, 50, 50)
    label, best = SparseCenters(c).nearest(*packed(rows))
    want_label, want = nearest_rows(dense(rows, 50), c)
    assert np.array_equal(label, want_label) and np.array_equal(best, want)


def test_wide_vectors_in_a_query(spark):
    dim = 200_000
    rng = np.random.default_rng(4)
    rows = random_rows(rng, 60, dim, 8)
    c = dense(rows[:3], dim)
    data = [(i, Vectors.sparse(dim, a.tolist(), v.tolist())) for i, (a, v) in enumerate(rows)] + [(99, None)]
    df = spark.createDataFrame(data, ["id", "features"])
    got = {r.id: (r.prediction, r.distance) for r in assign_sparse(df.repartition(2), c, distance_col="distance").collect()}
    want_label, want = nearest_rows(dense(rows, dim), c)
    assert got.pop(99) == (0, float("inf"))
    assert got == {i: (int(a), float(b)) for i, (a, b) in enumerate(zip(want_label, want))}


def test_mixed_vectors_and_sizes(spark):
    rows = [(0, Vectors.dense([1.0, 2.0, 0.0])), (1, Vectors.sparse(3, [1], [2.0])), (2, Vectors.sparse(3, [], []))]
    df = spark.createDataFrame(rows, ["id", "features"])
    c = np.array([[0.0, 0.0, 0.0], [1.0, 2.0, 0.0]])
    got = sorted((r.id, r.prediction, r.d) for r in assign_sparse(df, c, distance_col="d").collect())
    assert got == [(0, 1, 0.0), (1, 1, 1.0), (2, 0, 0.0)]
    with pytest.raises(Exception, match="3 entries"):
        assign_sparse(spark.createDataFrame([(0, Vectors.sparse(4, [1], [2.0]))], ["id", "features"]), c).collect()
    with pytest.raises(ValueError):
        assign_sparse(df.withColumn("prediction", F.lit(1)), c)
