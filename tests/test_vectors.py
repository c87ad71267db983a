import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fadeclust.functions import (to_array, to_vector, vec_axpy, vec_dot, vec_norm,
                                 vec_scale, vec_sqdist, vec_sqdist_lower_bound,
                                 vec_zeros)


@pytest.fixture(scope="module")
def vecs(spark):
    rows = [(1, [1.0, 2.0, 3.0], [0.5, -1.0, 4.0]),
            (2, [0.0, 0.0, 0.0], [1.0, 1.0, 1.0]),
            (3, None, [1.0, 2.0, 3.0])]
    return spark.createDataFrame(rows, "id int, a array<double>, b array<double>")


def test_norm_dot_sqdist(vecs):
    r = {x.id: x for x in vecs.select(
        "id", vec_norm("a").alias("n"), vec_dot("a", "b").alias("d"),
        vec_sqdist("a", "b").alias("s")).collect()}
    a, b = np.array([1.0, 2.0, 3.0]), np.array([0.5, -1.0, 4.0])
    assert r[1].n == pytest.approx(np.linalg.norm(a))
    assert r[1].d == pytest.approx(a @ b)
    assert r[1].s == pytest.approx(((a - b) ** 2).sum())
    assert r[2].n == 0.0 and r[2].s == 3.0
    assert r[3].d is None and r[3].s is None      # NULL vector -> NULL


def test_axpy_scale_zeros(vecs):
    r = vecs.filter("id = 1").select(
        vec_axpy(2.0, "a", "b").alias("ax"), vec_scale(-1.5, "a").alias("sc"),
        vec_zeros(F.size("a")).alias("z"), vec_zeros(2).alias("z2")).first()
    assert r.ax == [2.5, 3.0, 10.0]
    assert r.sc == [-1.5, -3.0, -4.5]
    assert r.z == [0.0, 0.0, 0.0] and r.z2 == [0.0, 0.0]


def test_lower_bound_below_distance(spark):
    rng = np.random.default_rng(1)
    rows = [(rng.normal(size=5).tolist(), rng.normal(size=5).tolist()) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    out = df.select(vec_sqdist("a", "b").alias("d"),
                    vec_sqdist_lower_bound(vec_norm("a"), vec_norm("b")).alias("lb")).collect()
    assert all(r.lb <= r.d + 1e-12 for r in out)


def test_size_mismatch_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(PySparkException):
        df.select(vec_dot("a", "b")).collect()


def test_vector_roundtrip(vecs):
    r = vecs.filter("id = 1").select(to_array(to_vector("a")).alias("a")).first()
    assert r.a == [1.0, 2.0, 3.0]
