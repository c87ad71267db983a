import numpy as np
import pytest

from fadeclust.operators.assign import assign_nearest, nearest_rows
from fadeclust.operators.center_index import CenterIndex
from fadeclust.operators.model import ModelState


def embeddings(sf):
    import pyarrow.parquet as pq
    t = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pandas().sort_values("vec_id")
    return np.stack(t.embedding).astype(float)


def same(x, c, index=None):
    index = index or CenterIndex(c)
    label, best = index.nearest(x)
    want_label, want = nearest_rows(x, c)
    assert np.array_equal(label, want_label) and np.array_equal(best, want)
    return index


def test_embeddings_with_500_centers_compare_less_than_a_fifth():
    x = embeddings("sf0.01")
    index = same(x, x[:500])
    assert index.useful and index.compared < len(x) * 500 / 5


def test_clustered_points_compare_less_than_a_fifth():
    rng = np.random.default_rng(0)
    c = rng.normal(size=(500, 64))
    x = c[rng.integers(0, 500, 3000)] + 0.1 * rng.normal(size=(3000, 64))
    index = same(x, c)
    assert index.compared < 3000 * 500 / 5
    low = rng.uniform(-1, 1, (800, 2))
    index = same(rng.uniform(-1, 1, (3000, 2)), low)
    assert index.compared < 3000 * 800 / 5


def test_where_bounds_do_not_help_the_index_is_given_up():
    x = embeddings("sf0.1")
    index = CenterIndex(x[:500])
    for a in range(0, len(x), 500):
        same(x[a:a + 500], x[:500], index)
    same(np.random.default_rng(1).normal(size=(1000, 64)), x[:500], index)
    assert not index.useful


@pytest.mark.parametrize("seed", range(8))
def test_ties_repeats_and_odd_values(seed):
    rng = np.random.default_rng(seed)
    c = rng.integers(-2, 3, (90, 3)).astype(float)       # many equal centers
    x = rng.integers(-3, 4, (400, 3)) / rng.choice([1.0, 2.0])
    x[::37] = np.nan
    x[5::41, 1] = np.inf
    x[7::43, 2] = np.nan
    x[11::47] = 1e200
    with np.errstate(all="ignore"):
        same(x, c)
        c[3, 1], c[17, 0] = np.nan, np.inf
        index = CenterIndex(c)
        assert not index.useful                             # such a model is compared whole
        same(rng.normal(size=(50, 3)) * 1e-160, np.vstack([np.zeros((70, 3)), rng.normal(size=(10, 3)) * 1e-160]))
        same(rng.normal(size=(200, 5)) + 1e8, rng.normal(size=(100, 5)) + 1e8)


def test_arrow_form_uses_the_index(spark):
    x = embeddings("sf0.001")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None)], "id int, features array<double>").repartition(3)
    rng = np.random.default_rng(2)
    c = x[:120] + 0.01 * rng.normal(size=(120, 64))
    want_label, want = nearest_rows(x, c)
    got = {r.id: (r.prediction, r.distance) for r in assign_nearest(df, ModelState(c, np.ones(120)), distance_col="distance", method="arrow").collect()}
    assert got.pop(9000) == (0, float("inf"))
    assert got == {i: (int(a), float(b)) for i, (a, b) in enumerate(zip(want_label, want))}
