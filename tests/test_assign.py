import numpy as np
import pytest
from pyspark.errors import PySparkException

from conftest import SF_SMALL
from fadeclust.operators import (ModelState, assign_nearest, attach_center,
                                 initial_state_from_first, predict_point)
from fadeclust.sources import embedding_points, lineitem_points


@pytest.mark.parametrize("loader,order", [(embedding_points, "vec_id"),
                                          (lineitem_points, ["l_orderkey", "l_linenumber"])])
def test_all_forms_agree(spark, loader, order):
    pts = loader(spark, SF_SMALL)
    init = initial_state_from_first(pts, 4, order)
    key = order if isinstance(order, list) else [order]
    res = {}
    for m in ("unrolled", "hof", "arrow"):
        rows = assign_nearest(pts, init, distance_col="d", method=m).select(
            *key, "prediction", "d").collect()
        res[m] = {tuple(r[c] for c in key): (r.prediction, r.d) for r in rows}
    assert res["unrolled"] == res["hof"] == res["arrow"]     # bit-equal


def test_matches_numpy_bruteforce(spark):
    pts = embedding_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 5, "vec_id")
    rows = assign_nearest(pts, init).select("features", "prediction").collect()
    for r in rows:
        d = ((init.centers - np.array(r.features)) ** 2).sum(axis=1)
        assert r.prediction == int(np.argmin(d))


def test_tie_lowest_index_and_nan(spark):
    C = np.array([[0.0, 0.0], [4.0, 4.0], [0.0, 0.0]])
    df = spark.createDataFrame([(1, [2.0, 2.0]), (2, [float("nan"), 1.0]), (3, None)],
                               "id int, features array<double>")
    for m in ("unrolled", "hof", "arrow"):
        out = {r.id: (r.prediction, r.d) for r in
               assign_nearest(df, C, distance_col="d", method=m).collect()}
        assert out[1] == (0, 8.0)
        assert out[2] == (0, float("inf"))        # all distances NaN -> label 0
        assert out[3] == (0, float("inf"))        # keep: NULL labelled 0
        skipped = assign_nearest(df, C, method=m, handle_invalid="skip").collect()
        assert [r.id for r in skipped] == [1]
        with pytest.raises(PySparkException):
            assign_nearest(df, C, method=m, handle_invalid="error").collect()


def test_wrong_dimension_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "features array<double>")
    for m in ("unrolled", "hof", "arrow"):
        with pytest.raises(Exception):
            assign_nearest(df, np.zeros((2, 2)), method=m).collect()


def test_existing_prediction_column_refused(spark):
    df = spark.createDataFrame([([1.0], 0)], "features array<double>, prediction int")
    with pytest.raises(ValueError):
        assign_nearest(df, [[0.0]])


def test_attach_center_literal_and_table(spark):
    st = ModelState(np.array([[0.0, 1.0], [2.0, 3.0]]), np.array([1.0, 1.0]))
    df = spark.createDataFrame([(0,), (1,)], "prediction int")
    a = {r.prediction: r.center for r in attach_center(df, st).collect()}
    b = {r.prediction: r.center for r in attach_center(df, st.to_df(spark)).collect()}
    assert a == b == {0: [0.0, 1.0], 1: [2.0, 3.0]}


def test_predict_point():
    C = np.array([[0.0, 0.0], [4.0, 4.0]])
    assert predict_point(C, [3.0, 3.5]) == 1
    assert predict_point(C, [2.0, 2.0]) == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(k=st.integers(1, 6), dim=st.integers(1, 12), seed=st.integers(0, 1000))
def test_forms_agree_on_random_models(spark, k, dim, seed):
    """Random models on both sides of the unroll threshold: the three forms
    give the same labels and bit-equal distances, and match numpy."""
    rng = np.random.default_rng(seed)
    C = rng.normal(size=(k, dim))
    X = rng.normal(size=(40, dim))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(40)],
                               "id int, features array<double>")
    out = {}
    for m in ("unrolled", "hof", "arrow"):
        rows = assign_nearest(df, C, distance_col="d", method=m).collect()
        out[m] = {r.id: (r.prediction, r.d) for r in rows}
    assert out["unrolled"] == out["hof"] == out["arrow"]
    for i in range(40):
        d = ((C - X[i]) ** 2).sum(axis=1)
        assert out["arrow"][i][0] == int(np.argmin(d))


def test_pruned_search_equals_plain_search():
    """The norm bound only skips centers that cannot be nearest; ties keep the
    lowest index and NaN rows get label 0 and an infinite distance."""
    from fadeclust.operators.assign import nearest_rows
    rng = np.random.default_rng(3)
    for scale in (1.0, 1e-150, 1e6):
        C = rng.normal(size=(200, 5)) * rng.choice([0.1, 1, 30], size=(200, 1)) * scale
        C[50] = C[10]
        X = np.vstack([rng.normal(size=(400, 5)) * 5 * scale, C[:60], [[np.nan] * 5]])
        lab, dist = nearest_rows(X, C)
        d = np.stack([np.cumsum((X - c) ** 2, axis=1)[:, -1] for c in C], axis=1)
        d = np.where(np.isnan(d), np.inf, d)
        assert np.array_equal(lab, d.argmin(1)) and np.array_equal(dist, d.min(1))


def test_center_tables(spark, monkeypatch):
    from fadeclust.operators import assign
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, prediction int")
    big = ModelState(np.arange(600, dtype=float).reshape(3, 200), [1.0] * 3)     # joined, not a literal
    got = assign.attach_center(df, big)
    assert got.columns == ["id", "prediction", "center"]
    assert {r.id: r.center[0] for r in got.collect()} == {i: 200.0 * (i % 3) for i in range(9)}
    table = big.to_df(spark)
    monkeypatch.setattr(assign, "ATTACH_BROADCAST_BYTES", 0)                      # the shuffle join
    assert {r.id: r.center[1] for r in assign.attach_center(df, table).collect()} == {i: 200.0 * (i % 3) + 1 for i in range(9)}
    with pytest.raises(ValueError, match="repeats labels"):
        assign.attach_center(df, table.union(table.limit(1)))
