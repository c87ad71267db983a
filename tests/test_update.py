import numpy as np
import pytest

from conftest import SF_SMALL
from fadeclust.operators import (ModelState, UpdateParams, apply_update,
                                 initial_state_from_first, train_step)
from fadeclust.sources import embedding_points

C0 = np.array([[0.0, 0.0], [4.0, 4.0]])
W0 = np.array([1.0, 1.0])


def step(spark, pts, decay, **kw):
    df = spark.createDataFrame([(p,) for p in pts], "features array<double>")
    return train_step(df, ModelState(C0, W0), UpdateParams(decay=decay, **kw))


# hand-computed cases (FIXTURES.md)
@pytest.mark.parametrize("pts,decay,centers,weights", [
    ([[1.0, 1.0], [2.0, 0.0]], 0.5, [[1.2, 0.4], [4, 4]], [2.5, 0.5]),
    ([], 0.5, [[0, 0], [4, 4]], [0.5, 0.5]),
    ([[2.0, 2.0]], 0.5, [[4 / 3, 4 / 3], [4, 4]], [1.5, 0.5]),
    ([[1.0, 1.0], [2.0, 0.0]], 0.0, [[1.5, 0.5], [4, 4]], [2.0, 0.0]),
    ([[1.0, 1.0], [2.0, 0.0]], 1.0, [[1.0, 1 / 3], [4, 4]], [3.0, 1.0]),
])
def test_hand_computed(spark, pts, decay, centers, weights):
    s = step(spark, pts, decay)
    assert np.allclose(s.centers, centers, atol=1e-12)
    assert np.allclose(s.weights, weights, atol=1e-12)
    assert s.batch_id == 0


def _mllib(sc, centers, weights, batches, decay, time_unit="batches"):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors
    m = StreamingKMeansModel([Vectors.dense(c) for c in centers], list(weights))
    for b in batches:
        m = m.update(sc.parallelize([Vectors.dense(p) for p in b], 2), decay, time_unit)
    return np.array([np.asarray(c) for c in m.centers]), np.array(m.clusterWeights)


@pytest.mark.parametrize("time_unit,split,w0", [("batches", False, 0.01),
                                                ("points", False, 0.01),
                                                ("batches", True, 0.0)])
def test_against_mllib(spark, time_unit, split, w0):
    """Cross-check with Spark's own streaming k-means (the DStream path)."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(3, 4))
    batches = [rng.normal(size=(40, 4)) + i * 0.1 for i in range(4)]
    decay = 0.9 if time_unit == "points" else 0.3
    state = ModelState(centers, np.full(3, w0))
    p = UpdateParams(decay=decay, time_unit=time_unit, split_dying=split)
    for b in batches:
        df = spark.createDataFrame([(r.tolist(),) for r in b], "features array<double>")
        state = train_step(df, state, p)
    if split:
        exp_c, exp_w = _mllib(spark.sparkContext, centers, [w0] * 3, batches, decay, time_unit)
    else:
        # MLlib always splits dying clusters; compare the no-split path to the
        # formula applied directly on the driver instead
        exp = ModelState(centers, np.full(3, w0))
        for b in batches:
            d = ((b[:, None, :] - exp.centers[None]) ** 2).sum(-1)
            lab = d.argmin(1)
            stats = [(j, int((lab == j).sum()), b[lab == j].sum(0)) for j in range(3)
                     if (lab == j).any()]
            exp = apply_update(exp, stats, p)
        exp_c, exp_w = exp.centers, exp.weights
    assert np.allclose(state.centers, exp_c, rtol=1e-9, atol=1e-12)
    assert np.allclose(state.weights, exp_w, rtol=1e-9, atol=1e-12)


def test_split_rule_matches_mllib(spark):
    # w0 = 0: a cluster without points in the first batch is split at once
    c, w = _mllib(spark.sparkContext, [[0.0], [100.0]], [0.0, 0.0], [[[1.0]]], 0.3)
    df = spark.createDataFrame([([1.0],)], "features array<double>")
    s = train_step(df, ModelState([[0.0], [100.0]], [0.0, 0.0]),
                   UpdateParams(decay=0.3, split_dying=True))
    assert np.allclose(s.centers, c, rtol=0, atol=1e-15) and np.allclose(s.weights, w)


def test_points_time_unit():
    s = apply_update(ModelState([[0.0], [10.0]], [1.0, 1.0]), [(0, 2, [1.0])],
                     UpdateParams(decay=0.5, time_unit="points"))
    assert s.weights[1] == pytest.approx(0.25)


def test_independent_of_partitioning(spark):
    pts = embedding_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 3, "vec_id", weight=0.01)
    p = UpdateParams(decay=0.3)
    a = train_step(pts.repartition(1), init, p)
    b = train_step(pts.repartition(7).orderBy("label"), init, p)
    assert np.allclose(a.centers, b.centers, rtol=1e-12, atol=1e-15)
    assert np.allclose(a.weights, b.weights)


def test_invalid_params():
    with pytest.raises(ValueError):
        UpdateParams(decay=1.5)
    with pytest.raises(ValueError):
        UpdateParams(time_unit="days")
    with pytest.raises(ValueError):
        ModelState([[0.0]], [-1.0])
    with pytest.raises(ValueError):
        ModelState([[0.0], [1.0]], [1.0])


def test_stats_forms_agree(spark):
    from fadeclust.operators import assign_nearest, cluster_stats
    pts = embedding_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 4, "vec_id")
    lab = assign_nearest(pts, init)
    res = {}
    for form in ("wide", "long", "arrow"):
        rows = cluster_stats(lab, "prediction", "features", 64, form).collect()
        res[form] = {r.label: (r.n, np.array(r.s)) for r in rows}
    for form in ("long", "arrow"):
        assert res[form].keys() == res["wide"].keys()
        for k, (n, s) in res["wide"].items():
            assert res[form][k][0] == n
            assert np.allclose(res[form][k][1], s, rtol=1e-12, atol=1e-12)


def test_drift_is_tracked(spark):
    """Rotating three-cluster table (radius 2.5, noise sd 1/3, 0.02 rad per
    tick, 3 points per cluster and tick) built with spark.range and a fixed
    seed: with forgetting the centers follow the drift."""
    from pyspark.sql import functions as F
    from fadeclust.plans import fit_fold
    ticks, per = 50, 3
    base = spark.range(ticks * 3 * per).select(
        (F.col("id") / (3 * per)).cast("long").alias("tick"),
        (F.col("id") % 3).cast("int").alias("true_label"))
    q = (F.col("tick") * 0.02 + (F.col("true_label") - 1) * (3 * np.pi / 4))
    pts = base.select("tick", "true_label",
                      F.array(2.5 * F.sin(q) + F.randn(1) / 3,
                              2.5 * F.cos(q) + F.randn(2) / 3).alias("features"))
    t0 = np.array([(k - 1) * 3 * np.pi / 4 for k in range(3)])
    init = ModelState(np.c_[2.5 * np.sin(t0), 2.5 * np.cos(t0)], np.full(3, 0.01))
    _, hist = fit_fold(pts, "tick", init, UpdateParams(decay=0.3))
    tl = (ticks - 1) * 0.02 + t0
    truth = np.c_[2.5 * np.sin(tl), 2.5 * np.cos(tl)]
    err = np.linalg.norm(hist[-1].centers - truth, axis=1)
    assert err.max() < 0.8, err
    # without forgetting the model lags behind the drift
    _, hist1 = fit_fold(pts, "tick", init, UpdateParams(decay=1.0))
    err1 = np.linalg.norm(hist1[-1].centers - truth, axis=1)
    assert err1.mean() > err.mean()


def _numpy_fold(X, batches, init_c, init_w, decay):
    C, W = init_c.copy(), init_w.copy()
    for b in sorted(set(batches)):
        pts = X[batches == b]
        d = np.cumsum((pts[:, None, :] - C[None]) ** 2, axis=2)[:, :, -1]
        lab = np.argmin(d, axis=1)
        W = W * decay
        for j in range(len(C)):
            m = int((lab == j).sum())
            if m:
                s = pts[lab == j].sum(0)
                nw = W[j] + m
                lam = m / max(nw, 1e-16)
                W[j] = nw
                C[j] = (1 - lam) * C[j] + (lam / m) * s
    return C, W


@pytest.mark.parametrize("stage", [True, False])
def test_hot_batch_and_hot_label_match_bruteforce(spark, stage):
    """One batch holds a third of all rows and one center attracts most
    points; the Spark fold equals a plain numpy fold of the same table."""
    from pyspark.sql import functions as F
    from fadeclust.plans import fit_fold
    pts = embedding_points(spark, "/root/testdata/sf0.01")
    n = pts.count()
    pts = pts.withColumn("batch", F.when(F.col("vec_id") < n // 3, F.lit(0))
                         .otherwise(1 + F.col("vec_id") % 4))
    rows = pts.select("batch", "features").collect()
    X = np.array([r.features for r in rows])
    B = np.array([r.batch for r in rows])
    mean = X.mean(0)
    init_c = np.stack([mean, mean + 5.0, mean - 5.0])        # center 0 takes nearly all
    init_w = np.array([0.01, 0.01, 0.01])
    _, hist = fit_fold(pts, "batch", ModelState(init_c, init_w), UpdateParams(decay=0.3),
                       stage=stage)
    C, W = _numpy_fold(X, B, init_c, init_w, 0.3)
    assert np.allclose(hist[-1].centers, C, rtol=1e-10, atol=1e-12)
    assert np.allclose(hist[-1].weights, W, rtol=1e-12)
    assert hist[-1].weights[0] > 10 * max(hist[-1].weights[1:])   # the hot label


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=200, deadline=None)
@given(k=st.integers(1, 4), dim=st.integers(1, 3), decay=st.floats(0.0, 1.0),
       seed=st.integers(0, 10_000))
def test_update_equals_closed_form(k, dim, decay, seed):
    """The lambda form of the update equals the closed form of the numpy
    demo, c' = (a*w*c + S) / (a*w + m), w' = a*w + m, for every cluster with
    points; clusters without points only decay."""
    rng = np.random.default_rng(seed)
    C = rng.normal(size=(k, dim))
    W = rng.uniform(0.0, 5.0, size=k)
    stats = []
    for j in range(k):
        m = int(rng.integers(0, 4))
        if m:
            stats.append((j, m, rng.normal(size=dim) * m))
    new = apply_update(ModelState(C, W), stats, UpdateParams(decay=decay))
    for j in range(k):
        hit = [s for s in stats if s[0] == j]
        if hit:
            _, m, S = hit[0]
            exp_c = (decay * W[j] * C[j] + S) / (decay * W[j] + m)
            assert np.allclose(new.centers[j], exp_c, rtol=1e-9, atol=1e-12)
            assert new.weights[j] == pytest.approx(decay * W[j] + m)
        else:
            assert np.array_equal(new.centers[j], C[j])
            assert new.weights[j] == pytest.approx(decay * W[j])


def test_fold_resumes_after_a_crash(spark, monkeypatch):
    """A fold with a checkpoint folder that dies in batch 3 and is run again
    trains only the missing batches and ends equal to an uninterrupted fold."""
    from pyspark.sql import functions as F
    import fadeclust.plans.fold as fold
    from fadeclust.session import fresh_dir
    pts = embedding_points(spark, SF_SMALL).withColumn("batch", F.col("vec_id") % 5)
    init = initial_state_from_first(pts, 3, "vec_id", weight=0.01)
    p = UpdateParams(decay=0.3)
    _, clean = fold.fit_fold(pts, "batch", init, p)
    ck = fresh_dir(spark, "fold-ck")
    real = fold.train_step
    calls = []

    def dying(batch, state, params, features_col, batch_id):
        calls.append(batch_id)
        if batch_id == 3 and calls.count(3) == 1:
            raise RuntimeError("driver lost")
        return real(batch, state, params, features_col, batch_id=batch_id)

    monkeypatch.setattr(fold, "train_step", dying)
    with pytest.raises(RuntimeError):
        fold.fit_fold(pts, "batch", init, p, checkpoint_dir=ck)
    _, resumed = fold.fit_fold(pts, "batch", init, p, checkpoint_dir=ck)
    assert calls == [0, 1, 2, 3, 3, 4]
    for a, b in zip(clean, resumed):
        assert np.array_equal(a.centers, b.centers) and np.array_equal(a.weights, b.weights)


def test_survey_anchor_weights(spark):
    """The anchor measured for the survey: embeddings (sf0.01, 500 x 64),
    k=3, a=0.3, w0=0.01, first three ids as centers, batches vec_id % 3."""
    from pyspark.sql import functions as F
    from fadeclust.plans import fit_fold
    pts = embedding_points(spark, "/root/testdata/sf0.01").withColumn(
        "batch", F.col("vec_id") % 3)
    init = initial_state_from_first(pts, 3, "vec_id", weight=0.01)
    _, hist = fit_fold(pts, "batch", init, UpdateParams(decay=0.3))
    assert np.round(hist[-1].weights, 5).tolist() == [70.50027, 76.38027, 84.25027]


def test_survey_split_anchor(spark):
    """Measured split case: centers 0 and 100, weights 1, a=1e-4, the batch
    {1, 2} twice; the second batch kills cluster 1 and splits cluster 0."""
    p = UpdateParams(decay=1e-4, split_dying=True)
    df = spark.createDataFrame([([1.0],), ([2.0],)], "features array<double>")
    s = ModelState([[0.0], [100.0]], [1.0, 1.0])
    for _ in range(2):
        s = train_step(df, s, p)
    assert np.allclose(s.weights, [1.00010001, 1.00010001], rtol=0, atol=1e-8)
    assert np.allclose(s.centers.ravel(), [1.49999999, 1.49999999], rtol=0, atol=1e-8)
    c, w = _mllib(spark.sparkContext, [[0.0], [100.0]], [1.0, 1.0],
                  [[[1.0], [2.0]], [[1.0], [2.0]]], 1e-4)
    assert np.allclose(s.centers, c, rtol=0, atol=1e-15) and np.allclose(s.weights, w)


def test_history_scoring_forms_agree(spark):
    """One-pass scoring against the per-batch history: the higher-order
    function form and the Arrow form give the same labels and centers."""
    from pyspark.sql import functions as F
    from fadeclust.plans import fit_fold, score_with_history
    pts = embedding_points(spark, SF_SMALL).withColumn("b", F.col("vec_id") % 4)
    init = initial_state_from_first(pts, 3, "vec_id", weight=0.01)
    keys, hist = fit_fold(pts, "b", init, UpdateParams(decay=0.3))
    for order in ("after", "before"):
        got = {}
        for m in ("hof", "arrow"):
            rows = score_with_history(pts, "b", keys, init, hist, order, method=m).select(
                "vec_id", "prediction", "center").collect()
            got[m] = {r.vec_id: (r.prediction, tuple(r.center)) for r in rows}
        assert got["hof"] == got["arrow"] and len(got["hof"]) == pts.count()


def test_string_keys_keep_their_type_and_value(spark):
    """'1', '01' and '' are three batches; nothing is read back as a number."""
    from fadeclust.plans import fit_fold, score_with_history
    from fadeclust.plans.fold import stage_by_batch
    rows = [("1", [1.0, 1.0]), ("01", [2.0, 2.0]), ("", [3.0, 3.0]), ("1", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "b string, features array<double>")
    init = ModelState([[0.0, 0.0], [4.0, 4.0]], [1.0, 1.0])
    staged = stage_by_batch(df, "b")
    assert staged.schema["b"].dataType == df.schema["b"].dataType
    keys, hist = fit_fold(df, "b", init, UpdateParams(decay=0.5))
    assert keys == ["", "01", "1"]
    for method in ("hof", "arrow"):
        assert score_with_history(staged, "b", keys, init, hist, method=method).count() == 4
    plain_keys, plain = fit_fold(df, "b", init, UpdateParams(decay=0.5), stage=False)
    assert plain_keys == keys and np.array_equal(plain[-1].centers, hist[-1].centers)


def test_scoring_rule_is_one_for_both_forms(spark, monkeypatch):
    from fadeclust.plans import fold, score_with_history
    nan = float("nan")
    rows = [(0, 0, [0.1, 0.0]), (1, 0, None), (2, 1, [nan, 1.0]), (3, 1, [None, 1.0]), (4, 2, [9.0, 9.0]), (5, 3, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, b int, features array<double>")
    models = [ModelState([[0.0, float(i)], [9.0, 9.0 + i]], [1.0, 1.0], i) for i in range(4)]
    init = ModelState([[5.0, 5.0], [6.0, 6.0]], [1.0, 1.0])
    out = {}
    for block in (8_000_000, 4):             # one block; one model per block
        monkeypatch.setattr(fold, "BLOCK_HISTORY_VALUES", block)
        for method in ("hof", "arrow"):
            for which in ("after", "before"):
                got = score_with_history(df, "b", [0, 1, 2, 3], init, models, which, method=method)
                assert got.columns == ["id", "b", "features", "prediction", "center"]
                out[block, method, which] = {r.id: (r.prediction, r.center) for r in got.collect()}
    for which in ("after", "before"):
        same = [v for k, v in out.items() if k[2] == which]
        assert all(v == same[0] for v in same) and len(same[0]) == 6
    assert same[0][1] == (0, [5.0, 5.0]) and out[4, "arrow", "after"][2] == (0, [0.0, 1.0])
    bad = spark.createDataFrame([(0, 0, [1.0])], "id int, b int, features array<double>")
    lost = spark.createDataFrame([(0, 9, [1.0, 1.0]), (1, None, [1.0, 1.0])], "id int, b int, features array<double>")
    for method in ("hof", "arrow"):
        with pytest.raises(Exception, match="must have 2 entries"):
            score_with_history(bad, "b", [0, 1, 2, 3], init, models, method=method).collect()
        for row in lost.collect():
            one = lost.filter(f"id = {row.id}")
            with pytest.raises(Exception, match="no model for batch"):
                score_with_history(one, "b", [0, 1, 2, 3], init, models, method=method).collect()


def test_resume_refuses_another_fold(spark):
    from fadeclust.plans import fit_fold
    from fadeclust.session import fresh_dir
    rows = [(2, [1.0, 1.0]), (3, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "b int, features array<double>")
    init = ModelState([[0.0, 0.0], [4.0, 4.0]], [1.0, 1.0])
    d = fresh_dir(spark, "resume")
    keys, hist = fit_fold(df, "b", init, UpdateParams(decay=0.5), checkpoint_dir=d)
    again = fit_fold(df, "b", init, UpdateParams(decay=0.5), checkpoint_dir=d)
    assert again[0] == keys and np.array_equal(again[1][-1].centers, hist[-1].centers)
    late = spark.createDataFrame([(1, [9.0, 9.0])] + rows, "b int, features array<double>")
    other = ModelState([[0.0, 1.0], [4.0, 4.0]], [1.0, 1.0])
    for frame, model, params in ((late, init, UpdateParams(decay=0.5)), (df, init, UpdateParams(decay=0.9)),
                                 (df, other, UpdateParams(decay=0.5))):
        with pytest.raises(ValueError, match="another fold"):
            fit_fold(frame, "b", model, params, checkpoint_dir=d)


def test_only_the_last_model_is_kept_on_request(spark):
    from fadeclust.plans import fit_fold
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "b int, features array<double>")
    init = ModelState([[0.0, 0.0], [4.0, 4.0]], [1.0, 1.0])
    _, every = fit_fold(df, "b", init, UpdateParams(decay=0.5))
    _, last = fit_fold(df, "b", init, UpdateParams(decay=0.5), keep_history=False)
    assert len(every) == 4 and len(last) == 1 and np.array_equal(last[0].centers, every[-1].centers)


def _jobs(spark, run):
    """What ``run`` returns, and how many Spark jobs it took."""
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _many_batches(spark):
    """41 batches of 1 to 27 points with string keys; some points are invalid, the
    whole of batch 7 is."""
    from pyspark.sql import functions as F
    base = spark.range(0, 540, 1, 3).select("id", (F.floor(F.sqrt(F.col("id") * 3))).cast("int").alias("n"))
    x, y = (F.col("id") * 7919 % 101) / 10, (F.col("id") * 104729 % 97) / 10
    odd = [F.lit(None).cast("array<double>"), F.array(), F.array(F.lit(float("nan")), y), F.array(x, F.lit(None).cast("double")),
           F.array(F.lit(float("inf")), y, y)]
    f = F.array(x, y)
    for i, bad in enumerate(odd):
        f = F.when(((F.col("n") == 7) & (F.col("id") % 5 == i)) | (F.col("id") % 23 == i), bad).otherwise(f)
    return base.select("id", F.format_string("%03d", "n").alias("b"), f.alias("features"))


@pytest.mark.parametrize("kw", [{}, {"time_unit": "points"}, {"split_dying": True}])
def test_small_batches_are_folded_in_few_jobs(spark, kw, monkeypatch):
    from fadeclust.plans import fold
    df = _many_batches(spark).persist()
    init, p = ModelState([[0.0, 0.0], [9.0, 2.0], [5.0, 50.0]], [0.01] * 3), UpdateParams(decay=0.7, **kw)
    keys, each = fold.fit_fold(df, "b", init, p, stage=False)
    (got_keys, got), jobs = _jobs(spark, lambda: fold.fit_fold(df, "b", init, p))
    assert len(keys) > 35 and jobs < 20                     # one or more for each batch before
    (staged_keys, staged), jobs = _jobs(spark, lambda: fold.fit_fold(fold.stage_by_batch(df, "b"), "b", init, p))
    assert jobs < 20
    monkeypatch.setattr(fold, "SMALL_BATCH_WORK", 6 * fold.ROW_WORK)     # batches of seven points and more are large
    monkeypatch.setattr(fold, "BLOCK_BATCHES", 5)
    mixed_keys, mixed = fold.fit_fold(df, "b", init, p)
    _, last = fold.fit_fold(df, "b", init, p, keep_history=False)
    assert keys == got_keys == staged_keys == mixed_keys == sorted(keys) and len(last) == 1
    for hist in (got, staged, mixed, each[:-1] + last):
        assert [m.batch_id for m in hist] == list(range(len(keys)))
        for a, b in zip(each, hist):
            assert np.allclose(a.centers, b.centers, rtol=1e-12, atol=1e-12) and np.allclose(a.weights, b.weights, rtol=1e-12)
    df.unpersist()


def test_blocks_take_vectors_and_refuse_what_single_batches_refuse(spark):
    from fadeclust.functions.vectors import to_vector
    from fadeclust.plans import fit_fold
    init = ModelState([[0.0, 0.0], [4.0, 4.0]], [1.0, 1.0])
    df = spark.createDataFrame([(i // 2, [float(i), 1.0]) for i in range(8)], "b int, features array<double>")
    _, arrays = fit_fold(df, "b", init, UpdateParams(decay=0.5))
    _, floats = fit_fold(df.selectExpr("b", "cast(features AS array<float>) AS features"), "b", init, UpdateParams(decay=0.5))
    _, vectors = fit_fold(df.select("b", to_vector("features").alias("features")), "b", init, UpdateParams(decay=0.5))
    for hist in (floats, vectors):
        assert len(hist) == 4 and all(np.array_equal(a.centers, b.centers) for a, b in zip(arrays, hist))
    wide = df.union(spark.createDataFrame([(2, [1.0, 1.0, 1.0])], df.schema))
    with pytest.raises(Exception, match="must have 2 entries"):
        fit_fold(wide, "b", init, UpdateParams(decay=0.5))
    bad = df.union(spark.createDataFrame([(2, [float("nan"), 1.0])], df.schema))
    with pytest.raises(Exception, match="NULL, NaN or Inf"):
        fit_fold(bad, "b", init, UpdateParams(decay=0.5, handle_invalid="error"))
    with pytest.raises(ValueError, match="must not be NULL"):
        fit_fold(df.union(spark.createDataFrame([(None, [1.0, 1.0])], df.schema)), "b", init, UpdateParams(decay=0.5))


def test_blocks_are_bounded(monkeypatch):
    from fadeclust.plans import fold
    rows = [10, 10, 500_000, 10, 90_000, 90_000, 90_000, 90_000, 90_000, 90_000, 90_000]
    blocks = fold.fold_blocks(rows, 3, 2)
    assert [i for b in blocks for i in range(b.first, b.last + 1)] == list(range(len(rows)))
    for b in blocks:
        work = fold.ROW_WORK * sum(rows[b.first:b.last + 1])
        assert work <= fold.BLOCK_WORK if b.small else b.first == b.last and work > fold.SMALL_BATCH_WORK
    assert len(blocks) < len(rows) and len(fold.fold_blocks([1] * 25_000, 1, 1)) == 3
    assert fold.fold_blocks([], 1, 1) == []


@pytest.mark.parametrize("name", ["train_replay", "center_display", "time_unit_points", "model_transform"])
def test_embedding_folds_do_not_run_a_job_for_each_batch(spark, tmp_path, name):
    """40 batches of 200 ids; the job count does not follow their number."""
    from pyspark.sql import functions as F
    from fadeclust.plans.queries import QUERIES
    vec = F.array(*[(F.col("id") * (i + 3) % 89 / 10).cast("float") for i in range(4)])
    spark.range(0, 8_000, 1, 2).select(F.col("id").alias("vec_id"), vec.alias("embedding"), (F.col("id") % 8).cast("int").alias("label")) \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    rows, jobs = _jobs(spark, lambda: QUERIES[name](spark, str(tmp_path)).collect())
    assert len(rows) == {"center_display": 3, "model_transform": 8_000}.get(name, 40 * 3 * 4) and jobs < 25


@pytest.mark.parametrize("small", [3, 1_000])
def test_history_of_small_batches_stays_off_the_driver(spark, small, monkeypatch):
    from fadeclust.plans import fold
    df = _many_batches(spark).filter("id < 24").persist()
    init, p = ModelState([[0.0, 0.0], [9.0, 2.0], [5.0, 50.0]], [0.01] * 3), UpdateParams(decay=0.999, time_unit="points")
    monkeypatch.setattr(fold, "SMALL_BATCH_WORK", small * fold.ROW_WORK)
    monkeypatch.setattr(fold, "BLOCK_BATCHES", 4)
    for params in (p, UpdateParams(decay=0.5, stats_form="long"))[:1 if small == 3 else 2]:
        want = fold.history_df(spark, fold.fit_fold(df, "b", init, params)[1]).collect()
        held, plain = [], fold.history_df
        with monkeypatch.context() as m:
            m.setattr(fold, "history_df", lambda spark, models: held.extend(models) or plain(spark, models))
            got = fold.fold_history(df, "b", init, params).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3 * len({r.b for r in df.select("b").collect()})
        if params is p:
            assert (len(held) == 0) if small == 1_000 else (len(held) > 0)
    df.unpersist()
    assert fold.fold_history(df.filter("id < 0"), "b", init, p).count() == 0


@pytest.mark.parametrize("name", ["train_replay", "time_unit_points"])
def test_embedding_histories_are_read_from_files(spark, tmp_path, name):
    """A batch for each of 60 vectors: their models come from files, not from the driver."""
    from pyspark.sql import functions as F
    from fadeclust.plans.queries import QUERIES
    vec = F.array(*[(F.col("id") * (i + 3) % 89 / 10).cast("float") for i in range(4)])
    spark.range(0, 60, 1, 2).select((F.col("id") * 1_000).alias("vec_id"), vec.alias("embedding"), F.lit(1).alias("label")) \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    assert out.inputFiles() and out.count() == 60 * 3 * 4
