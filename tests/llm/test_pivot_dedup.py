import math

import numpy as np
import pytest

from fadeclust.llm import pivot_dedup
from fadeclust.llm.pivot_dedup import near_vectors


def brute(rows, threshold):
    def ok(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    scaled = [np.array(v, dtype=float) / max(abs(x) for x in v) if ok(v, lab) else None for _, v, lab in rows]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in scaled]
    n = len(rows)
    links, comp = [0] * n, list(range(n))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) \
                    and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    least = {}
    for i, (vid, _, _) in enumerate(rows):
        r = find(i)
        if vid is not None:
            least[r] = min(vid, least.get(r, vid))
    return {(vid, i): (links[i], least.get(find(i))) for i, (vid, _, _) in enumerate(rows)}


def make(seed=0, n=260, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(30)] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 0.25, 1.0])
        rows.append((1000 - i, v.tolist(), int(rng.integers(3))))
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(4)]
    rows += [(3000, None, 1), (3001, [0.0] * dim, 1), (3002, [float("nan")] + [1.0] * (dim - 1), 1), (3003, rows[0][1], None),
             (3004, [None] + [1.0] * (dim - 1), 1), (3005, [1.0, 2.0], 1), (3006, [2.0, 4.0], 1), (3007, [], 1),
             (3008, [float("inf")] * dim, 1), (3009, [1e300] * dim, 2), (3010, [1e-300] * dim, 2)]
    return rows


@pytest.mark.parametrize("block,small,pivots", [(2048, 64, None), (5, 64, 64), (2048, 2, 64)])
def test_links_match_brute_force(spark, monkeypatch, block, small, pivots):
    monkeypatch.setattr(pivot_dedup, "BLOCK", block)
    monkeypatch.setattr(pivot_dedup, "SMALL", small)
    monkeypatch.setattr(pivot_dedup, "BUCKET_ROWS", 500)
    rows = make()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, digest string").repartition(3)
    got = {r.vec_id: r for r in near_vectors(df, pivots=pivots).collect()}
    want = {vid: w for (vid, _), w in brute(rows, 0.93).items()}
    assert set(got) == set(want)
    total = sum(w[0] for w in want.values())
    found = sum(r.n_links for r in got.values())
    assert found <= total and found >= 0.98 * total and total > 100
    for vid, r in got.items():
        assert r.n_links <= want[vid][0] and r.component_id >= want[vid][1] and r.kept == (r.component_id == vid)
    exact = sum((r.n_links, r.component_id) == want[v] for v, r in got.items())
    assert exact >= 0.97 * len(want)
    for vid in (3000, 3001, 3002, 3003, 3004, 3007, 3008):
        assert got[vid].n_links == 0 and got[vid].kept
    assert got[3005].n_links == 1 and got[3006].component_id == 3005 and got[3009].n_links == 1


def test_repeated_and_null_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (5, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (5, 0, 5, True), (None, 2, 1, False)]
    assert near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("pivots", [256, 2048])
def test_recall_in_a_large_noisy_group(spark, pivots):
    rng = np.random.default_rng(3)
    dim, n = 64, 1500
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0] + np.sqrt(0.05 / 0.95 / dim) * rng.normal(size=(n // 3, dim))   # pair cosines about 0.95
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: r for r in near_vectors(df, pivots=pivots).collect()}
    assert want.sum() > 200_000 and all(got[i].n_links <= want[i] for i in range(n))
    assert sum(r.n_links for r in got.values()) >= 0.98 * want.sum()
    assert all(got[i].n_links >= 0.9 * want[i] for i in range(0, n, 3))
    assert {got[i].component_id for i in range(0, n, 3)} == {0}
