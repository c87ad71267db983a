import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadeclust.llm import periodic_runs as pr
from fadeclust.llm.periodic_runs import WaveletMatrix, periodic_runs


def brute_force(w, least=12):
    """Maximal stretches on which words q apart agree, for every q; the smallest q of each."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def found(values):
    h, ptr = pr.word_hashes(values)
    s, e, q = pr.find_runs(h, ptr, 12)
    k = np.searchsorted(ptr, s, side="right") - 1
    out = [[] for _ in values]
    for i, *run in zip(k.tolist(), (s - ptr[k]).tolist(), (e - s).tolist(), q.tolist()):
        out[i].append(tuple(run))
    return out


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("seed", range(6))
def test_random_periodic_words_match_brute_force(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(pr, "INDEX_WORDS", rnd.choice([50, 400, 1 << 17]))
    monkeypatch.setattr(pr, "_HASH_BYTES", rnd.choice([7, 100, 1 << 20]))
    docs = [[], ["w"], fibonacci(700), ["a"] * 400, list("ab" * 100 + "b" + "ab" * 100), list("aab" * 60 + "aa" + "aab" * 60)]
    for _ in range(150):
        n, letters = rnd.randint(0, 250), rnd.choice([1, 2, 2, 3, 6, 50])
        w = [rnd.randrange(letters) for _ in range(n)]
        for _ in range(rnd.randint(0, 3) if n else 0):
            a = rnd.randrange(n)
            part = w[a:a + 1 + rnd.randrange(max(1, (n - a) // 2 + 1))]
            for i in range(a, min(n, a + rnd.randint(0, n))):
                w[i] = part[(i - a) % len(part)]
        docs.append([f"w{x}" for x in w])
    rnd.shuffle(docs)
    assert found([" ".join(d).encode() for d in docs]) == [brute_force(d) for d in docs]


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 500):
        x = rng.permutation(n)
        tree = WaveletMatrix(x)
        lo = rng.integers(0, n + 1, 200)
        hi = np.maximum(lo, rng.integers(0, n + 1, 200))
        v = rng.integers(0, n + 1, 200)
        below = tree.count_below(lo, hi, v)
        assert below.tolist() == [int((x[a:b] < c).sum()) for a, b, c in zip(lo, hi, v)]
        some = np.flatnonzero(hi > lo)
        k = rng.integers(0, hi[some] - lo[some])
        assert tree.smallest(lo[some], hi[some], k).tolist() == [int(np.sort(x[a:b])[c]) for a, b, c in zip(lo[some], hi[some], k)]


def test_rows_of_all_kinds(spark):
    long = " ".join(str(k % 700) for k in range(3000))
    texts = [None, "", " \t\n", "x " * 11, "x " * 12, "a\x0bb\x0cc\rd\te f a b c d e f", "é É " * 9 + "end", "A a " * 6, "a A a a " * 6, long,
             "one two three four five six seven eight nine ten eleven twelve", "p q r s t u p q r s t u v", " x " * 12]
    rows = [(k if k % 5 else None, t) for k, t in enumerate(texts)] + [(2, texts[4]), (2, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("id", F.lit("x")).withColumn("c0", F.lit(2))
    got = sorted((str(r.id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df.repartition(3)).collect())
    want = []
    for k, t in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = brute_force(w)
        want.append((str(k), len(w), runs, collapsed(w, runs)))
    assert got == sorted(want)


def test_no_rows_string_ids_and_parameters(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([("k", "a b a b a b")], "name string, body string")
    assert [r.runs for r in periodic_runs(df, least=6, doc_id="name", text="body").collect()] == [[(0, 6, 2)]]
    with pytest.raises(ValueError):
        periodic_runs(df, least=5, doc_id="name", text="body")


def test_very_long_texts_take_no_quadratic_time():
    rnd = random.Random(4)
    start = time.time()
    block = [str(rnd.randrange(1000)) for _ in range(70_000)]
    n = 200_000
    assert found([b"w " * n]) == [[(0, n, 1)]]
    assert found([" ".join((block * 3)[:n]).encode()]) == [[(0, n, 70_000)]]
    assert len(found([" ".join(fibonacci(50_000)).encode()])[0]) > 10_000
    assert found([b"x" * 3_000_000 + b" y"]) == [[]]
    assert time.time() - start < 60
