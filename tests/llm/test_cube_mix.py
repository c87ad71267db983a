import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fadeclust.llm import cube_mix
from fadeclust.llm.cube_mix import mix

SCHEMA = "doc_id long, text string, source string"


def targets(sizes, weights, share=1.0, most=3):
    """Sources in code-point order, null last; the excess over a cap goes round again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
            free.remove(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def words(text):
    return len([w for w in re.split("[\x20\x09-\x0d]+", text or "") if w])


def check(df, docs, weights=(5, 2, 1), share=1.0, most=3):
    rows = df.collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(d[0]) for d in docs)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    want = targets(sizes, weights, share, most)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= most
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    return rows, taken, want


def corpus(n, seed=0, sources=("a", "b", "c", "é", "Z", None)):
    rnd = random.Random(seed)
    return [(k, "w " * int(rnd.paretovariate(1.4) * 3) if k % 17 else None, sources[min(int(rnd.expovariate(0.7)), len(sources) - 1)]) for k in range(n)]


def test_targets_totals_and_number_of_documents(spark):
    docs = corpus(3000)
    docs = [(k, t if words(t) < 20000 else "w " * 20000, s) for k, t, s in docs]
    rows, taken, want = check(mix(spark.createDataFrame(docs, SCHEMA).repartition(7)), docs)
    number, share = defaultdict(int), defaultdict(int)
    for r in rows:
        number[r.source] += 1
        share[r.source] += r.copies
    for s, n in number.items():
        assert n < 200 or abs(taken[s] - want[s]) <= 0.01 * want[s]
        size = next(r.source_size for r in rows if r.source == s)
        assert abs(share[s] - n * want[s] / size) <= 0.02 * n + 3


def test_caps_zero_sources_ties_and_repeats(spark):
    docs = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "x " * 40, "t"), (None, "x " * 40, "t"), (5, "", "empty"), (6, None, "empty"),
            (7, "one", "u"), (8, "one", "u"), (9, "one", "u"), (10, "y " * 500, "v"), (11, " \x0b\x0c\t\r\n", None), (12, "é b", None)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("size", F.lit("x")).withColumn("sid", F.lit(1)).withColumn("p", F.lit(2))
    rows, taken, want = check(mix(df), docs)
    assert want["s"] == 18 and taken["s"] == 18 and want["empty"] == 0    # three times 2 x 3 words


def test_no_rows_one_row_and_parameters(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [(r.target, r.taken) for r in mix(spark.createDataFrame([(1, "a b", "s")], SCHEMA)).collect()] == [(2.0, 2)]
    assert [(r.target, r.taken) for r in mix(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()] == [(0.0, 0)]
    docs = corpus(400, 3)
    check(mix(spark.createDataFrame(docs, SCHEMA), (1, 1, 4), 0.3, 2), docs, (1, 1, 4), 0.3, 2)
    with pytest.raises(ValueError):
        mix(spark.createDataFrame(docs, SCHEMA), share=4)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(corpus(2000, 5), SCHEMA)
    one = {r.doc_id: r.taken for r in mix(docs.repartition(3)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert {r.doc_id: r.taken for r in mix(docs.repartition(11, F.rand())).collect()} == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.doc_id: r.taken for r in mix(docs, seed=1).collect()} != one


def test_levels_of_runs(spark, monkeypatch):
    """Small runs: open documents go through several levels; a source with most of the rows."""
    monkeypatch.setattr(cube_mix, "RUN_ROWS", 40)
    docs = [(k, "w " * (1 + k * 7919 % 97), "hot" if k % 3 else f"s{k % 12}") for k in range(4000)]
    rows, taken, want = check(mix(spark.createDataFrame(docs, SCHEMA)), docs)
    assert all(abs(taken[s] - want[s]) <= 6 for s in want)


def test_flight_keeps_expectations():
    """Over many seeds each document is taken as often as its probability says."""
    hits, n = defaultdict(int), 3000
    sizes = [1, 1, 2, 3, 5, 8, 13, 400, 2, 2, 7, 9, 30, 31, 32, 33]
    for seed in range(n):
        run = cube_mix._Run((0, 0), str(seed))
        done = [d for i, s in enumerate(sizes) for d in run.add([0, 0, s, 0.3, 0.3, i])]
        rest = run.open
        assert sum(r[4] for r in done + rest) == pytest.approx(0.3 * len(sizes))
        assert sum(r[4] * r[2] for r in done + rest) == pytest.approx(0.3 * sum(sizes))
        for r in done + rest:
            hits[r[5]] += r[4]
    assert all(abs(h / n - 0.3) < 0.04 for h in hits.values())
