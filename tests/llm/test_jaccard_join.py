import random

from fadeclust.llm import jaccard_join, work
from fadeclust.llm.decontam import shingle_strings
from fadeclust.llm.graph import components


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(docs, k, percent):
    sets = {d: shingle_strings((t or "").encode(), k) for d, t in docs}
    parent = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(parent, d)) for d in sets}


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    base = [prose(rnd.choice([4, 12, 40, 120])) for _ in range(12)]
    docs = []
    for i in range(260):
        w = list(rnd.choice(base)) if i % 2 else prose(rnd.randint(0, 50))
        for _ in range(rnd.randint(0, max(1, len(w) // 40 + 1))):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
        if i % 5 == 0:
            w = w + ["shared", "tail", "of", "many", "documents", "here"]
        docs.append((1000 - i, " ".join(w)))
    # a chain: each links with the next only
    chain = prose(60)
    for i in range(12):
        docs.append((2000 + i, " ".join(chain)))
        chain = chain[2:] + prose(2)
    docs += [(3000, None), (3001, ""), (3002, "only two"), (3003, "ONLY  two"), (3004, "\t \n")]
    return docs


def test_components_match_brute_force(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in docs] + [(1000, docs[0][1], 1), (None, docs[0][1], 1)],
                               "doc_id long, text string, component long").repartition(4)
    for k, percent, shipped in ((4, 85, 48 << 20), (5, 80, -1)):
        monkeypatch.setattr(work, "BROADCAST_BYTES", shipped)
        want = brute(docs, k, percent)
        rows = jaccard_join.jaccard_components(df, k=k, percent=percent).collect()
        assert len(rows) == len(docs) + 2
        for r in rows:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert len({c for _, c in want.values()}) < len(docs) - 60


def test_empty(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}
