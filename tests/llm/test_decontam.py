import random

from fadeclust.llm import decontam


def test_search_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, prose(rnd.choice([3, 5, 8, 20, 60]))) for i in range(40)] + [(90, None), (91, ""), (92, "one two"), (None, "alpha beta gamma delta eps zeta")]
    docs = []
    for i in range(150):
        t = prose(rnd.randint(0, 80))
        if i % 3 == 0:
            w = rnd.choice(items[:40])[1].split()
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab).upper()
            t += "\n" + " \t".join(w) + "\x0b" + prose(3)
        docs.append((i, t, "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "ONE  two", "x"), (503, items[3][1], "x"), (503, items[3][1], "x"),
             (None, "alpha beta gamma delta eps zeta eta", "x"), (504, prose(5000), "x")]
    want = []
    for d, t, _ in docs:
        s = decontam.shingle_strings((t or "").encode(), 5)
        for j, u in items:
            q = decontam.shingle_strings((u or "").encode(), 5)
            if q and len(q & s) >= 0.8 * len(q):
                want.append((d, j, len(q), len(q & s)))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (32 << 20, 900):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        got = [tuple(r)[:4] for r in decontam.contaminated(d, b).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    assert len(want) >= 15


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(d, b).count() == 0
