import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fadeclust.llm import lm_score


def brute(docs, order, prior):
    """The recursive definition over plain dictionaries."""
    toks = {d: [*(t or "").encode().lower().split(), None] for d, t, _ in docs}
    counts, n = Counter(), 0
    for d, _, train in docs:
        if train:
            t = toks[d]
            n += len(t)
            for m in range(1, order + 1):
                counts.update(tuple(t[i:i + m]) for i in range(len(t) - m + 1))
    v = sum(len(k) == 1 for k in counts)

    def p(ctx, w):
        if not ctx:
            return (counts[(w,)] + 0.1) / (n + 0.1 * (v + 1))
        return (counts[(*ctx, w)] + prior * p(ctx[1:], w)) / (counts[ctx] + prior)

    out = {}
    for d, t in toks.items():
        base = sum(math.log10(p((), w)) for w in t)
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1):i]), w)) for i, w in enumerate(t))
        out[d] = (len(t), sum(counts[(w,)] > 0 for w in t), n, base, score)
    return out


@pytest.mark.parametrize("order,block,shard", [(2, 4 << 20, 16 << 20), (2, 900, 2000), (3, 700, 1500), (4, 1 << 20, 300)])
def test_scores_match_brute_force(spark, monkeypatch, order, block, shard):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", shard)
    rnd = random.Random(2)
    vocab = ["The", "the", "of", "é", "Ünd", "a", "cat", "sat"] + [f"x{i}" for i in range(30)]
    docs = [(i, " ".join(rnd.choice(vocab[:rnd.choice([5, 38])]) for _ in range(rnd.randint(0, 40))), i % 4 != 0) for i in range(120)]
    docs += [(200, None, True), (201, "", True), (202, " \t\n", False), (203, "never seen words", False), (204, "late", None)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, train boolean, block string").repartition(3)
    want = brute(docs, order, 3.0)
    got = lm_score.lm_scores(df, F.col("train"), order=order, prior=3.0).collect()
    assert len(got) == len(docs)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3], r
        assert math.isclose(r.base_score, w[3], rel_tol=1e-9) and math.isclose(r.score, w[4], rel_tol=1e-9), (r, w)


def test_probabilities_sum_to_one():
    docs = [(0, "a b a c", True), (1, "b a b", True), (2, "c", True)]
    prior, words = 2.0, [b"a", b"b", b"c", None]
    counts = brute(docs, 2, prior)
    assert counts
    # p(w | a) over the vocabulary and one unknown token
    n, v = 4 + 1 + 3 + 1 + 1 + 1, 4
    c = Counter([b"a", b"b", b"a", b"c", None, b"b", b"a", b"b", None, b"c", None])
    pairs = Counter([(b"a", b"b"), (b"a", b"c"), (b"a", b"b")])
    uni = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    total = sum((pairs[(b"a", w)] + prior * uni(w)) / (3 + prior) for w in words) + prior * uni(b"?") / (3 + prior)
    assert math.isclose(total, 1.0)


def test_empty_table_and_no_training_text(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.lm_scores(df, F.lit(True)).count() == 0
    one = lm_score.lm_scores(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(False)).collect()
    assert one[0].train_tokens == 0 and one[0].n_known == 0 and one[0].score == one[0].base_score == 0.0


def test_order_is_checked(spark):
    with pytest.raises(ValueError):
        lm_score.lm_scores(spark.createDataFrame([], "doc_id long, text string"), F.lit(True), order=1)
