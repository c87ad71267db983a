import random

import numpy as np
import pytest

from fadeclust.llm import suffix_dedup, work
from fadeclust.llm.suffix_array import suffix_array


def brute(texts, length):
    """(doc, text bytes) in id order -> id: (removed mask)"""
    seen, masks = set(), {}
    for doc, t in sorted(texts.items()):
        mask = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            if s in seen:
                mask[i:i + length] = True
            seen.add(s)
        masks[doc] = mask
    return masks


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30) for _ in range(4)]
    texts = {}
    for i in range(120):
        t = prose(rnd.randint(0, 60))
        if i % 3 == 0:
            t = t[:40] + rnd.choice(shared) + t[40:]
        if i % 7 == 0:
            t = t + " " + shared[0][10:120]
        if i % 11 == 0 and i:
            t = texts[i - 3]
        texts[i] = t
    texts[200] = "a" * 700
    texts[201] = "ab" * 300 + "a" * 150
    texts[202] = ""
    texts[203] = None
    texts[204] = shared[1] * 3
    return texts


def test_suffix_array_matches_sorting():
    rnd = random.Random(1)
    for _ in range(1500):
        a = [rnd.randint(0, rnd.choice([1, 2, 4, 30])) for _ in range(rnd.randint(0, 40))]
        assert suffix_array(np.array(a, dtype=np.int64)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


@pytest.mark.parametrize("hot,shipped", [(4096, 48 << 20), (2, -1)])
def test_removal_matches_brute_force(spark, monkeypatch, hot, shipped):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(work, "BROADCAST_BYTES", shipped)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "BLOCK_PLACES", 50)
    texts = corpus()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000 if shipped > 0 else 7)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(None, "n" * 300, "x")],
                               "doc_id long, text string, doc string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    masks = brute({i: (t or "").encode() for i, t in texts.items()}, 100)
    assert len(got) == len(texts) + 1 and got[None].n_removed == 0
    for i, mask in masks.items():
        b = np.frombuffer((texts[i] or "").encode(), dtype=np.uint8)
        assert bytes(got[i].kept) == b[~mask].tobytes(), i
        edges = np.diff(np.concatenate([[0], mask.astype(int)]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(b), mask.sum(), (edges == 1).sum())


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lengths_out_of_range_are_refused(spark):
    from fadeclust.llm.suffix_dedup import MOST_LENGTH, remove_repeats
    docs = spark.createDataFrame([(1, "x" * 9000), (2, "x" * 9000)], "doc_id long, text string")
    with pytest.raises(ValueError):
        remove_repeats(docs, length=MOST_LENGTH)
    text = "".join(chr(97 + (k * k) % 23) for k in range(5000))
    docs = spark.createDataFrame([(1, "a" + text + "bc"), (2, "zz" + text + "q")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in remove_repeats(docs, length=MOST_LENGTH - 1).collect()}
    assert got[2] == "zzq"
