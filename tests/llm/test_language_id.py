import numpy as np
from pyspark.sql import functions as F

from fadeclust.llm import language_id
from fadeclust.llm.language_id import LanguageModel, languages

SF = "/root/testdata/sf0.01"


def grams(text: bytes) -> set:
    folded = bytes(language_id._FOLD[np.frombuffer(text + b"\n", dtype=np.uint8)])
    while b"  " in folded:
        folded = folded.replace(b"  ", b" ")
    return {(n, folded[i:i + n]) for n in language_id.ORDERS for i in range(len(folded) - n + 1)}


def test_presence_matches_sets():
    texts = [b"Ab, cd AB cd!!", "é ñandú  zzz".encode(), b"", b"a", b"the cat   sat"]
    model = LanguageModel(texts * 2, ["x", "y", "x", "y", "x"] * 2, landmarks=10, ridge=1.0)
    names = {tuple([int(g) >> (8 * n), int(g).to_bytes(8, "big")[-n:]]) for g in model.vocabulary.grams.tolist()
             for n in language_id.ORDERS if int(g) >> (8 * n) == n}
    p = model.vocabulary.presence(texts)
    for row, t in zip(p, texts):
        assert row.sum() == len(grams(t) & names)


def test_scoring_equals_explicit_kernel_regression():
    texts = [f"{a} {b} {a}{b}".encode() for a in ("the", "of", "and") for b in ("cat", "dog")] + \
            [f"{a} {b} {a}{b}".encode() for a in ("der", "die", "und") for b in ("katze", "hund")]
    langs = ["en"] * 6 + ["de"] * 6
    model = LanguageModel(texts, langs, landmarks=4, ridge=0.5)
    vocab = model.vocabulary
    unit = lambda ts: (p := vocab.presence(ts).astype(float)) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))
    marks = [t for lang in ("de", "en") for t in sorted((x for x, y in zip(texts, langs) if y == lang), key=len, reverse=True)[:4]]
    k = unit(marks) @ unit(marks).T
    w, v = np.linalg.eigh(k)
    root = (v * np.where(w > 1e-6 * w.max(), 1 / np.sqrt(np.maximum(w, 1e-12)), 0)) @ v.T
    phi = np.hstack([unit(texts) @ unit(marks).T @ root, np.ones((12, 1))])
    y = np.array([[1, -1]] * 0 + [[-1, 1] if x == "en" else [1, -1] for x in langs], dtype=float)
    f = phi @ np.linalg.solve(phi.T @ phi + 0.5 * np.eye(phi.shape[1]), phi.T @ y)
    got, score = model.predict(texts)
    assert got == [["de", "en"][i] for i in f.argmax(1)]
    assert np.allclose(score, np.clip((1 + f.max(1)) / 2, 0, 1), atol=1e-4)


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", None, "s", 0), (10**6 + 2, "12 !!", "en", "s", 0),
                                 (None, "the thing of the", None, "s", 0), (10**6 + 3, "x", "en", "s", 1)], docs.schema)
    both = docs.union(odd).withColumn("lang_pred", F.lit("clash"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    got = {r.doc_id: r for r in languages(both, ~held, fit_rows=100, landmarks=24).collect()}
    assert len(got) == 1005
    assert [got[10**6 + i].lang_pred for i in range(3)] == ["und"] * 3 and got[10**6].score == 0
    assert got[10**6 + 3].lang_pred != "und" and got[None].lang_pred == "en"
    truth = docs.where(held).select("doc_id", "lang").collect()
    assert sum(got[r.doc_id].lang_pred == r.lang for r in truth) >= 0.97 * len(truth)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_nothing_to_learn_and_empty(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in languages(docs, F.lit(True)).collect()) == [(1, None, 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert languages(docs.limit(0), F.lit(True)).count() == 0


def test_every_gram_is_found_where_slots_collide(monkeypatch):
    monkeypatch.setattr(language_id, "_SLOT_BITS", (4, 3))
    known = np.unique(np.random.default_rng(0).integers(2 << 16, 1 << 34, 300).astype(np.uint64))
    vocabulary = language_id.Vocabulary(known)
    asked = np.concatenate([known[::2], known[::3] + np.uint64(1), known])
    at, column = vocabulary.find(asked)
    want = np.isin(asked, known)
    assert len(vocabulary.tables) > 3 and sorted(at.tolist()) == np.flatnonzero(want).tolist()
    assert (known[column] == asked[at]).all()
    assert not len(language_id.Vocabulary(known[:0]).find(asked)[0])


def test_long_texts_repeats_and_null_ids_in_learning(spark, monkeypatch):
    monkeypatch.setattr(language_id, "FIT_BYTES", 200)
    rows = [(i, "the cat and the dog of it", "en") for i in range(4)] + [(4, "el perro y la casa " * 40, "es"), (5, "el perro y " * 30, "es")] \
        + [(None, "zzz qqq xxx", "zz"), (6, None, "fr")] + [(7, "the dog " * 50_000, None), (7, "la casa y el perro", None), (7, "la casa y el perro", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [(r.doc_id, r.lang_pred) for r in languages(docs, F.lit(True)).collect()]
    assert len(got) == len(rows) and (4, "es") in got and (6, "und") in got
    assert sorted(x for i, x in got if i == 7) == ["en", "es", "es"] and {x for _, x in got} == {"en", "es", "und"}
