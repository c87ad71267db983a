import os
import random
import sys
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import corpus_pipeline  # noqa: E402
from test_jaccard_join import brute as brute_components  # noqa: E402
from test_suffix_dedup import brute as brute_repeats  # noqa: E402

from fadeclust.llm.decontam import shingle_strings  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(21)
    vocab = {"en": ["the", "of", "and", "thing", "with", "reed"], "fr": ["le", "été", "aux", "tion", "eau", "près"]}
    more = {k: v + [rnd.choice(v) + rnd.choice(v) + str(i) for i in range(150)] for k, v in vocab.items()}
    prose = lambda k, n: " ".join(rnd.choice(more[k]) for _ in range(n))
    items = [(i, prose("en", rnd.choice([8, 25]))) for i in range(8)]
    passage = prose("en", 40)
    docs = []
    for i in range(150):
        k = rnd.choice(["en", "fr"])
        t = prose(k, rnd.randint(5, 120))
        if i % 9 == 0:
            t += "\n" + passage
        if i % 13 == 0:
            t += " " + rnd.choice(items)[1].upper() + " " + prose(k, 4)
        if i % 5 == 4:
            w = docs[rnd.randrange(len(docs))][1].split(" ")
            w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        docs.append((i, t, k, f"s{i % 3}", len(t)))
    docs += [(500, None, "en", None, None), (501, "", None, "s", 0), (502, "123 -- !!", "en", "s", 9), (503, "é", None, None, 1)]
    return docs, items


def expected(docs, items):
    live = {d: t for d, t, *_ in docs if t and any(c.isalpha() for c in t)}
    comp = brute_components([(d, t) for d, t in live.items()], 5, 80)
    live = {d: t for d, t in live.items() if comp[d][1] == d}
    masks = brute_repeats({d: t.encode() for d, t in live.items()}, 100)
    cut = {}
    for d, t in live.items():
        kept = bytes(b for b, m in zip(t.encode(), masks[d]) if not m).decode("utf-8", "ignore")
        if not masks[d].any() or kept.strip():
            cut[d] = kept
    sets = [shingle_strings(t.encode(), 5) for _, t in items]
    return {d: t for d, t in cut.items() if not any(len(q & shingle_strings(t.encode(), 5)) >= 0.8 * len(q) for q in sets)}, live, cut


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipe"))
    docs, items = corpus()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_pipeline_matches_brute_force(spark, folder):
    docs, items = corpus()
    final, near, cut = expected(docs, items)
    assert len(final) < len(cut) <= len(near) < len(docs) - 10
    assert sum(near[d] != t for d, t in cut.items()) > 3
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert {r.doc_id: r.text for r in frame.collect()} == final
    assert all(r.n_chars == len(r.text) for r in frame.collect())
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for d, t in final.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            part = b"".join(i.to_bytes(4, "little") for i in ids[s:s + 2048])
            want.add((d, s, len(part) // 4, zlib.crc32(part), len(ids)))
    assert {tuple(r)[:5] for r in corpus_pipeline.run(spark, folder).collect()} == want


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_input(spark, folder, name, stage):
    rows = [(None, None, None, None, None), (1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0),
            (3, "plain words of a text", "en", "s", 21), (3, "plain words of a text", "en", "s", 21), (4, "long text " * 30000, "en", "s", 300000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", component_id string")
    out = stage(spark, frame, folder)
    ids = [r.doc_id for r in out.collect()]
    assert {3, 4} <= set(ids) and (None in ids or name != "language_id")
    assert stage(spark, frame.limit(0), folder).count() == 0
