import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fadeclust.llm import packing
from fadeclust.llm.packing import WordEncoder, pack, placements, shortest_pack_first

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


TEXTS = ["", "The  cat's\tsat. Don't!", "ÉCOLE école Ünïcode ßtraße", "a b\u0085c\x0bd\x1ce", "x <|endoftext|> y<|STARTOFTEXT|>", "<|endoftext|>",
         "12 345,67% $$$ !!!...", "İstanbul ΣΑΣ ﬁ é ㎏", "中文 текст كلمة", "it'S we'Ll 'tis o'clock's", "word### a&&& *** b_c-d", "naïve.\n\nÀ;", "​ zero​width 😀👍🏽"]


def test_ids_equal_the_tokenizers():
    enc = WordEncoder(PATH)
    tok = Tokenizer.from_file(PATH)
    rnd = random.Random(4)
    pool = [w for t in TEXTS for w in t.split(" ")] + ["the", "Thndly.", "schön,", "été!"]
    for t in TEXTS + [" ".join(rnd.choice(pool) + rnd.choice(["", ".", "?!", "s"]) for _ in range(30)) for _ in range(300)]:
        got = enc.encode(t.encode())
        assert [int.from_bytes(got[i:i + 4], "little") for i in range(0, len(got), 4)] == tok.encode(t, add_special_tokens=False).ids, t


def test_cache_bound(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    enc = WordEncoder(PATH)
    text = "one two three four, five. six one two".encode()
    assert enc.encode(text) == WordEncoder(PATH).encode(text) and len(enc) <= 4


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_every_length_once(seed):
    rnd = random.Random(seed)
    hist = Counter(min(2048, int(rnd.paretovariate(0.6) * 20)) for _ in range(rnd.choice([1, 50, 3000])))
    patterns = shortest_pack_first(dict(hist), 2048)
    used = Counter()
    for p, n in patterns:
        assert n > 0 and sum(p) <= 2048 and list(p) == sorted(p, reverse=True)
        for x in p:
            used[x] += n
    assert used == hist
    ranks = defaultdict(list)
    for length, first, n, _, _ in placements(patterns):
        ranks[length] += range(first, first + n)
    assert all(sorted(r) == list(range(hist[x])) for x, r in ranks.items())


def test_shortest_pack_is_filled_first():
    assert shortest_pack_first({6: 1, 4: 1, 3: 2}, 10) == [((3, 3), 1), ((6, 4), 1)]
    assert shortest_pack_first({6: 2, 3: 2, 2: 2}, 10) == [((2, 2), 1), ((6, 3), 2)]
    assert shortest_pack_first({}, 10) == []


def test_pack_round_trip(spark):
    rnd = random.Random(8)
    words = ["the", "cat", "sat,", "ünd", "x1"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 40, 700, 5000])))) for i in range(60)]
    docs += [(100, None), (101, ""), (7, docs[7][1]), (None, "no id"), (102, "same length") , (103, "same length")]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, length long").repartition(3)
    rows = pack(df, PATH, capacity=256).collect()
    want = Counter()
    for d, t in docs:
        ids = ids_of(t or "") + [1]
        for s in range(0, len(ids), 256):
            part = b"".join(i.to_bytes(4, "little") for i in ids[s:s + 256])
            want[(d, s, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    tokens = sum(r.length for r in rows)
    assert sorted(sequences) == list(range(len(sequences))) and len(sequences) * 256 < tokens * 1.05


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
