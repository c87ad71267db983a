import re
from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from fadeclust.llm.filter_audit import any_of, audit, capitals, fewer_words, repeated_words
from fadeclust.llm.queries import QUERIES

FILTERS = {"A": fewer_words(5), "B": repeated_words(65), "C": capitals(5), "D": any_of("#$%&*|")}
LOSSES = {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"}
COLUMNS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute_force(docs, labels, least=5):
    """Each order applied document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, parts = [], []
    for i, text, source in docs:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        same = [j for j, u, _ in docs if (u or "") == text and j is not None]
        fails.append({"A": len(words) < least, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                      "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and any(j < i for j in same)})
        parts.append(source or "")
    out, total = [], defaultdict(int)
    for order in permutations("ABCDE"):
        for part in set(parts):
            left = [k for k, p in enumerate(parts) if p == part]
            every = list(left)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if fails[k][f]]
                failing = [k for k in every if fails[k][f]]
                left = [k for k in left if not fails[k][f]]
                total[part, f] += len(gone)
                out.append((part, "".join(order), step, f, len(left), len(gone), len(failing) - len(gone),
                            sum(sum(fails[k].values()) == 1 for k in failing), sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone)))
    return sorted((*r, total[r[0], r[3]]) for r in out)


def rows(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def test_matches_brute_force(spark):
    texts = ["one two three four five six", "ONE TWO three four five", "a a a a a a a", "# a b c d e f", "", None, " \t\n", "É x y", "A# A# A#",
             "w " * 3000 + "#", "one two three four five six\n", "\x0bone\x0ctwo\rthree four five"]
    docs = [(k if k % 11 else None, texts[(k * 7) % len(texts)], ("s1", "s2", None, "")[k % 4]) for k in range(60)]
    docs += [(3, "one two three four five six", "s1"), (3, texts[9], "s9"), (70, "clean words and nothing else here", "clean")]
    labels = [(k, k % 2, k % 3 % 2) for k in range(0, 60, 2)] + [(4, 1, 1), (4, 0, None), (None, 1, 1), (900, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    df = df.withColumn("rid", F.lit("x")).withColumn("filter", F.lit(1)).withColumn("t", F.lit(2)).withColumn("digest", F.lit(0))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert rows(audit(df, FILTERS, "E", lab, LOSSES)) == brute_force(docs, labels)


def test_empty_tables_and_no_failures(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert rows(audit(none, FILTERS, "E", lab, LOSSES)) == []
    fine = [(1, "one two three four five six", "s"), (2, "seven eight nine ten eleven", "s")]
    got = rows(audit(spark.createDataFrame(fine, "doc_id long, text string, source string"), FILTERS, "E", lab, LOSSES))
    assert got == brute_force(fine, []) and len(got) == 600 and {r[4] for r in got} == {2}


def test_two_filters_without_labels(spark):
    docs = spark.createDataFrame([("b", "#", "s"), ("a", "#", "s"), ("c", "x y", "s")], "doc_id string, text string, source string")
    got = audit(docs, {"hash": any_of("#")}, "same").orderBy("filter_order", "step").collect()
    assert [(r.filter_order, r.filter, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got] == [
        ("hashsame", "hash", 1, 2, 0, 1, 3), ("hashsame", "same", 1, 0, 1, 0, 1),
        ("samehash", "same", 2, 1, 0, 0, 1), ("samehash", "hash", 1, 1, 1, 1, 3)]


def test_only_joins_decide_and_no_hot_exchange(spark):
    plan = QUERIES["op11_filter_audit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "Python" not in plan and "Cartesian" not in plan
