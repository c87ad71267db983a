"""How quality filters interact: what each order of them removes, step by step.

Each filter's failing documents are stored as one table of ids.  A case is a
failing document of one filter with one set of filters that ran before (its
prefix).  Left-anti joins of the cases with the id tables, on id and "that filter
is in the prefix", leave the filter's removals after that prefix, left-semi joins
what is redundant there; the same left-anti join gives each prefix's survivors.
Orders share prefixes, so n filters need 2**n prefixes, not n! orders, and only
counts per part leave the joins.

Rows are documents, each for itself: also those that repeat an id, or have none.
A null text is empty, a null part is the empty one.  A row without an id has no
label and repeats no smaller id.  Equal texts are found by their SHA-256.  No
documents give no rows; a document without words fails what its conditions say
(an empty text has 0 of 0 distinct words).  Labels of an id that occur several
times count if any of them holds.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fadeclust.session import fresh_dir

from .work import numbered, written

MOST_FILTERS = 6  # 2**n prefixes per failing id, n! orders per part
SPACE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The maximal runs of characters other than ``\\x20 \\x09-\\x0D``."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def fewer_words(n: int) -> Callable[[Column], Column]:
    return lambda text: F.size(words_of(text)) < n


def repeated_words(percent: int) -> Callable[[Column], Column]:
    """Fewer than ``percent`` of a hundred words are different ones."""
    return lambda text: 100 * F.size(F.array_distinct(words_of(text))) < percent * F.size(words_of(text))


def capitals(percent: int) -> Callable[[Column], Column]:
    """More than ``percent`` of a hundred characters are A to Z."""
    return lambda text: 100 * F.regexp_count(text, F.lit("[A-Z]")) > percent * F.length(text)


def any_of(characters: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(f"[{characters}]")


def failing_ids(docs: DataFrame, filters: Mapping[str, Callable[[Column], Column]], same_text: str | None = None,
                labels: DataFrame | None = None, losses: Mapping[str, str] | None = None,
                doc_id: str = "doc_id", text: str = "text", part: str = "source") -> tuple[DataFrame, DataFrame]:
    """``(rows, ids)``: every row as ``rid, part``, and one stored table of failing
    rows per filter (``filter`` is its partition) with ``rid, part`` and one
    boolean per loss (SQL conditions over ``labels``).  ``same_text`` names the filter, if any, that fails texts
    identical to that of a smaller id."""
    conditions = [F.when(f(F.col("t")), F.lit(name)) for name, f in filters.items()]
    held = numbered(docs, doc_id, text, part).select(
        F.col("c0").alias("id"), F.coalesce("c2", F.lit("")).alias("part"), F.coalesce("c1", F.lit("")).alias("t"))
    rows = written(held.select(F.monotonically_increasing_id().alias("rid"), "id", "part", F.unhex(F.sha2("t", 256)).alias("digest"),
                               F.array_compact(F.array(*conditions)).alias("fails")), "audit-rows")
    ids = rows.select("rid", "id", "part", F.explode("fails").alias("filter"))
    if same_text is not None:
        first = written(rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                        .where("first < last").select("digest", "first"), "audit-firsts")
        later = rows.join(first.withColumnRenamed("digest", "d").hint("merge"), (F.col("digest") == F.col("d")) & (F.col("id") > F.col("first")), "left_semi")
        ids = ids.unionByName(later.select("rid", "id", "part", F.lit(same_text).alias("filter")))
    losses = dict(losses or {})
    if labels is not None and losses:
        marks = labels.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(*[F.max(F.expr(c)).alias(name) for name, c in losses.items()]).where("id is not null")
        ids = ids.join(written(marks, "audit-labels").hint("merge"), "id", "left")
    lost = [F.coalesce(F.col(f"`{name}`"), F.lit(False)).alias(name) if labels is not None else F.lit(False).alias(name) for name in losses]
    path = fresh_dir(docs.sparkSession, "audit-ids")
    ids = ids.select("rid", "part", *lost, "filter")
    ids.write.partitionBy("filter").parquet(path)
    return rows.select("rid", "part"), docs.sparkSession.read.schema(ids.schema).parquet(path)


def audit(docs: DataFrame, filters: Mapping[str, Callable[[Column], Column]], same_text: str | None = None,
          labels: DataFrame | None = None, losses: Mapping[str, str] | None = None,
          doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, zeros included:
    ``part, filter_order`` (the names joined), ``step, filter, kept, removed,
    redundant, unique_fails``, one count per loss, and ``shapley`` (what the filter
    removes in all orders together)."""
    names = [*filters, *([same_text] if same_text is not None else [])]
    n = len(names)
    if not 1 <= n <= MOST_FILTERS or len(set(names)) < n:
        raise ValueError(f"one to {MOST_FILTERS} filters of different names")
    losses = dict(losses or {})
    rows, ids = failing_ids(docs, filters, same_text, labels, losses, doc_id, text, part)
    number = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
    ids = ids.withColumn("f", F.element_at(number, F.col("filter")))
    full = (1 << n) - 1

    def masks(without: int) -> Column:
        return F.array(*[F.lit(m) for m in range(full + 1) if not m & without])

    # one row per failing row and filter (f), and one of the failing row itself (f = n)
    each = ids.select("rid", "part", *[F.col(f"`{x}`") for x in losses], "f")
    bare = each.groupBy("rid").agg(F.first("part").alias("part"), *[F.lit(False).alias(x) for x in losses], F.lit(n).alias("f"))
    prefixes = F.element_at(F.array(*[masks(1 << i) for i in range(n)], masks(0)), F.col("f") + 1)
    cases = each.unionByName(bare).repartition("rid").withColumn("before", F.explode(prefixes))
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(n)]), F.col("f") + 1)
    ran = ids.select(F.col("rid").alias("r"), bit.alias("bit")).hint("merge")     # grows with the input
    earlier = (F.col("rid") == F.col("r")) & (F.col("before").bitwiseAND(F.col("bit")) != 0)
    key = (F.col("f") * (full + 1) + F.col("before")).alias("key")
    left = cases.join(ran, earlier, "left_anti").groupBy("part", "f", "before").agg(
        F.count(F.lit(1)).alias("removed"), *[F.sum(F.col(f"`{x}`").cast("long")).alias(x) for x in losses])
    again = cases.where(F.col("f") < n).join(ran, earlier, "left_semi").groupBy("part", "f", "before").agg(F.count(F.lit(1)).alias("redundant"))
    zero = F.lit(0).cast("long")
    counts = left.select("part", key, "f", "before", "removed", *losses, zero.alias("redundant")).unionByName(
        again.select("part", key, "f", "before", zero.alias("removed"), *[zero.alias(x) for x in losses], "redundant"))
    measures = ["removed", *losses, "redundant"]
    counts = counts.groupBy("part", "key", "f", "before").agg(*[F.sum(F.col(f"`{x}`")).alias(x) for x in measures])
    # as many orders have a filter after this prefix
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), (F.bit_count("before") + 1).cast("int"))
    per_part = counts.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct(*[F.col(f"`{x}`") for x in measures])))).alias("by"),
        F.array(*[F.sum(F.when(F.col("f") == i, F.col("removed") * weight).otherwise(0)) for i in range(n)]).alias("all_orders"))
    clean = rows.join(ids.select("rid").hint("merge"), "rid", "left_anti").groupBy("part").agg(F.count(F.lit(1)).alias("clean"))
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(clean, "part", "left").join(per_part, "part", "left")

    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, f in enumerate(order):
            steps.append({"filter_order": "".join(names[i] for i in order), "step": k + 1, "filter": names[f], "f": f, "before": before})
            before |= 1 << f
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, filter string, f int, before int>>")
    out = parts.select("*", F.inline(plan))

    def at(f: Column, before: Column, measure: str) -> Column:
        return F.coalesce(F.try_element_at("by", f * (full + 1) + before)[measure], zero)

    f, before = F.col("f"), F.col("before")
    return out.select(
        "part", "filter_order", "step", "filter",
        (F.coalesce("clean", zero) + at(F.lit(n), before + bit, "removed")).alias("kept"),
        at(f, before, "removed").alias("removed"), at(f, before, "redundant").alias("redundant"),
        at(f, full - bit, "removed").alias("unique_fails"), *[at(f, before, x).alias(x) for x in losses],
        F.coalesce(F.element_at("all_orders", f + 1), zero).alias("shapley"))
