"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source is wanted target / size times: the whole part of that
ratio is taken of all its documents, and its fraction is each document's inclusion
probability.  The flight phase moves these probabilities through the null space of
the constraints (sum of tokens, number of documents) until each is 0 or 1: of three
undecided documents one is always decided, and both totals stay as they were.
Documents are dealt by a hash into runs of one source, each flown in one pass that
holds three documents; what a run leaves open (two documents at most) is dealt into
fewer runs, until a source's open documents fit into one.  There a dozen documents
of falling sizes are kept back: which of them are taken is the landing problem, solved
by trying all choices for the totals' smallest error.

Rows are documents, each for itself, also those that repeat an id.  A null text has
size 0, and whatever its size a row comes out once.  A null source is a source of its
own, the last; sources without words have target 0.  No documents give no rows.
Equal input gives equal output whatever its partitions (rows that agree in id and
text are interchangeable).  Other columns, whatever their names, are not read.

The table of sources (one row each, with weights by rank) is ordered by one task.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import bounded, numbered, written

RUN_ROWS = 4096     # documents of a run, on average; also the most that one source may have open at the last level
LANDING = 12        # documents kept back for the landing problem, besides the two that the flight leaves
_NEAR = 1e-9        # a probability this near to 0 or 1 is that


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (``source, source_size``) with ``sid`` (rank by code point, null
    last), ``weight`` and ``target``: ``share`` of all sizes by weight, each at
    most ``most`` times its size, the excess reshared by weight.

    Filled in order of cap / weight, the level that the rest would get rises as
    long as caps are below it; its largest value is every uncapped source's."""
    everything = Window.partitionBy()
    ranked = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1)) \
        .withColumn("cap", most * F.col("source_size"))
    below = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    rest = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    level = rest / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    filled = ranked.withColumn("level", level)
    filled = filled.withColumn("target", F.least(F.col("cap"), F.max("level").over(everything) * F.col("weight")))
    return filled.select("source", "source_size", "sid", "weight", F.greatest("target", F.lit(0.0)).alias("target"), (F.col("target") >= F.col("cap")).alias("capped"))


class _Run:
    """The open documents of one run: rows ``(sid, bucket, size, p, pi, ...)``."""

    def __init__(self, key: tuple, seed: str) -> None:
        self.key = key
        self.open: list[list] = []
        self.random = random.Random(f"{seed}/{key}")

    def add(self, row: list) -> list[list]:
        """Take a document in; returns those that are decided by it."""
        self.open.append(row)
        return self.fly() if len(self.open) == 3 else []

    def fly(self) -> list[list]:
        """Move along null vectors as long as there are any."""
        decided = []
        while (u := self.null_vector()) is not None:
            self.move(u)
            decided += [r for r in self.open if r[4] in (0.0, 1.0)]
            self.open = [r for r in self.open if r[4] not in (0.0, 1.0)]
        return decided

    def null_vector(self) -> list[float] | None:
        """u with sum(u * size / p) = sum(u * 1 / p) = 0, by the original p."""
        a = [r[2] / r[3] for r in self.open]
        b = [1 / r[3] for r in self.open]
        if len(a) == 3:
            u = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
            scale = max(map(abs, u))
            return [x / scale for x in u] if scale > _NEAR * max(a) * max(b) else [b[1], -b[0], 0.0]
        if len(a) == 2 and abs(a[0] * b[1] - a[1] * b[0]) <= _NEAR * max(a) * max(b):
            return [b[1], -b[0]]
        return None

    def move(self, u: list[float]) -> None:
        """To the end of the line one way or the other, so that each expectation stays."""
        moving = [(r, x) for r, x in zip(self.open, u) if x]
        ahead = [(1 - r[4]) / x if x > 0 else r[4] / -x for r, x in moving]
        back = [r[4] / x if x > 0 else (1 - r[4]) / -x for r, x in moving]
        up, down = min(ahead), min(back)
        forward = self.random.random() * (up + down) < down
        step, ends = (up, ahead) if forward else (-down, back)
        for (r, x), end in zip(moving, ends):
            pi = r[4] + step * x
            if end == abs(step):
                pi = float(round(pi))
            r[4] = 0.0 if pi < _NEAR else 1.0 if pi > 1 - _NEAR else pi

    def land(self, kept_back: list[list]) -> list[list]:
        """Of all choices of the open documents that nearest to both totals."""
        rows = self.open + kept_back
        if not rows:
            return []
        size = np.array([r[2] for r in rows], dtype=float)
        pi = np.array([r[4] for r in rows])
        choices = (np.arange(1 << len(rows))[:, None] >> np.arange(len(rows))) & 1
        tokens, number = np.abs(choices @ size - pi @ size), np.abs(choices.sum(1) - pi.sum())
        best = choices[int(np.argmin(tokens + 0.05 * size.mean() * number))]
        for r, x in zip(rows, best.tolist()):
            r[4] = float(x)
        return rows


def _spread(sizes: list[int]) -> set[int]:
    """Of sizes in falling order the places of some that fall by 0.6, or more, each:
    sums of these come near any total.  Where such are too few, the next largest."""
    picked, least = [], float("inf")
    for i, s in enumerate(sizes):
        if s <= least and len(picked) < LANDING:
            picked.append(i)
            least = 0.6 * s
    rest = [i for i in range(len(sizes)) if i not in set(picked)]
    return {*picked, *rest[:LANDING - len(picked)]}


def _flight(seed: str, last: bool):
    """Runs of rows sorted by run; the last level holds a run (``RUN_ROWS``
    documents at most) and lands it."""

    def ended(run: _Run, held: list[list]) -> list[list]:
        if not last:
            return run.open
        spread = _spread([r[2] for r in held])
        done = [d for i, r in enumerate(held) if i not in spread for d in run.add(r)]
        done += run.fly() if len(run.open) > 1 else []
        return done + run.land([held[i] for i in sorted(spread)])

    def fly(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held, schema = None, [], None
        for batch in batches:
            schema, out = batch.schema, []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if run is None or run.key != row[:2]:
                    if run is not None:
                        out += ended(run, held)
                    run, held = _Run(row[:2], seed), []
                if last:
                    held.append(list(row))
                else:
                    out += run.add(list(row))
            yield _batch(out, schema)
        if run is not None:
            yield _batch(ended(run, held), schema)

    return fly


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def balanced_sample(units: DataFrame, seed: int = 0) -> DataFrame:
    """Rows ``sid, bucket, size, p, pi, salt, id`` with ``pi`` = ``p`` strictly between
    0 and 1, given back with ``pi`` 0 or 1, so that in each ``sid`` the taken sizes
    and documents come to their expected totals."""
    done, level = None, 0
    order = [F.desc("size"), "id", "salt"]
    while True:
        per_source = units.groupBy("sid").count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
        last = (per_source["most"] or 0) <= RUN_ROWS
        runs = -(-(per_source["n"] or 0) // RUN_ROWS)
        dealt = units.withColumn("bucket", F.lit(0).cast("long") if last else F.pmod(F.xxhash64("salt", F.lit(level)), F.lit(runs)))
        dealt = dealt.repartition(*(["sid"] if last else ["bucket"])).sortWithinPartitions("bucket", "sid", *order)
        flown = written(dealt.mapInArrow(_flight(f"{seed}/{level}", last), dealt.schema), "flight")
        if last:
            return flown if done is None else done.unionByName(flown)
        decided = flown.where("pi in (0.0, 1.0)")
        done = decided if done is None else done.unionByName(decided)
        units, level = flown.where("pi not in (0.0, 1.0)"), level + 1


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size`` (words), ``source_size``,
    ``target`` (of its source), ``copies`` (0 to ``most``) and ``taken`` words."""
    if not weights or min(weights) <= 0 or share < 0 or most < 1 or share > most:
        raise ValueError("weights above 0, a share from 0 to most, and most of 1 or more")
    size = F.coalesce(F.regexp_count("c1", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    rows = written(numbered(docs, doc_id, text, source).select(
        F.col("c0").alias("id"), F.col("c2").alias("source"), size.alias("size"), F.xxhash64("c0", "c1").alias("salt")), "mix-rows")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.when(F.expr("capped and source_size > 0"), F.lit(most)).otherwise(F.least(F.floor(ratio + _NEAR), F.lit(most)))
    targets = written(source_targets(sources, weights, share, float(most)).withColumn("whole", whole.cast("int")).withColumn(
        "p", F.when(F.col("whole") < most, F.greatest(ratio - F.col("whole"), F.lit(0.0))).otherwise(0.0)), "mix-targets")
    side = bounded(targets.select(F.col("source").alias("s"), "sid", F.when(F.col("p") < _NEAR, 0.0).otherwise(F.col("p")).alias("p")))
    units = rows.join(side, F.col("source").eqNullSafe(F.col("s"))).select(
        "sid", F.lit(0).cast("long").alias("bucket"), "size", "p", F.col("p").alias("pi"), "salt", "id")
    units = written(units, "mix-units")
    chosen = units.where("pi = 0.0").unionByName(balanced_sample(units.where("pi > 0.0"), seed))
    side = bounded(targets.select("sid", "source", "source_size", "target", "whole"))
    copies = F.col("whole") + F.col("pi").cast("int")
    return chosen.select("sid", "size", "pi", "id").join(side, "sid").select(
        F.col("id").alias(doc_id), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
