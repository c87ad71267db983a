"""N-gram Jaccard join: near copies of whole texts and their components.

A document's set are its distinct ``k``-word shingles (lower-cased A-Z, words
split at ASCII white space; with fewer words the whole sequence is the one
shingle, without words or text the set is empty and links with nothing).  Two
documents link when ``100 * |A & B| >= percent * |A | B|``.

1. Equal sets are aggregated to their least id first; only these go on.
2. All shingles are counted into ``2**RARITY_BITS`` counters (a fixed size at any
   input), which give one global order, rare shingles first.
3. A linked pair shares a shingle among the first ``n - ceil(percent n / 100) + 1``
   of each set (prefix filter); shingles of only one prefix are dropped.
4. First each set is tried against the least id among the leaders of its prefix
   shingles (each shingle's least id) that pass the filters of step 5;
   components of these links are known before step 5, which so need not look at
   pairs within a group of near copies.
5. All pairs that share a prefix shingle across components pass the length and
   positional filters, are made distinct, and are verified once, after the
   suffix filter, by their full sets.

Only components are returned, so pairs within one are not all tested; no link
between different components is lost.  Rows that repeat an id count as one
document and give one result row each; rows with a null id have a component
only through themselves and return it as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import work
from .graph import components
from .text import CHUNK_BYTES, byte_values, chunks, mix64, shingle_sets, size_ranges, small_batches
from .work import bounded, join_side, numbered, semi_join, written

RARITY_BITS = 23
_BLOCK = 1 << 17


def _rarity(rows: DataFrame, k: int) -> np.ndarray:
    """Rank (0 to 255) of each counter: larger for shingles that more documents have."""
    size = 1 << RARITY_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.uint32)
        for batch in small_batches(batches, 1):
            values = byte_values(batch.column(1))
            for lo, hi in chunks(values):
                at, n = np.unique(np.concatenate(shingle_sets(values[lo:hi], k)) & np.uint64(size - 1), return_counts=True)
                total[at.view(np.int64)] += n.astype(np.uint32)
        for b in range(0, size, _BLOCK):
            part = total[b:b + _BLOCK]
            kind = np.uint8 if part.max() < 1 << 8 else np.uint16 if part.max() < 1 << 16 else np.uint32
            yield pa.RecordBatch.from_arrays([pa.array([b // _BLOCK], type=pa.int32()), pa.array([part.astype(kind).tobytes()], type=pa.binary())],
                                             ["block", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(c, dtype=f"u{len(c) // _BLOCK}")
                total.setdefault(b, np.zeros(_BLOCK, dtype=np.int64))
                total[b] += part
        for b, part in total.items():
            rank = np.minimum(255, 12 * np.log2(part + 1.0)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b], type=pa.int32()), pa.array([rank.tobytes()], type=pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    out = np.zeros(size, dtype=np.uint8)
    for b, c in rows.mapInArrow(count, schema).repartition(size // _BLOCK, "block").mapInArrow(merge, schema).collect():
        out[b * _BLOCK:(b + 1) * _BLOCK] = np.frombuffer(c, dtype=np.uint8)
    return out


def _order_keys(h: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Sort key of each shingle: its rarity, then bits of its hash."""
    return (rarity[h & np.uint64(len(rarity) - 1)].astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20))


def _ordered(h: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return h[np.argsort(_order_keys(h, rarity), kind="stable")]  # h comes sorted


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _sets(rows: DataFrame, k: int, percent: int, rarity: np.ndarray) -> DataFrame:
    """id, n, two digests of the set, and its prefix in order."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            values = byte_values(batch.column(1))
            for lo, hi in chunks(values):
                sets = shingle_sets(values[lo:hi], k)
                with np.errstate(over="ignore"):
                    d1 = [int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                    d2 = [int(np.bitwise_xor.reduce(mix64(s + np.uint64(0x14057B7EF767814F))).astype(np.int64)) if len(s) else 0 for s in sets]
                prefixes = [_ordered(s, rarity)[:prefix_size(len(s), percent)] for s in sets]
                ptr = np.zeros(len(sets) + 1, dtype=np.int32)
                np.cumsum([len(p) for p in prefixes], out=ptr[1:])
                flat = np.concatenate(prefixes).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo)] + [pa.array(x, type=pa.int64()) for x in ([len(s) for s in sets], d1, d2)]
                    + [pa.ListArray.from_arrays(pa.array(ptr), pa.array(flat))], ["id", "n", "d1", "d2", "prefix"])
    return rows.mapInArrow(make, "id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>")


def _suffix_distance(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """A lower bound of the number of shingles in just one of two ordered sets."""
    if depth == 0 or not len(x) or not len(y):
        return abs(len(x) - len(y))
    pivot = y[len(y) // 2]
    i, j = int(np.searchsorted(x, pivot)), int(np.searchsorted(y, pivot))
    return _suffix_distance(x[:i], y[:j], depth - 1) + _suffix_distance(x[i:], y[j:], depth - 1)


def _may_link(percent: int):
    """Length and positional filter on two postings (n, at) and (n2, at2) of one shingle."""
    need = F.floor((F.lit(percent) * (F.col("n") + F.col("n2")) + F.lit(99 + percent)) / F.lit(100 + percent))
    return (F.lit(100) * F.least("n", "n2") >= F.lit(percent) * F.greatest("n", "n2")) \
        & (F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) >= need)


def _verified(pairs: DataFrame, rows: DataFrame, k: int, percent: int, rarity: np.ndarray) -> DataFrame:
    """Of distinct pairs (a, b), those that link.  Only the texts of these ids
    move: those of b to their a, which join splits if one a has many."""
    pairs = written(pairs, "pairs")
    small = 48 * pairs.count() <= work.BROADCAST_BYTES
    lookup = (lambda df: F.broadcast(df)) if small else (lambda df: df.hint("merge"))
    texts = rows.select(F.col("c0").alias("id"), "c1")
    right = texts.withColumnRenamed("id", "b").withColumnRenamed("c1", "tb").join(lookup(pairs), "b").select("a", "b", "tb")
    left = texts.withColumnRenamed("id", "a").withColumnRenamed("c1", "ta").join(lookup(pairs.select("a").distinct()), "a", "left_semi")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "ta", "tb"):
            keep: list[bool] = []
            ta, tb = byte_values(batch.column("ta")), byte_values(batch.column("tb"))
            for lo, hi in size_ranges((len(x) + len(y) for x, y in zip(ta, tb)), CHUNK_BYTES):
                first = list(dict.fromkeys(ta[lo:hi]))
                sets = dict(zip(first, shingle_sets(first, k)))
                keep += [_linked(sets[t], y, percent, rarity) for t, y in zip(ta[lo:hi], shingle_sets(tb[lo:hi], k))]
            yield batch.filter(pa.array(keep, type=pa.bool_())).select(["a", "b"])

    return written(right.join(left.hint("merge"), "a").select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint"), "edges")


def _linked(x: np.ndarray, y: np.ndarray, percent: int, rarity: np.ndarray) -> bool:
    n = len(x) + len(y)
    need = (percent * n + 99 + percent) // (100 + percent)
    if min(len(x), len(y)) < need:
        return False
    if _suffix_distance(np.sort(_order_keys(x, rarity)), np.sort(_order_keys(y, rarity)), 3) > n - 2 * need:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (n - shared)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    least id reachable by links, itself included)."""
    rows = numbered(docs, id_col, text_col).withColumn("c0", F.col("c0").cast("long"))
    rarity = _rarity(rows, k)
    sets = written(_sets(rows, k, percent, rarity), "sets")
    some = sets.where("n > 0 and id is not null")
    least = written(some.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "least")
    copies = written(some.join(bounded(least), ["n", "d1", "d2"]).where("id != rep").select("id", "rep").distinct(), "copies")
    single = join_side(some, copies, "id", "rep").where("rep is null").select("id", "n", "prefix")

    repeated = written(single.select(F.explode("prefix").alias("t")).groupBy("t").count().where("count > 1").select("t"), "tokens")
    tokens = semi_join(single.select("id", "n", F.posexplode("prefix").alias("at", "t")), repeated, "t").select("t", "id", "n", "at")
    tokens = written(tokens, "postings")

    first = tokens.groupBy("t").agg(F.min(F.struct("id", "n", "at")).alias("f")) \
        .select("t", F.col("f.id").alias("id2"), F.col("f.n").alias("n2"), F.col("f.at").alias("at2"))
    star = written(tokens.join(first, "t").where((F.col("id2") < F.col("id")) & _may_link(percent)).groupBy("id")
                   .agg(F.min("id2").alias("a")).select("a", F.col("id").alias("b")), "star")
    edges = _verified(star, rows, k, percent, rarity)
    known_groups = components(edges)

    placed = tokens.join(known_groups, "id", "left").select("t", "id", "n", "at", F.coalesce("component", "id").alias("g"))
    mixed = placed.groupBy("t").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 != g1").select("t")
    x = written(placed.join(mixed, "t"), "mixed")
    y = x.select("t", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "at", "g")])
    cross = x.join(y, "t").where((F.col("id") < F.col("id2")) & (F.col("g") != F.col("g2")) & _may_link(percent))
    cross = cross.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    groups = written(components(edges.union(_verified(cross, rows, k, percent, rarity))), "groups")

    out = join_side(sets.select("id", "n"), copies, "id", "rep").withColumn("rep", F.coalesce("rep", "id"))
    out = join_side(out, groups.withColumnRenamed("id", "rep"), "rep", "component")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))

