"""Near-copies among embeddings by a pivot-permutation index.

Vectors link if their labels are equal and not null, their lengths are equal,
and their cosine in double precision is at least ``threshold``; a vector that is
null or zero, or holds a null or non-finite number, links with nothing.

1. Vectors that are equal bit for bit under one label are one entry with a count.
2. Pivots are ``pivots`` reference points: random points of the unit sphere, by
   default one per 200 vectors, 64 to 2048; they depend on the vectors' length
   only, never on the vectors.  An entry is described by its ``nearest`` nearest
   pivots in order, nearest first (a prefix of its pivot permutation).
3. The first ``lead`` pivots of the order have an inverted list each that holds the
   entry.  Two entries of one list are compared if their descriptions share at
   least ``SHARED`` = 2 pivots: within a list, entries are put under each further
   pivot of their description, so that only such pairs meet.  A pair that meets
   more than once is counted only under its least shared leading pivot and,
   there, its least other shared pivot.  ``lead`` and ``nearest`` are made as
   large as a simulated pair at the threshold needs to meet with a chance of
   ``RECALL``.
4. Pairs that meet are verified by products of their vectors, which a list's task
   holds once.  A list of more than ``BLOCK`` entries is cut into blocks that are
   compared two at a time in tasks of their own.  A task gives out each entry's
   number of links and one edge per entry and local component, never all pairs.

The products of a unit vector with random points are nearly normal, those of two
vectors correlated by their cosine, so a pair's chance to meet depends on its
cosine alone: not on how many vectors lie around it.  It is ``RECALL`` at the
threshold and more above, in a large group of near copies as elsewhere; some of
the weakest links may be missed, and no pair below the threshold is ever linked.
The price is paid in time: vectors that all lie in one narrow cone share their
lists, and pairs of a list are compared block by block.

Rows that repeat an id are vectors of their own.  A null id takes part, names no
component, and is never kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .work import written

BLOCK = 4096         # entries of a list that are compared in one task with as many others
SMALL = 64           # lists up to this size are verified many at once
BUCKET_ROWS = 20_000
RECALL = 0.999       # least chance of a pair at the threshold to meet in a list
SHARED = 2           # pivots that the descriptions of a compared pair share, the list's own among them


def _vectors(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows with a digest of their vector, null where it can't link."""
    for batch in batches:
        out, digests = [], []
        for v in batch.column(2).to_pylist():
            a = np.array(v, dtype=kind) if v and None not in v else None
            if a is None or not np.isfinite(a).all() or not a.any():
                out.append(None)
                digests.append(None)
            else:
                out.append((a + 0).tobytes())  # -0.0 becomes 0.0
                digests.append(hashlib.blake2b(out[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, type=pa.binary()), pa.array(out, type=pa.binary())],
                                         ["id", "label", "digest", "v"])


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(v, dtype=kind) for v in vectors]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(maxsize=8)
def _points(pivots: int, dim: int) -> np.ndarray:
    """Reference points: random points of the unit sphere."""
    x = np.random.default_rng([pivots, dim]).normal(size=(pivots, dim))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _order(products: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    near = np.argpartition(-products, nearest - 1, axis=1)[:, :nearest]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(products, near, axis=1), axis=1, kind="stable"), axis=1)


def recall(cosine: float, pivots: int, lead: int, nearest: int, pairs: int = 10_000) -> float:
    """Share of simulated pairs at this cosine that meet: one of the ``lead`` first
    pivots is the same, and ``SHARED`` of the ``nearest`` first are."""
    rng = np.random.default_rng(0)
    hits = 0
    for at in range(0, pairs, 1000):
        n = min(1000, pairs - at)
        x = rng.normal(size=(n, pivots))
        y = cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * rng.normal(size=(n, pivots))
        a, b = _order(x, nearest), _order(y, nearest)
        same = a[:, :, None] == b[:, None, :]
        hits += int((same[:, :lead, :lead].any(axis=(1, 2)) & (same.sum(axis=(1, 2)) >= SHARED)).sum())
    return hits / pairs


class PivotIndex:
    """Ordered nearest pivots of vectors; each length of vectors has points of its own."""

    def __init__(self, pivots: int, kind: str, nearest: int, lead: int, threshold: float) -> None:
        self.kind, self.pivots = kind, max(2, pivots)
        self.lead = min(self.pivots, max(1, lead))
        self.nearest = min(self.pivots, max(SHARED, nearest, self.lead))
        while self.lead < self.pivots and recall(min(1.0, threshold), self.pivots, self.lead, self.nearest) < RECALL:
            self.lead = min(self.pivots, self.lead + 1)
            self.nearest = min(self.pivots, self.nearest + 2)

    def describe(self, vectors: list[bytes]) -> np.ndarray:
        """Numbers of the nearest pivots, nearest first."""
        out = np.empty((len(vectors), self.nearest), dtype=np.int32)
        sizes = np.array([len(v) for v in vectors], dtype=np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            unit = _unit([vectors[i] for i in rows], self.kind)
            out[rows] = _order(unit @ _points(self.pivots, unit.shape[1]).T, self.nearest)
        return out


def _lists(batches: Iterator[pa.RecordBatch], index: PivotIndex) -> Iterator[pa.RecordBatch]:
    """An entry's rows in the inverted lists: one per leading pivot."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            near = index.describe(part.column("v").to_pylist())
            taken = part.take(pa.array(np.repeat(np.arange(part.num_rows), index.lead)))
            order = pa.array([b for o in near for b in [o.tobytes()] * index.lead], type=pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(near[:, :index.lead].reshape(-1)), taken.column("label"), taken.column("gid"), taken.column("k"), taken.column("v"), order],
                ["pivot", "label", "gid", "k", "v", "near"])


def _counted_elsewhere(near: np.ndarray, lead: int, x: np.ndarray, y: np.ndarray, p, q) -> np.ndarray:
    """Whether another meeting counts the pairs (x, y): one in the list of a leading
    pivot below p that they share, or under a shared pivot below q other than p."""
    out = np.zeros(len(x), dtype=bool)
    for c in range(near.shape[1]):
        pivot = near[y, c]
        same = near[x] == pivot[:, None]
        out |= (pivot < q) & (pivot != p) & same.any(axis=1)
        if c < lead:
            out |= (pivot < p) & same[:, :lead].any(axis=1)
    return out


def _presence(near: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """0/1 matrix, rows by those of their pivots that count."""
    pivots, column = np.unique(near[counts], return_inverse=True)
    has = np.zeros((len(near), len(pivots)), dtype=np.float32)
    has[np.nonzero(counts)[0], column] = 1
    return has


def _link_blocks(links: np.ndarray, to: np.ndarray, k: np.ndarray, unit: np.ndarray, near: np.ndarray, lead: int, block: np.ndarray,
                 first: int, second: int, p: int, q: int, threshold: float) -> None:
    """Links among many entries that share p and q, or between two blocks of
    them.  Where many pairs link, they are counted as a matrix, never listed."""
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    lower = _presence(near, (near < q) & (near != p))
    leading = _presence(near, (near < p) & (np.arange(near.shape[1]) < lead))
    for at in range(0, len(left), 512):
        a = left[at:at + 512]
        hit = unit[a] @ unit[right].T >= threshold
        if first == second:
            hit &= a[:, None] < right
        if 16 * np.count_nonzero(hit) <= hit.size:
            x, y = np.nonzero(hit)
            x, y = a[x], right[y]
            keep = ~_counted_elsewhere(near, lead, x, y, p, q)
            _add(links, to, k, x[keep], y[keep])
            continue
        hit &= (lower[a] @ lower[right].T == 0) & (leading[a] @ leading[right].T == 0)
        links[a] += (hit @ k[right].astype(np.float64)).astype(np.int64)
        links[right] += (k[a].astype(np.float64) @ hit).astype(np.int64)
        some = hit.any(axis=1)
        _merge(to, a[some], right[hit[some].argmax(axis=1)])
        some = hit.any(axis=0)
        _merge(to, right[some], a[hit[:, some].argmax(axis=0)])
        x, y = np.nonzero(hit & (to[a][:, None] != to[right]))
        _merge(to, a[x], right[y])


def _links_of_lists(unit: np.ndarray, near: np.ndarray, lead: int, row: np.ndarray, start: np.ndarray, p: np.ndarray, q: np.ndarray,
                    threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of many small groups that lie one after the other; start: each member's first of its group."""
    xs, ys = [], []
    x = np.arange(len(start))
    d = 1
    while True:
        x = x[x + d < len(start)]
        x = x[start[x + d] == start[x]]        # members that still have a partner at this distance
        if not len(x):
            break
        a, b = row[x], row[x + d]
        hit = np.concatenate([np.einsum("ij,ij->i", unit[a[i:i + 50_000]], unit[b[i:i + 50_000]]) for i in range(0, len(a), 50_000)]) >= threshold
        a, b = a[hit], b[hit]
        keep = ~_counted_elsewhere(near, lead, a, b, p[x[hit]], q[x[hit]])
        xs.append(a[keep])
        ys.append(b[keep])
        d += 1
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.empty(0, dtype=np.int64),) * 2


def _verify(table: pa.Table, kind: str, lead: int, threshold: float) -> pa.Table:
    """Links within the lists of one bucket."""
    label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    pivot, i, j, block, gid, k = (table.column(c).to_numpy() for c in ("pivot", "i", "j", "block", "gid", "k"))
    raw = table.column("v").to_pylist()
    size = np.array([len(v) for v in raw])
    near = np.stack([np.frombuffer(b, dtype=np.int32) for b in table.column("near").to_pylist()])
    order = np.lexsort((gid, j, i, pivot, label, size))
    label, pivot, i, j, block, gid, k, size, near = (x[order] for x in (label, pivot, i, j, block, gid, k, size, near))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (label[1:] != label[:-1]) | (pivot[1:] != pivot[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (size[1:] != size[:-1])
    part = np.cumsum(new) - 1
    links = np.zeros(len(gid), dtype=np.int64)
    to = np.arange(len(gid))
    for bytes_ in np.unique(size):
        of = np.flatnonzero(size == bytes_)
        unit = _unit([raw[r] for r in order[of]], kind)
        # each row under every pivot of its description but the list's own
        row, column = np.nonzero(near[of] != pivot[of][:, None])
        q = near[of][row, column]
        by = np.lexsort((row, q, part[of][row]))
        row, q = row[by], q[by]
        list_ = part[of][row]
        first = np.ones(len(row), dtype=bool)
        first[1:] = (list_[1:] != list_[:-1]) | (q[1:] != q[:-1])
        cuts = np.append(np.flatnonzero(first), len(row))
        count = np.diff(cuts)
        start, many = np.repeat(cuts[:-1], count), np.repeat(count, count)
        own = np.flatnonzero((many > 1) & (many <= SMALL) & (i[of][row] == j[of][row]))
        if len(own):
            x, y = _links_of_lists(unit, near[of], lead, row[own], start[own], pivot[of][row[own]], q[own], threshold)
            _add(links, to, k, of[x], of[y])
        for g in np.flatnonzero((count > SMALL) | ((count > 1) & (i[of][row[cuts[:-1]]] != j[of][row[cuts[:-1]]]))).tolist():
            r = row[cuts[g]:cuts[g + 1]]
            at = of[r]
            counted, reach = np.zeros(len(r), dtype=np.int64), np.arange(len(r))
            _link_blocks(counted, reach, k[at], unit[r], near[at], lead, block[at], int(i[at[0]]), int(j[at[0]]), int(pivot[at[0]]), int(q[cuts[g]]), threshold)
            links[at] += counted
            _merge(to, at, at[reach])
    some = links > 0
    return pa.table({"gid": pa.array(gid[some]), "links": pa.array(links[some]), "to": pa.array(gid[to[some]])})


def _add(links: np.ndarray, to: np.ndarray, k: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Count linked rows, and point each row at the least row it reaches."""
    np.add.at(links, x, k[y])
    np.add.at(links, y, k[x])
    _merge(to, x, y)


def _merge(to: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the components of linked rows: every row points at its component's least row."""
    while True:
        a, b = to[x], to[y]
        differ = a != b
        if not differ.any():
            return
        x, y, a, b = x[differ], y[differ], a[differ], b[differ]
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := to[to], to):
            to[:] = up


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.93, pivots: int | None = None, nearest: int = 8, lead: int = 4) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    element = dict(rows.dtypes)[vec_col]
    kind = "f4" if element == "array<float>" else "f8"
    plain = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vec_col}`").alias("v"))
    vectors = written(plain.mapInArrow(lambda it: _vectors(it, kind), "id bigint, label string, digest binary, v binary"), "vectors")
    entries = written(vectors.where("label is not null and digest is not null").groupBy("label", "digest")
                      .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("k"), F.min("v").alias("v"))
                      .withColumn("gid", F.monotonically_increasing_id()), "entries")
    n = entries.count()
    m = pivots or min(2048, max(64, n // 200))
    index = PivotIndex(m, kind, nearest, lead, threshold)

    lists = written(entries.select("label", "gid", "k", "v").mapInArrow(
        lambda it: _lists(it, index), "pivot int, label string, gid bigint, k bigint, v binary, near binary"), "lists")
    counts = lists.groupBy("pivot", "label").count().where("count > 1") \
        .select("pivot", "label", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))  # a list of one has no pair
    buckets = max(1, n * index.lead // BUCKET_ROWS)
    cut = lists.join(counts.hint("merge"), ["pivot", "label"]) \
        .withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")) \
        .withColumn("bucket", F.pmod(F.xxhash64("pivot", "label", "i", "j"), F.lit(buckets))).drop("blocks", "other")
    found = written(cut.groupBy("bucket").applyInArrow(lambda t: _verify(t, kind, index.lead, threshold), "gid bigint, links bigint, to bigint"), "links")
    groups = components(found.select(F.col("gid").alias("a"), F.col("to").alias("b")))
    counted = found.groupBy("gid").agg(F.sum("links").alias("links"))
    merged = entries.select("gid", "label", "digest", "least", "k").join(counted, "gid", "left").join(groups.withColumnRenamed("id", "gid"), "gid", "left") \
        .withColumn("component", F.coalesce("component", "gid"))
    least = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    result = merged.join(least, "component").select("label", "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("k") - 1).alias("n_links"))
    return vectors.select("id", "label", "digest").join(result, ["label", "digest"], "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
