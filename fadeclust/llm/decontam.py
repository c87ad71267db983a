"""Benchmark decontamination: containment MinHash search, partitioned by size.

An item's set are its distinct five-word shingles (lower-cased A-Z, words split
at ASCII white space); with fewer words, its whole sequence is its one shingle,
which only documents of exactly these words share.  A document is contaminated
by an item if it contains at least ``threshold`` of the item's set.

The shingle hash serves as the random order of MinHash.  Of an item with n
shingles of which r must be shared, the n - r + s least hashes are its sketch:
a document that shares r of n shingles holds at least s of them, so a search for
documents that hold s sketch hashes misses none.  Items are partitioned by size
(powers of two); s and the least document size are set per partition, so short
items stay findable in documents thousands of times longer.  Candidates are
verified by counting shared shingles as strings.

Items are shipped to the tasks in blocks of at most ``BLOCK_BYTES``; more items
take more passes over the documents, which are never shuffled.

Null or empty texts share nothing and are in no result; a row that repeats an id
gives a row of its own; null ids are carried like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import byte_values, chunks, sequence_hashes, shingle_sets, small_batches, words
from .work import numbered, written

BLOCK_BYTES = 32 << 20


def shingle_strings(text: bytes, k: int) -> set[bytes]:
    w = text.lower().split()
    if len(w) < k:
        return {b" ".join(w)} if w else set()
    return {b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def needed(n: int, threshold: float) -> int:
    """Least number of n shingles that reaches the threshold."""
    return max(1, math.ceil(threshold * n - 1e-9))


class ItemIndex:
    """Sketches of one block of items: sorted hashes with the items of each."""

    def __init__(self, ids: list, texts: list[bytes], k: int, threshold: float) -> None:
        self.ids, self.texts, self.k = ids, texts, k
        sets = shingle_sets(texts, k)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        self.n = n
        self.need = np.array([needed(int(x), threshold) for x in n], dtype=np.int64)
        partition = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
        self.hits = np.ones(len(n), dtype=np.int64)
        for p in np.unique(partition):
            own = (partition == p) & (n > 0)
            if own.any():
                self.hits[own] = max(1, int(self.need[own].min()) // 8)
        self.least = int(self.need[n > 0].min()) if (n > 0).any() else 0
        h, item = [], []
        for i, s in enumerate(sets):
            m = len(s) - int(self.need[i]) + int(self.hits[i])
            h.append(s[:m])              # sorted: the least hashes
            item += [i] * len(h[-1])
        h = np.concatenate(h) if h else np.empty(0, dtype=np.uint64)
        order = np.argsort(h, kind="stable")
        self.item = np.array(item, dtype=np.int64)[order]
        self.hash, self.ptr = np.unique(h[order], return_index=True)
        self.ptr = np.append(self.ptr, len(h))
        self._strings: dict[int, set[bytes]] = {}

    def strings(self, i: int) -> set[bytes]:
        if i not in self._strings:
            self._strings[i] = shingle_strings(self.texts[i], self.k)
        return self._strings[i]

    def search(self, values: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(document, item, shared shingles) of all pairs that reach the threshold."""
        if not len(self.hash):
            return
        h, ptr = words(values)
        runs = sequence_hashes(h, self.k)
        doc = np.repeat(np.arange(len(values)), np.diff(ptr))[:len(runs)]
        ok = np.arange(len(runs)) + self.k <= ptr[1:][doc]
        short = [i for i, (a, b) in enumerate(zip(ptr[:-1].tolist(), ptr[1:].tolist())) if 0 < b - a < self.k]
        runs, doc = runs[ok], doc[ok]
        if short:
            runs = np.concatenate([runs, *[sequence_hashes(h[ptr[i]:ptr[i + 1]], int(ptr[i + 1] - ptr[i])) for i in short]])
            doc = np.concatenate([doc, np.array(short, dtype=doc.dtype)])
        at = np.searchsorted(self.hash, runs)
        at[at == len(self.hash)] = 0
        found = self.hash[at] == runs
        if not found.any():
            return
        pairs = np.unique(np.stack([doc[found], at[found]], axis=1), axis=0)
        size = self.ptr[pairs[:, 1] + 1] - self.ptr[pairs[:, 1]]
        d = np.repeat(pairs[:, 0], size)
        k = np.arange(len(d)) - np.repeat(np.cumsum(size) - size, size)
        item = self.item[np.repeat(self.ptr[pairs[:, 1]], size) + k]
        both, times = np.unique(np.stack([d, item], axis=1), axis=0, return_counts=True)
        both = both[times >= self.hits[both[:, 1]]]
        last, shingles = -1, set()
        for i, j in both.tolist():
            if i != last:
                last, shingles = i, shingle_strings(values[i], self.k)
            shared = len(shingles & self.strings(j)) if len(shingles) >= self.need[j] else 0
            if shared >= self.need[j]:
                yield i, j, shared


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 k: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared, containment`` with
    ``n_shared >= threshold * n_item``."""
    rows = numbered(docs, id_col, text_col).withColumn("c0", F.col("c0").cast("long"))
    bench = written(numbered(items, item_id_col, item_text_col).where("octet_length(c1) > 0")
                    .withColumn("c0", F.col("c0").cast("long")), "items")
    total = bench.agg(F.sum(F.octet_length("c1") + F.lit(64))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    schema = "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint, containment double"
    out = None
    for b in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("c0", "c1"), F.lit(blocks)) == b).collect()  # a block
        index = ItemIndex([r[0] for r in part], [r[1].encode() for r in part], k, threshold)
        found = rows.mapInArrow(_searcher(index), schema)
        out = found if out is None else out.union(found)
    return out


def _searcher(index: ItemIndex):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            ids = batch.column(0).to_pylist()
            values = byte_values(batch.column(1))
            rows = []
            for lo, hi in chunks(values):
                rows += [(ids[lo + i], index.ids[j], int(index.n[j]), shared) for i, j, shared in index.search(values[lo:hi])]
            if rows:
                d, j, n, s = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=pa.int64()) for x in (d, j, n, s)] + [pa.array([y / x for x, y in zip(n, s)], type=pa.float64())],
                    ["doc_id", "item_id", "n_item", "n_shared", "containment"])
    return search
