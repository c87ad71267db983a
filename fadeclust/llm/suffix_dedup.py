"""Removal of long byte strings that occur earlier in the corpus.

A byte is removed if a ``length``-byte string (100 by default) that covers it
also starts earlier: in a document with a smaller id, or before in the same one.
Matches never cross documents and are judged on the input.

1. Every window of ``length`` bytes is assigned to the anchor in it, the
   ``gram``-byte string of least hash, so equal windows have equal anchors at
   equal offsets.  An anchor's context is the run of bytes of its windows.
2. A scan aggregates equal contexts to their first occurrence, some hundred
   thousand at a time; every later one repeats in full.  What is left is dealt
   out by anchor and sorted, which aggregates it over the whole corpus and drops
   the contexts whose anchor has no other.
3. The first occurrences of different contexts of one anchor are compared by a
   suffix array (:mod:`suffix_array`) over buckets of contexts: positions are
   grouped by equal prefixes in suffix order, and all but the earliest window of
   a group is repeated.  The array is over eight-byte symbols aligned at the
   anchor; the rest of a window, less than two symbols, is compared beside it.
4. An anchor with more than ``HOT_CONTEXTS`` different contexts is not put into
   one bucket: its windows are aggregated by content over all tasks.

Nulls and odd rows: a null text is an empty one; rows without an id take no part
and stay as they are; rows that repeat an id are the same place, so none of them
is earlier than the other.  Other columns of the input are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffix_array import suffix_array
from .text import RunHash, byte_values, chunks, joined, mix64, pieces, sliding, small_batches
from .work import join_side, numbered, written

PIECE_BYTES = 1 << 19
BUCKET_BYTES = 128 << 10
HOT_CONTEXTS = 32768
BLOCK_PLACES = 250_000     # places aggregated at once by a scan
_SYMBOL = 8
_LEN_BITS = 12           # a range is packed as start << _LEN_BITS | bytes
_LEN_MASK = (1 << _LEN_BITS) - 1
MOST_LENGTH = 1 << (_LEN_BITS - 1)      # a context has less than twice the length


def anchors(buf: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Anchors of all windows in one buffer of newline-ended pieces: position,
    first and last start of their windows, hash, and hash of the context."""
    w = length - gram + 1
    run = RunHash(buf)
    g = run.grams(gram)
    m = sliding(g, w, np.minimum)
    empty = np.empty(0, dtype=np.int64)
    if len(buf) < length:
        return empty, empty, empty, g[:0], g[:0]
    for a, z in zip(starts[:-1].tolist(), (starts[1:] - 1).tolist()):
        m[max(a, z - length + 1):z + 1] = 0
    pad = np.zeros(w - 1, dtype=np.uint64)
    most = sliding(np.concatenate([pad, m, pad]), w, np.maximum)[:len(g)]
    p = np.flatnonzero((most == g) & (most != 0))
    if not len(p):
        return empty, empty, empty, g[:0], g[:0]
    first = np.concatenate([[0], np.flatnonzero(m[1:] != m[:-1]) + 1])
    last = np.append(first[1:], len(m)) - 1
    value, h = m[first], g[p]
    r = np.searchsorted(first, np.minimum(p, len(m) - 1), side="right") - 1
    off = np.flatnonzero(value[r] != h)
    while len(off):
        r[off] -= 1
        off = off[value[r[off]] != h[off]]
    lo = np.maximum(first[r], p - w + 1)
    hi = np.minimum(last[r], p)
    return p, lo, hi, h, run.runs(lo, hi + length, p - lo)


def _places(batches: Iterator[pa.RecordBatch], length: int, gram: int):
    """Blocks of places (anchor, context, document, packed start, context bytes and anchor offset)."""
    held, size = [], 0
    for batch in small_batches(batches, 1):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        parts, row, base = pieces(byte_values(batch.column(1)), PIECE_BYTES, length - 1)
        row, base = np.asarray(row, dtype=np.int64), np.asarray(base, dtype=np.int64)
        for i, j in chunks(parts, PIECE_BYTES):
            buf, starts = joined(parts[i:j])
            p, lo, hi, h, c = anchors(buf, starts, length, gram)
            piece = np.searchsorted(starts, p, side="right") - 1
            shift = base[i:j][piece] - starts[piece]
            held.append((h.view(np.int64), c.view(np.int64), ids[row[i:j][piece]],
                         ((lo + shift) << 2 * _LEN_BITS) | ((hi - lo + length) << _LEN_BITS) | (p - lo)))
            size += len(h)
            if size >= BLOCK_PLACES:
                yield [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _sorted_runs(h, c, doc, at):
    """Order by all columns, and where a new anchor, context or place begins in it."""
    order = np.lexsort((at, doc, c, h))
    h, c, doc, at = h[order], c[order], doc[order], at[order]
    new_h = np.ones(len(h), dtype=bool)
    new_h[1:] = h[1:] != h[:-1]
    new_c = new_h.copy()
    new_c[1:] |= c[1:] != c[:-1]
    return h, c, doc, at, new_h, new_c


def _range(at: np.ndarray) -> np.ndarray:
    """The packed byte range of a packed place."""
    return (at >> 2 * _LEN_BITS << _LEN_BITS) | (at >> _LEN_BITS & _LEN_MASK)


def _later(doc: np.ndarray, at: np.ndarray, new_c: np.ndarray) -> np.ndarray:
    """Places that are not the first one of their context (nor the same place)."""
    first = np.flatnonzero(new_c)[np.cumsum(new_c) - 1]
    return (doc != doc[first]) | (at != at[first])


def _local_firsts(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for block in _places(batches, length, gram):
        h, c, doc, at, _, new_c = _sorted_runs(*block)
        for k in range(0, len(h), 100_000):
            s = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[s][new_c[s]]) for x in (h, c, doc, at)], ["h", "c", "doc", "at"])


def _local_repeats(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for block in _places(batches, length, gram):
        _, _, doc, at, _, new_c = _sorted_runs(*block)
        again = _later(doc, at, new_c)
        yield pa.RecordBatch.from_arrays([pa.array(doc[again]), pa.array(_range(at[again]))], ["doc", "range"])


def _global_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over places sorted by anchor, context and place: later places of a context
    (h null), and first places of the contexts of anchors with several."""
    schema = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])
    last = None        # the context that the batch before ended in: (h, c, first doc, first at, given out)
    for batch in batches:
        if not batch.num_rows:
            continue
        h, c, doc, at = (x.to_numpy() for x in batch.columns)
        if last is not None:  # its first place leads, so the batch is judged as one run with it
            h, c, doc, at = (np.concatenate([[v], x]) for v, x in zip(last[:4], (h, c, doc, at)))
        new_h = np.ones(len(h), dtype=bool)
        new_h[1:] = h[1:] != h[:-1]
        new_c = new_h.copy()
        new_c[1:] |= c[1:] != c[:-1]
        again = _later(doc, at, new_c)
        contexts = np.add.reduceat(new_c.astype(np.int64), np.flatnonzero(new_h))
        several = (contexts > 1)[np.cumsum(new_h) - 1]
        if last is not None and last[4]:      # an anchor known to have several goes on
            several |= np.cumsum(new_h) == 1
        firsts = new_c & several
        if last is not None and last[4]:
            firsts[0] = False                 # it was given out before
        for keys, rows, values in ((None, again, _range(at)), (h, firsts, at)):
            n = int(rows.sum())
            if n:
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if keys is None else pa.array(keys[rows]),
                                                  pa.array(doc[rows]), pa.array(values[rows])], schema=schema)
        k = int(np.flatnonzero(new_c)[-1])
        last = (h[k], c[k], doc[k], at[k], bool(several[k]))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = 100, gram: int = 32) -> DataFrame:
    """Per document with repeats: ``doc`` and ``ranges``, packed byte ranges
    (unsorted, possibly overlapping) that are repeated from earlier places.
    ``length`` is at most ``MOST_LENGTH`` - 1."""
    if not gram <= length < MOST_LENGTH:
        raise ValueError(f"a length from {gram} to {MOST_LENGTH - 1}")
    rows = numbered(docs, id_col, text_col).where("c0 is not null and octet_length(c1) >= %d" % length) \
        .select(F.col("c0").cast("long").alias("c0"), "c1")
    places = rows.mapInArrow(lambda it: _local_firsts(it, length, gram), "h bigint, c bigint, doc bigint, at bigint")
    merged = written(places.repartition("h").sortWithinPartitions("h", "c", "doc", "at")
                     .mapInArrow(_global_firsts, "h bigint, doc bigint, at bigint"), "places")
    again = rows.mapInArrow(lambda it: _local_repeats(it, length, gram), "doc bigint, range bigint") \
        .union(merged.where("h is null").select("doc", F.col("at").alias("range")))
    firsts = merged.where("h is not null")
    hot = written(firsts.groupBy("h").count().where(F.col("count") > HOT_CONTEXTS).select("h", F.lit(True).alias("hot")), "hot")
    marked = join_side(firsts, hot, "h", "hot")
    tried = written(marked.groupBy("doc").agg(F.collect_list(F.struct("h", F.col("hot").isNotNull().alias("hot"), "at")).alias("parts")), "contexts")
    texts = join_side(rows.select(F.col("c0").alias("doc"), "c1"), tried, "doc", "parts", "inner")
    cut = written(texts.mapInArrow(_cut, "h bigint, hot boolean, doc bigint, lo bigint, a int, bytes binary"), "cut")
    total = cut.where("not hot").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(1, total // BUCKET_BYTES)
    sorted_out = cut.where("not hot").withColumn("bucket", F.pmod(F.hash("h"), F.lit(buckets))) \
        .groupBy("bucket").applyInArrow(lambda t: _by_suffixes(t, length), "doc bigint, range bigint")
    found = again.union(sorted_out).union(_hot(cut.where("hot"), length))
    return found.groupBy("doc").agg(F.collect_set("range").alias("ranges"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed contexts of each text."""
    for batch in small_batches(batches, "c1"):
        values = byte_values(batch.column("c1"))
        lists = batch.column("parts")
        ptr = lists.offsets.to_numpy()
        parts = lists.flatten()
        if not len(parts):
            continue
        counts = np.diff(ptr)
        field = lambda name: parts.field(name).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(values)), counts)
        at = field("at")
        lo, n, a = at >> 2 * _LEN_BITS, at >> _LEN_BITS & _LEN_MASK, at & _LEN_MASK
        docs = batch.column("doc").to_numpy(zero_copy_only=False)[row]
        h, hot = field("h"), field("hot")
        for k in range(0, len(at), 20000):
            s = slice(k, k + 20000)
            out = [values[r][x:x + m] for r, x, m in zip(row[s].tolist(), lo[s].tolist(), n[s].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h[s], hot[s], docs[s], lo[s], a[s].astype(np.int32))] + [pa.array(out, type=pa.binary())],
                ["h", "hot", "doc", "lo", "a", "bytes"])


def repeated_windows(parts: list[bytes], a: np.ndarray, order: np.ndarray, length: int):
    """Which windows of some contexts repeat an earlier one among them.

    ``a``: each context's anchor offset; ``order``: a number per context such
    that ``order + start`` orders the windows.  Returns, for all windows of all
    contexts in turn, the context, the start in it, and whether it is repeated.
    """
    sizes = np.array([len(b) for b in parts], dtype=np.int64)
    shift = a % _SYMBOL
    full = (sizes - shift) // _SYMBOL
    text = b"".join(parts)
    at = np.cumsum(sizes) - sizes
    data = np.frombuffer(text, dtype=np.uint8)
    # symbols of all contexts, each followed by a separator (0)
    ctx = np.repeat(np.arange(len(parts)), full)
    first = np.cumsum(full + 1) - (full + 1)
    k = np.arange(len(ctx)) - np.repeat(np.cumsum(full) - full, full)
    cells = data[(at[ctx] + shift[ctx] + _SYMBOL * k)[:, None] + np.arange(_SYMBOL)].view(np.uint64).ravel()
    _, rank = np.unique(cells, return_inverse=True)
    symbols = np.zeros(int((full + 1).sum()), dtype=np.int64)
    symbols[first[ctx] + k] = rank + 1
    inner = (length - _SYMBOL + 1) // _SYMBOL     # full symbols in any window
    sa = suffix_array(symbols)
    left = np.zeros(len(symbols), dtype=np.int64)  # symbols from here to the separator
    left[first[ctx] + k] = full[ctx] - k
    sa = sa[left[sa] >= inner]
    grid = symbols[sa[:, None] + np.arange(inner)] if len(sa) else np.empty((0, inner), dtype=np.int64)
    name = np.zeros(len(symbols), dtype=np.int64)
    if len(sa):
        new = np.ones(len(sa), dtype=bool)
        new[1:] = (grid[1:] != grid[:-1]).any(axis=1)
        name[sa] = np.cumsum(new)                  # equal prefixes are neighbours in suffix order
    count = sizes - length + 1
    ctx = np.repeat(np.arange(len(parts)), count)
    start = np.arange(len(ctx)) - np.repeat(np.cumsum(count) - count, count)
    before = (shift[ctx] - start) % _SYMBOL
    cell = (start + before - shift[ctx]) // _SYMBOL
    key = mix64(name[first[ctx] + cell].astype(np.uint64) * np.uint64(_SYMBOL) + before.astype(np.uint64))
    for j in range(length - inner * _SYMBOL):      # the bytes beside those symbols
        i = at[ctx] + start + np.where(j < before, j, j + inner * _SYMBOL)
        key = key * np.uint64(0x9E3779B97F4A7C15) + data[i] + np.uint64(1)
    key = mix64(key)
    place = order[ctx] + start
    by = np.lexsort((place, key))
    fresh = np.ones(len(by), dtype=bool)
    fresh[1:] = key[by[1:]] != key[by[:-1]]
    earliest = place[by[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]] if len(by) else place
    repeated = np.zeros(len(by), dtype=bool)
    repeated[by] = place[by] != earliest
    return ctx, start, repeated


def _by_suffixes(table: pa.Table, length: int) -> pa.Table:
    """Repeated ranges among the contexts of one bucket."""
    parts = [b for b in table.column("bytes").combine_chunks().to_pylist()]
    doc, lo, a = (table.column(x).to_numpy() for x in ("doc", "lo", "a"))
    _, rank = np.unique(doc, return_inverse=True)
    ctx, start, repeated = repeated_windows(parts, a.astype(np.int64), (rank.astype(np.int64) << 40) + lo, length)
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    # a run of repeated windows ends with its context
    border = np.flatnonzero(np.diff(ctx)) + 1
    border = border[repeated[border] & repeated[border - 1]]
    begin = np.sort(np.concatenate([np.flatnonzero(edge == 1), border]))
    end = np.sort(np.concatenate([np.flatnonzero(edge == -1), border])) - 1
    c = ctx[begin]
    packed = ((lo[c] + start[begin]) << _LEN_BITS) | (start[end] - start[begin] + length)
    return pa.table({"doc": pa.array(doc[c], type=pa.int64()), "range": pa.array(packed, type=pa.int64())})


def _hot(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: their windows, aggregated by content."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = byte_values(part.column("bytes"))
                buf, starts = joined(values)
                run = RunHash(buf)
                count = np.diff(starts) - length
                row = np.repeat(np.arange(len(values)), count)
                start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                s = starts[row] + start
                half = run.runs(s, s + length // 2, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (run.runs(s, s + length).view(np.int64), half.view(np.int64),
                                           part.column("doc").to_numpy()[row], part.column("lo").to_numpy()[row] + start)],
                    ["k1", "k2", "doc", "at"])

    rows = cut.mapInArrow(windows, "k1 bigint, k2 bigint, doc bigint, at bigint")
    first = rows.groupBy("k1", "k2").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
    return rows.join(first, ["k1", "k2"]).where("(doc, at) != (first.doc, first.at)") \
        .select("doc", F.shiftleft("at", _LEN_BITS).bitwiseOR(F.lit(length).cast("long")).alias("range"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 100, gram: int = 32, rows: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``kept`` (binary, the remaining bytes),
    ``kept_text`` (the same without cut characters), ``n_bytes``, ``n_removed``
    and ``n_spans`` (maximal removed runs); with ``rows`` also ``row``, the whole input row."""
    ranges = written(repeated_ranges(docs, id_col, text_col, length, gram), "ranges")
    own = [F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("c1")]
    if rows:
        own.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    joined = join_side(docs.select(*own), ranges, "doc", "ranges")
    schema = "doc_id bigint, kept binary, kept_text string, n_bytes bigint, n_removed bigint, n_spans bigint"
    if rows:
        schema += f", row {docs.drop(text_col).schema.simpleString()}"
    return joined.mapInArrow(_keep, schema)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "c1"):
        values = byte_values(batch.column("c1"))
        lists = batch.column("ranges").to_pylist()
        kept, removed, spans = [], [], []
        for v, ranges in zip(values, lists):
            if not ranges:
                kept.append(v)
                removed.append(0)
                spans.append(0)
                continue
            packed = np.sort(np.asarray(ranges, dtype=np.int64))
            lo, hi = packed >> _LEN_BITS, (packed >> _LEN_BITS) + (packed & _LEN_MASK)
            reach = np.maximum.accumulate(hi)
            new = np.ones(len(lo), dtype=bool)
            new[1:] = lo[1:] > reach[:-1]
            begin = lo[new].tolist()
            end = reach[np.append(np.flatnonzero(new)[1:], len(lo)) - 1].tolist()
            kept.append(b"".join(v[x:y] for x, y in zip([0, *end], [*begin, len(v)])))
            removed.append(sum(end) - sum(begin))
            spans.append(len(begin))
        texts = [k.decode("utf-8", "ignore") for k in kept]
        columns = [batch.column("doc"), pa.array(kept, type=pa.binary()), pa.array(texts, type=pa.string())] \
            + [pa.array(x, type=pa.int64()) for x in ([len(v) for v in values], removed, spans)]
        names = ["doc_id", "kept", "kept_text", "n_bytes", "n_removed", "n_spans"]
        if "row" in batch.schema.names:
            columns.append(batch.column("row"))
            names.append("row")
        yield pa.RecordBatch.from_arrays(columns, names)
