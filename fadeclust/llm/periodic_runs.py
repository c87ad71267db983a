"""Periodic runs: stretches of words that repeat themselves at least once.

A run is a stretch of consecutive words with smallest period q and a length of at
least ``least`` and 2 q that no neighbouring word extends keeping period q.

Internal pattern matching finds them.  Every run of period q in [2 L - 1, 4 L - 2]
holds an aligned block of L = 2**k words whose copy starts q words later, so each
aligned block of each level asks for its occurrences in the next windows of L
starts.  Such a window's occurrences form one progression, which a wavelet tree
over the suffix array gives by its number and first two members (range
successors); its members are the candidate periods.  A progression inside one
stretch of its own difference is left out, as its members are no smallest periods.
A candidate is extended to both sides by comparing names of dyadic blocks (the
ranks that make the suffix array), and kept if it is long enough.

Any run is covered by sequences of ``least`` / 2 words that occur again in the
same document, so only stretches covered by such sequences are indexed, each
closed by a word of its own; matches never cross stretches or documents.  Words
and sequences are told apart by 64-bit hashes.  Memory: about 300 bytes per word
of the longest such stretch, or of ``INDEX_WORDS`` words.

Rows are documents, each for itself, also those that repeat an id or have none.  A
null or empty text has no words, no runs and an empty collapsed text.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import RunHash, byte_values, joined, mix64, sequence_hashes, size_ranges, small_batches
from .work import numbered

INDEX_WORDS = 1 << 17   # words indexed at once; a longer stretch is indexed alone
_HASH_BYTES = 1 << 20
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_U = np.uint64


def word_hashes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (case counts), and where each value's words begin (and the end)."""
    buf, starts = joined(values)
    space = _SPACE[buf]
    first = ~space
    first[1:] &= space[:-1]
    at = np.flatnonzero(first)
    last = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    out = np.empty(len(at), dtype=_U)
    cuts = np.searchsorted(at, np.arange(0, len(buf), _HASH_BYTES))  # some bytes at once, or one longer word
    for lo, hi in zip(cuts, [*cuts[1:], len(at)]):
        if lo < hi:
            base = at[lo]
            out[lo:hi] = RunHash(buf[base:last[hi - 1]]).runs(at[lo:hi] - base, last[lo:hi] - base)
    return out, np.searchsorted(at, starts)


def repeated_stretches(h: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches (starts, ends) covered by sequences of k words that occur
    at least twice in the same value."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    value = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    whole = value[:n] == value[k - 1:]
    at = np.flatnonzero(whole)
    key = mix64(sequence_hashes(h, k)[at] + mix64((value[at] + 1).astype(_U)))
    order = np.argsort(key)
    again = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][again]] = True
    twice[order[:-1][again]] = True
    at = at[twice]
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    covered = np.cumsum(edge[:-1]) > 0
    change = np.ones(len(h), dtype=bool)
    change[1:] = (covered[1:] != covered[:-1]) | (value[1:] != value[:-1])
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(h))
    return start[covered[start]], end[covered[start]]


class WaveletMatrix:
    """A sequence of numbers below 2**bits; counts and order statistics of its
    ranges, many at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values)).bit_length())
        self.levels = []
        words = len(values) // 64 + 1
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 > 0
            padded = np.zeros(words * 64, dtype=bool)
            padded[:len(values)] = one
            packed = np.packbits(padded, bitorder="little").view("<u8")
            before = np.zeros(words, dtype=np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            self.levels.append((bit, packed, before, int(len(values) - one.sum())))
            values = np.concatenate([values[~one], values[one]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        return before[word] + np.bitwise_count(packed[word] & ((_U(1) << (i & 63).astype(_U)) - _U(1)))

    def count_below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values lo..hi-1 are below x."""
        out = np.zeros(len(lo), dtype=np.int64)
        for bit, packed, before, zeros in self.levels:
            a, b = self._ones(packed, before, lo), self._ones(packed, before, hi)
            up = (x >> bit) & 1 > 0
            out += np.where(up, hi - lo - (b - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values lo..hi-1."""
        out = np.zeros(len(lo), dtype=np.int64)
        for bit, packed, before, zeros in self.levels:
            a, b = self._ones(packed, before, lo), self._ones(packed, before, hi)
            below = hi - lo - (b - a)
            up = k >= below
            out |= np.where(up, 1 << bit, 0)
            k = np.where(up, k - below, k)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return out


def _ranked(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of equal keys, and how many there are."""
    order = np.argsort(key)
    new = np.empty(len(key), dtype=np.int32)
    step = np.zeros(len(key), dtype=np.int32)
    ordered = key[order]
    step[1:] = ordered[1:] != ordered[:-1]
    np.cumsum(step, out=step)
    new[order] = step
    return new, int(step[-1]) + 1


class RunIndex:
    """Names of all dyadic blocks, suffix array and wavelet tree of a sequence in
    which every stretch ends with a symbol that occurs once."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.n = len(symbols)
        names, number = _ranked(symbols)
        self.names = [names]
        while number < n:
            half = 1 << (len(self.names) - 1)
            key = names.astype(np.int64) * (n + 1)
            key[:n - half] += names[half:] + 1
            names, number = _ranked(key)
            self.names.append(names)
        self.order = np.empty(n, dtype=np.int64)
        self.order[names] = np.arange(n)
        self.tree = WaveletMatrix(self.order)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i < j on agree."""
        at = j.copy()
        for k in range(len(self.names) - 1, -1, -1):
            fits = at < self.n
            there = np.minimum(at, self.n - 1)
            at = np.where(fits & (self.names[k][there - (j - i)] == self.names[k][there]), at + (1 << k), at)
        return at - j

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i < j agree."""
        at = i.copy()
        for k in range(len(self.names) - 1, -1, -1):
            back = at - (1 << k)
            there = np.maximum(back, 0)
            at = np.where((back >= 0) & (self.names[k][there] == self.names[k][there + (j - i)]), back, at)
        return i - at

    def candidates(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Aligned blocks of 2**level symbols and the distances to their
        occurrences in the next windows."""
        size, names = 1 << level, self.names[level]
        first = np.zeros(int(names.max()) + 2, dtype=np.int64)
        np.cumsum(np.bincount(names), out=first[1:])
        block = np.arange(0, self.n - size + 1, size)
        lo, hi = first[names[block]], first[names[block] + 1]
        block, lo, hi = (x[hi - lo > 1] for x in (block, lo, hi))
        windows = [1, 3, 5, 7] if size == 2 else [2 * size - 1, 3 * size - 1, 4 * size - 1]
        found = []
        below = self.tree.count_below(lo, hi, np.minimum(block + windows[0], self.n))
        for end in windows[1:]:
            upto = self.tree.count_below(lo, hi, np.minimum(block + end, self.n))
            some = np.flatnonzero(upto > below)
            found.append(self._progressions(size, block[some], lo[some], hi[some], below[some], (upto - below)[some]))
            below = upto
        return tuple(np.concatenate(x) for x in zip(*found))

    def _progressions(self, size: int, block: np.ndarray, lo: np.ndarray, hi: np.ndarray, skip: np.ndarray, number: np.ndarray):
        start = self.tree.smallest(lo, hi, skip)
        step = np.zeros(len(block), dtype=np.int64)
        more = number > 1
        step[more] = self.tree.smallest(lo[more], hi[more], skip[more] + 1) - start[more]
        many = np.flatnonzero(number > 2)
        end = start[many] + (number[many] - 1) * step[many] + size
        within = self.ahead(block[many], block[many] + step[many]) >= end - block[many] - step[many]
        keep = np.ones(len(block), dtype=bool)
        keep[many[within]] = False
        block, start, step, number = block[keep], start[keep], step[keep], number[keep]
        which = np.repeat(np.arange(len(block)), number)
        member = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        return block[which], start[which] + member * step[which] - block[which]

    def runs(self, least: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of all runs; no stretch is longer than ``longest``."""
        found = []
        for level in range(1, len(self.names)):
            if level > 1 and 4 * (1 << level) - 2 > longest:
                break       # twice the least period of this level does not fit
            block, gap = self.candidates(level)
            ahead, behind = self.ahead(block, block + gap), self.behind(block, block + gap)
            start, end = block - behind, block + gap + ahead
            good = end - start >= np.maximum(least, 2 * gap)
            found.append(np.stack([start[good], end[good], gap[good]]))
        start, end, period = np.concatenate(found, axis=1) if found else np.empty((3, 0), dtype=np.int64)
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.ones(len(start), dtype=bool)       # of one stretch the smallest period
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        return start[new], end[new], period[new]


def find_runs(h: np.ndarray, ptr: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of all values, by word number in ``h``."""
    first, last = repeated_stretches(h, ptr, min(32, (least + 1) // 2))
    long = last - first >= least
    first, last = first[long], last[long]
    out = [np.empty((3, 0), dtype=np.int64)]
    for a, b in size_ranges((last - first).tolist(), INDEX_WORDS):
        sizes = last[a:b] - first[a:b] + 1
        ends = np.cumsum(sizes)
        shift = np.repeat(first[a:b] - (ends - sizes), sizes)
        place = np.arange(ends[-1]) + shift
        closing = ends - 1
        place[closing] = first[a:b]
        symbols, number = _ranked(h[place])
        symbols[closing] = number + np.arange(b - a, dtype=np.int32)
        start, end, period = RunIndex(symbols).runs(least, int(sizes.max()) - 1)
        out.append(np.stack([start + shift[start], end + shift[start], period]))
    start, end, period = np.concatenate(out, axis=1)
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _collapse(value: bytes, drop: list[tuple[int, int]]) -> bytes:
    parts = value.split()       # at the six white-space bytes
    if drop:
        keep = bytearray(b"\x01") * len(parts)
        for lo, hi in drop:
            keep[lo:hi] = bytes(hi - lo)
        parts = compress(parts, keep)
    return b" ".join(parts)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(least: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            values = byte_values(batch.column(1))
            h, ptr = word_hashes(values)
            start, end, period = find_runs(h, ptr, least)
            own = np.searchsorted(start, ptr)
            value = np.searchsorted(ptr, start, side="right") - 1
            fields = [pa.array(x) for x in (start - ptr[value], end - start, period)]
            runs = pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUNS.value_type)))
            drops = list(zip((start + period - ptr[value]).tolist(), (end - ptr[value]).tolist()))
            own = own.tolist()
            collapsed = [_collapse(v, drops[own[i]:own[i + 1]]) for i, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ptr)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])
    return scan


def periodic_runs(docs: DataFrame, least: int = 12, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_words, runs`` (``start, length, period`` in words, by start, then
    period) and ``collapsed`` (the words joined by a blank, without those that any
    run holds after its first period) of every row."""
    if least < 6:
        raise ValueError("runs of 6 words or more")
    rows = numbered(docs, doc_id, text)
    kind = rows.schema["c0"].dataType.simpleString()
    return rows.mapInArrow(_scan(least), f"id {kind}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
