"""Vectorised helpers over the UTF-8 bytes of text columns, used inside Arrow tasks.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` with A-Z lower-cased;
as all of these are ASCII, working on UTF-8 bytes equals working on characters.
A null text counts as an empty one.  Hashes are 64 bits and the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # bytes hashed at once; a longer text is a chunk of its own

_P = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1
_PINV = pow(_P, -1, 1 << 64)
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_WORD_BYTE = _BYTE.copy()
_WORD_BYTE[65:91] = _WORD_BYTE[97:123]
_WORD_BYTE[_SPACE] = 0
_MIX = [int(x) | 1 for x in _RNG.integers(1, 1 << 63, 64, dtype=np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up = np.full(n, _P, dtype=np.uint64)
            down = np.full(n, _PINV, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def byte_values(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's texts as bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [v or b"" for v in column.to_pylist()]


def chunks(values: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of values with at most ``limit`` bytes, or one longer value."""
    return size_ranges(map(len, values), limit)


def size_ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes add up to at most ``limit``, or one larger item."""
    lo = total = end = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n + 1
        end = i + 1
    if lo < end:
        yield lo, end


def small_batches(batches: Iterable[pa.RecordBatch], *columns: int | str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts (in these columns) have at most
    ``limit`` bytes, or one row: only a slice at a time becomes Python objects."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        for c in columns:
            sizes += pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in size_ranges(sizes.tolist(), limit):
            yield batch.slice(lo, hi - lo)


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a newline after each value, and each value's start (and the end)."""
    buf = np.frombuffer(b"\n".join(values) + b"\n", dtype=np.uint8)
    starts = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(v) + 1 for v in values], out=starts[1:])
    return buf, starts


def words(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each value's words begin (and the end)."""
    buf, starts = joined(values)
    space = _SPACE[buf]
    first = ~space
    first[1:] &= space[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.empty(0, dtype=np.uint64), np.zeros(len(values) + 1, dtype=np.int64)
    up, down = _POWERS.get(len(buf))
    h = np.add.reduceat(_WORD_BYTE[buf] * up, at) * down[at]
    last = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    h = mix64(h + (last - at).astype(np.uint64) * np.uint64(_MIX[0]))
    return h, np.searchsorted(at, starts)


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbours."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, (k * _MIX[1]) & _M, dtype=np.uint64)
    for j in range(k):
        out += h[j:j + n] * np.uint64(_MIX[2 + j])
    return mix64(out)


def shingle_sets(values: list[bytes], k: int) -> list[np.ndarray]:
    """Each value's distinct k-word shingles as sorted hashes.

    With fewer than k words the whole sequence is the one shingle; without
    words the set is empty.
    """
    h, ptr = words(values)
    runs = sequence_hashes(h, k)
    out = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if b - a >= k:
            s = np.sort(runs[a:b - k + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(sequence_hashes(h[a:b], b - a))
        else:
            out.append(runs[:0])
    return out


def pieces(values: list[bytes], limit: int, overlap: int) -> tuple[list[bytes], list[int], list[int]]:
    """Values cut so that none exceeds ``limit`` + ``overlap`` bytes; each cut
    repeats ``overlap`` bytes.  Returns the pieces, their values and offsets."""
    out, row, base = [], [], []
    for i, v in enumerate(values):
        for at in range(0, max(1, len(v) - overlap), limit):
            out.append(v if len(v) <= limit + overlap else v[at:at + limit + overlap])
            row.append(i)
            base.append(at)
            if len(v) <= limit + overlap:
                break
    return out, row, base


class RunHash:
    """Hashes of any runs of bytes of one buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray) -> None:
        self.up, self.down = _POWERS.get(len(buf) + 1)
        self.total = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[buf] * self.up[:-1], out=self.total[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k bytes from each position on."""
        n = len(self.total) - k
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mix64((self.total[k:] - self.total[:-k]) * self.down[:n])

    def runs(self, lo: np.ndarray, hi: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """Hash of bytes lo..hi-1, with their number and a salt."""
        h = mix64((self.total[hi] - self.total[lo]) * self.down[lo])
        return mix64(h + (hi - lo).astype(np.uint64) * np.uint64(_MIX[40]) + np.asarray(salt).astype(np.uint64) * np.uint64(_MIX[41]))


def sliding(values: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """op (minimum or maximum) over each w neighbours, by doubling."""
    out, size = values, 1
    while size < w:
        step = min(size, w - size)
        out = op(out[:-step], out[step:])
        size += step
    return out
