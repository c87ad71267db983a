"""Packing of tokenised documents into sequences of fixed capacity.

Documents longer than the capacity are cut at its multiples; each piece is a row.
Pieces are packed by the histogram of their lengths alone (shortest-pack-first):
lengths are placed longest first, each into the pattern of the shortest packs
that still have room, and the counts of the patterns are updated; a new pattern
is opened where none has room.  The histogram has at most ``capacity`` entries
and the patterns are few, so this is the only work done on the driver.  Patterns
are joined back by rank: pieces of one length are ranked, and each pattern slot
takes a range of ranks.  A length is ranked in salted parts whose number follows
its count, so a length that a third of all pieces have is no hot group.

Null or empty texts have just the closing id.  Rows that repeat an id are
documents of their own (their pieces are told apart by an internal number).
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import byte_values, small_batches
from .work import numbered, written

CACHE_WORDS = 300_000
_encoders: dict[str, WordEncoder] = {}


def _byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes are themselves, the
    others are code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = (b for b in range(256) if b not in set(plain))
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class WordEncoder(dict):
    """Words (bytes without ASCII white space) to their ids as little-endian
    32-bit numbers, filled on demand and bounded.

    The tokenizer's pieces never span ASCII white space, so a text's ids are its
    words' in turn.  A-Z are lower-cased first, as the tokenizer does, except in
    a text that may hold the string of a special token.  A word of Latin letters
    is one piece and goes straight to the model; a tail of ASCII punctuation is
    the next piece; every other word goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in _encoders:  # kept for later tasks of the same worker
            _encoders[path] = cls(path)
        return _encoders[path]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        packed = self.packed
        text = word.decode()
        if text.isalpha() and max(text) < "\u0130":
            mapped = text.lower().encode().decode("latin-1").translate(self.alphabet)
            ids = b"".join([packed[t.id] for t in self.model.tokenize(mapped)])
        else:
            core = word.rstrip(b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~")
            if core != word and core.isalpha():
                ids = self[core] + self[word[len(core):]]
            else:
                ids = b"".join([packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


def pieces_of(docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for batch in small_batches(batches, 1):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
                data = encoder.encode(text) + end
                n = len(data) // 4
                for s in range(0, n, capacity):
                    piece = data[4 * s:4 * (s + capacity)]
                    rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in zip(*rows)],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    rows = numbered(docs, id_col, text_col).withColumn("c0", F.col("c0").cast("long"))
    return rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (the lengths of a pack, in order) and how many packs have each."""
    counts: dict[tuple[int, ...], int] = {}
    room: list[tuple[int, tuple[int, ...]]] = []  # heap: most room first
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if room and -room[0][0] >= length:
                free, pattern = heapq.heappop(room)
                free = -free
                n = counts[pattern]
                take = min(n, left)
                if take < n:
                    counts[pattern] = n - take
                    heapq.heappush(room, (-free, pattern))
                else:
                    del counts[pattern]
                grown, free = (*pattern, length), free - length
            else:  # a new pack, which then is the shortest until it is full
                each = min(capacity // length, left)
                take, grown, free = left // each, (length,) * each, capacity - each * length
                left += take - take * each
            if grown in counts:
                counts[grown] += take
            else:
                counts[grown] = take
                if free:
                    heapq.heappush(room, (-free, grown))
            left -= take
    return sorted(counts.items())


def placements(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Per pattern slot: length, first rank, ranks, first sequence, offset."""
    used: Counter = Counter()
    out, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            out.append((length, used[length], n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces with their place: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``; offsets in a sequence run from 0 without gaps."""
    spark = docs.sparkSession
    pieces = written(pieces_of(docs, path, id_col, text_col, capacity, end_id)
                     .withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    schema = "length long, first long, ranks long, sequence long, offset long"
    slots = spark.createDataFrame(placements(shortest_pack_first(histogram, capacity)), schema)
    # ranks: within salted parts of a length, plus the sizes of the parts before
    unit = max(64, sum(histogram.values()) // 2000)
    salts = spark.createDataFrame([(n, max(1, -(-c // unit))) for n, c in histogram.items()], "length long, salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts"))).drop("salts")
    sizes = sorted((r["length"], r["salt"], r["count"]) for r in salted.groupBy("length", "salt").count().collect())  # ~2000 + capacity rows
    before, at, last = [], 0, None
    for length, salt, n in sizes:
        at = 0 if length != last else at
        before.append((length, salt, at))
        at, last = at + n, length
    offsets = spark.createDataFrame(before, "length long, salt long, before long")
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")) - 1) \
        .join(F.broadcast(offsets), ["length", "salt"]).withColumn("rank", F.col("r") + F.col("before"))
    placed = ranked.alias("p").join(F.broadcast(slots).alias("s"), F.expr(
        "p.length = s.length and p.rank >= s.first and p.rank < s.first + s.ranks"))
    return placed.selectExpr("p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens",
                             "s.sequence + p.rank - s.first AS sequence_id", "s.offset")
