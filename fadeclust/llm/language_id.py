"""Language identification with string kernels.

A text's features are the n-grams of 2, 3 and 4 bytes that occur in it (A-Z
lower-cased, runs of other ASCII bytes than letters taken as one space): the
blended-spectrum presence kernel counts shared n-grams,

    k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|),

with G over the n-grams of at least two landmarks.  Landmarks are some training
texts per language (``landmarks`` each); the Nystroem map of a text is its kernel
row times K^-1/2, and one-versus-rest kernel ridge regression is fitted on it
over at most ``fit_rows`` training texts per language, none over ``FIT_BYTES``
(of a language that has only longer ones, the ``landmarks`` shortest): both are bounded samples
of labelled rows by hash of the id, the only part of the work that does not use
all rows.  A row without an id does not teach.

Prediction reads every whole text.  As kernel row, map and regression are
linear, scoring a batch is one product of its presence matrix with a matrix of
n-grams by languages, divided by each text's norm.

A text that is null or has no letter is ``und`` with score 0; other texts get a
learned language, equal scores going to the alphabetically first.  The score is
(1 + the ridge output of the predicted language) / 2, cut to 0..1.  Without any
labelled training row the language of a text with a letter is null.  Rows that
repeat an id are predicted one by one, each from its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import byte_values, chunks, joined, small_batches

FIT_BYTES = 64 << 10
ORDERS = (2, 3, 4)
_SLOT_BITS = (20, 16)  # of the first table of n-grams, and of those that take its collisions
_ROWS = 64  # texts per matrix product

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def _grams(buf: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram as a number unique over all orders, its text) per order, at all positions."""
    folded = _FOLD[buf]
    keep = np.ones(len(folded), dtype=bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    row = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))[keep]
    text = folded[keep].astype(np.uint64)
    for n in ORDERS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        g = np.full(m, n, dtype=np.uint64)
        for j in range(n):
            g = (g << np.uint64(8)) | text[j:j + m]
        same = row[:m] == row[n - 1:]
        yield g[same], row[:m][same]


def _slot(g: np.ndarray, level: int) -> np.ndarray:
    bits = _SLOT_BITS[min(level, 1)]
    return (g * np.uint64(0x9E3779B97F4A7C15 + 2 * level)) >> np.uint64(64 - bits)


class Vocabulary:
    """N-grams with a column each, found by table lookups: one for most; n-grams
    that share a slot follow in further tables, looked up only from such slots."""

    def __init__(self, grams: np.ndarray) -> None:
        self.grams = grams
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        left = np.arange(len(grams))
        while len(left):
            level = len(self.tables)
            size = 1 << _SLOT_BITS[min(level, 1)]
            key, column, more = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32), np.zeros(size, dtype=bool)
            slot = _slot(grams[left], level)
            first = np.zeros(len(left), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            key[slot[first]], column[slot[first]] = grams[left[first]], left[first]
            more[slot[~first]] = True
            self.tables.append((key, column, more))
            left = left[~first]

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in g of known n-grams, and their columns."""
        at, columns, left = [], [], np.arange(len(g))
        for level, (key, column, more) in enumerate(self.tables):
            slot = _slot(g[left], level)
            hit = key[slot] == g[left]
            at.append(left[hit])
            columns.append(column[slot[hit]])
            left = left[~hit & more[slot]]
            if not len(left):
                break
        return (np.concatenate(at), np.concatenate(columns)) if at else (left[:0], left[:0])

    def presence(self, values: list[bytes]) -> np.ndarray:
        """0/1 matrix, texts by n-grams."""
        buf, starts = joined(values)
        out = np.zeros((len(values), len(self.grams)), dtype=np.float32)
        flat = out.reshape(-1)
        for g, row in _grams(buf, starts):
            at, column = self.find(g)
            flat[row[at].astype(np.int64) * len(self.grams) + column] = 1
        return out


class LanguageModel:
    """Fitted vocabulary, weights by language, and the languages' names."""

    def __init__(self, texts: list[bytes], langs: list[str], landmarks: int, ridge: float) -> None:
        self.langs = sorted(set(langs))
        marks = []
        for lang in self.langs:
            own = [t for t, x in zip(texts, langs) if x == lang]
            marks += sorted(own, key=len, reverse=True)[:landmarks]
        seen: list[np.ndarray] = []
        for t in marks:
            buf, starts = joined([t])
            parts = [np.unique(g) for g, _ in _grams(buf, starts)]
            seen += parts
        grams, times = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.empty(0, np.uint64), np.empty(0, int))
        self.vocabulary = Vocabulary(grams[times >= min(2, len(marks))])
        basis = self._normed(marks)                       # landmarks x n-grams
        values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
        scale = np.where(values > 1e-6 * values.max(initial=1), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)
        root = (vectors * scale) @ vectors.T              # K^-1/2
        phi = np.concatenate([self._normed(texts[i:i + _ROWS]) @ basis.T for i in range(0, len(texts), _ROWS)]) @ root
        phi = np.hstack([phi, np.ones((len(phi), 1))])
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        w = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ y)
        self.weights = (basis.T @ (root @ w[:-1])).astype(np.float32)
        self.bias = w[-1]

    def _normed(self, texts: list[bytes]) -> np.ndarray:
        p = self.vocabulary.presence(texts)
        return p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))

    def predict(self, values: list[bytes]) -> tuple[list[str], list[float]]:
        p = self.vocabulary.presence(values)
        norm = np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        f = (p @ self.weights) / norm + self.bias
        best = f.argmax(axis=1)
        score = np.clip((1 + f[np.arange(len(f)), best]) / 2, 0, 1)
        letters = [_has_letter(v) for v in values]
        return ([self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters)],
                [float(s) if ok else 0.0 for s, ok in zip(score.tolist(), letters)])


_LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128)


def _has_letter(value: bytes) -> bool:
    rest = value.translate(None, _LETTERS)
    return len(rest) != len(value) or (not value.isascii() and any(c.isalpha() for c in value.decode("utf-8", "ignore")))


def fit(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str,
        landmarks: int = 48, fit_rows: int = 300, ridge: float = 1.0) -> LanguageModel | None:
    rows = docs.select(F.col(f"`{id_col}`").alias("c0"), F.col(f"`{text_col}`").alias("c1"), F.col(f"`{lang_col}`").alias("c2"),
                       F.coalesce(train, F.lit(False)).alias("train")).where("train and c0 is not null and c2 is not null")
    size = F.octet_length("c1")
    counts = {r["c2"]: r["n"] for r in rows.where("c1 is not null").groupBy("c2").agg(F.count_if(size <= FIT_BYTES).alias("n")).collect()}
    if not counts:
        return None
    # of each language about 2 fit_rows rows by hash of the id, then the least fit_rows hashes
    spread = 1 << 40
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(spread, 2 * fit_rows * spread // max(1, n)))])
    h = F.pmod(F.xxhash64("c0"), F.lit(spread))
    sample = rows.where((h < share[F.col("c2")]) & (size <= FIT_BYTES)).select("c2", h.alias("h"), "c1").collect()
    if long := [lang for lang, n in counts.items() if not n]:
        place = F.row_number().over(Window.partitionBy("c2").orderBy(size, "h"))
        sample += rows.where(F.col("c2").isin(long) & F.col("c1").isNotNull()).select("c2", h.alias("h"), "c1") \
            .withColumn("place", place).where(F.col("place") <= landmarks).collect()
    texts, langs = [], []
    for lang in sorted(counts):
        own = sorted((r["h"], r["c1"]) for r in sample if r["c2"] == lang)[:fit_rows]
        texts += [t.encode() for _, t in own]
        langs += [lang] * len(own)
    return LanguageModel(texts, langs, landmarks, ridge) if texts else None


def languages(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang", **fitting) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``."""
    model = fit(docs, train, id_col, text_col, lang_col, **fitting)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            values = byte_values(batch.column(1))
            langs: list[str | None] = [None if _has_letter(v) else "und" for v in values] if model is None else [None] * len(values)
            scores = [0.0] * len(values)
            if model is not None:
                for lo, hi in chunks(values, 1 << 20):
                    for at in range(lo, hi, _ROWS):
                        end = min(hi, at + _ROWS)
                        langs[at:end], scores[at:end] = model.predict(values[at:end])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("c0"), F.col(f"`{text_col}`").alias("c1"))
    return rows.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")
