"""Scores of whole texts under a smoothed n-gram model, as a weighted backoff automaton.

Tokens are words (A-Z lower-cased, split at ASCII white space) and one end token
per text.  With counts c over the training texts, N tokens and V distinct ones,

    p(w)         = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | ctx)   = (c(ctx w) + prior * p(w | shorter ctx)) / (c(ctx) + prior)

for contexts of up to ``order - 1`` tokens within the text (one unknown token
takes the rest of p).  In the automaton every context seen in training is a
state.  A seen n-gram is an arc that bears its log-probability; a state's failure
arc leads to the context without its first token and bears
log10(prior / (c(ctx) + prior)).  A text is read once from left to right: the
state is carried, failure arcs are taken until an arc bears the token, and the
weights on the way add up to the text's log10 probability.

The model is never in one place.  Texts are dealt out to blocks of a few MB.  A
block asks for the counts of its distinct n-grams and adds its own training
counts; the n-grams' shards add up all blocks and answer each in its own order;
the block then builds the automaton of its own n-grams and scores its texts.
Every count covers all training texts, and hot n-grams are one entry per block.

Null texts are empty (one token, the end); rows that repeat an id are texts of
their own; texts that are not marked for training, or marked null, are only scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import byte_values, chunks, mix64, sequence_hashes, small_batches, words

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
END = np.uint64(0x3C79AC492BA7B653)


def _tokens(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end token after each, and their starts."""
    h, ptr = words(values)
    return np.insert(h, ptr[1:], END), ptr + np.arange(len(ptr))


def _keys(tokens: np.ndarray, ptr: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of the m-gram that ends at each position, and whether it lies in one text."""
    ok = np.arange(len(tokens)) - np.repeat(ptr[:-1], np.diff(ptr)) >= m - 1
    key = np.zeros(len(tokens), dtype=np.uint64)
    key[m - 1:] = mix64(sequence_hashes(tokens, m) + np.uint64(m))
    return key, ok


def _block_keys(values: list[bytes], order: int):
    """Distinct n-gram keys of some texts, sorted, and each position's index per length (-1: none)."""
    parts = [_tokens(values[lo:hi]) for lo, hi in chunks(values, 1 << 20)]
    shift = np.cumsum([0] + [len(t) for t, _ in parts])
    tokens = np.concatenate([t for t, _ in parts])
    ptr = np.concatenate([p[:-1] + s for (_, p), s in zip(parts, shift.tolist())] + [shift[-1:]])
    del parts
    all_keys = [_keys(tokens, ptr, m) for m in range(1, order + 1)]
    flat = np.concatenate([k[ok] for k, ok in all_keys])
    distinct, inverse = np.unique(flat, return_inverse=True)
    index, at = [], 0
    for _, ok in all_keys:
        one = np.full(len(tokens), -1, dtype=np.int64)
        n = int(ok.sum())
        one[ok] = inverse[at:at + n]
        at += n
        index.append(one)
    return ptr, distinct, index


def _pack(counts: np.ndarray) -> bytes:
    """Counts in a byte each; larger ones follow in eight bytes, in order."""
    large = counts[counts >= 255].astype(np.uint64)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, dtype=np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, dtype=np.uint64, offset=n).astype(np.int64)
    return out


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the steps between them, in as many bytes each as the largest step needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + keys[:1].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    cells = np.frombuffer(data, dtype=np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(cells), 8), dtype=np.uint8)
    steps[:, :width] = cells
    return np.cumsum(np.concatenate([np.frombuffer(data, dtype=np.uint64, count=1, offset=1), steps.view(np.uint64).ravel()]), dtype=np.uint64)


def _edges(distinct: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of the sorted keys begins (and the end)."""
    bounds = np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, bounds), [len(distinct)]]).astype(np.int64)


def _ask(table: pa.Table, order: int, shards: int) -> pa.Table:
    block = table.column("block")[0].as_py()
    ptr, distinct, index = _block_keys(byte_values(table.column("c1")), order)
    train = np.repeat(np.array(table.column("train").to_pylist(), dtype=bool), np.diff(ptr))
    counts = np.zeros(len(distinct), dtype=np.int64)
    for one in index:
        counts += np.bincount(one[train & (one >= 0)], minlength=len(distinct))
    cut = _edges(distinct, shards)
    parts = [(s, slice(a, b)) for s, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if b > a]
    return pa.table({
        "shard": pa.array([s for s, _ in parts], type=pa.int32()), "block": pa.array([block] * len(parts), type=pa.int64()),
        "keys": pa.array([_pack_keys(distinct[p]) for _, p in parts], type=pa.binary()),
        "counts": pa.array([_pack(counts[p]) for _, p in parts], type=pa.binary())})


def _answer(table: pa.Table) -> pa.Table:
    keys = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
    counts = [_unpack(c, len(k)) for k, c in zip(keys, table.column("counts").to_pylist())]
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    name = np.cumsum(new) - 1
    total = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))
    answer = np.empty(len(flat), dtype=np.int64)
    answer[order] = total[name]
    cut = np.cumsum([0] + [len(k) for k in keys])
    return pa.table({"block": table.column("block"), "shard": table.column("shard"),
                     "totals": pa.array([_pack(answer[a:b]) for a, b in zip(cut[:-1], cut[1:])], type=pa.binary())})


class Automaton:
    """Backoff automaton over the n-grams of one block."""

    ROOT = 0

    def __init__(self, index: list[np.ndarray], totals: np.ndarray, n: int, v: int, prior: float) -> None:
        base = n + 0.1 * (v + 1)
        first = np.full(len(totals), -1, dtype=np.int64)  # a position of each n-gram
        for one in index:
            at = np.flatnonzero(one >= 0)
            first[one[at]] = at
        token = index[0]
        self.token_count = len(totals)
        p = np.zeros(len(totals))                         # each n-gram's smoothed probability
        grams = [np.unique(one[one >= 0]) for one in index]
        p[grams[0]] = (totals[grams[0]] + 0.1) / base
        self.unigram = np.log10(p, where=p > 0, out=np.zeros(len(p)))
        # states: contexts seen in training, numbered from 1; the root is 0
        state = np.zeros(len(totals), dtype=np.int64)
        contexts = np.concatenate([g[totals[g] > 0] for g in grams[:-1]]) if len(grams) > 1 else grams[0][:0]
        state[contexts] = np.arange(1, len(contexts) + 1)
        self.fail_weight = [0.0] * (len(contexts) + 1)
        self.fail_state = [self.ROOT] * (len(contexts) + 1)
        self.arcs: dict[int, int] = {}
        weight, to = [], []
        for m, g in enumerate(grams[:-1], start=1):       # m: length of the context
            own = g[totals[g] > 0]
            shorter = state[index[m - 2][first[own]]] if m > 1 else np.zeros(len(own), dtype=np.int64)
            for s, f, q in zip(state[own].tolist(), np.log10(prior / (totals[own] + prior)).tolist(), shorter.tolist()):
                self.fail_weight[s], self.fail_state[s] = f, q
            grown = grams[m]
            r = first[grown]
            prefix, suffix = index[m - 1][r - 1], index[m - 1][r]
            c = totals[prefix]
            p[grown] = (totals[grown] + prior * p[suffix]) / (c + prior)
            seen = totals[grown] > 0
            grown, r = grown[seen], r[seen]
            # the state after an arc is the n-gram itself, or its suffix at full order
            target = state[grown] if m + 1 < len(grams) else state[suffix[seen]]
            keys = state[prefix[seen]] * self.token_count + token[r]
            self.arcs.update(zip(keys.tolist(), range(len(weight), len(weight) + len(grown))))
            weight += np.log10(p[grown]).tolist()
            to += target.tolist()
        self.weight, self.to = weight, to
        self.root_weight, self.root_to = self.unigram.tolist(), state.tolist()

    def score(self, tokens: list[int]) -> float:
        arcs, weight, to, n = self.arcs, self.weight, self.to, self.token_count
        fail_weight, fail_state = self.fail_weight, self.fail_state
        root_weight, root_to = self.root_weight, self.root_to
        state, total = 0, 0.0
        for t in tokens:
            while state:
                arc = arcs.get(state * n + t)
                if arc is not None:
                    total += weight[arc]
                    state = to[arc]
                    break
                total += fail_weight[state]
                state = fail_state[state]
            else:
                total += root_weight[t]
                state = root_to[t]
        return total


def _score(answers: pa.Table, table: pa.Table, order: int, n: int, v: int, prior: float, shards: int) -> pa.Table:
    values = byte_values(table.column("c1"))
    ptr, distinct, index = _block_keys(values, order)
    cut = _edges(distinct, shards)
    totals = np.zeros(len(distinct), dtype=np.int64)
    for s, data in zip(answers.column("shard").to_pylist(), answers.column("totals").to_pylist()):
        totals[cut[s]:cut[s + 1]] = _unpack(data, int(cut[s + 1] - cut[s]))
    model = Automaton(index, totals, n, v, prior)
    token = index[0]
    known = np.concatenate([[0], np.cumsum(totals[token] > 0)])
    base = [math.fsum(model.unigram[token[a:b]]) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
    score = [model.score(token[a:b].tolist()) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
    return pa.table({
        "doc_id": table.column("c0"), "n_tokens": pa.array(np.diff(ptr)), "n_known": pa.array(known[ptr[1:]] - known[ptr[:-1]]),
        "train_tokens": pa.array([n] * len(values), type=pa.int64()),
        "base_score": pa.array(base, type=pa.float64()), "score": pa.array(score, type=pa.float64())})


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 0, limit=16 << 20):
        values = byte_values(batch.column(0))
        found = []
        for lo, hi in chunks(values):
            found.append(np.unique(_tokens(values[lo:hi])[0], return_counts=True))
        if found:
            t, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            c = np.bincount(where, weights=np.concatenate([f[1] for f in found])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(c)], ["t", "c"])


def lm_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
              order: int = 2, prior: float = 256.0) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known`` (tokens seen in
    training), ``train_tokens`` (N), ``base_score`` (log10 of the unigram
    probability) and ``score`` (log10 of the model's)."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    rows = docs.select(F.coalesce(train, F.lit(False)).alias("train"), F.col(f"`{id_col}`").cast("long").alias("c0"),
                       F.col(f"`{text_col}`").alias("c1"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("c1"), F.lit(0)) + F.lit(1)).alias("n")).first()["n"] or 0
    blocks, shards = max(1, size // BLOCK_BYTES), max(1, size // SHARD_BYTES)
    counted = rows.where("train").select("c1").mapInArrow(_unigrams, "t bigint, c bigint").groupBy("t").agg(F.sum("c").alias("c")) \
        .agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    n, v = counted["n"] or 0, counted["v"]

    dealt = rows.select(F.pmod(F.xxhash64("c0", F.octet_length("c1")), F.lit(blocks)).alias("block"), "train", "c0", "c1")
    asked = dealt.groupBy("block").applyInArrow(lambda t: _ask(t, order, shards), "shard int, block bigint, keys binary, counts binary")
    answered = asked.groupBy("shard").applyInArrow(_answer, "block bigint, shard int, totals binary")
    return answered.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(
        lambda a, t: _score(a, t, order, n, v, prior, shards),
        "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
