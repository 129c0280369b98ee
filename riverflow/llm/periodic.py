"""Periodic run detection with string synchronising sets.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) and at least four periods long.  At each dyadic scale t = 4, 8, 16, ... a
position i is in the synchronising set S(t) if the least fingerprint among the
t-word fragments that start in [i, i + t] starts at i or at i + t: membership
depends on the 2t words from i only, so equal contexts are chosen alike.
Fragments inside a stretch of period t / 4 or less are omitted, which keeps S(t)
sparse; their periods are small ones, found at a lower scale before.

A run of smallest period q with t <= q < 2t and 4 q words or more holds a chosen
position i with i + q chosen too and equal contexts, and no nearer position has
that context: neighbours of equal context propose exactly q (a nearer one would
make the period smaller).  Proposals are verified and extended word by word, so a
collision of fingerprints can add nothing; fingerprints are 64-bit mixes of
exact word numbers.  Periods 1 to 3 come from comparing neighbours directly.

Documents are scanned in Arrow functions over runs of whole documents joined by
separators that occur once, about 20 scales of vectorised work over the words;
memory per task is bounded by the run, or by one document if it is larger.

Defined cases: a NULL or blank text has no words and no runs; its two digests
are those of empty strings.  Rows are judged one by one: NULL or repeated
doc_ids stay as they are.  An empty table gives no row.  Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table

LEAST = 6       # words of a run, at least
PERIODS = 4     # periods of a run, at least; the method needs four
SMALL = 4       # periods below come from comparing neighbours

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: prefix minima of blocks
    of that width meet suffix minima of the block before."""
    n = len(x)
    if n < width:
        return x[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def _small_runs(words: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """Maximal stretches of smallest period q of four periods, by comparing
    every word with the q-th next."""
    same = words[:-q] == words[q:]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2] + q
    long = end - start >= PERIODS * q
    out = []
    for s, e in zip(start[long].tolist(), end[long].tolist()):
        if not any((words[s:e - d] == words[s + d:e]).all() for d in range(1, q) if q % d == 0):
            out.append((s, e, q))
    return out


def _extend(words: np.ndarray, s: int, e: int, q: int) -> tuple[int, int]:
    """The maximal stretch of period q around [s, e), which has it; steps grow
    twofold, so the work follows the stretch."""
    step = 2 * q
    while s > 0:
        a = max(0, s - step)
        odd = np.flatnonzero(words[a:s] != words[a + q:s + q])
        if len(odd):
            s = a + int(odd[-1]) + 1
            break
        s, step = a, 2 * step
    step, n = 2 * q, len(words)
    while e < n:
        b = min(n, e + step)
        odd = np.flatnonzero(words[e:b] != words[e - q:b - q])
        if len(odd):
            e += int(odd[0])
            break
        e, step = b, 2 * step
    return s, e


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All maximal (start, end, q) of at least four periods in an array of
    word numbers; ``longest``: words of the longest document in it."""
    words = words.astype(np.int64, copy=False)
    n, runs = len(words), []
    longest = n if longest is None else longest
    for q in range(1, min(SMALL, longest // PERIODS + 1)):
        runs += _small_runs(words, q)
    # fingerprints of the fragments of t words, doubled from scale to scale
    print_ = K.mix(words.view(np.uint64) * _C1 + _C2)
    t = 1
    while 2 * t < SMALL:
        print_, t = K.mix(print_[:-t] * _C1 ^ K.mix(print_[t:] + _C2)), 2 * t
    while 8 * t <= longest:
        print_, t = K.mix(print_[:-t] * _C1 ^ K.mix(print_[t:] + _C2)), 2 * t
        context = K.mix(print_[:-t] * _C1 ^ K.mix(print_[t:] + _C2))  # 2t words
        # fragments with a period of t / 4 or less lie in runs found before
        omitted = np.zeros(len(print_) + 1, np.int32)
        for s, e, q in runs:
            if 4 * q <= t <= e - s:
                omitted[s] += 1
                omitted[e - t + 1] -= 1
        omitted = np.cumsum(omitted[:-1]) > 0
        value = np.where(omitted, np.iinfo(np.uint64).max, print_ >> np.uint64(1))
        least = _least(value, t + 1)
        there = len(context)
        chosen = np.flatnonzero((least < np.iinfo(np.uint64).max)
                                & ((least == value[:there]) | (least == value[t:t + there])))
        if len(chosen) < 2:
            continue
        order = np.argsort(context[chosen], kind="stable")
        at, same = chosen[order], context[chosen][order]
        gap = at[1:] - at[:-1]
        near = (same[1:] == same[:-1]) & (gap >= t) & (gap < 2 * t)
        found: dict[int, list[int]] = {}
        for i, q in zip(at[:-1][near].tolist(), gap[near].tolist()):
            found.setdefault(q, []).append(i)
        for q, places in found.items():
            upto = -1
            for i in sorted(places):
                if i < upto:
                    continue  # inside the run before
                if (words[i:i + 2 * t] != words[i + q:i + q + 2 * t]).any():
                    continue  # fingerprints collided
                s, e = _extend(words, i, i + q + 2 * t, q)
                upto = e - q - 2 * t + 1
                if e - s >= PERIODS * q:
                    runs.append((s, e, q))
    return runs


def planted(words: list, doc_id) -> list:
    """The document with a periodic tail, for every tenth crc32 of its id."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def _numbers(docs: list[list[bytes]]) -> tuple[np.ndarray, list[int]]:
    """Word numbers of the documents, one after another, with a separator
    that occurs once after each, and where each document starts."""
    flat, starts, at = [], [], 0
    for words in docs:
        starts.append(at)
        flat += words
        at += len(words) + 1
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    out = np.empty(at, np.int64)
    is_word = np.ones(at, bool)
    is_word[np.array(starts[1:] + [at], np.int64) - 1] = False
    out[is_word] = codes
    out[~is_word] = -1 - np.arange(len(docs))
    return out, starts


def describe(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the run of the greatest exponent (start, length, period,
    exponent_milli), the runs' and the collapsed text's sha256."""
    runs = sorted((s, q, e) for s, e, q in runs if e - s >= LEAST)
    best, listed = None, hashlib.sha256()
    gone = np.zeros(len(words) + 1, np.int32)
    for s, q, e in runs:
        listed.update(b"%d,%d,%d\n" % (s, e - s, q))
        gone[min(e, s + q)] += 1
        gone[e] -= 1
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    if runs:
        gone = np.cumsum(gone[:-1]) > 0
        words = [w for w, g in zip(words, gone.tolist()) if not g]
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, listed.hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _scan(plant: bool):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, raw, off in K.strings(batch, "text"):
                docs = [raw[x:y].tobytes().split() for x, y in zip(off[:-1].tolist(), off[1:].tolist())]
                if plant:
                    docs = [planted(w, i) for w, i in zip(docs, ids[a:b])]
                words, starts = _numbers(docs)
                per: list[list] = [[] for _ in docs]
                found = find_runs(words, max(map(len, docs)))
                owner = np.searchsorted(starts, [s for s, _, _ in found], side="right") - 1
                for (s, e, q), o in zip(found, owner.tolist()):
                    per[o].append((s - starts[o], e - starts[o], q))
                rows = list(zip(*(describe(w, r) for w, r in zip(docs, per))))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a)] + [pa.array(c, k) for c, k in zip(rows, kinds)], names=_NAMES)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per document: doc_id, n_runs; of the run with the greatest
    length / period (ties: smallest start, then period) start, length, period
    and exponent_milli; runs_sha256 over all runs' ``start,length,period`` lines;
    collapsed_sha256 of the words outside of every run's repeats.  ``plant``
    first makes the tail of about every tenth document periodic."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(K.lean("periodic", _scan(plant)),
                            f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
                            "runs_sha256 string, collapsed_sha256 string")


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of all documents, every tenth with a planted tail."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)
