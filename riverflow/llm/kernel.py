"""Numpy kernels over Arrow string batches: words, hashes, shingles.

A batch is cut into runs of whole texts of about ``CHUNK`` bytes; every kernel
is vectorised over the bytes or words of one run, so memory per task is bounded
by the run (or by one text, if a text alone is larger).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_PLACES = 64   # places in a span whose byte values are looked up

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
# bytes of words: everything but 00-2F, 3A-60, 7B-7F (after lower-casing A-Z)
ALNUM = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
# bytes of words: everything but 20 and 09-0D
NONSPACE = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection that spreads every input bit)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _place_value(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) << np.uint64(8) | byte.astype(np.uint64))
               * np.uint64(0x9E3779B97F4A7C55) + np.uint64(0x6A09E667F3BCC909))


_TABLE = _place_value(np.repeat(np.arange(_PLACES), 256), np.tile(np.arange(256), _PLACES))


def inside(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all bytes of the spans, one span after another, and their
    places within their span."""
    ends = np.cumsum(size)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    return np.repeat(start, size) + within, within


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, places: tuple | None = None) -> np.ndarray:
    """64-bit hash of each (not empty) span: the sum of a mixed value for every
    place and byte, mixed with the length.  Unlike a polynomial modulo 2**64 it
    has no structure that long regular words could meet.  ``places``: what
    ``inside`` gives for the spans, if it is known."""
    size = end - start
    if not len(size):
        return np.zeros(0, np.uint64)
    at, within = places or inside(start, size)
    byte = data[at]
    if int(size.max()) <= _PLACES:
        value = _TABLE[within << 8 | byte]
    else:
        value = _TABLE[np.minimum(within, _PLACES - 1) << 8 | byte]
        far = np.flatnonzero(within >= _PLACES)
        value[far] = _place_value(within[far], byte[far])
    sums = np.add.reduceat(value, np.cumsum(size) - size)
    return mix(sums ^ (size.astype(np.uint64) << np.uint64(48)))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def runs(offsets: np.ndarray, chunk: int = CHUNK):
    """(first, last) text numbers of consecutive runs of about ``chunk`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + chunk, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


class Words:
    """Words of a run of texts: byte spans, 64-bit hashes, texts' word ranges."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, wordbyte: np.ndarray):
        base = int(offsets[0])
        self.data = LOWER[raw[base:int(offsets[-1])]]
        off = offsets - base
        n = len(self.data)
        is_word = wordbyte[self.data]
        cut = np.zeros(n + 1, dtype=bool)  # a text ends before this byte
        cut[off] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = is_word[:-1]
        start = is_word & (~before | cut[:-1])
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = is_word[1:]
        end = is_word & (~after | cut[1:])
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.ptr = np.searchsorted(self.start, off)  # text i: words ptr[i]..ptr[i+1]
        self.owner = np.repeat(np.arange(len(off) - 1), np.diff(self.ptr))
        self.hash = span_hashes(self.data, self.start, self.end)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; meaningful where ``fits``."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        if n >= k:
            acc = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                acc = acc * np.uint64(0xD6E8FEB86659FD93) + self.hash[j:n - k + 1 + j]
            out[:n - k + 1] = mix(acc)
        return out

    def fits(self, k: int) -> np.ndarray:
        """Whether k words from each word on lie in its text."""
        return np.arange(len(self.hash)) + k <= self.ptr[self.owner + 1]

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


# What workers keep from task to task, by operator.
HELD: dict[str, dict] = {}


def lean(name: str, run):
    """``run`` as a task that drops what other operators keep in this worker
    before it starts, and gives freed memory back to the system at its end."""
    def task(batches):
        for other, kept in HELD.items():
            if other != name:
                kept.clear()
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()
    return task


def _give_back():
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def strings(batch, name: str):
    """Yield (first, last, raw, offsets) for the runs of a batch's column."""
    raw, off = utf8(batch.column(batch.schema.get_field_index(name)))
    for a, b in runs(off):
        yield a, b, raw, off[a:b + 1]
