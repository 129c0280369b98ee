"""Token-ID / binary output with Elias-Fano document boundaries.

File format: a folder of Parquet part files written in ascending document
order, one row per block of whole documents:

    shard int            number of the part (ascending with the order)
    block int            number of the block in its shard
    first_token long     ids of the shard before this block
    n_tokens long        ids in the block
    width int            bytes of an id: 2 if the vocabulary fits, else 4
    ids binary           the block's ids, concatenated, little-endian
    ef_low_bits int      Elias-Fano: low bits of each boundary ...
    ef_low binary        ... packed, most significant first
    ef_high binary       unary gaps of the high parts
    ef_samples binary    position of every 256th one bit, uint32 little-endian
    doc_ids array<long>  the documents, in order

Boundary i is the number of the block's ids up to the end of document i.  With
n documents and u ids this takes about n * (2 + log2(u / n)) bits instead of
64 n, and ``EliasFano.select`` finds one boundary from a sample in constant
expected time.  Spark's committer writes the parts, so a lost task leaves no
half block, and any store that Spark reads can hold them.

Defined cases: a NULL or empty text is just its end id; rows are ordered by
doc_id (NULL first), rows of equal doc_id by a hash of their text.  An empty
table gives no block.  Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table
from riverflow.session import scratch_path

END_ID = 2
BLOCK_TOKENS = 1 << 20      # a block is closed at the first document end beyond
CACHE_PIECES = 1_200_000    # ids of so many distinct pieces are kept per worker
CACHE_BYTES = 32 << 20      # and about so many bytes of them
TABLE = 1 << 21
SAMPLE = 256


class EliasFano:
    """Non-decreasing non-negative numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
        n = len(values)
        if n == 0:
            return 0, b"", b"", b""
        values = values.astype(np.int64)
        low_bits = max(0, int(values[-1]) // n).bit_length() - 1 if values[-1] >= n else 0
        shifts = np.arange(low_bits - 1, -1, -1)
        low = np.packbits(((values[:, None] >> shifts) & 1).astype(np.uint8).reshape(-1))
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return low_bits, low.tobytes(), np.packbits(bits).tobytes(), ones[::SAMPLE].astype("<u4").tobytes()

    def _low(self, i: int) -> int:
        value = 0
        for b in range(i * self.low_bits, (i + 1) * self.low_bits):
            value = value << 1 | (int(self.low[b >> 3]) >> (7 - (b & 7))) & 1
        return value

    def select(self, i: int) -> int:
        """Value i: walk from the nearest sampled one bit."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) & (0xFF >> (at & 7))
        while left >= (ones := word.bit_count()):
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for bit in range(8):
            if word >> (7 - bit) & 1:
                if left == 0:
                    return ((byte * 8 + bit - i) << self.low_bits) | self._low(i)
                left -= 1
        raise IndexError(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low)[:self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low_bits - 1, -1, -1, dtype=np.int64))
        return out


class Encoder:
    """Texts to ids with a byte-level BPE of the tokenizers library.

    A byte-level BPE encodes the pieces of its split pattern one by one, so
    equal pieces have equal ids: distinct pieces go through the library once
    and their ids are kept.  Pieces are cut here for texts of ASCII and Latin
    letters without apostrophes; any other text goes through the library whole.
    """

    _LETTER = ((np.arange(256) | 0x20) >= 0x61) & ((np.arange(256) | 0x20) <= 0x7A) | (np.arange(256) >= 0x80)
    _DIGIT = (np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)
    _SPACE = np.isin(np.arange(256), [9, 10, 13, 32])
    # bytes outside the cut: controls, apostrophe, lead bytes beyond U+024F
    _ODD = ((np.arange(256) < 32) & ~_SPACE) | (np.arange(256) == 0x27) | (np.arange(256) == 0x7F) \
        | ((np.arange(256) >= 0xC0) & ((np.arange(256) < 0xC3) | (np.arange(256) > 0xC9)))
    _KIND = np.where(_SPACE, 0, np.where(_LETTER, 1, np.where(_DIGIT, 2, 3))).astype(np.uint8)

    def __init__(self, path: str):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.uint16 if self.width == 2 else np.uint32
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                     and not pre.get("add_prefix_space") and not spec.get("normalizer")
                     and spec["model"]["type"] == "BPE")
        # bytes of each id: a character of a byte-level token is one byte
        vocab = self.tokenizer.get_vocab()
        self.long = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        self.long[list(vocab.values())] = [len(t) for t in vocab]
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self._clear()

    def _clear(self):
        # open addressing: piece hash -> piece number, linear probing
        self.keys = np.zeros(TABLE, np.uint64)
        self.number = np.full(TABLE, -1, np.int32)
        self.flat = np.zeros(1 << 20, self.kind)
        self.used = 0
        self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        # the pieces themselves, so that an equal hash is never trusted
        self.bytes, self.held = np.zeros(1 << 20, np.uint8), 0
        self.byte_first, self.byte_size = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        out = np.full(len(hashes), -1, np.int32)
        slot, left = (hashes & np.uint64(TABLE - 1)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            number = self.number[slot]
            hit = (self.keys[slot] == hashes[left]) & (number >= 0)
            out[left[hit]] = number[hit]
            on = ~hit & (number >= 0)
            left, slot = left[on], (slot[on] + 1) & (TABLE - 1)
        return out

    def _enter(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        slot, left = (hashes & np.uint64(TABLE - 1)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = self.number[slot] < 0
            self.number[slot[free]] = numbers[left[free]]
            won = free & (self.number[slot] == numbers[left])
            self.keys[slot[won]] = hashes[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (TABLE - 1)

    def _differs(self, number: np.ndarray, data: np.ndarray, size: np.ndarray, places: tuple) -> np.ndarray:
        """Numbers of the pieces whose bytes are not those of their known piece."""
        odd, known = self.byte_size[number] != size, self.byte_first[number].astype(np.int64)
        at, within = places
        there = np.repeat(known, size) + within
        if odd.any():           # any place will do: they differ already
            there = np.minimum(there, len(self.bytes) - 1)
        unlike = data[at] != self.bytes[there]
        if not unlike.any():
            return np.flatnonzero(odd)
        return np.flatnonzero(odd | np.logical_or.reduceat(unlike, np.cumsum(size) - size))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in got]

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Ids of new pieces.  Pieces that start with a space keep apart when
        joined, so they are encoded many at a time and told apart by the bytes
        of their ids."""
        after = data[np.minimum(start + 1, len(data) - 1)]
        apart = (data[start] == 32) & (size > 1) & ~self._SPACE[after]
        order = np.argsort(~apart, kind="stable")       # those that keep apart first
        start, long, many = start[order], size[order].astype(np.int32), int(apart.sum())
        joined = data[K.inside(start, long)[0]]
        blob, stop = joined.tobytes(), np.cumsum(long, dtype=np.int64)
        borders = [0, *stop[:many][199:-1:200].tolist(), *([int(stop[many - 1])] if many else [])]
        texts = [blob[a:b].decode() for a, b in zip(borders, borders[1:])]
        ids, sizes = [], []
        for i, (t, e) in enumerate(zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))):
            ends = stop[200 * i:min(200 * (i + 1), many)] - borders[i]
            got = np.array(e.ids, np.int64)
            upto = np.cumsum(self.long[got])
            n = np.searchsorted(upto, ends) + 1
            if len(got) < len(ends) or n[-1] != len(got) or (upto[n - 1] != ends).any():
                # bytes without a token of their own: by the library's count
                e = self.tokenizer.encode(t, add_special_tokens=False)
                got, n = np.array(e.ids, np.int64), np.cumsum(np.bincount(np.array(e.word_ids), minlength=len(ends)))
            ids.append(got)
            sizes.append(np.diff(n, prepend=0))
        rest = [blob[b - n:b].decode() for b, n in zip(stop[many:].tolist(), long[many:].tolist())]
        for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False):
            ids.append(np.array(e.ids, np.int64))
            sizes.append([len(e.ids)])
        n, ids = np.concatenate(sizes).astype(np.int32), np.concatenate(ids)
        base = len(self.first)
        self._enter(hashes[order], np.arange(base, base + len(n), dtype=np.int32))
        self.first = np.concatenate([self.first, (self.used + np.cumsum(n) - n).astype(np.int32)])
        self.size = np.concatenate([self.size, n])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.byte_first = np.concatenate([self.byte_first, (self.held + stop - long).astype(np.int32)])
        self.byte_size = np.concatenate([self.byte_size, long])
        while self.held + len(joined) > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[self.held:self.held + len(joined)] = joined
        self.held += len(joined)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a run."""
        base = int(offsets[0])
        data, off = raw[base:int(offsets[-1])], offsets - base
        n, texts = len(data), len(offsets) - 1
        if n == 0:
            return [np.zeros(0, self.kind)] * texts
        odd = self._ODD[data]
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        sums = np.concatenate([[0], np.cumsum(odd)])
        cut = (sums[off[1:]] == sums[off[:-1]]) & self.cuts
        blob = data.tobytes()
        if any(t in blob for t in self.added):
            for i in range(texts):
                cut[i] &= not any(t in blob[off[i]:off[i + 1]] for t in self.added)
        out: list = [None] * texts
        whole = np.flatnonzero(~cut)
        if len(whole):
            for i, x in zip(whole, self._whole([blob[off[i]:off[i + 1]].decode("utf-8", "replace") for i in whole])):
                out[i] = x
        # piece starts of the byte-level split pattern, as run borders
        kind = self._KIND[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        run = edge[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        at = np.flatnonzero(run)
        stop = np.append(at[1:], n)
        space = kind[at] == 0
        start = np.zeros(n, bool)
        start[at[space]] = True                       # blanks before a word's own blank
        inner = space & ~edge[stop]
        start[stop[inner] - 1] = True                 # last blank: joins the word, or stands alone
        word = at[~space]
        glued = np.zeros(len(word), bool)
        glued[word > 0] = (data[word[word > 0] - 1] == 32)
        start[word[~glued | edge[word]]] = True
        start = np.flatnonzero(start)
        stop = np.append(start[1:], n)
        owner = np.searchsorted(off, start, side="right") - 1
        if len(whole):
            keep = cut[owner]
            start, stop, owner = start[keep], stop[keep], owner[keep]
        if len(start):
            places = K.inside(start, stop - start)
            h = K.span_hashes(data, start, stop, places)
            number = self._find(h)
            new = np.flatnonzero(number < 0)
            if len(new):
                if len(self.first) + len(new) > CACHE_PIECES or self.held > CACHE_BYTES:
                    self._clear()
                    new = np.arange(len(h))
                fresh, where = np.unique(h[new], return_index=True)
                where = new[where]
                self._learn(fresh, data, start[where], (stop - start)[where])
                number[new] = self._find(h[new])
            for i in np.unique(owner[self._differs(number, data, stop - start, places)]):
                # a piece of it only has the hash of a known one
                cut[i], out[i] = False, self._whole([blob[off[i]:off[i + 1]].decode("utf-8", "replace")])[0]
            if not cut[owner].all():
                keep = cut[owner]
                number, owner = number[keep], owner[keep]
            size, first = self.size[number], self.first[number]
            ends = np.cumsum(size, dtype=np.int64)
            ids = self.flat[np.repeat((first - (ends - size)).astype(np.int32), size)
                            + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]
            per = np.bincount(owner, weights=size, minlength=texts).astype(np.int64)
        else:
            ids, per = np.zeros(0, self.kind), np.zeros(texts, np.int64)
        upto = np.cumsum(per)
        for i in np.flatnonzero(cut):
            out[i] = ids[upto[i] - per[i]:upto[i]]
        return out


_ENCODERS: dict[str, Encoder] = K.HELD.setdefault("tokens", {})

SCHEMA = ("shard int, block int, first_token long, n_tokens long, width int, ids binary, ef_low_bits int, "
          "ef_low binary, ef_high binary, ef_samples binary, doc_ids array<long>")
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _write(path: str, end_id: int, block_tokens: int):
    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        end = np.array([end_id], encoder.kind)
        block, first, ids, parts, ends, size = 0, 0, [], [], [], 0

        def close():
            low_bits, low, high, samples = EliasFano.encode(np.array(ends, np.int64))
            row = [shard, block, first, size, encoder.width,
                   np.concatenate(parts).astype(f"<u{encoder.width}").tobytes(), low_bits, low, high, samples, ids]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(),
                     pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=_NAMES)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, raw, off in K.strings(batch, "text"):
                for doc_id, tokens in zip(doc_ids[a:b], encoder.encode(raw, off)):
                    ids.append(doc_id)
                    parts += [tokens, end]
                    size += len(tokens) + 1
                    ends.append(size)
                    if size >= block_tokens:
                        yield close()
                        block, first, ids, parts, ends, size = block + 1, first + size, [], [], [], 0
        if ids:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 order: list[Column] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token file of ``docs`` to ``path`` (a shared folder), in the
    order of ``order`` (default: doc_id).  ``tokenizer_path`` is read by the
    tasks: the tokenizer package is installed on every executor."""
    ready(docs.sparkSession)
    keys = order or [F.col(id_col)]
    names = [f"key{i}_" for i in range(len(keys) + 1)]
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *[k.alias(n) for k, n in zip([*keys, F.xxhash64(text_col)], names)])
    dealt = keyed.repartitionByRange(*names).sortWithinPartitions(*names).select("doc_id", "text")
    dealt.mapInArrow(K.lean("tokens", _write(tokenizer_path, end_id, block_tokens)), SCHEMA).write.parquet(path)


def _read(with_ids: bool):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{r['width']}")
                ends = EliasFano(len(r["doc_ids"]), r["ef_low_bits"], r["ef_low"], r["ef_high"], r["ef_samples"]).all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[s:e].tobytes()) for s, e in zip(starts, ends)]
                cols = [pa.array([r["shard"]] * len(ends), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                        pa.array(starts + r["first_token"]), pa.array(ends - starts), pa.array(crc, pa.int64())]
                names = ["shard", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(wide.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before),
    n_tokens, ids_crc32 (of the ids as little-endian uint32) and, on request,
    the ids themselves."""
    blocks = ready(spark).read.schema(SCHEMA).parquet(path)
    # one row per shard: as many as the file has parts
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    base = sizes.select(F.col("shard").alias("shard_"), F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    kind = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = blocks.mapInArrow(K.lean("tokens", _read(with_ids)), kind)
    # bounded by the number of part files
    out = found.join(F.broadcast(base), found.shard == base.shard_)
    return out.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      *(["ids"] if with_ids else []))


def round_trip(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the token file under the shared checkpoint folder and read it back."""
    path = scratch_path(docs.sparkSession, f"tokens/{uuid.uuid4().hex}")
    write_tokens(docs, path, tokenizer_path, **options)
    return read_tokens(docs.sparkSession, path)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op3_token_ids(spark, sf_dir):
    """All documents' places in a token file written and read back."""
    return round_trip(table(spark, sf_dir, "documents"), vocabulary())
