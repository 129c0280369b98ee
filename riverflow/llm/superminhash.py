"""MinHash near-dedup with SuperMinHash signatures.

Each distinct shingle of a document gives a pseudo-random permutation of the
signature slots and offers slot ``perm[j]`` the value ``j + r_j`` with
``r_j`` in [0, 1); a slot keeps its minimum.  Because the ranks j of one
element are a permutation, slots are filled evenly and estimates have lower
variance than independent minima; a document stops at the first rank that can
no longer lower any slot.

Pipeline: (1) one pass makes per document the shingle-set digest and the band
keys; (2) documents with equal sets become one class, so groups of exact
copies collapse before anything else; (3) classes sharing a band key are
joined to the smallest class of that key (no pair is emitted), and their
connected components bound the comparisons; (4) each candidate component is
cut into blocks of bounded size, twice at random, and each block is compared
in one task, signature first, then on full shingle sets, with union-find: only
a spanning forest of confirmed links leaves it; (5) where that left members of
a component of several blocks outside its largest confirmed part, these meet
all members of the component, block by block; pairs inside the largest part
are linked already and are not compared; (6) components of all confirmed links.

Defined cases: NULL or wordless text: empty set, linked with nothing.  Rows
with equal doc_id are versions of one document and are linked.  A NULL doc_id
is never linked: component_id NULL, kept.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import components, counted_broadcast, ready
from riverflow.session import stage

SHINGLE = 5
BANDS, ROWS = 32, 6          # misses a pair of likeness 0.85 with chance 3e-7
SLOTS = BANDS * ROWS
MIN_PERCENT = 85
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
# a pair goes to the exact check unless its estimate is this far below the
# threshold (over five standard deviations at 192 slots)
MARGIN = 0.14


def shingle_sets(words: K.Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a run; a text with fewer
    words than ``size`` has one shingle, its whole sequence."""
    grams = words.grams(size)
    out = []
    for i in range(len(words.ptr) - 1):
        a, b = words.ptr[i], words.ptr[i + 1]
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            acc = np.uint64(b - a)
            one = np.array([acc], np.uint64)
            for h in words.hash[a:b]:
                one = K.mix(one * np.uint64(0xD6E8FEB86659FD93) + h)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, uint32 [texts, slots] (undefined for empty sets)."""
    n = len(sets)
    value = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets])
    elem = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(n), sizes)
    perm = None
    for j in range(slots):
        if j:
            # early stop: documents whose largest slot is below rank j are done
            top = value.reshape(n, slots).max(axis=1) >> np.uint64(32)
            live = (top >= j) & (sizes > 0)
            keep = live[doc]
            if not keep.any():
                break
            if not keep.all():
                elem, doc = elem[keep], doc[keep]
                perm = perm[keep] if perm is not None else None
                first = first[keep] if perm is None else None
            if perm is None:
                perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16),
                               (len(elem), 1))
                rows = np.arange(len(elem))
                perm[rows, 0] = first
                perm[rows, first] = 0
        x = K.mix(elem + np.uint64(((j + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        k = j + (((x >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            at = first = k
        else:
            rows = np.arange(len(elem))
            at = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
        np.minimum.at(value, doc * slots + at,
                      np.uint64(j << 32) | (x & np.uint64(0xFFFFFFFF)))
    return (K.mix(value) >> np.uint64(32)).astype(np.uint32).reshape(n, slots)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig[:, :bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    acc = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for j in range(rows):
        acc = K.mix(acc * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return acc.view(np.int64)


def _sign(size: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, off in K.strings(batch, "text"):
                sets = shingle_sets(K.Words(raw, off, K.NONSPACE), size)
                keys = band_keys(signatures(sets, bands * rows), bands, rows)
                keys = np.ascontiguousarray(keys)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                             pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (b - a + 1) * bands, bands, dtype=np.int32)),
                        pa.array(keys.reshape(-1), pa.int64())),
                ], names=["doc_id", "n_shingles", "digest", "bands"])
    return run


def _resign(size: int, slots: int):
    """Full sets and signatures of the documents to be compared."""
    def run(batches):
        for batch in batches:
            cols = [batch.column(i) for i in range(4)]
            for a, b, raw, off in K.strings(batch, "text"):
                sets = shingle_sets(K.Words(raw, off, K.NONSPACE), size)
                sig = signatures(sets, slots)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(a, b - a) for c in cols]
                    + [pa.array([s.tobytes() for s in sets], pa.binary()),
                       pa.array([s.tobytes() for s in sig], pa.binary())],
                    names=["cid", "cc", "blocks", "block", "shingles", "sig"])
    return run


def _confirm(percent: int, slots: int, margin: float):
    """Confirmed links of each (component, block pair): a spanning forest.
    Rows of a key arrive together (sorted); a key's rows are bounded by two
    blocks."""
    floor = (percent / 100 - margin) * slots

    def links(rows):
        ids = [r[0] for r in rows]
        side = np.array([r[1] for r in rows])
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        size = np.array([len(s) for s in sets])
        sig = np.stack([np.frombuffer(r[3], np.uint32) for r in rows])
        cross = side.any() and not side.all()
        parent = list(range(len(rows)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i in range(1, len(rows)):
            near = (sig[:i] == sig[i]).sum(axis=1) >= floor
            near &= 100 * np.minimum(size[:i], size[i]) >= percent * np.maximum(size[:i], size[i])
            if cross:
                near &= side[:i] != side[i]
            for j in np.flatnonzero(near):
                ri, rj = root(i), root(int(j))
                if ri == rj:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    parent[ri] = rj
                    yield ids[i], ids[j]

    def run(batches):
        key, rows = None, []
        out_u, out_v = [], []
        for batch in batches:
            for cc, p, q, cid, b, shingles, sig in zip(
                    *(batch.column(n).to_pylist() for n in ("cc", "p", "q", "cid", "block", "shingles", "sig"))):
                if (cc, p, q) != key:
                    for u, v in links(rows) if len(rows) > 1 else ():
                        out_u.append(u), out_v.append(v)
                    key, rows = (cc, p, q), []
                rows.append((cid, int(b != p), shingles, sig))
            yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())],
                                             names=["u", "v"])
            out_u, out_v = [], []
        for u, v in links(rows) if len(rows) > 1 else ():
            out_u.append(u), out_v.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())],
                                         names=["u", "v"])
    return run


def _left_over(member: DataFrame, confirmed: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """Members of the candidate components that are not yet linked to one
    part: cid, rest (outside the component's largest part), rest_blocks (blocks
    of bounded size that the rest of its component needs)."""
    found = components(confirmed)
    parts = stage(member.join(found, member.cid == found.node, "left").select(
        "cid", "cc", "n", F.coalesce("component", "cid").alias("part")), "parts")
    sizes = parts.groupBy("cc", "part").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))
    main = sizes.groupBy("cc").agg(F.max(F.struct("docs", "part", "n")).alias("m"), F.sum("docs").alias("docs"),
                                   F.sum("n").alias("n"))
    main = main.withColumns({"docs": F.col("docs") - F.col("m.docs"), "n": F.col("n") - F.col("m.n")}).where("docs > 0")
    main = stage(main.select("cc", F.col("m.part").alias("main"), F.greatest(
        F.ceil(F.col("docs") / block_docs), F.ceil(F.col("n") / block_shingles)).cast("long").alias("rest_blocks")), "mains")
    return stage(parts.join(counted_broadcast(main), "cc").select(
        "cid", (F.col("part") != F.col("main")).alias("rest"), "rest_blocks"), "left_over")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = MIN_PERCENT,
                    bands: int = BANDS, rows: int = ROWS,
                    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES,
                    margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their
    shingle sets; component_id is the smallest doc_id reachable by links.
    """
    spark = ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = stage(texts.mapInArrow(K.lean("minhash", _sign(shingle, bands, rows)),
                                 "doc_id long, n_shingles long, digest binary, bands array<long>"), "signatures")
    named = sig.where("doc_id is not null and n_shingles > 0")
    # classes of equal sets; all members have the same bands
    classes = stage(named.groupBy("digest").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r")).select(
        "digest", F.col("r.doc_id").alias("cid"), F.col("r.n_shingles").alias("n"),
        F.col("r.bands").alias("bands")), "classes")
    keys = classes.select("cid", F.explode("bands").alias("key"))
    lowest = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high")
    stars = keys.join(lowest.select("key", "low"), "key").where("cid <> low").select(
        F.col("cid").alias("u"), F.col("low").alias("v")).distinct()
    candidates = components(stars)
    # blocks of bounded size within each candidate component
    member = candidates.join(classes.select("cid", "n"), candidates.node == classes.cid).select(
        "cid", "n", F.col("component").alias("cc"))
    per = member.groupBy("cc").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_docs), F.ceil(F.sum("n") / block_shingles))
        .cast("long").alias("blocks"))
    member = stage(member.join(per, "cc").groupBy("cid", "cc", "blocks").agg(F.max("n").alias("n")).select(
        "cid", "cc", "n", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block")), "members")
    wanted = texts.join(counted_broadcast(member), texts.doc_id == member.cid).select(
        "cid", "cc", "blocks", "block", "text")
    full = stage(wanted.mapInArrow(K.lean("minhash", _resign(shingle, bands * rows)),
                                   "cid long, cc long, blocks long, block long, shingles binary, sig binary"), "sets")

    def confirm(dealt):
        dealt = dealt.select("cc", "p", "q", "cid", "block", "shingles", "sig")
        dealt = dealt.repartition("cc", "p", "q").sortWithinPartitions("cc", "p", "q", "block", "cid")
        return stage(dealt.mapInArrow(K.lean("minhash", _confirm(percent, bands * rows, margin)), "u long, v long")
                     .where("u <> v"), "links")

    # each block by itself; members of several blocks also in a second partition
    second = F.col("blocks") + F.pmod(F.xxhash64("cid", F.lit(1)), F.col("blocks"))
    places = F.when(F.col("blocks") > 1, F.array(F.col("block"), second)).otherwise(F.array("block"))
    confirmed = confirm(full.withColumn("block", F.explode(places)).withColumns({"p": F.col("block"), "q": F.col("block")}))
    large = member.where("blocks > 1")
    if large.limit(1).count():
        dealt = full.where("blocks > 1").join(counted_broadcast(_left_over(
            large, confirmed, block_docs, block_shingles)), "cid")
        # a pair of blocks (p, q): both of left-over members, or q of the main part
        others = F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)
        mains = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda g: F.col("rest_blocks") + g)
        own = F.when(F.col("rest"), F.pmod(F.xxhash64("cid"), F.col("rest_blocks"))).otherwise(
            F.col("rest_blocks") + F.col("block"))
        dealt = dealt.withColumn("block", own).withColumn(
            "other", F.explode(F.when(F.col("rest"), F.concat(others, mains)).otherwise(others)))
        confirmed = confirmed.union(confirm(dealt.withColumns(
            {"p": F.least("block", "other"), "q": F.greatest("block", "other")})))
    # versions of one document and members of one class are linked too
    versions = named.select("digest", "doc_id").distinct().join(
        classes.select("digest", "cid"), "digest").where("doc_id <> cid")
    versions = versions.select(F.col("doc_id").alias("u"), F.col("cid").alias("v"))
    final = components(confirmed.union(versions))
    return sig.join(final, sig.doc_id == final.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op10_superminhash(spark, sf_dir):
    """All documents with their near-duplicate component."""
    from riverflow.llm.common import table
    return near_duplicates(table(spark, sf_dir, "documents"))
