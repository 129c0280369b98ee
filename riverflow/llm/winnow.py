"""Benchmark decontamination by winnowing.

Both sides hash every run of ``GRAM`` words and keep, in each window of
``WINDOW - GRAM + 1`` consecutive hashes, the smallest (the rightmost of
equals).  Any ``WINDOW`` shared words hold the same hashes, so both sides keep
the same one: joining kept hashes finds every shared span of that length.  A
hit is then extended to both sides over the words themselves; spans of
``WINDOW`` words or more count, so equal hashes of different words never do.
Items with fewer than ``WINDOW`` words are matched as one whole run.

Training texts are read once.  The benchmark's kept hashes reach the tasks as
a bitmap of fixed size, whatever the benchmark's size: texts without a marked
hash skip the winnowing, and only marked fingerprints, with the words around
them, leave the pass to be joined.

Defined cases: NULL or wordless text has no words and is never contaminated;
a wordless item never occurs.  Rows are judged one by one, so repeated rows
and repeated doc_ids give a row each.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table
from riverflow.session import stage

GRAM, WINDOW = 5, 13
MIN_PERCENT = 5
BITMAP_BITS = 22  # 512 KB per task

_CAND = "array<struct<pos:long,len:int,gram:long,before:array<string>,after:array<string>>>"
_CAND_TYPE = pa.list_(pa.struct([("pos", pa.int64()), ("len", pa.int32()), ("gram", pa.int64()),
                                 ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))


def _kept(grams: np.ndarray, words: K.Words, gram: int, window: int) -> np.ndarray:
    """Positions of winnowed fingerprints: the rightmost smallest hash of each
    window of ``window`` words inside a text."""
    span = window - gram + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.arange(n)
    for d in range(1, span):
        g = grams[d:n + d]
        better = g <= best
        best[better] = g[better]
        at[better] = np.flatnonzero(better) + d
    return np.unique(at[words.fits(window)[:n]])


def _around(words: K.Words, pos: int, n: int, gram: int, window: int) -> dict:
    """The words a window through this fingerprint can reach, nearest first."""
    text = words.owner[pos]
    a, b = words.ptr[text], words.ptr[text + 1]
    if n < window:
        return {"before": [], "after": [words.word(i) for i in range(pos, pos + n)]}
    return {"before": [words.word(i) for i in range(pos - 1, max(a, pos - (window - gram)) - 1, -1)],
            "after": [words.word(i) for i in range(pos, min(b, pos + window))]}


def _item_prints(gram: int, window: int):
    """All fingerprints of benchmark items."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, off in K.strings(batch, "text"):
                words = K.Words(raw, off, K.ALNUM)
                sizes = np.diff(words.ptr)
                grams = words.grams(gram)
                found = [(int(p), window, int(grams[p].view(np.int64)))
                         for p in _kept(grams, words, gram, window)]
                for t in np.flatnonzero((sizes > 0) & (sizes < window)):
                    p, n = int(words.ptr[t]), int(sizes[t])
                    found.append((p, n, int(words.grams(n)[p].view(np.int64))))
                rows = [{"len": n, "gram": g, **_around(words, p, n, gram, window)} for p, n, g in found]
                owner = pa.array([a + int(words.owner[p]) for p, _, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(owner), pa.array([r["len"] for r in rows], pa.int32()),
                     pa.array([r["gram"] for r in rows], pa.int64()),
                     pa.array([r["before"] for r in rows], pa.list_(pa.string())),
                     pa.array([r["after"] for r in rows], pa.list_(pa.string()))],
                    names=["item_id", "len", "gram", "before", "after"])
    return run


def _text_prints(gram: int, window: int, bits: int, lengths: list[int], marked):
    """Word count of each text and its fingerprints that the bitmap marks."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        bitmap = np.frombuffer(marked.value, np.uint8)

        def hit(grams):
            at = grams & mask
            return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, off in K.strings(batch, "text"):
                words = K.Words(raw, off, K.ALNUM)
                grams = words.grams(gram)
                found = []
                if window in lengths:
                    likely = np.flatnonzero(hit(grams) & words.fits(gram))
                    if len(likely):
                        kept = _kept(grams, words, gram, window)
                        likely = likely[np.isin(likely, kept, assume_unique=True)]
                        found += [(int(p), window, int(grams[p].view(np.int64))) for p in likely]
                for n in lengths:
                    if n < window:
                        short = words.grams(n)
                        found += [(int(p), n, int(short[p].view(np.int64)))
                                  for p in np.flatnonzero(hit(short) & words.fits(n))]
                cands: list[list] = [[] for _ in range(b - a)]
                for p, n, g in found:
                    t = int(words.owner[p])
                    cands[t].append({"pos": p - int(words.ptr[t]), "len": n, "gram": g,
                                     **_around(words, p, n, gram, window)})
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(words.ptr), pa.int64()),
                     pa.array(cands, _CAND_TYPE)], names=["doc_id", "n_words", "cands"])
    return run


def _common_prefix(x, y):
    """Number of leading equal elements of two arrays."""
    same = F.zip_with(x, y, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, F.size(same)).otherwise(first_other.cast("int") - 1)


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text",
                gram: int = GRAM, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(documents: row_, doc_id, n_words; spans: row_, item_id, start, stop).

    A span is a run of document words, at least a window long (or a whole
    shorter item), that occurs in the item; together the spans of an item cover
    every document word inside any occurrence of one of its windows.
    """
    spark = ready(docs.sparkSession)
    bench = stage(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
                  .mapInArrow(K.lean("winnow", _item_prints(gram, window)),
                              f"item_id {items.schema[item_col].dataType.simpleString()}, len int, gram long, "
                              "before array<string>, after array<string>"), "item_prints")
    lengths = sorted(r[0] for r in bench.select("len").distinct().collect())  # at most ``window`` values
    # at most 2**BITMAP_BITS distinct places, whatever the benchmark's size
    places = bench.select(F.col("gram").bitwiseAND((1 << BITMAP_BITS) - 1).alias("p")).distinct()
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    at = places.toArrow().column("p").to_numpy() if lengths else np.zeros(0, np.int64)
    np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
    marked = spark.sparkContext.broadcast(bitmap.tobytes())
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = stage(texts.mapInArrow(K.lean("winnow", _text_prints(gram, window, BITMAP_BITS, lengths, marked)),
                                  f"doc_id {id_type}, n_words long, cands {_CAND}")
                 .withColumn("row_", F.monotonically_increasing_id()), "text_prints")
    cand = seen.where(F.size("cands") > 0).select("row_", F.inline("cands"))
    pairs = cand.join(bench.select(
        "item_id", F.col("len").alias("l_"), F.col("gram").alias("g_"),
        F.col("before").alias("b_"), F.col("after").alias("a_")),
        (F.col("len") == F.col("l_")) & (F.col("gram") == F.col("g_")))
    pairs = pairs.withColumns({"left_": _common_prefix(F.col("before"), F.col("b_")),
                               "right_": _common_prefix(F.col("after"), F.col("a_"))})
    whole = F.when(F.col("len") < window, F.col("right_") == F.col("len")).otherwise(
        (F.col("right_") >= gram) & (F.col("left_") + F.col("right_") >= window))
    spans = pairs.where(whole).select("row_", "item_id", (F.col("pos") - F.col("left_")).alias("start"),
                                      (F.col("pos") + F.col("right_")).alias("stop"))
    return seen.select("row_", "doc_id", "n_words"), spans


def decontaminate(docs: DataFrame, items: DataFrame, min_percent: int = MIN_PERCENT, **names) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit (words inside any
    occurrence of a window), n_items, item_ids (sorted strings), contaminated
    (n_hit > 0 and 100 * n_hit >= min_percent * n_words)."""
    from pyspark.sql import Window as W
    seen, spans = occurrences(docs, items, **names)
    spans = stage(spans.groupBy("row_", "item_id", "start").agg(F.max("stop").alias("stop")), "spans")
    # words covered by the union of a row's spans
    w = W.partitionBy("row_").orderBy("start")
    runs = spans.groupBy("row_", "start").agg(F.max("stop").alias("stop")).withColumn(
        "done_", F.max("stop").over(w.rowsBetween(W.unboundedPreceding, -1)))
    covered = runs.groupBy("row_").agg(F.sum(F.greatest(
        F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("done_", F.lit(0))))).alias("n_hit"))
    found = spans.groupBy("row_").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    hits = covered.join(found, "row_")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return seen.join(hits, "row_", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (100 * n_hit >= min_percent * F.col("n_words"))).alias("contaminated"))


def op2_winnowing(spark, sf_dir):
    """All documents with their hits by benchmark items."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")
