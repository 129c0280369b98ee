"""Language identification by word-first backoff.

A word seen in training scores its log frequency in every language.  An unseen
word backs off to its character n-grams (with word borders), longest first: the
first length of which any n-gram was seen gives the mean log frequency of its
known n-grams; shorter lengths are not looked at then.  The prediction is the
language with the largest sum over the words, its score the posterior under
equal priors.

The model is fitted on a bounded sample of labelled documents
(``docs_per_lang`` per language in expectation, chosen by a hash of id and
text, whole texts), with all its words and n-grams.  A word is a run of letters and
combining marks, in training and prediction.  Prediction reads whole texts.

Defined cases: NULL text or text without a letter gives ``und`` with score 0,
and so does every text if nothing was learned.  Equal sums go to the smaller
language name.  Rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table
from riverflow.session import stage

LONGEST = 5
DOCS_PER_LANG = 4000
NO_WORD = r"[^\p{L}\p{M}]+"
UNKNOWN = "und"
_byte = np.arange(256)
LETTERS = ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


class Model:
    """Sorted word hashes with a row of log frequencies each, and the same by
    n-gram string."""

    def __init__(self, langs, words, grams, totals):
        self.langs = langs
        at = {lang: i for i, lang in enumerate(langs)}
        table: dict[str, np.ndarray] = {}
        for lang, word, n in words:
            table.setdefault(word, np.zeros(len(langs), np.float32))[at[lang]] += n
        raw, off = K.utf8(pa.array(list(table), pa.string()))
        keys, rows = [], []
        values = np.array(list(table.values()), np.float32).reshape(len(table), len(langs))
        for a, b in K.runs(off):
            found = K.Words(raw, off[a:b + 1], LETTERS)
            keys.append(found.hash)
            rows.append(found.owner + a)
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        total = np.array([max(1.0, totals.get((lang, 0), 0)) for lang in langs], np.float32)
        self.logs = np.log((values[rows[order]] + 0.1) / total).astype(np.float32)
        grams = list(grams)
        self.grams = {gram: i for i, gram in enumerate(dict.fromkeys(g for _, g, _ in grams))}
        counts = np.zeros((len(self.grams), len(langs)), np.float32)
        for lang, gram, n in grams:
            counts[self.grams[gram], at[lang]] += n
        totals_by_length = np.array([[max(1.0, totals.get((lang, k), 0)) for lang in langs]
                                     for k in range(LONGEST + 1)], np.float32).reshape(LONGEST + 1, len(langs))
        length = np.array([len(g) for g in self.grams], np.int64)
        self.gram_logs = np.log((counts + 0.1) / totals_by_length[length]).astype(np.float32)

    def unseen(self, word: str) -> np.ndarray:
        bordered = f"<{word}>"
        for n in range(min(LONGEST, len(bordered)), 0, -1):
            got = [g for i in range(len(bordered) - n + 1)
                   if (g := self.grams.get(bordered[i:i + n])) is not None]
            if got:
                return self.gram_logs[got].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)


def _predict(shared):
    def run(batches):
        model: Model = shared.value     # read once per worker
        order = np.argsort(np.array(model.langs)) if model.langs else None
        for batch in batches:
            ids = batch.column(0)
            lower = pc.replace_substring_regex(pc.utf8_lower(batch.column(1)), NO_WORD, " ")
            raw, off = K.utf8(lower)
            langs, scores, letters = [], [], []
            for a, b in K.runs(off):
                words = K.Words(raw, off[a:b + 1], LETTERS)
                n = b - a
                sums = np.zeros((n, max(1, len(model.langs))))
                # a text of other signs than ASCII may hold no letter at all
                letter = np.bincount(words.owner, minlength=n) > 0
                for i in np.flatnonzero(letter):
                    first, last = words.ptr[i], words.ptr[i + 1]
                    span = words.data[words.start[first]:words.end[last - 1]]
                    if not ((span >= 0x61) & (span <= 0x7A)).any():
                        letter[i] = any(c.isalpha() for c in span.tobytes().decode("utf-8", "replace"))
                letters += letter.tolist()
                if model.langs and len(words.hash):
                    uniq, where, back = np.unique(words.hash, return_index=True, return_inverse=True)
                    at = np.searchsorted(model.keys, uniq)
                    at[at == len(model.keys)] = 0
                    known = model.keys[at] == uniq if len(model.keys) else np.zeros(len(uniq), bool)
                    logs = np.zeros((len(uniq), len(model.langs)), np.float32)
                    logs[known] = model.logs[at[known]]
                    for i in np.flatnonzero(~known):
                        logs[i] = model.unseen(words.word(where[i]))
                    for j in range(len(model.langs)):
                        sums[:, j] = np.bincount(words.owner, weights=logs[back, j], minlength=n)
                for i in range(n):
                    if not letter[i] or not model.langs:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    s = sums[i][order]
                    best = int(np.argmax(s))
                    langs.append(model.langs[order[best]])
                    scores.append(float(1.0 / np.exp(s - s[best]).sum()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(letters, pa.bool_())],
                                             names=["doc_id", "lang_pred", "score", "has_letter"])
    return run


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        docs_per_lang: int = DOCS_PER_LANG, id_col: str = "doc_id") -> Model:
    """Word and n-gram log frequencies by language; the counts are made by
    Spark, the driver holds the bounded model."""
    named = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                            F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in named.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [], [], {})
    share = F.element_at(F.create_map(*[F.lit(v) for lang, n in sizes.items()
                                        for v in (lang, min(1.0, docs_per_lang / n))]), F.col("lang"))
    place = F.pmod(F.xxhash64("id", "text", "lang"), F.lit(1 << 20)) / float(1 << 20)
    sample = named.where(place < share)
    words = sample.select("lang", F.explode(F.split(F.lower("text"), NO_WORD)).alias("word")).where("word <> ''")
    counts = stage(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "lang_words")
    bordered = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(bordered)))).alias("k")
    grams = (counts.select("lang", "n", bordered.alias("b"), lengths)
             .select("lang", "n", "k", F.explode(F.transform(
                 F.sequence(F.lit(1), F.length("b") - F.col("k") + 1),
                 lambda i: F.col("b").substr(i, F.col("k")))).alias("gram"))
             .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))
    grams = stage(grams, "lang_grams")
    totals = {(r[0], 0): r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    totals |= {(r[0], r[1]): r[2] for r in grams.groupBy("lang", "k").agg(F.sum("n")).collect()}
    kept = counts.select("lang", "word", "n").toArrow()
    kept_grams = grams.select("lang", "gram", "n").toArrow()
    rows = lambda t: zip(*(t.column(i).to_pylist() for i in range(3)))
    return Model(sorted(sizes), rows(kept), rows(kept_grams), totals)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, and has_letter: ``und`` by lack
    of a letter is told from ``und`` by lack of a model."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(K.lean("langid", _predict(shared)),
                            f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, "
                            "has_letter boolean")


def fold(id_column: Column, parts: int) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(parts))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.coalesce(fold(F.col(id_col), 5), F.lit(1)) != 0)


def op4_langid(spark, sf_dir):
    """All documents' languages, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(training_rows(docs)))
    return out.select("doc_id", (F.coalesce(fold(F.col("doc_id"), 5), F.lit(1)) == 0).alias("held_out"),
                      "lang_pred", "score")
