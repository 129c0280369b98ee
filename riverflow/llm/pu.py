"""Quality classifier by positive-unlabelled learning.

The model sees trusted positives P (documents labelled good) and unlabelled web
text U (any documents of the training rows, their labels unused) and minimises
the non-negative unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

with the logistic loss; where the bracket turns negative the step goes the
other way, as the non-negative correction asks.  ``prior``, the share of good
documents in U, is estimated as the share among the labelled training rows.

P and U are bounded samples (``SAMPLE`` documents each in expectation, chosen
by a hash of the text); features come from whole texts.  Scoring covers every
row with the same features.

Defined cases: NULL text counts as empty; empty texts get the score of a text
without words.  Without any positive every score is 0; without any negative
label the prior is held at ``MAX_PRIOR``.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table
from riverflow.llm.langid import fold

SAMPLE = 8000
MIN_PRIOR, MAX_PRIOR = 0.02, 0.98
STEPS, RATE, DECAY = 800, 0.03, 1e-4

_byte = np.arange(256)
_LINE = _byte != 0x0A
_UPPER = (_byte >= 65) & (_byte <= 90)
_ASCII = _UPPER | ((_byte >= 97) & (_byte <= 122))
_DIGIT = (_byte >= 48) & (_byte <= 57)
_SYMBOL = np.isin(_byte, [ord(c) for c in "#$%&*@^~|\\<>{}[]=+_/"])
_MARK = np.isin(_byte, [ord(c) for c in ".,;:!?"])
_LOUD = np.isin(_byte, [ord(c) for c in "!?"])
_STOP = _byte == ord(".")
FEATURES = 16


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[texts, FEATURES] numbers of form and repetition of a run of texts."""
    words = K.Words(raw, offsets, K.NONSPACE)
    lines = K.Words(raw, offsets, _LINE)
    n = len(offsets) - 1
    data, off = raw[int(offsets[0]):int(offsets[-1])], offsets - offsets[0]

    def share(kind):
        c = np.concatenate([[0], np.cumsum(kind[data])])
        return (c[off[1:]] - c[off[:-1]]).astype(np.float64)

    size = np.maximum(1, np.diff(off)).astype(np.float64)
    count = np.diff(words.ptr).astype(np.float64)
    n_lines = np.diff(lines.ptr).astype(np.float64)
    per = np.maximum(1, count)
    pairs = words.grams(2)
    distinct, top, distinct2, twin, distinct_lines = (np.zeros(n) for _ in range(5))
    for i in range(n):
        a, b = words.ptr[i], words.ptr[i + 1]
        if b > a:
            _, c = np.unique(words.hash[a:b], return_counts=True)
            distinct[i], top[i] = len(c), c.max()
            twin[i] = (words.hash[a + 1:b] == words.hash[a:b - 1]).sum()
            distinct2[i] = len(np.unique(pairs[a:b - 1])) if b > a + 1 else 1
        a, b = lines.ptr[i], lines.ptr[i + 1]
        if b > a:
            distinct_lines[i] = len(np.unique(lines.hash[a:b]))
    length = (words.end - words.start).astype(np.float64)
    mean_length = np.bincount(words.owner, weights=length, minlength=n) / per
    return np.column_stack([
        np.log1p(count), mean_length, np.log1p(distinct) / np.maximum(1, np.log1p(count)), distinct / per,
        top / per, twin / per, distinct2 / np.maximum(1, per - 1), 1 - distinct_lines / np.maximum(1, n_lines),
        np.log1p(per / np.maximum(1, n_lines)), share(_UPPER) / np.maximum(1, share(_ASCII)), share(_DIGIT) / size,
        np.sqrt(share(_SYMBOL) / size), share(_MARK) / per, np.sqrt(share(_LOUD) / size), share(_STOP) / per,
        (count == 0).astype(np.float64)])


def expand(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features with squares and hinges, and a constant."""
    z = np.clip((x - centre) / scale, -5, 5)
    return np.column_stack([z, z * z / 5, np.maximum(0, z - 1), np.maximum(0, -z - 1), np.ones(len(z))])


class Model:
    def __init__(self, centre, scale, weight):
        self.centre, self.scale, self.weight = centre, scale, weight

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weight is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(expand(x, self.centre, self.scale) @ self.weight, -30, 30)))


def risk_step(w, xp, xu, prior):
    """Gradient of the non-negative risk (of its corrected step)."""
    sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (xp, xu))
    plus = -prior * (xp * (1 - sp)[:, None]).mean(axis=0)            # of prior * E_P[loss(+)]
    minus = (xu * su[:, None]).mean(axis=0) - prior * (xp * sp[:, None]).mean(axis=0)
    rest = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
    return plus + minus if rest >= 0 else -minus


def train(p: np.ndarray, u: np.ndarray, prior: float) -> Model:
    """Full-batch Adam on the bounded sample."""
    if len(p) == 0:
        return Model(None, None, None)
    both = np.vstack([p, u]) if len(u) else p
    u = u if len(u) else p
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    xp, xu = expand(p, centre, scale), expand(u, centre, scale)
    w, m, v = (np.zeros(xp.shape[1]) for _ in range(3))
    mean_w = np.zeros_like(w)
    for t in range(1, STEPS + 1):
        g = risk_step(w, xp, xu, prior) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        if t > STEPS // 2:
            mean_w += w / (STEPS - STEPS // 2)
    return Model(centre, scale, mean_w)


def _featurise(batches):
    for batch in batches:
        for a, b, raw, off in K.strings(batch, "text"):
            x = features(raw, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.FixedSizeListArray.from_arrays(
                    pa.array(x.reshape(-1)), FEATURES).cast(pa.list_(pa.float64()))], names=["kind", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Train on the given rows: ``labels`` mark positives (1); ``docs`` are the
    unlabelled text.  Both hold training rows only."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.min(F.col(label_col)).alias("label"))
    n_pos, n_all = marks.agg(F.coalesce(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)), F.lit(0)),
                             F.count(F.lit(1))).first()
    n_docs = texts.count()
    if not n_pos or not n_docs:
        return Model(None, None, None)
    prior = min(MAX_PRIOR, max(MIN_PRIOR, n_pos / n_all))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    # bounded by ``sample`` ids in expectation
    chosen = marks.where((F.col("label") == 1) & (place < min(1.0, sample / n_pos))).select("doc_id")
    p = texts.join(F.broadcast(chosen), "doc_id").select(F.lit(1).alias("kind"), "text")
    u = texts.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 20)) / float(1 << 20) < min(1.0, sample / n_docs))
    both = p.union(u.select(F.lit(0).alias("kind"), "text")).mapInArrow(_featurise, "kind int, x array<double>").toArrow()
    kind = both.column("kind").to_numpy()
    x = np.array(both.column("x").to_pylist(), np.float64).reshape(-1, FEATURES)
    order = np.lexsort(x.T)         # the result does not depend on the rows' arrival
    kind, x = kind[order], x[order]
    return train(x[kind == 1], x[kind == 0], prior)


def _scores(model: Model):
    def run(batches):
        for batch in batches:
            for a, b, raw, off in K.strings(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(model.score(features(raw, off)), pa.float64())],
                    names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = texts.mapInArrow(_scores(model), f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_pu(spark, sf_dir):
    """Quality scores of all documents; labels of two thirds are used."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(fold(F.col("doc_id"), 3), F.lit(0)) == 1
    model = fit(docs.where(~held), labels.where(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
