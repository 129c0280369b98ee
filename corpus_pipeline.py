"""Training-corpus pipeline over ``documents``: language ID, near-duplicate
removal, benchmark decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir), with docs as its predecessor wrote it,
and returns a DataFrame; ``run`` writes each result as Parquet in the shared
checkpoint folder and reads it again for the next.  All stages but the last
return the columns of ``documents``.  Language ID and decontamination judge row
by row, also rows without a doc_id or of a repeated one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverflow.llm import langid, pfair, superminhash, tokenbin, winnow
from riverflow.llm.common import counted_broadcast, ready, table
from riverflow.session import scratch_path, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# near_dedup's own threshold (op10's query has 85); the bands miss a pair of
# likeness 0.80 with chance 3e-7, the margin is over five standard deviations
NEAR = {"percent": 80, "bands": 38, "rows": 5, "margin": 0.16}


def _row() -> Column:
    """128-bit key of a row's doc_id and text: rows equal in both are judged alike."""
    return F.struct(F.xxhash64(F.lit(1), "doc_id", "text").alias("a"), F.xxhash64(F.lit(2), "doc_id", "text").alias("b"))


def _without(keyed: DataFrame, rejected: DataFrame) -> DataFrame:
    """``keyed`` without the rows whose key_ is in ``rejected`` (doc_id)."""
    keys = stage(rejected.select(F.col("doc_id").alias("key_")).distinct(), "rejected")
    return keyed.select(*COLUMNS, "key_").join(counted_broadcast(keys), "key_", "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that can have no language: no text, or text without a
    letter.  Others stay, also if no language was learned; a NULL lang becomes
    the predicted one."""
    ready(spark)
    keyed = docs.withColumn("key_", F.struct(_row().alias("row"), F.col("lang").isNotNull().alias("named")))
    found = langid.identify(keyed, langid.fit(langid.training_rows(docs)), id_col="key_")
    found = stage(found.where(~F.col("has_letter") | ~F.col("doc_id.named")).select(
        F.col("doc_id").alias("key_"), "has_letter", F.nullif("lang_pred", F.lit(langid.UNKNOWN)).alias("pred_")).distinct(), "found")
    out = keyed.join(counted_broadcast(found), "key_", "left").where(F.coalesce("has_letter", F.lit(True)))
    return out.withColumn("lang", F.coalesce("lang", "pred_")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies
    (likeness 0.80 or more).  Different texts of one doc_id are documents of
    their own: the one of the least hash has the doc_id; the others come after
    all ids (by a 61-bit hash of doc_id and text), then rows without a doc_id (by
    a 62-bit hash of the text)."""
    ready(spark)
    text = F.xxhash64("text")
    several = stage(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("id_")).agg(
        F.min(text).alias("least_"), F.max(text).alias("most_")).where("least_ <> most_").drop("most_"), "several")
    mark = F.xxhash64(F.lit(3), "doc_id", "text")
    other = F.when(F.col("doc_id").isNull(), F.shiftrightunsigned(mark, 2) + F.lit(1 << 62)).otherwise(
        F.shiftrightunsigned(mark, 3) + F.lit(1 << 61))
    keyed = docs.join(counted_broadcast(several), docs.doc_id == several.id_, "left").withColumn(
        "key_", F.when(F.col("doc_id").isNotNull() & (F.col("least_").isNull() | (text == F.col("least_"))),
                       F.col("doc_id").cast("long")).otherwise(other))
    keyed = keyed.select(*COLUMNS, "key_")
    found = superminhash.near_duplicates(keyed, id_col="key_", **NEAR)
    kept = _without(keyed, found.where(~F.col("kept")))
    # rows of one key are copies of one row
    repeated = keyed.groupBy("key_").count().where("count > 1").limit(1).count()
    if repeated:
        kept = kept.groupBy("key_").agg(F.min(F.struct(*COLUMNS)).alias("r_")).select("r_.*")
    return kept.select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is benchmark text."""
    keyed = docs.withColumn("key_", _row())
    found = winnow.decontaminate(keyed, table(spark, sf_dir, "benchmark"), id_col="key_")
    return _without(keyed, found.where("contaminated")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture: the part files, in
    order of their names, hold it."""
    out = pfair.schedule(docs.select(*COLUMNS))
    return out.repartitionByRange("slot_", "place_").sortWithinPartitions("slot_", "place_").select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture (the order of the rows in
    ``docs``'s part files), read back: doc_id, start, n_tokens, ids_crc32."""
    ready(spark)
    files = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file_"),
                        F.col("_metadata.row_index").alias("row_"))
    return tokenbin.round_trip(files, tokenbin.vocabulary(), order=[F.col("file_"), F.col("row_")])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# Near-duplicate components, EDF schedules and BPE have no SQL form; the stages
# are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    base = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
