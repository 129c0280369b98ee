"""Merging the small files of a table that many loads write.

Every load of such a table owns a folder (``load=<name>``), so a table of many
micro-batches is made of many small files.  ``compact`` packs the small files of
each day into bins of about ``target_bytes`` and writes each bin as one file under
a load of its own; one append to the log beside the table (``<path>_replaced``)
then names the files that it replaces.  Readers (``read``) leave out the files
that the log names and the merged loads that it does not, so they see the old
files until that append and the merged ones after it, and a run that stops
before it has changed nothing.  ``vacuum`` deletes replaced files later.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from riverflow.operators.joins import checked_broadcast
from riverflow.session import stage
from riverflow.sources.layout import with_blooms
from riverflow.sources.readers import read_if_exists

MERGED = "merged-"           # first part of a merged load's name
TARGET_BYTES = 128 << 20
MIN_FILES = 8                # a day with fewer small files is left alone
MAX_FILES = 500_000          # paths of a broadcast list, about 100 bytes each


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}_replaced"


def files(spark: SparkSession, path: str) -> DataFrame:
    """The table's files by listing alone: path, bytes, load."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
             .select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes")))
    return found.withColumn("load", F.regexp_extract("path", r"load=([^/]+)/", 1))


def _committed(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_exists(spark, log_path(path))


def _live(df: DataFrame, log: DataFrame | None, file_path: str) -> DataFrame:
    """Rows of current files: no replaced file, no merged load without a commit."""
    merged = F.coalesce(F.col("load").startswith(MERGED), F.lit(False))
    if log is None:
        return df.where(~merged)
    done = log.select(F.col("merged").alias("load"), F.lit(True).alias("done_")).distinct()
    gone = log.select(F.col("path").alias(file_path)).distinct()
    kept = df.join(checked_broadcast(done, MAX_FILES), "load", "left").where(~merged | F.col("done_")).drop("done_")
    return kept.join(checked_broadcast(gone, MAX_FILES), file_path, "left_anti")


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table's rows from its current files, or None if it was never written."""
    stored = read_if_exists(spark, path, schema=schema)
    if stored is None or "load" not in stored.columns:
        return stored
    columns = stored.columns
    found = stored.select("*", F.col("_metadata.file_path").alias("file_path_"))
    return _live(found.withColumn("load", F.col("load").cast("string")), _committed(spark, path), "file_path_").select(*columns)


def current_files(spark: SparkSession, path: str) -> DataFrame:
    return _live(files(spark, path), _committed(spark, path), "path")


def commit(spark: SparkSession, path: str, replaced: DataFrame, merged: str) -> None:
    """From now on ``merged`` stands for the files in ``replaced`` (path)."""
    entry = replaced.select("path", F.lit(merged).alias("merged")).coalesce(1)
    entry.write.mode("append").parquet(log_path(path))


def compact(spark: SparkSession, path: str, partition: str | None = None, target_bytes: int = TARGET_BYTES,
            min_files: int = MIN_FILES, without: tuple[str, ...] = (), schema: T.StructType | None = None,
            blooms: dict[str, int] | None = None) -> int:
    """Merge the small files of every value of ``partition`` (a partition
    column below ``load``) that has ``min_files`` or more of them; loads named in
    ``without`` are left alone.  Returns the number of files replaced.

    Only one compaction of a table may run at a time."""
    if read_if_exists(spark, path, schema=schema) is None:
        return 0
    day = F.regexp_extract("path", rf"{partition}=([^/]+)/", 1) if partition else F.lit("")
    small = (current_files(spark, path).where((F.col("bytes") < target_bytes // 2) & ~F.col("load").isin(list(without)))
             .withColumn("day_", day))
    # whole files, in order of size, fill bin after bin
    of_day = Window.partitionBy("day_")
    before = F.coalesce(F.sum("bytes").over(of_day.orderBy("bytes", "path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = stage(small.withColumns({"n_": F.count(F.lit(1)).over(of_day), "bin_": F.floor(before / target_bytes)})
                 .where(F.col("n_") >= min_files).select("path", "day_", "bin_"), "plan")
    bins = plan.select("day_", "bin_").distinct()
    bins = stage(bins.select("*", (F.dense_rank().over(Window.orderBy("day_", "bin_")) - 1).alias("no_")), "bins")
    replaced = plan.count()
    if not replaced:
        return 0
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.parquet(path)
    columns = [c for c in stored.columns if c != "load"]
    rows = stored.select(*columns, F.col("_metadata.file_path").alias("path"))
    numbered = stage(plan.join(checked_broadcast(bins, MAX_FILES), ["day_", "bin_"]).select("path", "no_"), "numbered")
    rows = rows.join(checked_broadcast(numbered, MAX_FILES), "path")
    rows = rows.repartitionById(bins.count(), F.col("no_").cast("int")).select(*columns)   # one task and file per bin
    merged = f"{MERGED}{uuid.uuid4().hex}"
    writer = with_blooms(rows.write, blooms or {})
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path.rstrip('/')}/load={merged}")
    commit(spark, path, plan, merged)
    return replaced


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that the log names, once no reader uses them."""
    log = _committed(spark, path)
    if log is None:
        return 0
    old = files(spark, path).join(checked_broadcast(log.select("path").distinct(), MAX_FILES), "path", "left_semi")
    gone = 0
    conf = spark._jsc.sc().hadoopConfiguration()
    for r in stage(old.select("path"), "replaced").toLocalIterator():
        location = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r.path))
        gone += bool(location.getFileSystem(conf).delete(location, False))
    return gone
