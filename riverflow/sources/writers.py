"""Sinks: append, overwrite, landing and materialization.

Targets are paths (parquet by default) or catalog table names.  Every writer
returns the number of rows written, taken from an ``Observation`` on the
write itself, so no second scan is needed (K10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riverflow.functions import year_of
from riverflow.sources.layout import with_blooms


def _is_path(target: str) -> bool:
    return "/" in target or "://" in target


def clustered(df: DataFrame, cluster_by: list[str] | None,
              partitions: int | None = None) -> DataFrame:
    """Lay rows out by ``cluster_by`` before a write (K8).

    Range partitioning plus a sort inside each partition gives files whose
    min/max statistics on the keys do not overlap, so later filters on those
    keys skip whole files and row groups.  A row hash is the last range key:
    the sampled bounds can then cut inside one heavy key value, so a station
    with a third of all rows is written by several tasks, not one.
    """
    if not cluster_by:
        return df
    parts = [partitions] if partitions else []
    spread = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_spread")
    return (df.repartitionByRange(*parts, *[F.col(c) for c in cluster_by], spread)
            .sortWithinPartitions(*cluster_by))


# Text formats keep microseconds and the UTC offset of every timestamp.
TEXT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TEXT_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _write(df: DataFrame, target: str, mode: str, fmt: str, cluster_by: list[str] | None,
           partition_by: list[str] | None,
           bucket_by: tuple[int, list[str]] | None = None, blooms: dict[str, int] | None = None) -> int:
    obs = Observation("rows_written")
    out = clustered(df, cluster_by).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = with_blooms(out.write.mode(mode), blooms or {})
    if fmt in ("json", "csv"):
        writer = (writer.option("timestampFormat", TEXT_TIMESTAMP_FORMAT)
                  .option("timestampNTZFormat", TEXT_TIMESTAMP_NTZ_FORMAT))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        if _is_path(target):
            raise ValueError("bucketing needs a catalog table name, not a path")
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if _is_path(target):
        writer.format(fmt).save(target)
    else:
        writer.format(fmt).saveAsTable(target)
    return int(obs.get.get("rows", 0))


def append(df: DataFrame, target: str, fmt: str = "parquet",
           cluster_by: list[str] | None = None, partition_by: list[str] | None = None,
           bucket_by: tuple[int, list[str]] | None = None, blooms: dict[str, int] | None = None) -> int:
    """Append rows, creating the target on first use (K1).  ``blooms`` names
    columns that get a Parquet Bloom filter, with their distinct values a file."""
    return _write(df, target, "append", fmt, cluster_by, partition_by, bucket_by, blooms)


def overwrite(df: DataFrame, target: str, fmt: str = "parquet",
              cluster_by: list[str] | None = None, partition_by: list[str] | None = None,
              bucket_by: tuple[int, list[str]] | None = None) -> int:
    """Replace the target's content (K2).

    ``bucket_by=(n, keys)`` stores a catalog table in ``n`` buckets sorted
    by ``keys`` (K8): two tables bucketed alike on the join key join
    without any shuffle, whatever their sizes.
    """
    return _write(df, target, "overwrite", fmt, cluster_by, partition_by, bucket_by)


def land_hist(envelopes: DataFrame, root: str, date_col: str = "json_file", by_file: bool = False) -> int:
    """Land day envelopes as JSON under ``<root>/year=<YYYY>/`` (K3), with
    ``by_file`` under ``<root>/year=<YYYY>/file=<json_file>/``: a folder per
    day-file, so that a listing names the day-files and loaded ones are never
    opened again.

    The year is taken from the envelope's file tag (``..._YYYY-MM-DD.json``)
    unless ``date_col`` names a date column.
    """
    if date_col == "json_file":
        day = F.regexp_extract(F.col("json_file"), r"(\d{4}-\d{2}-\d{2})", 1)
    else:
        day = F.col(date_col)
    out = envelopes.withColumn("year", year_of(day))
    if by_file:
        out = out.withColumn("file", F.col("json_file"))
    return append(out, root, fmt="json", partition_by=["year", "file"] if by_file else ["year"])


def land_live(records: DataFrame, path: str) -> int:
    """Land live records as NDJSON, one object per line (K4)."""
    return append(records, path, fmt="json")


def load_path(root: str, load: str) -> str:
    """Folder of one load of a table that several writers share.

    Each load owns its folder: a repeated load replaces its own rows, and no
    writer's file list hides the rows of another."""
    return f"{root.rstrip('/')}/load={load}"


def materialize(df: DataFrame, target: str, cluster_by: list[str] | None = None,
                fmt: str = "parquet", partition_by: list[str] | None = None) -> DataFrame:
    """Write as a table and return the read-back frame (K5).

    Reading back cuts the lineage: downstream models reuse the stored rows
    instead of recomputing the whole plan per action, and a lost executor
    only costs the re-read of its files.
    """
    overwrite(df, target, fmt=fmt, cluster_by=cluster_by, partition_by=partition_by)
    spark: SparkSession = df.sparkSession
    return spark.read.format(fmt).load(target) if _is_path(target) else spark.table(target)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register as a view (K6): no storage, recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df
