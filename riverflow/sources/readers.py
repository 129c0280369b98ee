"""Readers for landed JSON (S1-S5, S7) and named tables.

Schemas are always explicit.  ``mode`` follows Spark's JSON reader:
FAILFAST (the default here, as the loader allows no bad record) raises on a
malformed line; PERMISSIVE keeps it as NULLs, with the raw text in
``_corrupt_record`` when ``corrupt_column`` is set.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverflow import schemas
from riverflow.functions import basename
from riverflow.sources import pages


def _json(spark: SparkSession, schema: T.StructType, path: str | list[str], mode: str,
          multiline: bool, corrupt_column: str | None, nested: bool = False) -> DataFrame:
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
    # No explicit timestampFormat: Spark's default ISO parsing accepts
    # "...Z" and offsets with any number of fractional digits.
    reader = spark.read.schema(schema).option("mode", mode).option("multiLine", multiline)
    if nested:
        reader = reader.option("recursiveFileLookup", True)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(path)


def read_hist_raw(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                  multiline: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """Day envelopes, one JSON document per file (S1), of every sub-folder:
    ``<root>/<year>/<json_file>`` and ``<root>/year=<year>/...`` alike."""
    return _json(spark, schemas.HIST_RAW, path, mode, multiline, corrupt_column, nested=True)


def list_hist_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed day-files by listing alone, no file is opened: path and
    json_file, the last name in the path that looks like a day-file's
    (``<json_file>`` itself or a folder ``file=<json_file>``), else NULL."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.col("_metadata.file_path").alias("path")))
    named = F.regexp_extract("path", r"([^/=]+_\d{4}-\d{2}-\d{2}\.json)(?:/[^/]*)?$", 1)
    return found.select("path", F.nullif(named, F.lit("")).alias("json_file"))


def read_live_raw(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                  corrupt_column: str | None = None) -> DataFrame:
    """Live NDJSON records with their ingestion stamp (S2).  ISO ``...Z``
    strings parse to timestamps, integers coerce to doubles and unknown keys
    are ignored."""
    return _json(spark, schemas.LIVE_RAW, path, mode, False, corrupt_column)


def read_live_records(spark: SparkSession, path: str | list[str],
                      mode: str = "FAILFAST") -> DataFrame:
    """Live records as fetched, before the ingestion stamp."""
    return _json(spark, schemas.LIVE_RECORD, path, mode, False, None)


def merge_pages(pages: DataFrame) -> DataFrame:
    """Records of all landed API pages (S5): a bag union of every page's
    ``data``, duplicates kept.  A page missing from the landing is simply
    absent; the pages read are used as they are."""
    return pages.select(F.inline("data"))


def read_live_pages(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                    multiline: bool = False) -> DataFrame:
    """Landed live API pages, then their merged records."""
    return merge_pages(_json(spark, schemas.LIVE_PAGE, path, mode, multiline, None))


def read_page_chain(spark: SparkSession, path: str | list[str], first: str | None = None,
                    mode: str = "FAILFAST", multiline: bool = False) -> pages.Chain:
    """Landed live API pages followed from ``first`` along their ``next`` links
    (S5): records up to the first missing page, and a report of every page.  A
    page's address is its ``page`` field, or its file's name without one."""
    schema = T.StructType([*schemas.LIVE_PAGE.fields, T.StructField("page", T.StringType())])
    landed = _json(spark, schema, path, mode, multiline, None)
    address = F.coalesce("page", basename(F.col("_metadata.file_path")))
    return pages.follow(landed.select(address.alias("page"), "next", "data"), first)


def read_stations(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                  multiline: bool = False) -> DataFrame:
    """Station list from the response's ``data`` array."""
    resp = _json(spark, schemas.STATION_RESPONSE, path, mode, multiline, None)
    return resp.select(F.inline("data"))


def read_live_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored raw live rows of every load, whoever wrote it.

    Loads are sub-folders of ``path`` (``writers.load_path``); all files under
    the root are read, with the fixed schema."""
    return spark.read.schema(schemas.LIVE_RAW).option("recursiveFileLookup", True).parquet(path)


def table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Named table read (S6): a catalog table name, or a path of ``fmt``."""
    if "/" in name_or_path or "://" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame | None:
    """The stored table at ``path``, or None when it was never written.  With
    ``schema`` (without the partition columns) no file is opened to infer it.

    The path's own file system is asked (the default one for a path without a
    scheme).  Only a missing path means None; any other failure is raised, so
    it cannot pass for a first run.
    """
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark._jsc.sc().hadoopConfiguration())
    if not fs.exists(location):
        return None
    try:
        reader = spark.read.format(fmt)
        return (reader.schema(schema) if schema is not None else reader).load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None  # a folder without a data file holds no rows yet
        raise


def decode_json_column(df: DataFrame, col: str, schema: str | T.DataType,
                       out: str | None = None) -> DataFrame:
    """Decode embedded JSON text into a struct (X12, decode half)."""
    return df.withColumn(out or col, F.from_json(F.col(col), schema))


def encode_json_column(df: DataFrame, cols: list[str], out: str = "json") -> DataFrame:
    """Encode columns as one JSON object per row (X12, encode half)."""
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in cols])))
