"""Structured Streaming form of the live refresh.

The source system re-runs its batch models every five minutes over all raw
rows.  Here landed NDJSON files are a file stream; each micro-batch stamps,
de-duplicates within a watermark, keeps the latest value per key in state,
and scores readings against the static history.

The exact forms (``dedup_to_table``, ``indicator_to_table``,
``windows_to_table``) keep stored tables equal to the batch models over
everything landed.  ``stream_dedup`` and ``stream_indicator`` are low-latency
options that drop rows later than their watermark (T6).  ``ingest`` writes
every micro-batch to the raw table exactly once, so the batch truth can always
be recomputed.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverflow import schemas
from riverflow.operators.indicator import indicator
from riverflow.operators.joins import HIST_BROADCAST_MAX_ROWS, checked_broadcast
from riverflow.operators.live import (LATEST_KEYS, MAX_PROBES, OBS_DAY, ROW_HASH, live_dedup, stamp_ingestion,
                                      unseen_rows, with_obs_day, with_row_hash)
from riverflow.session import scratch_path, stage
from riverflow.sources import compaction
from riverflow.sources.layout import with_blooms
from riverflow.sources.readers import read_if_exists
from riverflow.sources.writers import load_path
from riverflow.streaming.windows import pull_windows

DEFAULT_DELAY = "15 minutes"
COMPACT_EVERY = 50   # micro-batches between two merges of small files
DAY_FILES = 4   # files that a micro-batch adds to a day, at most


def stream_live_raw(spark: SparkSession, path: str, with_stamp: bool = True,
                    max_files_per_trigger: int | None = None, mode: str = "FAILFAST",
                    corrupt_column: str | None = None) -> DataFrame:
    """Landed live NDJSON as a stream (S3).  Files without an ingestion
    stamp get one per micro-batch (the statement clock of that batch).
    ``mode``/``corrupt_column`` behave as in the batch readers (S7)."""
    schema = schemas.LIVE_RAW if with_stamp else schemas.LIVE_RECORD
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    return df if with_stamp else stamp_ingestion(df)


def _each_batch(stream: DataFrame, write, name: str, checkpoint: str | None,
                available_now: bool, processing_time: str | None) -> StreamingQuery:
    """Start ``write(batch, load)`` on every micro-batch.  ``load`` names the
    micro-batch: a replay has the same name, another stream or a stream with
    a new checkpoint never has it."""
    spark = stream.sparkSession

    def run(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the micro-batch does not name its query")
        write(batch, f"{query}-{epoch}")

    w = (stream.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .foreachBatch(run))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def indicator_to_table(stream: DataFrame, hist: DataFrame, path: str, name: str = "indicator",
                       checkpoint: str | None = None, available_now: bool = True,
                       processing_time: str | None = None,
                       max_broadcast_rows: int = HIST_BROADCAST_MAX_ROWS,
                       compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Exact stream-static indicator (T5, T6): ``<path>/indicator`` always
    equals the batch indicator over everything landed.

    Each micro-batch stores the rows that no other micro-batch holds under
    ``<path>/dedup`` and their indicator rows, both in its own folder, which a
    replay replaces.  No watermark: no row is too late.  The stored rows lie by
    day, with a Bloom filter on their hash: a late row opens its own day only
    and, in it, only the row groups that may hold it.
    """
    spark = stream.sparkSession
    rows, out = f"{path.rstrip('/')}/dedup", f"{path.rstrip('/')}/indicator"

    def write(batch: DataFrame, load: str) -> None:
        new = staged_batch(batch)
        stored = read_dedup_store(spark, rows)
        if stored is not None:
            stored = stored.where(F.col("load") != load)
        mine = load_path(rows, load)
        write_dedup_store(unseen_rows(new, stored), mine)
        found = indicator(spark.read.schema(STORE_SCHEMA).parquet(mine).select(*schemas.LIVE_DEDUP_COLUMNS),
                          checked_broadcast(hist, max_broadcast_rows))
        found.write.mode("overwrite").parquet(load_path(out, load))
        if int(load.rsplit("-", 1)[1]) % compact_every == compact_every - 1:
            # this micro-batch may be replayed; those before it never
            compaction.compact(spark, rows, OBS_DAY, without=(load,), schema=STORE_SCHEMA, blooms={ROW_HASH: STORE_FILE_ROWS})
            compaction.compact(spark, out, without=(load,))

    return _each_batch(stream, write, name, checkpoint, available_now, processing_time)


STORE_SCHEMA = T.StructType([f for f in schemas.LIVE_RAW.fields if f.name in schemas.LIVE_DEDUP_COLUMNS]
                            + [T.StructField(ROW_HASH, T.LongType())])
STORE_FILE_ROWS = 1_000_000


def staged_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch de-duplicated and written once (its files would be read
    again by every action on it), with its days and row hashes."""
    return stage(with_row_hash(with_obs_day(live_dedup(batch))), "micro_batch")


def read_dedup_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows of all loads; no file is opened for the schema."""
    threshold = "spark.sql.parquet.pushdown.inFilterThreshold"
    if int(spark.conf.get(threshold, "10")) < MAX_PROBES:
        spark.conf.set(threshold, str(MAX_PROBES))   # lists of hashes reach the Bloom filters
    return compaction.read(spark, path, schema=STORE_SCHEMA)


def read_indicator_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The indicator rows that ``indicator_to_table`` keeps under ``path``."""
    found = compaction.read(spark, f"{path.rstrip('/')}/indicator")
    return None if found is None else found.drop("load")


def write_dedup_store(rows: DataFrame, path: str) -> None:
    """Rows by day; of each day one file per STORE_FILE_ROWS rows or so."""
    rows = stage(rows, "unseen")
    per = rows.groupBy(OBS_DAY).count().agg(F.max("count")).first()[0] or 1
    cut = F.pmod(F.col(ROW_HASH), F.lit(-(-per // STORE_FILE_ROWS)))
    writer = rows.repartition(F.col(OBS_DAY), cut).write.mode("overwrite").partitionBy(OBS_DAY)
    with_blooms(writer, {ROW_HASH: min(per, STORE_FILE_ROWS)}).parquet(path)


def windows_to_table(stream: DataFrame, path: str, ts: str = "date_obs", name: str = "pull_windows",
                     checkpoint: str | None = None, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Exact pull-window counts (T2): every micro-batch stores its own count
    per window, in a folder that a replay replaces; ``stored_windows`` adds
    them up.  Open windows and late rows are counted too."""
    def write(batch: DataFrame, load: str) -> None:
        pull_windows(batch, ts).write.mode("overwrite").parquet(load_path(path, load))

    return _each_batch(stream, write, name, checkpoint, available_now, processing_time)


def stored_windows(spark: SparkSession, path: str) -> DataFrame:
    """Observations per pull window over all micro-batches stored so far."""
    parts = spark.read.parquet(path)
    return parts.groupBy("window_start", "window_end").agg(F.sum("n_obs").alias("n_obs"))


def dedup_to_table(stream: DataFrame, dedup_path: str, name: str = "live_dedup",
                   checkpoint: str | None = None, available_now: bool = True,
                   processing_time: str | None = None) -> StreamingQuery:
    """Exact incremental de-duplication into a stored table.

    Each micro-batch appends only rows the table does not hold yet
    (``unseen_rows``), so the table always equals batch
    ``live_dedup`` over everything landed: no watermark, nothing is too
    late, and a replayed batch appends nothing.  Unlike the stateful stream
    dedup, identical copies are combined map-side before any shuffle.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, _load: str) -> None:
        new = staged_batch(batch)
        existing = read_if_exists(spark, dedup_path)
        # Same layout and batch mark as pipelines.run_live_incremental, so the
        # latest and average tables can fold in what the stream appended.
        batch_id = int(_dt.datetime.now(_dt.UTC).timestamp() * 1e6)
        (unseen_rows(new, existing).drop(ROW_HASH)
         .withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
         .repartition(OBS_DAY, F.pmod(F.xxhash64("date_obs", "code_station"), F.lit(DAY_FILES)))
         .write.mode("append").partitionBy(OBS_DAY).parquet(dedup_path))

    return _each_batch(stream, write, name, checkpoint, available_now, processing_time)


def stream_dedup(stream: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """De-duplicate overlapping pulls within the watermark.

    The key is the 16 landed columns, ``date_obs`` included; state for a key
    is dropped once the watermark passes its ``date_obs`` + delay.  Output
    columns are those of the batch ``live_dedup``.
    """
    return (stream.withWatermark("date_obs", delay)
            .dropDuplicatesWithinWatermark(schemas.LIVE_DEDUP_COLUMNS)
            .select(*schemas.LIVE_DEDUP_COLUMNS))


def _latest_struct_cols() -> list[str]:
    first = ["date_obs", "resultat_obs"]
    return first + [c for c in schemas.LIVE_DEDUP_COLUMNS if c not in first and c not in LATEST_KEYS]


def stream_latest(stream: DataFrame) -> DataFrame:
    """Latest row per (station, measure) kept in state (T4).

    ``max`` of a struct ordered (date_obs, resultat_obs, other columns)
    compares field by field with NULL lowest: the same total order as the
    batch ``latest`` (all descending, NULLs last).  Duplicates do not change a
    maximum, so no de-dup is needed first.  One state row per key; use the
    ``update`` or ``complete`` output mode.
    """
    cols = _latest_struct_cols()
    agg = stream.groupBy(*LATEST_KEYS).agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("_m"))
    return agg.select(*[F.col(c) if c in LATEST_KEYS else F.col(f"_m.{c}").alias(c)
                        for c in schemas.LIVE_DEDUP_COLUMNS],
                      F.lit(1).cast("bigint").alias("row_num"))


def latest_to_table(stream: DataFrame, path: str, name: str = "live_latest", checkpoint: str | None = None,
                    available_now: bool = True, processing_time: str | None = None,
                    merge_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Latest row per key as a log of changes (T4): every micro-batch appends
    the latest rows of the keys it holds, in a folder that a replay replaces;
    ``stored_latest`` folds them.  After ``merge_every`` micro-batches the changes
    before are folded into one row per key.  Nothing is kept in state and a
    micro-batch writes its own keys only, not the whole table."""
    spark = stream.sparkSession

    def write(batch: DataFrame, load: str) -> None:
        _fold_latest(batch).write.mode("overwrite").parquet(load_path(path, load))
        if int(load.rsplit("-", 1)[1]) % merge_every == merge_every - 1:
            merge_latest(spark, path, without=load)

    return _each_batch(stream, write, name, checkpoint, available_now, processing_time)


def _fold_latest(rows: DataFrame) -> DataFrame:
    """One row per key: a maximum, combined map-side, so copies and earlier
    folds of the same rows do not change it."""
    cols = _latest_struct_cols()
    agg = rows.groupBy(*LATEST_KEYS).agg(F.max(F.struct(*cols)).alias("_m"))
    return agg.select(*[F.col(c) if c in LATEST_KEYS else F.col(f"_m.{c}").alias(c) for c in schemas.LIVE_DEDUP_COLUMNS])


def stored_latest(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per (station, measure) over all changes stored so far."""
    return _fold_latest(compaction.read(spark, path)).withColumn("row_num", F.lit(1).cast("bigint"))


def merge_latest(spark: SparkSession, path: str, without: str = "") -> None:
    """Replace all changes but those of the load ``without`` by their fold."""
    old = stage(compaction.current_files(spark, path).where(F.col("load") != without).select("path"), "changes")
    if old.isEmpty():
        return
    merged = f"{compaction.MERGED}{uuid.uuid4().hex}"
    rows = compaction.read(spark, path).where(F.col("load") != without)
    _fold_latest(rows).write.parquet(load_path(path, merged))
    compaction.commit(spark, path, old, merged)


def ingest_lines(spark: SparkSession, landed: str, raw_path: str, dead_path: str, counts_path: str | None = None,
                 name: str = "live_lines", checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Landed NDJSON into the raw table, bad lines into a quarantine.

    Each micro-batch is parsed once; records go to ``raw_path``, lines that
    are no record to ``dead_path`` with their file, line number (from 1) and
    text, both in the micro-batch's own folder, which a replay replaces: every
    line is stored exactly once, in one of the two.  Blank lines are neither.
    ``counts_path`` gets one row per micro-batch with the rows written to either
    table, observed on the writes themselves (K10).

    A landed file (the answer to one ten-minute pull) is taken as a whole, so
    that its lines have numbers.
    """
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landed).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    record = T.StructType([*schemas.LIVE_RAW.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.where(F.trim("line") != "").select(
        "file", (F.col("at") + 1).cast("bigint").alias("position"), "line",
        F.from_json("line", record, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))

    def write(batch: DataFrame, load: str) -> None:
        once = stage(batch, "parsed")
        bad = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
        good = once.where(~bad).select("r.*").drop("_corrupt_record")
        rows = [_counted(good, load_path(raw_path, load)),
                _counted(once.where(bad).select("file", "position", "line"), load_path(dead_path, load))]
        if counts_path:
            spark.createDataFrame([(load, *rows)], "micro_batch string, n_rows bigint, n_bad bigint").coalesce(1).write.mode(
                "overwrite").parquet(load_path(counts_path, load))

    return _each_batch(parsed, write, name, checkpoint, available_now, processing_time)


def _counted(rows: DataFrame, path: str) -> int:
    seen = Observation("rows_written")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(seen.get.get("rows", 0))


def stream_indicator(stream: DataFrame, hist: DataFrame, delay: str = DEFAULT_DELAY,
                     max_broadcast_rows: int = HIST_BROADCAST_MAX_ROWS) -> DataFrame:
    """Stream-static inner join of de-duplicated readings with the history's
    quantiles (T5), append mode.

    ``hist`` should be the stored history.  AQE does not run inside
    micro-batches, so the static side is counted once here and broadcast
    when small; otherwise every micro-batch would shuffle it again.
    """
    return indicator(stream_dedup(stream, delay), checked_broadcast(hist, max_broadcast_rows))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Checkpoint of a named stream under the configured shared folder.

    The configured ``spark.checkpoint.dir`` itself is used, not the
    per-application subfolder Spark creates in it, so the same stream name
    resumes from its checkpoint in the next application.  Callers that own a
    table root should rather keep the checkpoint next to the table.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/") + f"/streams/{name}"
    return scratch_path(spark, f"streams/{name}")


def start(df: DataFrame, name: str, sink: str = "memory", mode: str = "append",
          path: str | None = None, checkpoint: str | None = None,
          available_now: bool = False, processing_time: str | None = None,
          fmt_options: dict | None = None) -> StreamingQuery:
    """Start a streaming query with a checkpoint in the shared folder.

    ``available_now`` processes what has landed and stops (the scheduled
    run of the source system); ``processing_time`` runs continuously.
    """
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    if sink == "memory":
        w = w.format("memory")
    else:
        w = w.format(sink).option("path", path)
    for k, v in (fmt_options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def ingest(stream: DataFrame, raw_path: str, name: str = "live_ingest",
           checkpoint: str | None = None, available_now: bool = True,
           processing_time: str | None = None) -> StreamingQuery:
    """Append every landed record to the raw table exactly once.

    Each micro-batch writes its own load folder, as ``pipelines.ingest_live``
    does, so streamed and batch loads share one table; a replay replaces its
    folder."""
    def write(batch: DataFrame, load: str) -> None:
        batch.write.mode("overwrite").parquet(load_path(raw_path, load))

    return _each_batch(stream, write, name, checkpoint, available_now, processing_time)


def run_to_table(df: DataFrame, out_path: str, name: str, mode: str = "append",
                 checkpoint: str | None = None) -> DataFrame:
    """Process everything landed (``availableNow``) into a parquet table and
    return the stored result.

    Append-mode results go through the exactly-once file sink; a
    ``complete``-mode result (the latest-value state) is rewritten per
    micro-batch with ``foreachBatch``.  Nothing is held by the driver.
    """
    spark = df.sparkSession
    ckpt = checkpoint or checkpoint_location(spark, name)
    if mode == "append":
        q = start(df, name, sink="parquet", mode="append", path=out_path, checkpoint=ckpt,
                  available_now=True)
    elif mode == "complete":
        def write(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(out_path)
        q = (df.writeStream.queryName(name).outputMode("complete")
             .option("checkpointLocation", ckpt).foreachBatch(write)
             .trigger(availableNow=True).start())
    else:
        raise ValueError("mode must be 'append' or 'complete'")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return spark.read.parquet(out_path)
