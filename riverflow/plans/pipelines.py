"""The refresh pipelines (G1-G5) as ordered DataFrame writes.

Each model that several others read is written once and read back
(``materialize``), which both avoids recomputation and cuts the lineage; the
cheap single-reader models stay views.  Paths live under ``out``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.functions import horizon
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.operators.indicator import indicator
from riverflow.operators.joins import HIST_BROADCAST_MAX_ROWS, checked_broadcast
from riverflow.sources import compaction
from riverflow.sources import readers as R
from riverflow.sources.readers import read_if_exists
from riverflow.session import stage
from riverflow.sources import versions as V
from riverflow.sources import writers as W
from riverflow.sources.layout import along_curve

STATIONS_PER_FILE = 10_000  # expected distinct stations in a file of hist_flat


@dataclass
class Paths:
    out: str
    raw_hist: str = ""
    raw_live: str = ""
    flat: str = field(init=False)
    hist_agg: str = field(init=False)
    live_dedup: str = field(init=False)
    live_latest: str = field(init=False)
    stations: str = field(init=False)
    live_avg_parts: str = field(init=False)
    hist_sketches: str = field(init=False)

    def __post_init__(self):
        base = self.out.rstrip("/")
        self.raw_hist = self.raw_hist or f"{base}/hist_raw"
        self.raw_live = self.raw_live or f"{base}/live_raw"
        self.flat = f"{base}/hist_flat"
        self.hist_agg = f"{base}/hist_agg"
        self.live_dedup = f"{base}/live_dedup"
        self.live_latest = f"{base}/live_latest"
        self.stations = f"{base}/stations"
        self.live_avg_parts = f"{base}/live_avg_parts"
        self.hist_sketches = f"{base}/hist_sketches"


def load_hist_files(spark: SparkSession, landed: str, paths: Paths) -> int:
    """Historical load (G3): append the day-files that the raw table does not
    hold.  Creates the table on first use.

    Landed files are listed first and anti-joined by name (K9), so a loaded
    file is not opened again; files that no day-file's name tells apart are
    read and compared by their content's tag."""
    loaded = read_if_exists(spark, paths.raw_hist)
    if loaded is None:
        return W.append(R.read_hist_raw(spark, landed), paths.raw_hist)
    listed = R.list_hist_files(spark, landed)
    new = listed.where("json_file is null").unionByName(H.load_new_files(listed.where("json_file is not null"), loaded))
    # paths of new files only: Spark's file index holds them on the driver anyway
    todo = [r.path for r in stage(new.select("path"), "new_files").toLocalIterator()]
    if not todo:
        return 0
    return W.append(H.load_new_files(R.read_hist_raw(spark, todo), loaded), paths.raw_hist)


def run_historical(spark: SparkSession, paths: Paths, method: str = "approx") -> DataFrame:
    """Historical refresh (G1): incremental flatten, then the quantiles.

    ``method``: ``approx`` (percentile sketch over the whole history),
    ``exact`` (distributed exact quantiles), or ``kll``: a stored KLL sketch
    per (group, day-file); only day-files without sketches are sketched, and
    the stored sketches are merged, so the daily cost follows the new files.
    """
    raw = spark.read.schema(schemas.HIST_RAW).parquet(paths.raw_hist)
    target = read_if_exists(spark, paths.flat)
    new_rows = H.flatten_incremental(raw, target)
    # along the station-day curve: lookups by station or day open few files
    W.append(along_curve(stage(new_rows, "new_rows")), paths.flat, blooms={"code_station": STATIONS_PER_FILE})
    flat = spark.read.parquet(paths.flat)
    if method == "kll":
        stored = read_if_exists(spark, paths.hist_sketches)
        todo = flat if stored is None else H.not_in_files(flat, stored, strict=False)
        W.append(H.hist_sketches(todo), paths.hist_sketches)
        hist = H.hist_agg_from_sketches(spark.read.parquet(paths.hist_sketches))
    elif method in ("approx", "exact"):
        hist = H.hist_agg(flat, exact=method == "exact")
    else:
        raise ValueError("method must be 'approx', 'exact' or 'kll'")
    return W.materialize(hist, paths.hist_agg)


def ingest_live(spark: SparkSession, pages_path: str, paths: Paths,
                now: _dt.datetime | None = None, first: str | None = None) -> int:
    """Live load (G4): merge the landed pages, stamp, append.  With ``first``
    the pages are followed from that address along their links, up to the
    first one that did not land; without it every landed page is taken."""
    if first is None:
        records = R.read_live_pages(spark, pages_path)
    else:
        records = R.read_page_chain(spark, pages_path, first).records.drop("position")
    return W.append(L.stamp_ingestion(records, now),
                    W.load_path(paths.raw_live, f"batch-{uuid.uuid4().hex}"))


def recent_from_store(stored: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """The recent view over the day-partitioned dedup table: only the day
    partitions the window can touch are read."""
    clock = (F.current_timestamp() if as_of is None
             else as_of if isinstance(as_of, Column) else F.lit(as_of))
    window = L.from_day(stored, horizon(clock, hours)).select(*schemas.LIVE_DEDUP_COLUMNS)
    return L.recent(window, as_of=clock, hours=hours)


def _run_id() -> int:
    """Batch id of a refresh: microseconds since the epoch (increasing)."""
    return int(_dt.datetime.now(_dt.UTC).timestamp() * 1e6)


def run_live(spark: SparkSession, paths: Paths, as_of: Column | _dt.datetime | None = None,
             run_id: int | None = None) -> dict[str, DataFrame]:
    """Live refresh (G2): dedup once, then the latest table, the average
    parts and the views (average, recent, indicators).  Returns every model
    by name.

    The tables have the same layout as ``run_live_incremental`` writes
    (batch id on dedup rows, log of folded files with latest and avg
    parts), so the two refresh modes can follow each other on the same tables.
    """
    run_id = run_id if run_id is not None else _run_id()
    mark = F.lit(run_id).cast("bigint")
    stored = W.materialize(
        L.with_obs_day(L.live_dedup(R.read_live_table(spark, paths.raw_live)))
        .withColumn("ingest_batch", mark), paths.live_dedup,
        cluster_by=[L.OBS_DAY, "code_station"], partition_by=[L.OBS_DAY])
    dedup = stored.select(*schemas.LIVE_DEDUP_COLUMNS)
    # latest and hist_agg hold one row per station: no clustering needed
    log = dedup_files(spark, paths.live_dedup)
    latest = fold_rows(W.materialize(_with_log(L.latest(dedup), log), paths.live_latest))
    parts = fold_rows(W.materialize(_with_log(L.live_avg_parts(dedup), log), paths.live_avg_parts))
    avg = W.as_view(L.avg_from_parts(parts), "live_avg")
    recent = W.as_view(recent_from_store(stored, as_of), "live_recent")
    hist = checked_broadcast(spark.read.parquet(paths.hist_agg), HIST_BROADCAST_MAX_ROWS)
    return {
        "live_dedup": dedup,
        "live_latest": latest,
        "live_avg": avg,
        "live_recent": recent,
        "indicator": W.as_view(indicator(dedup, hist), "indicator"),
        "indicator_latest": W.as_view(indicator(latest, hist), "indicator_latest"),
        "indicator_recent": W.as_view(indicator(recent, hist, coords="history"),
                                      "indicator_recent"),
    }


# A derived table holds its rows (FOLD_LOG NULL) and, in the same write, one
# row per file of the dedup table it has folded in (FOLD_LOG set, all else NULL).
FOLD_LOG = "fold_log"
MAX_FOLD_PATHS = 1_000  # new files that a fold names to the scan; more are joined by name


def dedup_files(spark: SparkSession, table: str) -> DataFrame:
    """The files of the dedup table by listing alone: path, and FOLD_LOG, the
    day's folder and file name."""
    return stage(compaction.files(spark, table).select(
        "path", F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias(FOLD_LOG)), "dedup_files")


def _with_log(rows: DataFrame, log: DataFrame) -> DataFrame:
    return rows.withColumn(FOLD_LOG, F.lit(None).cast("string")).unionByName(
        log.select(FOLD_LOG), allowMissingColumns=True)


def fold_rows(stored: DataFrame) -> DataFrame:
    """The rows of a derived table, without its log of folded files."""
    return stored.where(F.col(FOLD_LOG).isNull()).drop(FOLD_LOG)


def _stored_fold(spark: SparkSession, path: str) -> DataFrame | None:
    """A derived table with its log of files, or None if it has none (then every
    stored dedup row is folded into a new one)."""
    stored = read_if_exists(spark, path)
    named = stored is not None and dict(stored.dtypes).get(FOLD_LOG) == "string"
    return stored if named else None


def rows_of(dedup: DataFrame, files: DataFrame, max_paths: int = MAX_FOLD_PATHS) -> DataFrame:
    """The dedup rows in ``files`` (path).  A few files are named to the scan,
    which then opens no other one; many are joined by name."""
    paths = [r.path for r in files.select("path").limit(max_paths + 1).collect()]
    rows = dedup.select(*schemas.LIVE_DEDUP_COLUMNS, F.col("_metadata.file_path").alias("path"))
    if len(paths) <= max_paths:
        rows = rows.where(F.col("path").isin(paths))
    else:
        rows = rows.join(checked_broadcast(files.select("path"), compaction.MAX_FILES), "path", "left_semi")
    return rows.select(*schemas.LIVE_DEDUP_COLUMNS)


def _fold(spark: SparkSession, dedup: DataFrame, files: DataFrame, path: str, make, merge) -> DataFrame:
    """Bring a derived table up to the listed ``files`` of ``dedup``: only those
    that its log does not name are read, in whatever order and by whomever they
    were committed.  ``make`` derives rows from dedup rows, ``merge`` combines
    stored and new ones."""
    stored = _stored_fold(spark, path)
    if stored is None:
        rows = make(rows_of(dedup, files))
    else:
        log = stored.where(F.col(FOLD_LOG).isNotNull()).select(FOLD_LOG)
        new = stage(files.join(log, FOLD_LOG, "left_anti"), "unfolded")
        rows = merge(fold_rows(stored), rows_of(dedup, new))
    W.overwrite(stage(_with_log(rows, files), "fold"), path)
    return fold_rows(spark.read.parquet(path))


def run_live_incremental(spark: SparkSession, paths: Paths, new_raw: DataFrame,
                         as_of: Column | _dt.datetime | None = None,
                         run_id: int | None = None) -> dict[str, DataFrame]:
    """Live refresh whose cost follows the new rows, not the whole history.

    Same tables as ``run_live`` over all raw rows seen so far:
    - ``live_dedup``: ``live_dedup_increment(new_raw, stored)`` appended with
      its ``ingest_batch`` (this run's id, increasing across runs);
    - ``live_latest``: ``latest`` over the stored latest rows plus the rows of
      the dedup files it has not folded in yet (the pick is a maximum, so it
      composes);
    - ``live_avg``: a view over stored per (station, month) sum/count
      parts, folded the same way (the parts are the stored, mergeable form
      of the average).
    The derived tables log the dedup files they folded in, so a run that stopped
    half-way is completed by the next one, a file that is committed late is folded
    by the next run, replaying a batch changes nothing, and a refresh opens the
    files added since the last one, not the table.  Each replaced
    table is first staged (written under ``spark.checkpoint.dir``) and then
    overwritten from the stage, so no job reads the files it replaces.
    """
    run_id = run_id if run_id is not None else _run_id()
    stored = read_if_exists(spark, paths.live_dedup)
    inc = L.live_dedup_increment(new_raw, stored,
                                 days=L.batch_days(new_raw) if stored is not None else None)
    W.append(L.with_obs_day(inc).withColumn("ingest_batch", F.lit(run_id).cast("bigint")),
             paths.live_dedup, partition_by=[L.OBS_DAY])
    files = dedup_files(spark, paths.live_dedup)  # listed first: the table below holds them all
    dedup_all = spark.read.parquet(paths.live_dedup)

    latest = _fold(spark, dedup_all, files, paths.live_latest, L.latest,
                   lambda old, new: L.latest(old.select(*schemas.LIVE_DEDUP_COLUMNS).unionByName(new)))
    parts = _fold(spark, dedup_all, files, paths.live_avg_parts, L.live_avg_parts,
                  lambda old, new: L.merge_avg_parts(old, L.live_avg_parts(new)))
    avg = W.as_view(L.avg_from_parts(parts), "live_avg")

    dedup = dedup_all.select(*schemas.LIVE_DEDUP_COLUMNS)
    recent = W.as_view(recent_from_store(dedup_all, as_of), "live_recent")
    models = {"live_dedup": dedup, "live_latest": latest, "live_avg": avg,
              "live_recent": recent}
    stored_hist = read_if_exists(spark, paths.hist_agg)
    if stored_hist is None:
        return models  # no history yet: the indicator views wait for G1
    hist = checked_broadcast(stored_hist, HIST_BROADCAST_MAX_ROWS)
    models.update({
        "indicator": W.as_view(indicator(dedup, hist), "indicator"),
        "indicator_latest": W.as_view(indicator(latest, hist), "indicator_latest"),
        "indicator_recent": W.as_view(indicator(recent, hist, coords="history"),
                                      "indicator_recent"),
    })
    return models


def refresh_stations(spark: SparkSession, landed: str, paths: Paths, table: str | None = None) -> int:
    """Station refresh (G5): replace the dimension with the latest list.  With
    a catalog ``table`` readers of that name see the old or the new list, never
    a part of it; without one the folder is rewritten in place."""
    if table is not None:
        return V.replace(R.read_stations(spark, landed), table, f"{paths.stations}_versions")
    return W.overwrite(R.read_stations(spark, landed), paths.stations)
