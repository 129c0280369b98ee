"""Registered queries: each SURVEY operator run over the driver's test tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
fixture views of ``riverflow.fixtures`` (no sampling, no row caps; limits
only where the limit is the feature).  ``oracle.py`` holds the DuckDB SQL
that must give the same rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.functions import basename, file_tag, hist_landing_path, iso_utc, previous_day, year_of
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.operators import rolling
from riverflow.operators import serving as V
from riverflow.operators.indicator import bbox_filter, indicator
from riverflow.plans import pipelines as P
from riverflow.session import scratch_path, stage
from riverflow.streaming import live_stream as S
from riverflow.streaming.windows import pull_windows
from riverflow.sources import layout, pages, versions
from riverflow.sources import readers as R
from riverflow.sources import writers as W
from riverflow.sources.readers import decode_json_column, encode_json_column, merge_pages

# Parameters of the registered queries (shared with the oracle SQL).
STATION = "S7"
NOT_IN_TARGET_BEFORE = "2000-12-01"          # not_in_files / load_new_files target
INCREMENTAL_FIRST_RUN_BEFORE = "1998-01-01"  # flatten_incremental: files of the first run
BACKFILL_MARGIN_DAYS = 31
STATION_COLUMNS = ["code_station", "libelle_station", "libelle_commune", "code_departement",
                   "libelle_region"]
FIXED_CLOCK = _dt.datetime(2024, 2, 1, 12, 30, 45, 678000)
AVG_DIGITS = 6
# Incremental live refresh: rows landed before this instant form the first
# run, the rest the second.
LIVE_INCREMENT_CUT = _dt.datetime(2024, 1, 15)
# Watermarked streams: thirds of the month, and which events land late or again.
LATE_BEFORE, LAST_FROM = _dt.datetime(2024, 1, 11), _dt.datetime(2024, 1, 21)
LATE_EVERY = 40
AGAIN_WITHIN = _dt.timedelta(minutes=10)
BROKEN_EVERY = 13              # live_quarantine: events whose line is broken
PAGE_SIZE = 250                # records of a chained API page
LOST_PAGE_EVERY = 32           # page_chain_report: every 32nd page names one that never landed
ROLLING_AS_OF = [_dt.date(y, m, d) for y, m, d in
                 ((1994, 1, 1), (1995, 6, 30), (1996, 2, 29), (1997, 12, 31), (1999, 3, 17), (2000, 12, 31), (2002, 7, 1))]


def _hist(spark, sf):
    return H.hist_agg(fx.fx_hist_flat(spark, sf))


def _obs_dedup(spark, sf):
    return L.live_dedup(fx.fx_obs(spark, sf))


def _live_dedup(spark, sf):
    return L.live_dedup(fx.fx_live_raw(spark, sf))


def _ind_latest_obs(spark, sf):
    return indicator(L.latest(_obs_dedup(spark, sf)), _hist(spark, sf))


def _ind_latest_events(spark, sf):
    return indicator(L.latest(_live_dedup(spark, sf)), _hist(spark, sf))


def _recent_events(spark, sf):
    dedup = _live_dedup(spark, sf)
    return L.recent(dedup, as_of=L.as_of_max(dedup))


def _file_before(day: str):
    return F.col("json_file") < F.lit(f"obs_elab_QmJ_{day}.json")


# ------------------------------------------------------------------ queries ---

def q_indicator(spark, sf):
    """Flood indicator over all de-duplicated live readings."""
    return indicator(_obs_dedup(spark, sf), _hist(spark, sf))


def q_indicator_latest(spark, sf):
    """Indicator of the latest reading per station."""
    return _ind_latest_obs(spark, sf)


def q_indicator_recent(spark, sf):
    """Indicator of the last 24 hours, coordinates from history."""
    return indicator(_recent_events(spark, sf), _hist(spark, sf), coords="history")


def q_hist_agg(spark, sf):
    """Six quantiles and date window per station history, approximate."""
    return _hist(spark, sf)


def q_hist_agg_exact(spark, sf):
    """Same, exact discrete quantiles computed without a per-group task (A1, A2)."""
    return H.hist_agg(fx.fx_hist_flat(spark, sf), exact=True)


def q_live_dedup(spark, sf):
    """Exact-row de-duplication of overlapping pulls (A3, Q1, Q2)."""
    return _live_dedup(spark, sf)


def q_live_latest(spark, sf):
    """Latest row per (station, measure) with row_num."""
    return L.latest(_live_dedup(spark, sf))


def q_live_recent(spark, sf):
    """Last 24 hours, stations only, sorted."""
    dedup = _live_dedup(spark, sf)
    return L.recent(dedup, as_of=L.as_of_max(dedup), ordered=True)


def q_live_avg(spark, sf):
    """Monthly mean of the H measure, year ignored, rounded to 6 digits."""
    avg = L.live_avg(_obs_dedup(spark, sf), ordered=True)
    return avg.withColumn("avg_resultat_obs", F.round("avg_resultat_obs", AVG_DIGITS))


def q_not_in_files(spark, sf):
    """Null-aware NOT IN on day-files."""
    flat = fx.fx_hist_flat(spark, sf)
    target = flat.where(_file_before(NOT_IN_TARGET_BEFORE))
    return H.not_in_files(flat, target, strict=True)


def q_load_new_files(spark, sf):
    """Rows of day-files not loaded yet (K9)."""
    flat = fx.fx_hist_flat(spark, sf)
    target = flat.where(_file_before(NOT_IN_TARGET_BEFORE))
    return H.load_new_files(flat, target)


def q_loaded_files(spark, sf):
    """Distinct loaded day-files (A5)."""
    return H.loaded_files(fx.fx_hist_flat(spark, sf))


def q_file_row_counts(spark, sf):
    """Rows per day-file."""
    return H.file_row_counts(fx.fx_hist_flat(spark, sf))


def q_hist_flatten(spark, sf):
    """Unnest of day envelopes into flat rows."""
    return H.hist_flatten(fx.fx_hist_envelopes(spark, sf))


def q_flatten_incremental(spark, sf):
    """Two runs of the incremental model into a stored table: the first
    (table absent) loads the early day-files, the second appends only the
    day-files the table does not hold yet (K7, J3)."""
    table = _run_dir(spark, "flatten_incremental")
    raw = fx.fx_hist_envelopes(spark, sf)
    W.append(H.flatten_incremental(raw.where(_file_before(INCREMENTAL_FIRST_RUN_BEFORE)), None),
             table)
    W.append(H.flatten_incremental(raw, spark.read.parquet(table)), table)
    return spark.read.parquet(table)


def q_backfill_days(spark, sf):
    """Backfill calendar, from a month before the first loaded day to a month
    after the last, minus the day-files loaded (T1)."""
    loaded = fx.fx_hist_flat(spark, sf)
    first, last = loaded.agg(F.min("date_obs_elab"), F.max("date_obs_elab")).first()
    margin = _dt.timedelta(days=BACKFILL_MARGIN_DAYS)
    return H.backfill_days(spark, loaded, first - margin, last + margin)


def _loaded_history(spark, sf, name):
    """Day envelopes landed as JSON and loaded in two runs; the second finds
    the day-files of the first among the landed ones and skips them."""
    d = _run_dir(spark, name)
    paths = P.Paths(f"{d}/tables")
    early = F.coalesce(_file_before(INCREMENTAL_FIRST_RUN_BEFORE), F.lit(False))
    for part in (early, ~early):
        W.land_hist(fx.fx_hist_envelopes(spark, sf, files=part), f"{d}/landed")
        P.load_hist_files(spark, f"{d}/landed", paths)
    return paths


def q_land_load_hist(spark, sf):
    """Envelopes landed, loaded by new day-file and unnested."""
    paths = _loaded_history(spark, sf, "land_load_hist")
    return H.hist_flatten(spark.read.parquet(paths.raw_hist))


def q_hist_refresh(spark, sf):
    """Historical refresh of landed day-files, exact quantiles."""
    return P.run_historical(spark, _loaded_history(spark, sf, "hist_refresh"), method="exact")


def q_stations_refresh(spark, sf):
    """Station list landed as API responses, loaded and replaced."""
    d = _run_dir(spark, "stations_refresh")
    paths = P.Paths(f"{d}/tables")
    stations = fx.fx_stations(spark, sf)
    W.append(stations.select(F.array(F.struct(*stations.columns)).alias("data")), f"{d}/landed", fmt="json")
    P.refresh_stations(spark, f"{d}/landed", paths)
    return spark.read.parquet(paths.stations).select(*STATION_COLUMNS)


def q_json_encode(spark, sf):
    """Rows encoded as JSON text and decoded again."""
    ev = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    text = encode_json_column(ev, ev.columns).select("json")
    return decode_json_column(text, "json", ev.schema).select("json.*")


def q_file_tag(spark, sf):
    """Day-file name, landing path, basename and year."""
    days = fx.fx_hist_flat(spark, sf).select("date_obs_elab").distinct()
    path = hist_landing_path("date_obs_elab")
    return days.select(
        F.col("date_obs_elab").alias("day"),
        file_tag("date_obs_elab").alias("json_file"),
        path.alias("landing_path"),
        basename(path).alias("basename"),
        year_of("date_obs_elab").cast("bigint").alias("year"),
    )


def q_stamp_ingestion(spark, sf):
    """Ingestion stamp with an injected clock, whole seconds."""
    out = L.stamp_ingestion(fx.fx_live_base(spark, sf), now=FIXED_CLOCK)
    return out.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast(fx.NTZ))


def q_pull_windows(spark, sf):
    """Overlapping 10-minute pull windows every 5 minutes."""
    ev = fx.table(spark, sf, "events")
    w = pull_windows(ev, "ts")
    return w.select("window_start", "window_end",
                    iso_utc("window_start").alias("date_debut_obs"),
                    iso_utc("window_end").alias("date_fin_obs"), "n_obs")


def q_merge_pages(spark, sf):
    """Bag union of the records of all API pages."""
    return merge_pages(fx.fx_live_pages(spark, sf))


def _chained_pages(spark, sf):
    """API pages by address, each naming the next; every third one was landed
    once more under an old address, which no page names."""
    found = fx.fx_live_pages(spark, sf, PAGE_SIZE)
    last = found.select(F.max("page")).scalar()
    chain = found.select(F.concat(F.lit("p"), "page").alias("page"), "data",
                         F.when(F.col("page") < last, F.concat(F.lit("p"), F.col("page") + 1)).otherwise("").alias("next"),
                         (F.col("page") % 3 == 0).alias("again_"))
    old = chain.where("again_").withColumn("page", F.concat(F.lit("old"), F.substring("page", 2, 20)))
    return chain.unionByName(old).drop("again_")


def q_merge_pages_chain(spark, sf):
    """Landed pages followed from the first along their links (S5, Q17, G4):
    pages off the chain give no records."""
    d = _run_dir(spark, "merge_pages_chain")
    W.append(_chained_pages(spark, sf).withColumn("count", F.size("data").cast("bigint")), f"{d}/pages", fmt="json")
    return _as_ntz(R.read_page_chain(spark, f"{d}/pages", "p0").records.drop("position"))


def q_page_chain_report(spark, sf):
    """Position and status of every landed page where some pages are missing."""
    number = F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint")
    found = fx.table(spark, sf, "events").select(number.alias("no")).distinct()
    last = found.select(F.max("no")).scalar()
    name = F.concat(F.lit("p"), "no")
    link = (F.when(F.col("no") % LOST_PAGE_EVERY == LOST_PAGE_EVERY - 1, F.concat(F.lit("lost"), "no"))
            .when(F.col("no") < last, F.concat(F.lit("p"), F.col("no") + 1)))
    landed = found.select(name.alias("page"), link.alias("next"), F.array(F.struct("no")).alias("data"))
    return pages.follow(landed, "p0").report


def q_hist_agg_rolling(spark, sf):
    """Quantiles over moving windows of 730 days from stored sketches, kept by
    two refreshes (A1, A2)."""
    d = _run_dir(spark, "hist_agg_rolling")
    flat = fx.fx_hist_flat(spark, sf)
    rolling.refresh(spark, d, flat.where(_file_before(INCREMENTAL_FIRST_RUN_BEFORE)), load=1)
    rolling.refresh(spark, d, flat, load=2)
    return rolling.window_quantiles(spark, d, ROLLING_AS_OF)


def q_stations_versions(spark, sf):
    """Station list replaced twice as versions of a catalog table, read by its
    name (K2, K5, K6, G5, S6)."""
    d = _run_dir(spark, "stations_versions")
    paths, name = P.Paths(f"{d}/tables"), f"stations_{uuid.uuid4().hex}"
    stations = fx.fx_stations(spark, sf)
    lists = stations.select(F.array(F.struct(*stations.columns)).alias("data"), "code_station")
    W.append(lists.where(F.col("code_station") < "S5").drop("code_station"), f"{d}/first", fmt="json")
    W.append(lists.drop("code_station"), f"{d}/all", fmt="json")
    for landed in ("first", "all"):
        P.refresh_stations(spark, f"{d}/{landed}", paths, table=name)
    W.as_view(R.table(spark, name).select(*STATION_COLUMNS), f"{name}_view")
    return R.table(spark, f"{name}_view")


def q_station_history_lookup(spark, sf):
    """One station's history from a table stored along the station-day curve
    with Bloom filters (K8, F7, D2, J2)."""
    d = _run_dir(spark, "station_history_lookup")
    W.append(layout.along_curve(fx.fx_hist_flat(spark, sf)), f"{d}/flat", blooms={"code_station": P.STATIONS_PER_FILE})
    return V.station_history(spark.read.parquet(f"{d}/flat"), fx.fx_stations(spark, sf), STATION)


def q_json_roundtrip(spark, sf):
    """Embedded JSON decoded to typed columns."""
    ev = fx.table(spark, sf, "events").select("event_id", "props")
    dec = decode_json_column(ev, "props", "k bigint")
    return dec.select("event_id", F.col("props.k").alias("k"))


def q_bbox_filter(spark, sf):
    """Inclusive bounding box."""
    return bbox_filter(fx.fx_obs(spark, sf))


def q_station_history(spark, sf):
    """One station's history with commune and department."""
    return V.station_history(fx.fx_hist_flat(spark, sf), fx.fx_stations(spark, sf), STATION)


def q_station_live(spark, sf):
    """One station's recent series of measure Q."""
    return V.station_live(_recent_events(spark, sf), STATION)


def q_station_ymax(spark, sf):
    """Shared y-axis maximum of history and live."""
    return V.station_ymax(fx.fx_hist_flat(spark, sf), _recent_events(spark, sf), STATION)


def q_station_thresholds(spark, sf):
    """Current value and upper quantiles of one station."""
    return V.station_thresholds(_ind_latest_obs(spark, sf), STATION)


def q_map_stations(spark, sf):
    """Map markers: ratio, radius, colour position, newest first."""
    ind = _ind_latest_events(spark, sf)
    return V.map_stations(ind, as_of=L.as_of_max(ind))


def q_live_top20(spark, sf):
    """Newest 20 latest rows."""
    return V.live_top20(L.latest(_live_dedup(spark, sf)))


def q_live_top20_since(spark, sf):
    """Newest latest rows of the last day."""
    latest = L.latest(_live_dedup(spark, sf))
    return V.live_top20(latest, since=L.as_of_max(latest) - F.expr("INTERVAL 1 DAY"))


def q_daily_runs(spark, sf):
    """The day and landed file that a run on each observed day fetches."""
    days = fx.fx_hist_flat(spark, sf).select(F.col("date_obs_elab").alias("run_day")).where(
        "run_day is not null").distinct()
    fetched = previous_day("run_day")
    return days.select("run_day", fetched.alias("fetched_day"), hist_landing_path(fetched).alias("landing_path"))


# ---------------------------------------------------- streaming, as batch ---
# The events table is read as a file stream, processed to the end with
# ``availableNow`` into a table under the checkpoint folder, and read back.
# Watermarks need TIMESTAMP, so wall-clock columns are read as UTC instants
# on the way in and turned back into TIMESTAMP_NTZ on the way out.

def _as_ltz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(T.TimestampType()).alias(f.name)
                       if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields])


def _as_ntz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, f"registered/{name}-{uuid.uuid4().hex}")


# The landed files of a stream are taken in this many micro-batches or more.
MICRO_BATCHES = 4


def _split_events(spark, sf, folder):
    """``events`` landed anew in shuffled order over several files, as a stream
    of several micro-batches: late and repeated rows cross their borders."""
    ev = fx.table(spark, sf, "events")
    files = max(MICRO_BATCHES, spark.sparkContext.defaultParallelism)
    ev.repartition(files, F.xxhash64("event_id")).write.parquet(folder)
    return (spark.readStream.schema(ev.schema)
            .option("maxFilesPerTrigger", max(1, files // MICRO_BATCHES)).parquet(folder))


def _split_live_raw(spark, sf, folder):
    return _as_ltz(fx.live_raw_from(_split_events(spark, sf, folder)))


def _finished(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def _live_raw_stream(spark, sf):
    return _as_ltz(fx.live_raw_from(fx.stream_table(spark, sf, "events")))


def q_stream_dedup(spark, sf):
    """Stream de-duplication over several micro-batches in any order."""
    d = _run_dir(spark, "stream_dedup")
    _finished(S.dedup_to_table(_split_live_raw(spark, sf, f"{d}/landed"), f"{d}/out",
                               name=f"stream_dedup_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt"))
    return _as_ntz(spark.read.parquet(f"{d}/out").select(*schemas.LIVE_DEDUP_COLUMNS))


def q_stream_dedup_exact(spark, sf):
    """Exact incremental stream de-duplication into a table."""
    d = _run_dir(spark, "stream_dedup_exact")
    q = S.dedup_to_table(_live_raw_stream(spark, sf), f"{d}/out",
                         name=f"stream_dedup_exact_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return _as_ntz(spark.read.parquet(f"{d}/out").select(*schemas.LIVE_DEDUP_COLUMNS))


def q_stream_latest(spark, sf):
    """Latest row per key kept in stream state (T4)."""
    d = _run_dir(spark, "stream_latest")
    out = S.run_to_table(S.stream_latest(_live_raw_stream(spark, sf)), f"{d}/out",
                         f"stream_latest_{uuid.uuid4().hex}", mode="complete",
                         checkpoint=f"{d}/ckpt")
    return _as_ntz(out)


def q_stream_latest_log(spark, sf):
    """Latest row per key as a log of changes over several micro-batches, folded
    once on the way and once at the read (T4)."""
    d = _run_dir(spark, "stream_latest_log")
    _finished(S.latest_to_table(_split_live_raw(spark, sf, f"{d}/landed"), f"{d}/out",
                                name=f"stream_latest_log_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt", merge_every=3))
    return _as_ntz(S.stored_latest(spark, f"{d}/out"))


def q_stream_indicator_compacted(spark, sf):
    """Stream-static indicator whose small files are merged on the way."""
    d = _run_dir(spark, "stream_indicator_compacted")
    hist = W.materialize(_hist(spark, sf), f"{d}/hist_agg")
    _finished(S.indicator_to_table(_split_live_raw(spark, sf, f"{d}/landed"), hist, f"{d}/out", compact_every=3,
                                   name=f"stream_indicator_compacted_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt"))
    return _as_ntz(S.read_indicator_store(spark, f"{d}/out"))


def q_live_quarantine(spark, sf):
    """Landed NDJSON with a broken line for every 13th event, parsed once into
    records and quarantined lines (S2, S3, S7, K4, K10).  The counts observed per
    micro-batch come with the lines."""
    d = _run_dir(spark, "live_quarantine")
    ev = fx.table(spark, sf, "events")
    records = stage(_as_ltz(fx.live_mapped(ev)), "records")
    record = F.to_json(F.struct(*schemas.LIVE_DEDUP_COLUMNS), {"timestampFormat": W.TEXT_TIMESTAMP_FORMAT})
    line = F.when(F.col("event_id") % BROKEN_EVERY == 0, F.concat(F.lit("broken "), "event_id")).otherwise(record)
    files = max(MICRO_BATCHES, spark.sparkContext.defaultParallelism)
    records.select(line.alias("value"), "event_id").repartition(files, "event_id").select("value").write.text(f"{d}/landed")
    _finished(S.ingest_lines(spark, f"{d}/landed", f"{d}/raw", f"{d}/dead", f"{d}/counts", name=f"live_quarantine_{uuid.uuid4().hex}",
                             checkpoint=f"{d}/ckpt", max_files_per_trigger=max(1, files // MICRO_BATCHES)))
    counts = spark.read.parquet(f"{d}/counts").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))
    good = _as_ntz(R.read_live_table(spark, f"{d}/raw")).select(
        F.lit("record").alias("kind"), F.lit(None).cast("string").alias("line"), "code_station", "date_obs", "resultat_obs",
        *[F.lit(None).cast("bigint").alias(c) for c in ("n_rows", "n_bad")])
    empty = [F.lit(None).cast(good.schema[c].dataType).alias(c) for c in ("code_station", "date_obs", "resultat_obs")]
    no_counts = [F.lit(None).cast("bigint").alias(c) for c in ("n_rows", "n_bad")]
    bad = spark.read.parquet(f"{d}/dead").select(F.lit("line").alias("kind"), "line", *empty, *no_counts)
    total = counts.select(F.lit("counts").alias("kind"), F.lit(None).cast("string").alias("line"), *empty, "n_rows", "n_bad")
    return good.unionByName(bad).unionByName(total)


def q_stream_indicator(spark, sf):
    """Stream-static indicator join over several micro-batches (T5)."""
    d = _run_dir(spark, "stream_indicator")
    hist = W.materialize(_hist(spark, sf), f"{d}/hist_agg")
    _finished(S.indicator_to_table(_split_live_raw(spark, sf, f"{d}/landed"), hist, f"{d}/out",
                                   name=f"stream_indicator_{uuid.uuid4().hex}",
                                   checkpoint=f"{d}/ckpt"))
    return _as_ntz(S.read_indicator_store(spark, f"{d}/out"))


def _watermarked(spark, sf, name, build):
    """The stored result of a watermarked stream that is run three times, from
    one checkpoint, as its events land by thirds of the month: some of the first
    third land with the last one, ten days behind the watermark; others, and the
    last minutes of the second third, land a second time."""
    d = _run_dir(spark, name)
    ev = fx.table(spark, sf, "events")
    first, last = (F.col("ts") < F.lit(LATE_BEFORE).cast("timestamp_ntz"), F.col("ts") >= F.lit(LAST_FROM).cast("timestamp_ntz"))
    late = first & (F.col("event_id") % LATE_EVERY == 0)
    again = (first & (F.col("event_id") % LATE_EVERY == 1)) | (
        ~last & (F.col("ts") >= F.lit(LAST_FROM - AGAIN_WITHIN).cast("timestamp_ntz")))
    for part in (first & ~late, ~first & ~last, last | late | again):
        ev.where(part).write.mode("append").parquet(f"{d}/landed")
        stream = _as_ltz(fx.live_raw_from(spark.readStream.schema(ev.schema).parquet(f"{d}/landed")))
        out = S.run_to_table(build(stream), f"{d}/out", f"{name}_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt")
    return _as_ntz(out)


def q_stream_dedup_watermark(spark, sf):
    """De-duplication in state within the watermark; late rows are left out."""
    return _watermarked(spark, sf, "stream_dedup_watermark", S.stream_dedup)


def q_stream_indicator_watermark(spark, sf):
    """Stream-static indicator within the watermark; late rows are left out."""
    hist = W.materialize(_hist(spark, sf), f"{_run_dir(spark, 'stream_indicator_watermark_hist')}/hist_agg")
    return _watermarked(spark, sf, "stream_indicator_watermark", lambda stream: S.stream_indicator(stream, hist))


def q_stream_pull_windows(spark, sf):
    """Pull windows of a stream, all of them, over several micro-batches."""
    d = _run_dir(spark, "stream_pull_windows")
    ev = _as_ltz(_split_events(spark, sf, f"{d}/landed"))
    _finished(S.windows_to_table(ev, f"{d}/out", "ts", name=f"stream_pull_windows_{uuid.uuid4().hex}",
                                 checkpoint=f"{d}/ckpt"))
    out = _as_ntz(S.stored_windows(spark, f"{d}/out"))
    return out.select("window_start", "window_end",
                      iso_utc("window_start").alias("date_debut_obs"),
                      iso_utc("window_end").alias("date_fin_obs"), "n_obs")


# ------------------------------------------------- incremental refresh ---

def _incremental_live(spark, sf, name):
    """Two incremental live refreshes into tables under the checkpoint
    folder: rows landed before LIVE_INCREMENT_CUT, then the rest."""
    d = _run_dir(spark, name)
    paths = P.Paths(f"{d}/tables")  # no stored history: only the live tables
    raw = _as_ltz(fx.fx_live_raw(spark, sf))
    cut = F.col("ingestion_timestamp") < F.lit(LIVE_INCREMENT_CUT)
    # the later run has the smaller id: batches may commit in any order
    P.run_live_incremental(spark, paths, raw.where(cut), run_id=2)
    return P.run_live_incremental(spark, paths, raw.where(~cut), run_id=1)


def q_live_dedup_incremental(spark, sf):
    """De-duplication kept by two incremental refreshes (A3, G2 incremental)."""
    return _as_ntz(_incremental_live(spark, sf, "live_dedup_incremental")["live_dedup"])


def q_live_latest_incremental(spark, sf):
    """Latest rows kept by two incremental refreshes (W1, G2 incremental)."""
    return _as_ntz(_incremental_live(spark, sf, "live_latest_incremental")["live_latest"])


def q_live_avg_incremental(spark, sf):
    """Monthly averages kept by two incremental refreshes (A4, G2 incremental)."""
    avg = _incremental_live(spark, sf, "live_avg_incremental")["live_avg"]
    return avg.withColumn("avg_resultat_obs", F.round("avg_resultat_obs", AVG_DIGITS))


def q_live_shared_load(spark, sf):
    """One raw table loaded by a stream and by landed API pages, then the full
    refresh (S2, S5, K4, G2, G4): the stream brings the observations before
    LIVE_INCREMENT_CUT, the pages the rest."""
    d = _run_dir(spark, "live_shared_load")
    paths = P.Paths(f"{d}/tables")
    early = F.coalesce(F.col("date_obs") < F.lit(LIVE_INCREMENT_CUT), F.lit(False))
    _finished(S.ingest(_split_live_raw(spark, sf, f"{d}/landed").where(early), paths.raw_live,
                       name=f"live_shared_load_{uuid.uuid4().hex}", checkpoint=f"{d}/ckpt"))
    pages = fx.fx_live_pages(spark, sf).withColumn("data", F.filter(
        "data", lambda r: ~F.coalesce(r["date_obs"] < F.lit(LIVE_INCREMENT_CUT), F.lit(False))))
    W.append(pages, f"{d}/pages", fmt="json")
    P.ingest_live(spark, f"{d}/pages", paths)
    W.materialize(_hist(spark, sf), paths.hist_agg)
    return _as_ntz(P.run_live(spark, paths)["live_dedup"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "indicator": q_indicator,
    "indicator_latest": q_indicator_latest,
    "indicator_recent": q_indicator_recent,
    "hist_agg": q_hist_agg,
    "hist_agg_exact": q_hist_agg_exact,
    "live_dedup": q_live_dedup,
    "live_latest": q_live_latest,
    "live_recent": q_live_recent,
    "live_avg": q_live_avg,
    "not_in_files": q_not_in_files,
    "load_new_files": q_load_new_files,
    "loaded_files": q_loaded_files,
    "file_row_counts": q_file_row_counts,
    "hist_flatten": q_hist_flatten,
    "flatten_incremental": q_flatten_incremental,
    "backfill_days": q_backfill_days,
    "file_tag": q_file_tag,
    "stamp_ingestion": q_stamp_ingestion,
    "pull_windows": q_pull_windows,
    "merge_pages": q_merge_pages,
    "json_roundtrip": q_json_roundtrip,
    "bbox_filter": q_bbox_filter,
    "station_history": q_station_history,
    "station_live": q_station_live,
    "station_ymax": q_station_ymax,
    "station_thresholds": q_station_thresholds,
    "map_stations": q_map_stations,
    "live_top20": q_live_top20,
    "live_top20_since": q_live_top20_since,
    "daily_runs": q_daily_runs,
    "live_dedup_incremental": q_live_dedup_incremental,
    "live_latest_incremental": q_live_latest_incremental,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_exact": q_stream_dedup_exact,
    "stream_latest": q_stream_latest,
    "stream_indicator": q_stream_indicator,
    "stream_pull_windows": q_stream_pull_windows,
    "stream_dedup_watermark": q_stream_dedup_watermark,
    "stream_indicator_watermark": q_stream_indicator_watermark,
    "land_load_hist": q_land_load_hist,
    "hist_refresh": q_hist_refresh,
    "stations_refresh": q_stations_refresh,
    "json_encode": q_json_encode,
    "live_avg_incremental": q_live_avg_incremental,
    "live_shared_load": q_live_shared_load,
    "stream_latest_log": q_stream_latest_log,
    "stream_indicator_compacted": q_stream_indicator_compacted,
    "live_quarantine": q_live_quarantine,
    "merge_pages_chain": q_merge_pages_chain,
    "page_chain_report": q_page_chain_report,
    "hist_agg_rolling": q_hist_agg_rolling,
    "stations_versions": q_stations_versions,
    "station_history_lookup": q_station_history_lookup,
}
