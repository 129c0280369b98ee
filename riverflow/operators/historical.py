"""Historical (daily elaborated) data: flatten the day envelopes, load only
new day-files, and summarize each station's history as six quantiles."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.functions import file_tag, quantile_at
from riverflow.operators.joins import checked_broadcast
from riverflow.session import stage

HIST_KEYS = ["code_station", "latitude", "longitude", "grandeur_hydro_elab"]
# Broadcast the list of loaded day-files up to this many names (about 60 bytes
# each, 30 MB); a measure has one per day.
FILES_BROADCAST_MAX_ROWS = 500_000


# ---------------------------------------------------------------- flatten ---

def hist_flatten(raw: DataFrame) -> DataFrame:
    """One row per record of each envelope.

    ``inline`` is the inner lateral unnest: an envelope whose ``data`` is
    empty or NULL yields no row.  ``date_prod`` is dropped.
    """
    return (raw.select("prev", "json_file", F.inline("data"))
            .select(*schemas.HIST_FLAT_COLUMNS))


def loaded_files(target: DataFrame) -> DataFrame:
    """Distinct day-files present in a table (A5)."""
    return target.select("json_file").distinct()


def not_in_files(src: DataFrame, target: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of ``src`` whose ``json_file`` is NOT IN the target's files.

    ``strict`` keeps SQL's null-aware meaning: a NULL file in the target
    blocks every row, a NULL file in the source never passes, and an empty
    target passes everything.  The distinct file list is stored once (one
    column of the target is read) and broadcast after counting it, so the source
    is not shuffled; the existence tests are scalar subqueries on that list.
    Without ``strict`` only the anti join on non-NULL files is applied.
    """
    files = stage(loaded_files(target), "files")
    named = checked_broadcast(files.where(F.col("json_file").isNotNull()), FILES_BROADCAST_MAX_ROWS)
    kept = src.join(named, on="json_file", how="left_anti").select(*src.columns)
    if not strict:
        return kept.where(F.col("json_file").isNotNull())
    target_empty = ~files.select("json_file").exists()
    target_has_null = files.where(F.col("json_file").isNull()).select("json_file").exists()
    return kept.where(target_empty | (F.col("json_file").isNotNull() & ~target_has_null))


def load_new_files(df: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose day-file is not loaded yet (K9): the per-file lookup of
    the loader done for a whole batch as one anti join on ``json_file``
    against the stored, counted file list; ``df`` is not shuffled."""
    files = checked_broadcast(stage(loaded_files(target), "files"), FILES_BROADCAST_MAX_ROWS)
    return df.join(files, on="json_file", how="left_anti").select(*df.columns)


def flatten_incremental(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Flat rows to append (K7): all of them on the first run (no target),
    afterwards only those of day-files the target does not hold yet.

    The file test runs on envelopes, before the unnest, so a skipped file is
    never exploded.
    """
    if target is None:
        return hist_flatten(raw)
    return hist_flatten(not_in_files(raw, target, strict=True))


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per day-file."""
    return df.groupBy("json_file").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- backfill ---

def calendar(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """One row per day in [start, end], generated distributed by ``range``."""
    n = (end - start).days + 1
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def backfill_days(spark: SparkSession, loaded: DataFrame, start: _dt.date, end: _dt.date,
                  param: str = "QmJ") -> DataFrame:
    """Days of the backfill span whose day-file is not loaded yet.

    ``loaded`` is any frame with a ``json_file`` column (raw or flat table).
    """
    days = calendar(spark, start, end).withColumn("json_file", file_tag(F.col("day"), param))
    return days.join(loaded_files(loaded), on="json_file", how="left_anti").select("day", "json_file")


def backfill_span(run_day: _dt.date, days: int = 730) -> tuple[_dt.date, _dt.date]:
    """The scheduled span: a run on day D fetches D-1; the schedule starts
    ``days`` days before today."""
    return run_day - _dt.timedelta(days=days + 1), run_day - _dt.timedelta(days=1)


# ------------------------------------------------------------- aggregation ---

def positive_measure(df: DataFrame, measure: str = "QmJ") -> DataFrame:
    """Daily mean flow only, strictly positive values only (F1)."""
    return df.where((F.col("grandeur_hydro_elab") == F.lit(measure))
                    & (F.col("resultat_obs_elab") > 0))


def hist_agg(flat: DataFrame, exact: bool = False, accuracy: int = 10000,
             measure: str = "QmJ", checkpoint: bool = True) -> DataFrame:
    """Six quantiles and the date window per (station, lat, lon, measure) (A1, A2).

    Default: one ``percentile_approx`` over an array of the six fractions, a
    mergeable sketch with map-side partial aggregation, so a station holding
    a third of all rows costs one bounded sketch per task.  Its rank error is
    at most n / accuracy (exact while a group has fewer rows than accuracy).

    ``exact=True``: the discrete quantile (smallest value whose cumulative
    count reaches ceil(f * n)) computed by ``exact_quantiles``, which never
    gathers a group's values in one task.
    """
    src = positive_measure(flat, measure)
    dates = [F.min("date_obs_elab").alias("minimum_date_window"),
             F.max("date_obs_elab").alias("maximum_date_window")]
    qcols = schemas.QUANTILE_COLUMNS
    if not exact:
        q = F.percentile_approx("resultat_obs_elab", schemas.QUANTILE_FRACTIONS, accuracy)
        agg = src.groupBy(*HIST_KEYS).agg(q.alias("_q"), *dates)
        return agg.select(*HIST_KEYS, *[quantile_at("_q", i).alias(c) for i, c in enumerate(qcols)],
                          "minimum_date_window", "maximum_date_window")
    # The date window rides along the per-value counts (every row has a
    # positive value here), so no second aggregate and join are needed.
    quant = exact_quantiles(src, HIST_KEYS, "resultat_obs_elab",
                            [int(round(f * 1000)) for f in schemas.QUANTILE_FRACTIONS], qcols,
                            checkpoint=checkpoint,
                            carry=[("min", "date_obs_elab", "minimum_date_window"),
                                   ("max", "date_obs_elab", "maximum_date_window")])
    return quant.select(*HIST_KEYS, *qcols, "minimum_date_window", "maximum_date_window")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, permille: list[int],
                    names: list[str], partitions: int | None = None,
                    checkpoint: bool = True,
                    carry: list[tuple[str, str, str]] = ()) -> DataFrame:
    """Exact discrete quantiles per group without a per-group task.

    1. Count each distinct (group, value): map-side combined, hashed on the
       value too, so a hot group spreads over all tasks.
    2. Range-partition those counts by (group, value) and stamp the partition
       id; a hot group becomes several value ranges.  The stamped table is
       written once under the checkpoint folder (``stage``) so the ids are
       data and survive a lost executor.
    3. Running count inside each (partition, group) slice (bounded by one
       range partition), plus the total of every earlier slice of the group
       from a small (slice -> total) table.
    4. The value whose cumulative count first reaches ceil(n * p / 1000) is
       picked by a grouped ``max`` over the rows that straddle that rank.
    ``carry`` adds per-group ``min``/``max`` of other columns, given as
    (function, column, output name), computed along the same aggregates.
    Rows with a NULL value are left out.
    """
    spark = df.sparkSession
    v = F.col(value)
    fns = {"min": F.min, "max": F.max}
    carried = [f"_carry{i}" for i in range(len(carry))]
    counts = df.where(v.isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c"),
        *[fns[fn](col).alias(c) for (fn, col, _), c in zip(carry, carried)])
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (counts.repartitionByRange(n_parts, *keys, value)
              .withColumn("_pid", F.spark_partition_id()))
    if checkpoint:
        ranged = stage(ranged, "exact_quantiles")

    slice_keys = ["_pid"] + keys
    in_slice = Window.partitionBy(*slice_keys).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_cum_local", F.sum("_c").over(in_slice))

    totals = ranged.groupBy(*slice_keys).agg(F.sum("_c").alias("_slice_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *slice_keys,
        F.coalesce(F.sum("_slice_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_slice_n").over(whole).alias("_n"),
    )
    cond = [local[k].eqNullSafe(offsets[k]) for k in slice_keys]
    ranked = local.join(offsets, on=cond, how="inner").select(
        *[local[k] for k in keys], local[value], local["_c"], *[local[c] for c in carried],
        (local["_cum_local"] + offsets["_offset"]).alias("_cum"), offsets["_n"])

    picks = []
    for p, name in zip(permille, names):
        rank = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(p) / F.lit(1000)))
        hit = ((F.col("_cum") - F.col("_c")) < rank) & (rank <= F.col("_cum"))
        picks.append(F.max(F.when(hit, v)).alias(name))
    picks += [fns[fn](c).alias(out) for (fn, _, out), c in zip(carry, carried)]
    return ranked.groupBy(*keys).agg(*picks)


# KLL sketch size: normalized rank error about 1.65 / k (k = 2000: ~0.08%).
KLL_K = 2000


def hist_sketches(flat: DataFrame, k: int = KLL_K, measure: str = "QmJ") -> DataFrame:
    """One mergeable KLL sketch per (group, day-file), with its date range.

    Sketches of different day-files merge, so a daily refresh only sketches
    the new day-files and merges the stored ones (``hist_agg_from_sketches``).
    """
    src = positive_measure(flat, measure)
    return src.groupBy(*HIST_KEYS, "json_file").agg(
        F.kll_sketch_agg_double("resultat_obs_elab", k).alias("sketch"),
        F.min("date_obs_elab").alias("min_date"), F.max("date_obs_elab").alias("max_date"))


def hist_agg_from_sketches(sketches: DataFrame, k: int = KLL_K) -> DataFrame:
    """``hist_agg`` rows from per-file sketches: merge per group (a partial
    aggregate, each task merging its own sketches first), then read the six
    fractions."""
    merged = sketches.groupBy(*HIST_KEYS).agg(
        F.kll_merge_agg_double("sketch", k).alias("_sk"),
        F.min("min_date").alias("minimum_date_window"),
        F.max("max_date").alias("maximum_date_window"))
    return merged.select(
        *HIST_KEYS,
        *[F.kll_sketch_get_quantile_double("_sk", F.lit(f)).alias(c)
          for f, c in zip(schemas.QUANTILE_FRACTIONS, schemas.QUANTILE_COLUMNS)],
        "minimum_date_window", "maximum_date_window")


def kll_hist_agg(flat: DataFrame, k: int = KLL_K, measure: str = "QmJ") -> DataFrame:
    """Approximate ``hist_agg`` through per-file KLL sketches."""
    return hist_agg_from_sketches(hist_sketches(flat, k, measure), k)
