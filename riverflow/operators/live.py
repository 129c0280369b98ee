"""Live observations: stamp, de-duplicate the overlapping pulls, and derive
the latest value, the recent window and the monthly averages."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.functions import horizon, month_of

LATEST_KEYS = ["code_station", "grandeur_hydro"]


def stamp_ingestion(df: DataFrame, now: Column | _dt.datetime | None = None) -> DataFrame:
    """Add ``ingestion_timestamp``: the load instant, UTC, whole seconds.

    ``now`` makes the clock injectable; by default the statement clock, which
    Spark fixes once per query.
    """
    clock = F.current_timestamp() if now is None else (
        F.lit(now) if not isinstance(now, Column) else now)
    return df.withColumn("ingestion_timestamp", F.date_trunc("second", clock).cast(schemas.TS))


def live_dedup(raw: DataFrame) -> DataFrame:
    """Exact-row de-duplication over the 16 landed columns (A3).

    The ingestion stamp is left out, so the same observation pulled by two
    overlapping windows collapses; a revised value at the same time differs
    in ``resultat_obs`` and survives as a second row.  Planned as a partial
    (map-side) plus final hash aggregate on all 16 columns.
    """
    return raw.select(*schemas.LIVE_DEDUP_COLUMNS).distinct()


# Partition column of the stored live tables: the UTC day of the observation.
OBS_DAY = "obs_day"


def with_obs_day(df: DataFrame) -> DataFrame:
    """Add the storage partition column (day of ``date_obs``, UTC)."""
    return df.withColumn(OBS_DAY, F.to_date("date_obs"))


def from_day(stored: DataFrame, since: Column | _dt.datetime | _dt.date | None,
             keep_null: bool = False) -> DataFrame:
    """Restrict a table stored by ``obs_day`` to the days that can hold
    observations at or after ``since``: a partition filter, so older days
    are never listed or read.  ``keep_null`` keeps the NULL-time partition."""
    if since is None or OBS_DAY not in stored.columns:
        return stored
    lit = since if isinstance(since, Column) else F.lit(since)
    cond = F.col(OBS_DAY) >= F.to_date(lit)
    return stored.where(cond | F.col(OBS_DAY).isNull() if keep_null else cond)


def batch_days(new_raw: DataFrame) -> list[_dt.date | None]:
    """The days that a batch observes (a few; None for rows without a time)."""
    return [r[0] for r in new_raw.select(F.to_date("date_obs")).distinct().toLocalIterator()]


def on_days(stored: DataFrame, days: list[_dt.date | None]) -> DataFrame:
    """Restrict a table stored by ``obs_day`` to those days: a partition
    filter, so one late row reads its own day and no later ones."""
    if OBS_DAY not in stored.columns:
        return stored
    cond = F.col(OBS_DAY).isin([F.lit(d) for d in days if d is not None])
    return stored.where(cond | F.col(OBS_DAY).isNull() if None in days else cond)


def live_dedup_increment(new_raw: DataFrame, existing: DataFrame | None,
                         since: _dt.datetime | None = None,
                         days: list[_dt.date | None] | None = None) -> DataFrame:
    """Rows of ``new_raw`` to append to a stored ``live_dedup`` table.

    The new rows are de-duplicated first (partial + final aggregate, so even
    a group of identical copies holding a third of the batch collapses
    map-side), then anti-joined on all 16 columns with NULL-safe equality
    (GROUP BY treats NULLs as equal) against the stored rows.  Only stored
    rows that can match are read: those at or after the batch's earliest
    ``date_obs``, plus those without one.  When the caller passes that
    earliest time as ``since`` and the table is stored by ``obs_day``, the
    restriction is also a partition filter; with the batch's ``days``
    (``batch_days``) only those days are read.  Appending the result keeps the
    table equal to ``live_dedup`` over all raw rows, and re-running a batch
    appends nothing.
    """
    new = live_dedup(new_raw)
    if existing is None:
        return new
    if days is not None:
        cand = on_days(existing, days).select(*schemas.LIVE_DEDUP_COLUMNS)
    else:
        first = new.select(F.min("date_obs")).scalar()
        cand = (from_day(existing, since, keep_null=True)
                .select(*schemas.LIVE_DEDUP_COLUMNS)
                .where((F.col("date_obs") >= first) | F.col("date_obs").isNull()))
    cond = [new[c].eqNullSafe(cand[c]) for c in schemas.LIVE_DEDUP_COLUMNS]
    return new.join(cand, on=cond, how="left_anti")


# Hash of the 16 columns, stored with a Parquet Bloom filter.
ROW_HASH = "row_hash"
# A batch of at most this many rows names their hashes to the scan, which then
# skips row groups by Bloom filter; a larger one would hit most of them.
MAX_PROBES = 200


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, F.xxhash64(*schemas.LIVE_DEDUP_COLUMNS))


def unseen_rows(new: DataFrame, stored: DataFrame | None, max_probes: int = MAX_PROBES) -> DataFrame:
    """Rows of ``new`` (de-duplicated, staged, with OBS_DAY and ROW_HASH) that
    ``stored`` does not hold.  Only the days of ``new`` are read; of a stored
    table with ROW_HASH a small batch reads only the row groups whose Bloom
    filter may hold one of its rows."""
    if stored is None:
        return new
    days = [r[0] for r in new.select(OBS_DAY).distinct().toLocalIterator()]
    seen = on_days(stored, days)
    hashed = ROW_HASH in stored.columns
    if hashed:
        probes = [r[0] for r in new.select(ROW_HASH).limit(max_probes + 1).collect()]
        if len(probes) <= max_probes:
            seen = seen.where(F.col(ROW_HASH).isin(probes))
    cond = [new[c].eqNullSafe(seen[c]) for c in schemas.LIVE_DEDUP_COLUMNS]
    if hashed:
        cond.insert(0, new[ROW_HASH] == seen[ROW_HASH])
    return new.join(seen, on=cond, how="left_anti")


def by_measure(df: DataFrame, measure: str, col: str = "grandeur_hydro") -> DataFrame:
    """Keep one measure."""
    return df.where(F.col(col) == F.lit(measure))


def latest_order(columns: list[str] | None = None) -> list[Column]:
    """Total order of the latest pick: newest ``date_obs`` first, then the
    highest ``resultat_obs`` (a revision at the same instant), then every
    other de-dup column, all descending with NULLs last.  Since de-duplicated
    rows differ in at least one of these columns the pick is deterministic."""
    cols = columns or schemas.LIVE_DEDUP_COLUMNS
    first = ["date_obs", "resultat_obs"]
    rest = [c for c in cols if c not in first and c not in LATEST_KEYS]
    return [F.col(c).desc_nulls_last() for c in first + rest]


def latest(dedup: DataFrame) -> DataFrame:
    """Latest row per (station, measure) with ``row_num`` = 1.

    ``row_number() = 1`` is planned as a WindowGroupLimit: each task keeps one
    row per key before the shuffle, so a station with a third of all rows
    sends one row per task, not its whole history.  NULL station or measure
    rows form one group, as in SQL.
    """
    w = Window.partitionBy(*LATEST_KEYS).orderBy(*latest_order(dedup.columns))
    ranked = dedup.withColumn("row_num", F.row_number().over(w))
    return ranked.where(F.col("row_num") == 1).withColumn("row_num", F.col("row_num").cast("bigint"))


def as_of_max(df: DataFrame, col: str = "date_obs") -> Column:
    """The newest observation time of ``df`` as a scalar subquery column."""
    return df.select(F.max(col)).scalar()


def recent(dedup: DataFrame, as_of: Column | _dt.datetime | None = None, hours: int = 24,
           ordered: bool = False) -> DataFrame:
    """Observations of the last ``hours`` before ``as_of``.

    Inclusive lower bound; rows without a station are dropped.  ``as_of``
    defaults to the statement clock.  ``ordered`` adds the view's sort by
    station and time (O2), which costs a range shuffle and only makes sense
    at the very end of a plan.
    """
    if as_of is None:
        clock = F.current_timestamp()
    else:
        clock = as_of if isinstance(as_of, Column) else F.lit(as_of)
    out = (dedup.where((F.col("date_obs") >= horizon(clock, hours))
                       & F.col("code_station").isNotNull())
           .select("code_station", "grandeur_hydro", "date_obs", "resultat_obs"))
    return out.orderBy("code_station", "date_obs") if ordered else out


AVG_KEYS = ["code_station", "month"]


def live_avg_parts(dedup: DataFrame, measure: str = "H") -> DataFrame:
    """Mergeable form of ``live_avg``: per (station, month) the sum and the
    count of non-NULL values.  Parts of disjoint row sets add up."""
    return (by_measure(dedup, measure)
            .groupBy("code_station", month_of("date_obs").alias("month"))
            .agg(F.sum("resultat_obs").alias("sum_resultat_obs"),
                 F.count("resultat_obs").alias("n_resultat_obs")))


def merge_avg_parts(*parts: DataFrame) -> DataFrame:
    """Add up avg parts of disjoint row sets."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*AVG_KEYS).agg(F.sum("sum_resultat_obs").alias("sum_resultat_obs"),
                                      F.sum("n_resultat_obs").alias("n_resultat_obs"))


def avg_from_parts(parts: DataFrame) -> DataFrame:
    """``live_avg`` rows from parts (NULL where a group has no value)."""
    return parts.select(*AVG_KEYS, F.try_divide(F.col("sum_resultat_obs"),
                                                F.col("n_resultat_obs")).alias("avg_resultat_obs"))


def live_avg(dedup: DataFrame, measure: str = "H", ordered: bool = False) -> DataFrame:
    """Mean value per station and month number, one measure.

    The month ignores the year, so January of two years share one row.
    """
    out = (by_measure(dedup, measure)
           .groupBy("code_station", month_of("date_obs").alias("month"))
           .agg(F.avg("resultat_obs").alias("avg_resultat_obs")))
    return out.orderBy("code_station", "month") if ordered else out
