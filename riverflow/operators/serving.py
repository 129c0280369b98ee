"""Dashboard reads as DataFrame operators.

Each returns a bounded result (one row per station, or one station's
series); station codes are bound as literals, never spliced into SQL text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverflow.functions import horizon, map_ratio, marker_radius, severity
from riverflow.sources.layout import of_station

# Quantiles the map may scale by; the default is the 99% one.
MAP_QUANTILES = ("quantile_999", "quantile_990", "quantile_900")
DEFAULT_MAP_QUANTILE = "quantile_990"


def by_station(df: DataFrame, code: str, measure: str | None = None,
               measure_col: str = "grandeur_hydro") -> DataFrame:
    """Point lookup on one station, optionally one measure (F7).  On a table
    stored along the station-day curve it opens a small share of the files."""
    out = of_station(df, code)
    return out if measure is None else out.where(F.col(measure_col) == F.lit(measure))


def positive_ratio(df: DataFrame, col: str = "map_ratio") -> DataFrame:
    """Keep markers with a positive ratio; NULL ratios drop too (F8)."""
    return df.where(F.col(col) > 0)


def map_stations(ind_latest: DataFrame, quantile: str = DEFAULT_MAP_QUANTILE,
                 as_of: Column | _dt.datetime | None = None, hours: int = 24,
                 ordered: bool = True) -> DataFrame:
    """Stations for the map (D1): latest indicator rows of the last ``hours``,
    the value over the chosen quantile clipped to [0, 5] (``map_ratio``),
    the marker radius and the colour position (``severity``), newest first."""
    if quantile not in MAP_QUANTILES:
        raise ValueError(f"quantile must be one of {MAP_QUANTILES}")
    clock = (F.current_timestamp() if as_of is None
             else as_of if isinstance(as_of, Column) else F.lit(as_of))
    rows = ind_latest.where((F.col("date_obs") >= horizon(clock, hours))
                            & F.col("code_station").isNotNull())
    ratio = map_ratio("resultat_obs", quantile)
    out = rows.select(
        "code_station", "date_obs", "flood_indicateur", "resultat_obs", "latitude", "longitude",
        "quantile_999", "quantile_990", "quantile_900", "quantile_001",
        ratio.alias("map_ratio"),
    )
    out = (positive_ratio(out)
           .withColumn("radius", marker_radius("map_ratio"))
           .withColumn("severity", severity("map_ratio")))
    return out.orderBy(F.col("date_obs").desc_nulls_last(), "code_station") if ordered else out


def station_history(hist_flat: DataFrame, stations: DataFrame, code: str) -> DataFrame:
    """One station's daily history with its commune and department.

    The station filter is applied to both sides, so both scans are pruned
    and the join is between one station's rows and its dimension row(s).
    """
    hf = by_station(hist_flat, code).select("code_station", "resultat_obs_elab", "date_obs_elab")
    st = by_station(stations, code).select("code_station", "libelle_commune", "code_departement")
    return hf.join(st, on="code_station", how="inner").select(
        "resultat_obs_elab", "date_obs_elab", "libelle_commune", "code_departement")


def station_live(recent_df: DataFrame, code: str, measure: str = "Q") -> DataFrame:
    """One station's recent series of one measure (D3)."""
    return by_station(recent_df, code, measure).select("resultat_obs", "date_obs")


def station_thresholds(ind_latest: DataFrame, code: str) -> DataFrame:
    """Current value and the three upper quantiles of one station."""
    return by_station(ind_latest, code).select("resultat_obs", "quantile_999", "quantile_990",
                                               "quantile_900")


def station_ymax(hist_flat: DataFrame, recent_df: DataFrame, code: str,
                 measure: str = "Q") -> DataFrame:
    """Shared y-axis maximum of one station's history and live series (A7):
    one aggregate over the union of both value columns, NULLs skipped."""
    h = by_station(hist_flat, code).select(F.col("resultat_obs_elab").alias("v"))
    lv = station_live(recent_df, code, measure).select(F.col("resultat_obs").alias("v"))
    return h.unionByName(lv).agg(F.max("v").alias("max_y"))


def live_top20(latest_df: DataFrame, since: Column | _dt.datetime | None = None,
               n: int = 20) -> DataFrame:
    """Newest ``n`` latest rows (D5, O4); ``since`` optionally keeps rows
    observed after it (F9).  Planned as TakeOrderedAndProject: each task
    keeps its top ``n``, the driver merges at most n per task."""
    df = latest_df
    if since is not None:
        df = df.where(F.col("date_obs") > (since if isinstance(since, Column) else F.lit(since)))
    return (df.select("code_station", "code_site", "date_obs", "resultat_obs", "grandeur_hydro")
            .orderBy(F.col("date_obs").desc_nulls_last(), F.col("code_station").asc_nulls_last(),
                     F.col("grandeur_hydro").asc_nulls_last(),
                     F.col("resultat_obs").desc_nulls_last(), F.col("code_site").asc_nulls_last())
            .limit(n))
