"""How high is each station's flow now, relative to its own history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.functions import flood_index
from riverflow.operators.live import by_measure

# The map's bounding box (inclusive), latitude then longitude.
BBOX_LAT = (41.0, 52.0)
BBOX_LON = (-5.0, 9.0)


def bbox_filter(df: DataFrame, lat: tuple[float, float] = BBOX_LAT,
                lon: tuple[float, float] = BBOX_LON) -> DataFrame:
    """Inclusive bounding box; NULL coordinates are dropped."""
    return df.where(F.col("latitude").between(lat[0], lat[1])
                    & F.col("longitude").between(lon[0], lon[1]))


def indicator(live: DataFrame, hist: DataFrame, coords: str = "live", measure: str = "Q",
              lat: tuple[float, float] = BBOX_LAT,
              lon: tuple[float, float] = BBOX_LON) -> DataFrame:
    """Live readings of one measure joined to their station's quantiles.

    Inner equi-join on ``code_station``: a station whose history has several
    coordinate pairs yields one row per pair (kept on purpose).  ``coords``
    picks where longitude/latitude come from: the live rows, or the history
    (the recent view carries none).  No join hint here: ``hist`` holds one
    row per station and coordinate pair; AQE broadcasts a side once its
    finished stage measures under the adaptive threshold, callers holding a
    stored history broadcast it after counting it
    (``operators.joins.checked_broadcast``), and otherwise both sides are shuffled
    (with skewed partitions split).  Filters on the measure and the box are
    pushed below the join into the scans.
    """
    if coords not in ("live", "history"):
        raise ValueError("coords must be 'live' or 'history'")
    lv = by_measure(live, measure).select("code_station", "date_obs", "resultat_obs",
                                          *(["longitude", "latitude"] if coords == "live" else []))
    hv = hist.select("code_station", *schemas.QUANTILE_COLUMNS,
                     *(["longitude", "latitude"] if coords == "history" else []))
    joined = lv.join(hv, on="code_station", how="inner")
    out = joined.select(
        flood_index("resultat_obs", "quantile_010", "quantile_990").alias("flood_indicateur"),
        "longitude", "latitude", "date_obs", "resultat_obs", "code_station",
        *schemas.QUANTILE_COLUMNS,
    )
    return bbox_filter(out, lat, lon)
