"""Scalar column expressions.  All are built-in Spark expressions, so they
stay inside whole-stage code generation; none calls back into Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flood_index(v: ColumnOrName, q010: ColumnOrName, q990: ColumnOrName) -> Column:
    """Flood indicator: 1 above q990, 0 below q010, linear in between.

    The branches are doubles (the source mixes 1/0 with a float).  A history
    with q990 == q010 makes the middle branch 0/0: ``try_divide`` answers NULL
    where plain division would raise under ANSI mode.  A NULL value fails both
    comparisons and ends NULL through the last branch.
    """
    v, lo, hi = _c(v), _c(q010), _c(q990)
    return (F.when(v > hi, F.lit(1.0))
            .when(v < lo, F.lit(0.0))
            .otherwise(F.try_divide(v - lo, hi - lo)))


def map_ratio(v: ColumnOrName, q: ColumnOrName, upper: float = 5.0) -> Column:
    """Value over the chosen quantile, clipped to [0, upper].

    ``greatest``/``least`` skip NULLs, so a NULL value is guarded explicitly:
    a missing reading must stay NULL, not become 0.
    """
    v = _c(v)
    return F.when(v.isNotNull(),
                  F.least(F.greatest(F.try_divide(v, _c(q)), F.lit(0.0)), F.lit(float(upper))))


def marker_radius(ratio: ColumnOrName, base: float = 2.0, scale: float = 15.0,
                  cap: float = 50.0) -> Column:
    """Map marker radius ``min(cap, base + scale * ratio)``; NULL stays NULL."""
    r = _c(ratio)
    return F.when(r.isNotNull(), F.least(F.lit(cap), F.lit(base) + F.lit(scale) * r))


def severity(ratio: ColumnOrName) -> Column:
    """Position on the 0..1 colour scale; ratios above 1 saturate."""
    r = _c(ratio)
    return F.when(r.isNotNull(), F.least(r, F.lit(1.0)))


def month_of(ts: ColumnOrName) -> Column:
    """Month number 1..12 as BIGINT (the year is deliberately ignored)."""
    return F.month(_c(ts)).cast("bigint")


def horizon(as_of: ColumnOrName, hours: int = 24) -> Column:
    """``as_of`` minus a fixed number of hours (inclusive lower bound)."""
    return _c(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def quantile_at(arr: ColumnOrName, i: int) -> Column:
    """Zero-based array position, as ``[OFFSET(i)]``."""
    return _c(arr).getItem(i)


def basename(path: ColumnOrName) -> Column:
    """Last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def year_of(date_text: ColumnOrName) -> Column:
    """Year of an ISO date (``YYYY-MM-DD`` text or a date)."""
    return F.year(F.to_date(_c(date_text)))


# Fixed value: the text form of a UTC instant used in API window bounds.
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_utc(ts: ColumnOrName) -> Column:
    """Timestamp as ``YYYY-MM-DDTHH:MM:SSZ`` (session zone is UTC)."""
    return F.date_format(_c(ts), ISO_UTC_FORMAT)


def previous_day(d: ColumnOrName) -> Column:
    """The day before: a run on day D fetches D-1."""
    return F.date_sub(_c(d), 1)


# The day-file name pattern obs_elab_<measure>_<YYYY-MM-DD>.json
# and the daily mean-flow measure code QmJ.
def file_tag(day: ColumnOrName, param: str = "QmJ") -> Column:
    """Name of a day's landed history file: ``obs_elab_<param>_<YYYY-MM-DD>.json``."""
    return F.concat(F.lit("obs_elab_"), F.lit(param), F.lit("_"),
                    F.date_format(F.to_date(_c(day)), "yyyy-MM-dd"), F.lit(".json"))


def hist_landing_path(day: ColumnOrName, param: str = "QmJ",
                      root: str = "historical") -> Column:
    """Object path ``<root>/<year>/<file_tag>`` of a landed day-file."""
    d = F.to_date(_c(day))
    return F.concat_ws("/", F.lit(root), F.year(d).cast("string"), file_tag(d, param))
