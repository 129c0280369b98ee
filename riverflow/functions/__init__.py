from riverflow.functions.expressions import (  # noqa: F401
    ISO_UTC_FORMAT,
    basename,
    file_tag,
    flood_index,
    hist_landing_path,
    horizon,
    iso_utc,
    map_ratio,
    marker_radius,
    month_of,
    previous_day,
    quantile_at,
    severity,
    year_of,
)
