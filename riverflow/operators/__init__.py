"""Relational operators of the pipeline, each a pure DataFrame -> DataFrame."""

from riverflow.operators.historical import (  # noqa: F401
    backfill_days,
    backfill_span,
    calendar,
    exact_quantiles,
    file_row_counts,
    flatten_incremental,
    hist_agg,
    hist_agg_from_sketches,
    hist_flatten,
    hist_sketches,
    kll_hist_agg,
    load_new_files,
    loaded_files,
    not_in_files,
    positive_measure,
)
from riverflow.operators.indicator import bbox_filter, indicator  # noqa: F401
from riverflow.operators.joins import checked_broadcast  # noqa: F401
from riverflow.operators.live import (  # noqa: F401
    as_of_max,
    avg_from_parts,
    by_measure,
    latest,
    live_avg,
    live_avg_parts,
    live_dedup,
    live_dedup_increment,
    merge_avg_parts,
    recent,
    stamp_ingestion,
)
from riverflow.operators.serving import (  # noqa: F401
    by_station,
    live_top20,
    map_stations,
    positive_ratio,
    station_history,
    station_live,
    station_thresholds,
    station_ymax,
)
