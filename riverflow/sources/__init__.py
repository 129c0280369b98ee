"""Sources (landed JSON, tables) and sinks (append, overwrite, landing)."""

from riverflow.sources.readers import (  # noqa: F401
    decode_json_column,
    encode_json_column,
    merge_pages,
    read_hist_raw,
    read_if_exists,
    read_live_pages,
    read_live_raw,
    read_live_records,
    read_stations,
    table,
)
from riverflow.sources.writers import (  # noqa: F401
    append,
    as_view,
    clustered,
    land_hist,
    land_live,
    materialize,
    overwrite,
)
