"""Structured Streaming forms of the live refresh, and the pull calendar."""

from riverflow.streaming.live_stream import (  # noqa: F401
    dedup_to_table,
    ingest,
    run_to_table,
    start,
    stream_dedup,
    stream_indicator,
    stream_latest,
    stream_live_raw,
)
from riverflow.streaming.windows import pull_windows  # noqa: F401
