"""River-flow monitoring on Spark: landed JSON -> de-duplicated time series ->
per-station quantiles -> flood indicators, as batch and streaming DataFrames."""

__version__ = "0.1.0"
