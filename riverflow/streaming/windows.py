"""Pull windows of the live schedule.

Each run asks for the last ``width`` of observations every ``step``, so the
windows overlap and an observation is pulled width/step times.  Spark's
sliding ``window`` is half-open [start, end).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The live schedule pulls 10 minutes of data every 5 minutes.
PULL_WIDTH = "10 minutes"
PULL_STEP = "5 minutes"


def pull_windows(df: DataFrame, ts: str = "date_obs", width: str = PULL_WIDTH,
                 step: str = PULL_STEP) -> DataFrame:
    """Observations per pull window: one row per (window) with its count.

    A partial hash aggregate on the window start; works on batch and on
    watermarked streaming frames alike.
    """
    w = F.window(F.col(ts), width, step)
    return (df.groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n_obs"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_obs"))
