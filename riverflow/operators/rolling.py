"""Quantiles over a moving window of days from a tree of KLL sketches (A1).

Level 0 holds one sketch per (group, day), level k one per (group, 2**k days);
of the levels every STEP-th is stored, the others are read as their nodes below.
A new day changes one node per stored level, and any window of n days is the
union of at most 2 * log2(n) nodes of the tree, each stored as at most
2**(STEP - 1) nodes: a daily refresh and a 730-day window merge a few sketches
per group, days that leave the window are simply not covered, and no history is
read again.

A sparse group has far more nodes than sketches to merge.  So a stored level is
made by dealing out the sketches below it as they are: a node of one child takes
its sketch over, and only the children of one node are merged.  The lists of the
nodes' versions and of changed nodes are broadcast, never the sketches shuffled
by them: high levels have a handful of node numbers.

Nodes are appended under the refresh's load number and never changed.  A
refresh's nodes count once its day-files are in the log, written last: a refresh
that stops half-way leaves nothing visible, and repeating it counts nothing
twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.operators.historical import HIST_KEYS, KLL_K, load_new_files, positive_measure
from riverflow.operators.joins import checked_broadcast
from riverflow.session import stage
from riverflow.sources.readers import read_if_exists

WINDOW_DAYS = 730
LEVELS = 9                 # the largest nodes hold 2**9 = 512 days
STEP = 3                   # levels 0, 3, 6 and 9 are stored
STORED = range(0, LEVELS + 1, STEP)
EPOCH = _dt.date(1970, 1, 1)
MAX_NODE_ROWS = 500_000    # (level, index, load) rows of a broadcast version list


def _day() -> Column:
    return F.datediff("date_obs_elab", F.lit(EPOCH)).cast("bigint")


def day_sketches(flat: DataFrame, k: int = KLL_K, measure: str = "QmJ") -> DataFrame:
    """Level 0: one sketch per group and day.  Rows without a day are left out."""
    return positive_measure(flat, measure).where(F.col("date_obs_elab").isNotNull()).groupBy(*HIST_KEYS, _day().alias("idx")).agg(
        F.kll_sketch_agg_double("resultat_obs_elab", k).alias("sketch"),
        F.min("date_obs_elab").alias("min_date"), F.max("date_obs_elab").alias("max_date"))


def _dates() -> list[Column]:
    return [F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")]


def _merged(parts: DataFrame, keys: list[str], slots: int) -> DataFrame:
    """One sketch per key from its parts, which ``slot`` numbers from 0 up to
    ``slots``: a lone one is taken over as it is.  A key has at most ``slots``
    rows, so they are dealt out once, without a partial aggregate."""
    if slots == 1:
        return parts.select(*keys, "sketch", "min_date", "max_date")
    names = [f"sketch{i}" for i in range(slots)]
    lined = parts.repartition(*keys).groupBy(*keys).agg(
        *[F.max(F.when(F.col("slot") == i, F.col("sketch"))).alias(n) for i, n in enumerate(names)], *_dates())
    there = F.filter(F.array(*names), lambda s: s.isNotNull())
    sketch = F.aggregate(F.slice(there, 2, slots), there[0], lambda a, b: F.kll_sketch_merge_double(a, b))
    return lined.select(*keys, sketch.alias("sketch"), "min_date", "max_date")


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_exists(spark, f"{root}/log")


def nodes(spark: SparkSession, root: str, running: int | None = None,
          levels: list[int] | None = None) -> DataFrame | None:
    """The tree's current nodes, of all or of the named stored ``levels``: of
    every (level, idx) the rows of its latest committed load (or of ``running``,
    the load of a refresh under way)."""
    stored, log = read_if_exists(spark, f"{root}/nodes"), _log(spark, root)
    if stored is None or (log is None and running is None):
        return None
    done = spark.createDataFrame([] if running is None else [(running,)], "load bigint")
    if log is not None:
        done = done.union(log.select("load")).distinct()
    stored = stored.withColumn("load", F.col("load").cast("bigint")).where(
        F.col("level").isin(list(STORED if levels is None else levels)))
    named = stored.select("level", "idx", "load").distinct().join(done, "load", "left_semi")
    latest = stage(named.groupBy("level", "idx").agg(F.max("load").alias("load")), "node_versions")
    return stored.join(checked_broadcast(latest, MAX_NODE_ROWS), ["level", "idx", "load"], "left_semi")


def refresh(spark: SparkSession, root: str, flat: DataFrame, load: int, k: int = KLL_K,
            measure: str = "QmJ") -> int:
    """Fold the day-files of ``flat`` that the log does not name into the tree;
    ``load`` must be greater than any earlier one.  Returns their number."""
    log = _log(spark, root)
    new = flat.where(F.col("json_file").isNotNull())
    if log is not None:
        new = load_new_files(new, log)
    # one scan for the files to log and their days
    seen = stage(new.select("json_file", _day().alias("day")).distinct(), "rolling_files")
    files = seen.select("json_file").distinct()
    days = seen.select("day").where("day is not null").distinct()
    before = nodes(spark, root, levels=[0])
    for level in STORED:
        if level == 0:
            made = day_sketches(new, k, measure)
            if before is not None:
                # another file of a day that the tree has: both together
                old = before.join(checked_broadcast(days.withColumnRenamed("day", "idx"), MAX_NODE_ROWS), "idx", "left_semi")
                slots = 1 if old.isEmpty() else 2
                both = made.withColumn("slot", F.lit(0))
                if slots == 2:
                    both = both.unionByName(old.select(*made.columns, F.lit(1).alias("slot")))
                made = _merged(both, [*HIST_KEYS, "idx"], slots)
        else:
            below = nodes(spark, root, running=load, levels=[level - STEP])
            if below is None:
                break
            # at most one row per new day
            parents = days.select(F.shiftright("day", level).alias("parent")).distinct()
            kids = below.withColumns({"parent": F.shiftright("idx", STEP), "slot": F.pmod("idx", F.lit(1 << STEP))}).join(
                checked_broadcast(parents, MAX_NODE_ROWS), "parent", "left_semi")
            made = _merged(kids.drop("idx").withColumnRenamed("parent", "idx"), [*HIST_KEYS, "idx"], 1 << STEP)
        # one folder per (load, level): a repeated load replaces its own nodes
        made.select(*HIST_KEYS, "idx", "sketch", "min_date", "max_date").write.mode("overwrite").parquet(
            f"{root}/nodes/load={load}/level={level}")
    files.withColumn("load", F.lit(load).cast("bigint")).write.mode("overwrite").parquet(f"{root}/log/part={load}")
    return spark.read.parquet(f"{root}/log/part={load}").count()


def cover(first: _dt.date, last: _dt.date) -> list[tuple[int, int]]:
    """(level, idx) of the largest nodes that make up the days [first, last]."""
    a, b, out = (first - EPOCH).days, (last - EPOCH).days + 1, []
    while a < b:
        level = 0
        while level < LEVELS and a % (2 << level) == 0 and a + (2 << level) <= b:
            level += 1
        out.append((level, a >> level))
        a += 1 << level
    return out


def stored_cover(first: _dt.date, last: _dt.date) -> list[tuple[int, int]]:
    """``cover`` by nodes of stored levels."""
    return [(level // STEP * STEP, i) for level, idx in cover(first, last)
            for i in range(idx << level % STEP, (idx + 1) << level % STEP)]


def window_quantiles(spark: SparkSession, root: str, as_of: list[_dt.date], days: int = WINDOW_DAYS,
                     k: int = KLL_K) -> DataFrame:
    """``hist_agg`` over the ``days`` days up to each of the ``as_of`` days:
    as_of, the group's keys, six quantiles and the first and last day with a
    value in the window."""
    tree = nodes(spark, root)
    if tree is None:
        raise ValueError(f"no sketches under {root}")
    wanted = [(d, level, idx) for d in as_of for level, idx in stored_cover(d - _dt.timedelta(days=days - 1), d)]
    # at most 2**STEP * log2(days) rows per window
    windows = spark.createDataFrame(wanted, "as_of date, level int, idx bigint")
    parts = tree.join(checked_broadcast(windows, MAX_NODE_ROWS), ["level", "idx"])
    merged = parts.groupBy("as_of", *HIST_KEYS).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), *_dates())
    return merged.select(
        "as_of", *HIST_KEYS,
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(f)).alias(c)
          for f, c in zip(schemas.QUANTILE_FRACTIONS, schemas.QUANTILE_COLUMNS)],
        F.col("min_date").alias("minimum_date_window"), F.col("max_date").alias("maximum_date_window"))
