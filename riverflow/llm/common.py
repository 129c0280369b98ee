"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverflow.session import stage

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# A side is broadcast only when it has been counted and has at most this many
# narrow rows (ids and a few numbers, about 40 bytes each: 20 MB).
BROADCAST_ROWS = 500_000


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package wherever the driver started.
    On a cluster without a shared code folder, ship it with --py-files."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    # whole texts go through Arrow: batches small enough for two tasks' buffers
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    if spark.conf.get(ARROW_BYTES, "67108864b") == "67108864b":
        spark.conf.set(ARROW_BYTES, "4m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def counted_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a staged table of narrow rows) with a broadcast hint if its
    counted rows are within the bound; else unchanged, and the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def ranked(df: DataFrame, group: Column, order: list[Column], size: Column | None = None,
           rows_per_slice: int = 100_000, weight: Column | None = None,
           weight_per_slice: int = 32 << 20) -> DataFrame:
    """Add ``rank_`` (0-based row number) and, with ``size``, ``before_`` (sum
    of the sizes of earlier rows) within each group, in the order of
    ``order``; its first element must be a 64-bit hash spread evenly.

    A group is cut into equal hash ranges of about ``rows_per_slice`` rows, and of
    about ``weight_per_slice`` of ``weight`` (bytes of a row), and each slice is
    numbered on its own, so a group holding most rows is spread over as many
    tasks as it has slices.  NULL groups are numbered as a group.
    """
    spread = order[0]
    keyed = df.withColumns({"group_": group, "spread_": spread})
    most = keyed.groupBy("group_").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.lit(0) if weight is None else weight).alias("w")).agg(F.max("n"), F.max("w")).first()
    slices = max(-(-(most[0] or 0) // rows_per_slice), -(-(most[1] or 0) // weight_per_slice))
    bits = max(0, (slices - 1).bit_length())
    # top bits of the hash, as an unsigned number, keep the order of the hash
    cut = (F.shiftright(F.col("spread_"), 64 - bits) if bits else F.lit(0).cast("long"))
    keyed = keyed.withColumn("slice_", cut)
    one = F.lit(1) if size is None else size
    sums = keyed.groupBy("group_", "slice_").agg(
        F.count(F.lit(1)).alias("n_"), F.sum(one).alias("s_"))
    earlier = Window.partitionBy("group_").orderBy("slice_").rowsBetween(
        Window.unboundedPreceding, -1)
    base = sums.select(
        F.col("group_").alias("g_"), F.col("slice_").alias("c_"),
        F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("n0_"),
        F.coalesce(F.sum("s_").over(earlier), F.lit(0)).alias("s0_"))
    w = Window.partitionBy("group_", "slice_").orderBy("spread_", *order[1:])
    out = keyed.withColumn("rank_", F.row_number().over(w) - 1)
    if size is not None:
        out = out.withColumn("before_", F.coalesce(
            F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.join(base, F.col("group_").eqNullSafe(F.col("g_")) & (F.col("slice_") == F.col("c_")))
    out = out.withColumn("rank_", F.col("rank_") + F.col("n0_"))
    if size is not None:
        out = out.withColumn("before_", F.col("before_") + F.col("s0_"))
    return out.drop("spread_", "slice_", "g_", "c_", "n0_", "s0_")


def _forest(batches):
    """Union-find over the edges of one partition; only its spanning forest
    (node, smallest node of its tree) goes on."""
    import numpy as np
    import pyarrow as pa
    parent: dict[int, int] = {}

    def root(x):
        r = x
        while (p := parent.get(r, r)) != r:
            r = p
        while x != r:
            parent[x], x = r, parent.get(x, x)
        return r

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rx, ry = root(x), root(y)
            parent.setdefault(x, rx), parent.setdefault(y, ry)
            if rx != ry:
                lo, hi = (rx, ry) if rx < ry else (ry, rx)
                parent[hi] = lo
    pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
    a = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (u long, v long):
    rows (node, component), component = smallest node reachable.

    Union-find contracts each partition's edges to a spanning forest; then
    alternating large-star and small-star rounds (hook every larger neighbour
    to the smallest) run until nothing changes.  Each round is written to the
    shared folder.  No partition or group is held by the driver.
    """
    ready(edges.sparkSession)
    cur = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .mapInArrow(_forest, "u long, v long").distinct())
    cur, mark = stage(cur, "edges"), None
    for _ in range(max_rounds):
        new_mark = tuple(cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                                 F.bit_xor(F.xxhash64("v", "u"))).first())
        if new_mark == mark or new_mark[0] == 0:
            break
        mark = new_mark
        # large star: every neighbour larger than the node points to the
        # smallest of the node and its neighbours
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the node and its smaller neighbours point to the smallest
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_min, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small_min.select("u", F.col("m").alias("v"))))
        cur = stage(small.where("u <> v").distinct(), "edges")
    else:
        raise RuntimeError("components did not converge")
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(cur.select("v", "v")).distinct()
