"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed random order, are cut into blocks.  In the
ideal mixture every source not yet used up receives its weight's share of each
slot.  Block i of a source is released when the ideal has given it i blocks and
due when it has given it i + 1; each slot goes to the released block with the
earliest deadline.  Thus, at every slot, the blocks a source has received
differ from what the ideal gives it by less than one block.

With virtual time v, in which a source of weight w and n blocks receives w per
unit until n / w, block i is released at v = i / w; the slot of a v is the sum of
w * min(v, n / w) over the sources.  So sources that run out need no phases, and
releases and deadlines are exact fractions: weights are whole multiples of
2**-60 of their sum, and nothing else is rounded.

Size: the corpus is counted per source, blocks have ``block_docs`` documents or
the corpus's ``max_blocks``-th part, if that is more, so one task makes the
schedule of at most ``max_blocks`` blocks and one more per source, holding one
entry per source.  Documents are ranked and joined with their block's slot.

Defined cases: a NULL source is a source of its own.  Sources without a given
positive weight (or all, by default) weigh the power ``temperature`` of their size
and share what the given weights leave of 1 (or, if nothing, the smallest given
weight).  Rows with equal doc_id and text are interchangeable.  An empty table
gives no row.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm.common import BROADCAST_ROWS, ranked, ready, table
from riverflow.session import stage

BLOCK_DOCS = 32
MAX_BLOCKS = 1 << 20
TEMPERATURE = 0.7
UNIT = 1 << 60             # whole weights add up to about this
SHIFT = 128                # tells fractions with denominators up to UNIT apart
ROWS = 50_000              # of an output batch
BROADCAST_BYTES = 20 << 20


def slots(sources: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot, for sources of (blocks, whole weight), by
    earliest deadline first among the released blocks."""
    ends = sorted((n << SHIFT) // w for n, w in sources)
    order = sorted(range(len(sources)), key=lambda s: (sources[s][0] << SHIFT) // sources[s][1])
    ended, running = [0], [sum(w for _, w in sources)]    # after each end: blocks of ended sources, others' weight
    for s in order:
        ended.append(ended[-1] + sources[s][0])
        running.append(running[-1] - sources[s][1])

    def due(s: int, i: int) -> tuple[int, int]:
        """The slots in and before which the ideal has given ``i`` blocks."""
        w = sources[s][1]
        k = bisect_right(ends, (i << SHIFT) // w)
        return ended[k] + i * running[k] // w, ended[k] - (-i * running[k] // w)

    waiting: list[tuple[int, int, int, int]] = []      # release, deadline, source, block
    released: list[tuple[int, int, int, int]] = []     # deadline, source, block, release of the next
    for s in range(len(sources)):
        after, deadline = due(s, 1)
        released.append((deadline, s, 0, after))
    heapq.heapify(released)
    for slot in range(ended[-1]):
        while waiting and waiting[0][0] <= slot:
            _, deadline, s, i = heapq.heappop(waiting)
            heapq.heappush(released, (deadline, s, i, due(s, i + 1)[0]))
        _, s, i, after = heapq.heappop(released)
        yield s, i
        if i + 1 < sources[s][0]:
            heapq.heappush(waiting, (after, due(s, i + 2)[1], s, i + 1))


def whole(weights: list[float]) -> list[int]:
    """Weights as whole multiples of the UNIT-th part of their sum."""
    total = sum(weights)
    return [max(1, round(w / total * UNIT)) for w in weights]


def _slots(batches):
    keys, blocks, weights = [], [], []
    for b in batches:
        keys += b.column(0).to_pylist()
        blocks += b.column(1).to_pylist()
        weights += b.column(2).to_pylist()
    rows: list[tuple[int, int, int]] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                          names=["k_", "at_", "slot_"])

    if keys:
        for t, (s, i) in enumerate(slots(list(zip(blocks, whole(weights))))):
            rows.append((keys[s], i, t))
            if len(rows) == ROWS:
                yield batch()
                rows = []
    yield batch()


def schedule(docs: DataFrame, weights: dict | None = None, source_col: str = "source", id_col: str = "doc_id",
             text_col: str = "text", block_docs: int = BLOCK_DOCS, max_blocks: int = MAX_BLOCKS,
             temperature: float = TEMPERATURE, seed: int = 7) -> DataFrame:
    """``docs`` with slot_ (the block's place in the mixture), block_ (its
    number in its source) and place_ (the document's place in the block);
    (slot_, place_) orders the mixture."""
    spark = ready(docs.sparkSession)
    names_in = docs.columns
    # the caller's columns go by number inside, so none can clash
    inner = dict(zip(names_in, (f"in{i}_" for i in range(len(names_in)))))
    kind = docs.schema[source_col].dataType.simpleString()
    docs = docs.toDF(*inner.values())
    source_col, id_col, text_col = inner[source_col], inner[id_col], inner[text_col]

    given = spark.createDataFrame([(s, float(w)) for s, w in (weights or {}).items() if w > 0], f"g_ {kind}, given_ double")
    sizes = docs.groupBy(F.col(source_col).alias("s_")).agg(F.count(F.lit(1)).alias("n_"))
    sizes = stage(sizes.join(given, F.col("s_").eqNullSafe(F.col("g_")), "left").select(
        "s_", "n_", "given_", F.pow("n_", F.lit(temperature)).alias("free_")), "sources")
    free = F.col("given_").isNull()
    total, given_sum, least, free_sum = sizes.agg(
        F.sum("n_"), F.sum("given_"), F.min("given_"), F.sum(F.when(free, F.col("free_")))).first()
    # given weights are shares of 1; the rest divides what they leave over
    spare = max(0.0, 1.0 - (given_sum or 0.0)) or min(1.0, least or 1.0)
    block_docs = max(block_docs, -(-(total or 0) // max_blocks))
    sizes = sizes.select("s_", F.ceil(F.col("n_") / block_docs).cast("long").alias("blocks_"),
                         F.when(free, F.lit(spare) * F.col("free_") / F.lit(free_sum or 1.0)).otherwise(F.col("given_")).alias("w_"))
    # numbered in the order of the sources, in the one task that makes the schedule
    sizes = stage(sizes.repartition(1).sortWithinPartitions(F.col("s_").asc_nulls_first()).select(
        F.monotonically_increasing_id().alias("k_"), "s_", "blocks_", "w_"), "numbered")
    plan = stage(sizes.select("k_", "blocks_", "w_").repartition(1).sortWithinPartitions("k_").mapInArrow(
        _slots, "k_ long, at_ long, slot_ long"), "slots")

    out = ranked(docs, F.col(source_col), [F.xxhash64(F.col(id_col), F.lit(seed)), F.xxhash64(text_col)],
                 weight=F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)
    out = out.withColumns({"block_": F.floor(F.col("rank_") / block_docs).cast("long"),
                           "place_": F.pmod(F.col("rank_"), F.lit(block_docs)).cast("int")})
    plan = plan.join(sizes.select("k_", "s_"), "k_")
    count, width = plan.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("s_").cast("string")))).first()
    small = count <= BROADCAST_ROWS and (width or 0) + 40 * count <= BROADCAST_BYTES
    out = out.join(F.broadcast(plan) if small else plan,
                   out.group_.eqNullSafe(plan.s_) & (out.block_ == plan.at_))
    return out.select(*[F.col(c).alias(n) for n, c in inner.items()], "slot_", "block_", "place_")


def op5_pfair(spark, sf_dir):
    """All documents' places in the mixture."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = schedule(docs)
    return out.select("doc_id", "source", F.col("slot_").alias("slot"), F.col("block_").alias("block"),
                      F.col("place_").alias("place"))
