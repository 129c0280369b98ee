"""Chat formatting by quotation linking.

Each message is parsed into its own text and quoted passages by level (the
number of ``>`` marks at a line's start).  Passages (paragraphs) and single
lines are normalised (lower case, single spaces) and hashed.  A quoted passage
is linked to the latest earlier message of its conversation that holds it as
its own text; a message replies to the message that the lowest quoted level
with a link names, by most linked characters, then the latest turn.  Without a
link it replies to the turn before.  Following replies gives each message its
thread (the turn at its root) and depth: (thread, depth, turn) puts every
message after the one it answers.

Quoted and own passages of equal hash meet in a window ordered by turn, which
passes the latest earlier owner on: no pairs are made, however often a passage
is quoted.  Conversations are cut into slices of turns, so a very long one is
not one group.

Defined cases: NULL text is empty text, NULL role is ``user``.  Rows with equal
(conv_id, turn) count as one message for linking.  NULL conv_ids or turns link
to nothing: reply_to NULL, thread their own turn, depth 0.  A message whose
lines are all quotes has empty content.  Extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverflow.llm.common import ready, table
from riverflow.session import stage

SLICE_TURNS = 4096
_MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
# the line that mail programs put above a quote
_INTRO = re.compile(r"\s*(on\b.*\bwrote|am\b.*\bschrieb.*|le\b.*\ba écrit|el\b.*\bescribió)\s*:\s*", re.I | re.S)


def split_quotes(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, passage)]): level 0 passages are the message's own."""
    own, passages, lines, level = [], [], [], 0

    def close():
        if lines:
            passages.append((level, "\n".join(lines)))
            lines.clear()

    for line in text.split("\n"):
        m = _MARK.match(line)
        at = m[1].count(">") if m else 0
        body = line[m.end():] if m else line
        if at != level or not body.strip():
            if at and not level and lines and _INTRO.fullmatch(lines[-1]):
                lines.pop()
                own.pop()
            close()
            level = at
        if body.strip():
            lines.append(body)
        if not at:
            own.append(line)
    close()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(), passages


def normalised(passage: str) -> str:
    return " ".join(passage.lower().split())


_UNIT = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary()), ("size", pa.int32())]))


def _parse(batches):
    import hashlib
    for batch in batches:
        own, units = [], []
        for text in batch.column(3).to_pylist():
            content, passages = split_quotes(text or "")
            seen = {}
            for level, p in passages:
                lines = p.split("\n")
                for piece in [p, *lines] if len(lines) > 1 else [p]:
                    whole = normalised(piece)
                    seen[(level, hashlib.blake2b(whole.encode(), digest_size=16).digest())] = len(whole)
            own.append(content)
            units.append([{"level": k, "hash": h, "size": n} for (k, h), n in seen.items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(own, pa.string()), pa.array(units, _UNIT)],
            names=["conv_id", "turn", "role", "content", "units"])


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """One row per message row: conv_id, turn, role, content (without quotes),
    n_quotes, n_linked, reply_to, thread, depth, formatted."""
    ready(messages.sparkSession)
    cols = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    parsed = stage(cols.mapInArrow(
        _parse, "conv_id long, turn long, role string, content string, "
                "units array<struct<level:int,hash:binary,size:int>>"), "messages")
    units = parsed.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.inline("units")).distinct()
    # only passages that somebody quotes can be linked
    quoted = units.where("level > 0")
    near = units.join(quoted.select("conv_id", "hash").distinct().hint("shuffle_hash"), ["conv_id", "hash"])
    w = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    linked = near.withColumn("owner", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(w)).where("level > 0")
    votes = linked.groupBy("conv_id", "turn", "level", "owner").agg(F.sum("size").alias("size"),
                                                                    F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_quotes"), F.coalesce(F.sum(F.when(F.col("owner").isNotNull(), F.col("n"))), F.lit(0)).alias("n_linked"),
        F.max(F.when(F.col("owner").isNotNull(), F.struct(-F.col("level"), "size", "owner")))["owner"].alias("quoted"))
    # the turn before, in slices of turns
    turns = parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct().withColumn(
        "slice", F.floor(F.col("turn") / SLICE_TURNS).cast("long"))
    last = turns.groupBy("conv_id", "slice").agg(F.max("turn").alias("last"))
    last = last.select("conv_id", "slice", F.lag("last").over(Window.partitionBy("conv_id").orderBy("slice")).alias("earlier"))
    turns = turns.withColumn("before", F.lag("turn").over(Window.partitionBy("conv_id", "slice").orderBy("turn")))
    turns = turns.join(last, ["conv_id", "slice"]).select("conv_id", "turn", F.coalesce("before", "earlier").alias("before"))
    edges = turns.join(best, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("quoted", "before").alias("reply_to"))
    edges = stage(edges, "replies")
    # root and depth by pointer doubling: log2(longest chain) rounds
    state = stage(edges.select("conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"),
                               F.col("reply_to").isNotNull().cast("long").alias("depth"),
                               F.col("reply_to").isNotNull().alias("moved")), "chains")
    while True:
        over = state.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        # messages that have reached their root stay out of the join
        state = stage(state.where("moved").join(over, ["conv_id", "up"]).select(
            "conv_id", "turn", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("up2") != F.col("up")).alias("moved")).union(state.where("not moved")), "chains")
        if not state.where("moved").limit(1).count():
            break
    found = edges.join(state.select("conv_id", "turn", F.col("up").alias("thread"), "depth"), ["conv_id", "turn"])
    found = found.select(F.col("conv_id").alias("c_"), F.col("turn").alias("t_"), "n_quotes", "n_linked", "reply_to",
                         "thread", "depth")
    out = parsed.join(found, (parsed.conv_id == found.c_) & (parsed.turn == found.t_), "left")
    role = F.coalesce("role", F.lit("user"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "turn", role.alias("role"), "content", zero("n_quotes"), zero("n_linked"), "reply_to",
                      F.coalesce("thread", "turn").alias("thread"), zero("depth"),
                      F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("content"), F.lit("\n<|end|>")).alias("formatted"))


def op7_quotes(spark, sf_dir):
    """All messages, linked, ordered and formatted."""
    return link(table(spark, sf_dir, "conversations"))
