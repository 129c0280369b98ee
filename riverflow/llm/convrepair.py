"""Conversation structure repair with a square-root checkpointed DP.

Rows of a conversation are taken by turn (NULLs first, then role and text).  A
row's first fault counts: blank (only white space), duplicate (role and text
seen earlier in the conversation), truncated (its last other character is none
of ``. ! ?``).  The cheapest edits make the roles' initials ``(s?(ua)+)?``: Keep
0, Rerole to user or assistant 2, Delete 3 (required for blank and duplicate
rows), Insert an empty user or assistant message 2; a truncated row that stays
adds 1.  Of the cheapest lists of edits the one whose initials are least in
ASCII is taken: at every place the first of D, I, K, R that is tight, that is,
whose cost and the cost still to go give the cost to go here.

The cost to go is a vector over four states (nothing yet, system, user or
assistant written last), computed backwards.  It is stored at checkpoints only,
about the square root of the rows apart; walking forward, one block's vectors
are computed again from the checkpoint after it.  This holds within a task and
across tasks: conversations are cut at the borders of a range partitioning by
(conversation, turn) and after about sqrt(all rows) rows; each block gives its
4 x 4 cost matrix, a scan of matrices from the last block to the first gives the
vector at each block's end, and the forward walk passes one block at a time.  A
conversation with a third of all rows is thus sorted, judged and summed up by
many tasks.  Only the walk over blocks of conversations that cross a border goes
through one task, since a SHA-256 cannot be cut: it streams and holds one block.

Identical rows are combined into one with a count before any shuffle; duplicates
are found by the first turn of each (conversation, role, text).

Defined cases: NULL role or text is one space; NULL turns come first and count
for no gap; NULL conv_ids are one conversation, returned as NULL.  Rows equal in
conversation and turn are ordered by role and text; equal rows are duplicates
after the first.  A conversation without rows has zeros, an empty audit and the
digest of an empty string.  An empty table gives no row.  Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table
from riverflow.session import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
END = (0, 2 * INSERT, INSERT, 0)          # cost to go after the last row
NEXT = (USER, USER, ASSISTANT, USER)      # state after an inserted message
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FAR = 1 << 60
LEAST_BLOCK = 1024                        # rows of a block, at least
BLOCK_BYTES = 4 << 20                     # a block is closed beyond


def closed(v: tuple) -> tuple:
    """The vector with messages inserted first where that is cheaper."""
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[NONE], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


def step(code: int, deletes: int, after: tuple) -> tuple:
    """Cost to go before an item: a row (code = 2 * class + truncated, -1: no
    row) followed by ``deletes`` rows that must go."""
    cost = DELETE * deletes
    n, s, u, a = after[0] + cost, after[1] + cost, after[2] + cost, after[3] + cost
    if code < 0:
        return closed((n, s, u, a))
    kind, extra = code >> 1, TRUNCATED * (code & 1)
    to_user = extra + u + (KEEP if kind == USER else REROLE)
    to_assistant = extra + a + (KEEP if kind == ASSISTANT else REROLE)
    start = min(DELETE + n, to_user)
    if kind == SYSTEM:
        start = min(start, extra + s + KEEP)
    return closed((start, min(DELETE + s, to_user), min(DELETE + u, to_assistant), min(DELETE + a, to_user)))


def matrix(items: list[tuple[int, int]]) -> list[int]:
    """Cost from every entry state (inner index) to every exit state."""
    out = []
    for e in range(4):
        v = tuple(0 if x == e else FAR for x in range(4))
        for code, deletes in reversed(items):
            v = step(code, deletes, v)
        out += [min(x, FAR) for x in v]
    return out


def through(costs: list[int], after: tuple) -> tuple:
    """Cost to go before a block from the vector after it."""
    return tuple(min(costs[4 * e + s] + after[e] for e in range(4)) for s in range(4))


def tight_edits(items: list[tuple[int, int]], state: int, after: tuple, last: bool):
    """(edit, item number or None, role or None) of the ASCII-least cheapest
    edits from ``state`` on; the final value is (None, None, exit state)."""
    m = len(items)
    size = isqrt(m) + 1
    marks = {m: after}
    v = after
    for k in range(m - 1, -1, -1):
        v = step(*items[k], v)
        if k % size == 0:
            marks[k] = v
    for first in range(0, m, size):
        stop = min(m, first + size)
        costs = [marks[stop]]
        for k in range(stop - 1, first - 1, -1):   # the block's vectors, again
            costs.append(step(*items[k], costs[-1]))
        costs.reverse()
        for k in range(first, stop):
            code, deletes = items[k]
            here, then = costs[k - first], costs[k - first + 1]
            while code >= 0:
                to_go, kind = here[state], code >> 1
                if DELETE + DELETE * deletes + then[state] == to_go:
                    yield "D", k, None
                    break
                if INSERT + here[NEXT[state]] == to_go:
                    state = NEXT[state]
                    yield "I", None, ROLE[state]
                    continue
                rest = to_go - TRUNCATED * (code & 1) - DELETE * deletes
                to = kind if (kind == SYSTEM and state == NONE) or kind == NEXT[state] else None
                if to is not None and KEEP + then[to] == rest:
                    state = to
                    yield "K", k, None
                else:
                    state = NEXT[state]
                    yield "R", k, ROLE[state]
                break
            if deletes:
                yield "D" * deletes, None, None
    while last and after[state]:
        state = NEXT[state]
        yield "I", None, ROLE[state]
        if state == ASSISTANT:
            break
    yield None, None, state


class Block(NamedTuple):
    """Rows of one conversation, in order, or its share in a task."""
    items: list           # (code, deletes)
    rows: list            # (role, text) of each item, None without a row
    counts: list          # blank, duplicate, truncated, illegal inside, distinct turns inside
    ends: list            # first and last class, first and last turn, -1 / None: none


class Writer:
    """Walks one conversation's blocks in order and holds its result."""

    def __init__(self):
        self.state, self.audit, self.hash, self.lines = NONE, [], hashlib.sha256(), 0
        self.counts, self.last_kind, self.first_turn, self.last_turn, self.cost = [0] * 5, -1, None, None, None

    def add(self, block: Block, after: tuple, last: bool) -> list[tuple[str, str, str]]:
        """The block's repaired messages (edit, role, text)."""
        first_kind, last_kind, first_turn, last_turn = block.ends
        self.counts = [x + y for x, y in zip(self.counts, block.counts)]
        if self.last_kind >= 0 and first_kind >= 0 and (self.last_kind, first_kind) not in LEGAL:
            self.counts[3] += 1
        if first_turn is not None:
            if self.last_turn == first_turn:
                self.counts[4] -= 1
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn
        self.last_kind = last_kind if last_kind >= 0 else self.last_kind
        if self.cost is None:
            v = after
            for code, deletes in reversed(block.items):
                v = step(code, deletes, v)
            self.cost = v[NONE]
        out = []
        for edit, k, role in tight_edits(block.items, self.state, after, last):
            if edit is None:
                self.state = role
                break
            self.audit.append(edit)
            if edit in "IKR":
                was, text = (None, "") if k is None else block.rows[k]
                out.append((edit, role or was, text))
                self.hash.update((("\n" if self.lines else "") + f"{role or was}:{text}").encode())
                self.lines += 1
        return out

    def result(self) -> list:
        blank, duplicate, truncated, illegal, turns = self.counts
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - turns
        return [gaps, blank, duplicate, truncated, illegal, self.cost or 0, "".join(self.audit), self.hash.hexdigest()]


class _Collector:
    """Collects the rows of one conversation into blocks."""

    def __init__(self):
        self.bytes = self.size = 0
        self.block = Block([], [], [0] * 5, [-1, -1, None, None])

    def row(self, turn, role: str, text: str, copies: int, fault: int) -> None:
        items, rows, counts, ends = self.block
        kind = INITIAL.get(role[:1], 0)    # NONE stands for any other initial
        if ends[0] >= 0 and (ends[1], kind) not in LEGAL:
            counts[3] += 1
        counts[3] += copies - 1
        ends[0], ends[1] = (kind if ends[0] < 0 else ends[0]), kind
        if turn is not None:
            counts[4] += turn != ends[3]
            ends[2], ends[3] = (turn if ends[2] is None else ends[2]), turn
        if fault in (BLANK, DUPLICATE):
            counts[0 if fault == BLANK else 1] += copies
            if items and items[-1][0] < 0:
                items[-1] = (-1, items[-1][1] + copies)
            else:
                items.append((-1, copies))
                rows.append(None)
        else:
            counts[1] += copies - 1
            counts[2] += fault == CUT_OFF
            items.append((2 * kind + (fault == CUT_OFF), copies - 1))
            rows.append((role, text))
            self.bytes += len(role) + len(text)
        self.size += 1


SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
_MESSAGE = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_KINDS = [pa.int64()] * 6 + [pa.string()] * 2
_MESSAGES = "messages array<struct<edit string, role string, text string>>"
_BLOCK = ("part long, block long, codes array<long>, deletes array<long>, roles array<string>, texts array<string>, "
          "counts array<long>, ends array<long>, costs array<long>")
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]
_BLOCK_KINDS = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.string())] * 2 + [pa.list_(pa.int64())] * 3


def _batch(kind: pa.DataType, ids: list, rows: list[list]) -> pa.RecordBatch:
    """Columns conv_id, result, messages and as many of a block's as the rows have."""
    names = ["conv_id", *_NAMES, "messages", *_BLOCK_NAMES][:len(rows[0]) + 1 if rows else None]
    kinds = [kind, *_KINDS, _MESSAGE, *_BLOCK_KINDS]
    cols = [ids, *([r[k] for r in rows] for k in range(len(names) - 1))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def _messages(found: list[tuple]) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in found]


def _pack(block_rows: int, block_bytes: int):
    """Conversations that begin and end inside the task and fit one block are
    solved; the shares of others become blocks."""
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        number, current, seen, kind = 0, None, False, pa.null()
        # border: the conversation may reach into another task; cut: a block
        # of it has been closed here already
        share, border, cut = _Collector(), True, False
        ids, out, held = [], [], 0

        def close(conv, last: bool):
            nonlocal number, share, held
            if last and not border and not cut:
                writer = Writer()
                messages = writer.add(share.block, END, True)
                out.append([*writer.result(), _messages(messages), *[None] * len(_BLOCK_NAMES)])
            else:
                items, rows, counts, ends = share.block
                out.append([None] * (len(_NAMES) + 1) + [
                    part, number, [c for c, _ in items], [d for _, d in items], [r and r[0] for r in rows],
                    [r and r[1] for r in rows], counts, ends, matrix(items)])
                number += 1
            ids.append(conv)
            held += share.bytes + 64
            share = _Collector()

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, real, turn, role, text, copies, fault in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not seen:
                    current, seen = conv, True
                elif conv != current:
                    close(current, True)
                    current, border, cut = conv, False, False
                if not real:
                    continue
                if share.size >= block_rows or share.bytes >= block_bytes:
                    close(current, False)
                    cut = True
                share.row(turn, role, text, copies, fault)
            if held >= block_bytes or len(ids) >= 1000:
                yield _batch(kind, ids, out)
                ids, out, held = [], [], 0
        if seen:
            border = True
            close(current, True)
            yield _batch(kind, ids, out)
    return run


def _backwards(batches):
    """Vector after each block: rows come by conversation, last block first."""
    current, seen, v = None, False, END
    for batch in batches:
        convs, costs = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        after = []
        for conv, cost in zip(convs, costs):
            if not seen or conv != current:
                current, seen, v = conv, True, END
            after.append(list(v))
            v = through(cost, v)
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(after, pa.list_(pa.int64()))],
                                         names=["part_", "block_", "after"])


def _walk(batches):
    """Forward over the blocks of each conversation: a block's messages, and
    with the last block (END follows) the conversation's result."""
    current, seen, writer = None, False, Writer()
    for batch in batches:
        ids, out = [], []
        cols = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in
                ("conv_id", "codes", "deletes", "roles", "texts", "counts", "ends", "after", "last", "part", "block"))
        for conv, codes, deletes, roles, texts, counts, ends, after, last, part, block in zip(*cols):
            if not seen or conv != current:
                current, seen, writer = conv, True, Writer()
            rows = [None if r is None else (r, t) for r, t in zip(roles, texts)]
            found = writer.add(Block(list(zip(codes, deletes)), rows, counts, ends), tuple(after), last)
            ids.append(conv)
            out.append([*(writer.result() if last else [None] * len(_NAMES)), _messages(found), part, block])
        yield _batch(batch.schema.field(0).type, ids, out)


def _fault(text) -> F.Column:
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
            .when(text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), SOUND).otherwise(CUT_OFF))


class Repaired(NamedTuple):
    """``report``: one row per conversation; ``messages``: the repaired
    conversations (conv_id, part, block, place, edit, role, text), in order by
    (part, block, place) within a conversation."""
    report: DataFrame
    messages: DataFrame


def repair(conversations: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id",
           turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           least_block: int = LEAST_BLOCK, block_bytes: int = BLOCK_BYTES) -> Repaired:
    """Faults, cheapest edits and repaired messages of every conversation;
    ``every`` names further conversations (``conv_col``), which may have no rows."""
    spark = ready(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    once = stage(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumns(
        {"digest": F.sha2("text", 256), "fault": _fault(F.col("text"))}), "once")
    # first turn of every message that a conversation has at several turns
    several = once.where(F.col("fault") != BLANK).groupBy("conv_id", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("m")).where("n > 1")
    several = several.select(F.col("conv_id").alias("c_"), F.col("role").alias("r_"), F.col("digest").alias("d_"),
                             F.col("m.turn").alias("first_"), F.lit(True).alias("several_"))
    judged = once.join(several, F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("role") == F.col("r_"))
                       & (F.col("digest") == F.col("d_")), "left")
    later = F.col("several_") & (F.col("fault") != BLANK) & ~F.col("turn").eqNullSafe(F.col("first_"))
    judged = judged.select("conv_id", F.lit(1).alias("real"), "turn", "role", "text", "copies",
                           F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault"))
    names = rows.select("conv_id")
    if every is not None:
        names = names.union(every.select(F.col(conv_col).alias("conv_id")))
    marks = names.distinct().select(
        "conv_id", F.lit(0).alias("real"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit(0).alias("fault"))
    ordered = stage(judged.unionByName(marks), "judged")
    keys = ["conv_id", "real", "turn", "role"]
    dealt = ordered.repartitionByRange(*keys, F.substring("text", 1, 64)).sortWithinPartitions(*keys, "text")
    block_rows = max(least_block, isqrt(ordered.count()))
    kind = rows.schema["conv_id"].dataType.simpleString()
    pieces = stage(dealt.mapInArrow(K.lean("repair", _pack(block_rows, block_bytes)),
                                    f"conv_id {kind}, {_RESULT}, {_MESSAGES}, {_BLOCK}"), "pieces")
    # conversations that cross a border between blocks
    blocks = pieces.where("block is not null").drop("messages", *_NAMES)
    order = ["conv_id", "part", "block"]
    after = blocks.select(*order, "costs").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("part"), F.desc("block")).mapInArrow(
        _backwards, "part_ long, block_ long, after array<long>")
    ends = blocks.groupBy("conv_id").agg(F.max(F.struct("part", "block")).alias("e")).select(
        F.col("e.part").alias("p_"), F.col("e.block").alias("b_"), F.lit(True).alias("last"))
    walked = (blocks.drop("costs")
              .join(after, (F.col("part") == F.col("part_")) & (F.col("block") == F.col("block_")))
              .join(ends, (F.col("part") == F.col("p_")) & (F.col("block") == F.col("b_")), "left")
              .withColumn("last", F.coalesce("last", F.lit(False)))
              .drop("part_", "block_", "p_", "b_"))
    walked = walked.repartition("conv_id").sortWithinPartitions(*order)
    walked = stage(walked.mapInArrow(K.lean("repair", _walk), f"conv_id {kind}, {_RESULT}, {_MESSAGES}, part long, block long"), "walked")
    columns = ["conv_id", *_NAMES, "messages", "part", "block"]
    both = pieces.where("block is null").select(*columns).unionByName(walked)
    messages = both.select("conv_id", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("block", F.lit(0)).alias("block"),
                           F.posexplode("messages").alias("place", "m"))
    return Repaired(both.where("audit is not null").select("conv_id", *_NAMES),
                    messages.select("conv_id", "part", "block", "place", "m.edit", "m.role", "m.text"))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults by crc32 of conv_id:turn (NULL:
    one space) modulo 20: 0 dropped, 1 empty text, 2 text without . ! ?, 3
    repeated, 4 role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("k_")).where("k_ <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("k_") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("k_") == 1, "").when(F.col("k_") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("k_") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy_"))
    return rows.drop("copy_")


def op11_conversation_repair(spark, sf_dir):
    """All conversations, damaged and repaired."""
    conversations = table(spark, sf_dir, "conversations")
    return repair(damage(conversations), every=conversations).report
