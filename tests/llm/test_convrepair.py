"""Conversation repair against all lists of edits and a plain DP."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverflow.llm import convrepair as R
from tests.llm.test_operators import SF

SCHEMA = "conv_id long, turn long, role string, text string"
WANT = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """rows: (turn, role, text) in order -> fault of each."""
    out, seen = [], set()
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cheapest edits by recursion over (row, state) with whole strings."""
    found, n = faults(rows), len(rows)
    ready = {"": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, room):
        # room: messages that may still be inserted before row i
        options = []
        if i == n and state in ("", "a"):
            options.append((0, "", ()))
        if room:
            cost, audit, lines = best(i, ready[state], room - 1)
            options.append((cost + 2, "I" + audit, (({"u": "user", "a": "assistant"}[ready[state]] + ":"),) + lines))
        if i < n:
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 2)
            options.append((cost + 3, "D" + audit, lines))
            if found[i] in ("", "truncated"):
                extra, first = found[i] == "truncated", role[:1]
                if first == ready[state] or (first == "s" and state == ""):
                    cost, audit, lines = best(i + 1, first, 2)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}",) + lines))
                to = ready[state]
                cost, audit, lines = best(i + 1, to, 2)
                options.append((cost + 2 + extra, "R" + audit, ({"u": "user", "a": "assistant"}[to] + ":" + text,) + lines))
        return min(options, default=(10 ** 9, "", ()))

    for i in range(n, 0, -1):       # from the end, so no call goes deep
        for state in ready:
            best(i, state, 2)
    cost, audit, lines = best(0, "", 2)
    assert WANT.fullmatch("".join(x[0] for x in lines))
    turns = [t for t, _, _ in rows if t is not None]
    kinds = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def plain(rows, every=()):
    groups = {c: [] for c in every}
    for conv, *rest in rows:
        groups.setdefault(conv, []).append(tuple(rest))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: plain_repair(sorted(g, key=order)) for c, g in groups.items()}


def got(report):
    rows = report.select("conv_id", *R._NAMES).collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def split(n, parts, rnd):
    cuts = sorted(rnd.randint(0, n) for _ in range(parts - 1))
    return list(zip([0, *cuts], [*cuts, n]))


row_lists = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.sampled_from(["user", "assistant", "system", "tool", "", "ua"]),
                               st.sampled_from(["Yes.", "no", "", " ", "Why?", "ok ", "Go! \n", ".a"])), max_size=14)


@settings(max_examples=300, deadline=None)
@given(row_lists, st.integers(1, 5), st.integers(0, 99))
def test_blocks_give_the_cheapest_least_edits(rows, parts, seed):
    """Any cut into blocks, with matrices scanned backwards, equals the plain
    version over the whole conversation."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    rows = sorted(rows, key=order)
    found, blocks = faults(rows), []
    code = {"": R.SOUND, "blank": R.BLANK, "duplicate": R.DUPLICATE, "truncated": R.CUT_OFF}
    for a, b in split(len(rows), parts, random.Random(seed)):
        share = R._Collector()
        for (turn, role, text), fault in zip(rows[a:b], found[a:b]):
            share.row(turn, role, text, 1, code[fault])
        blocks.append(share.block)
    after = [R.END]
    for block in reversed(blocks):
        after.append(R.through(R.matrix(block.items), after[-1]))
    after = after[-2::-1]
    writer, lines = R.Writer(), []
    for k, (block, v) in enumerate(zip(blocks, after)):
        lines += writer.add(block, v, k == len(blocks) - 1)
    want = plain_repair(rows)
    assert tuple(writer.result()) == want
    assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest() == want[-1]


def test_checkpoints_are_few():
    items = [(2 * (k % 3 + 1), 0) for k in range(400)]
    edits = list(R.tight_edits(items, R.NONE, R.END, True))
    assert [e for e, k, _ in edits if k is not None] and sum(k is not None for _, k, _ in edits) == 400


def test_query_equals_plain_version(spark):
    from riverflow.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(plain_damage(rows), {r[0] for r in rows})
    assert got(QUERIES["op11_conversation_repair"](spark, SF)) == want
    assert len({w[6] for w in want.values()}) > 5


def odd_rows(rnd, n=300):
    texts = ["Yes.", "Yes.", "no", "", None, " \n\t", "Why? ", "Go!\n", "ok", "a.b", "Ünï。", "x\x1c", " ."]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    return [(rnd.choice([None, 1, 2, 3, 4, -7]), rnd.choice([None, 0, 1, 2, 3, 5, 9, -4, 10 ** 12]), rnd.choice(roles), rnd.choice(texts))
            for _ in range(n)]


@pytest.mark.parametrize("least_block", [1, 3, 1024])
def test_edge_rows(spark, least_block):
    rows = odd_rows(random.Random(4))
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA + ", part string, block int")
    damaged = plain_damage(rows)
    found = R.repair(R.damage(df), every=df, least_block=least_block)
    assert got(found.report) == plain(damaged, {r[0] for r in rows})
    lines = {}
    for r in found.messages.orderBy("conv_id", "part", "block", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, want in plain(damaged).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == want[-1]


def test_damage_equals_plain_version(spark):
    rows = odd_rows(random.Random(9)) + [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(8)]
    found = R.damage(spark.createDataFrame(rows, SCHEMA)).select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, plain_damage(rows)))


def test_one_conversation_over_many_tasks(spark):
    """Most rows in one conversation, one message in bulk: many blocks."""
    rnd = random.Random(11)
    rows = [(5, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice([f"Line {t}.", "again.", "cut", ""]))
            for t in range(900)] + [(5, 77, "user", "bulk.")] * 300 + [(c, t, "user", "Hi.") for c in range(9) for t in range(2) if c != 5]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = R.repair(df, least_block=16)
    assert found.messages.where("conv_id = 5").select("part", "block").distinct().count() > 8
    assert got(found.report) == plain(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = R.repair(empty)
    assert found.report.collect() == [] and found.messages.collect() == []
    every = spark.createDataFrame([(3, 0, "user", "x")], SCHEMA)
    blank = hashlib.sha256(b"").hexdigest()
    assert got(R.repair(empty, every=every).report) == {3: (0, 0, 0, 0, 0, 0, "", blank)}
    assert R.damage(empty).where(F.lit(True)).collect() == []
