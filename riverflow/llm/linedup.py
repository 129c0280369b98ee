"""Line dedup over runs of lines by prefix doubling, DataFrame functions only.

The corpus is one sequence of line ids (128-bit hashes), cut at document ends.
Suffixes are grouped by prefix doubling: the name of the first 2**k lines of a
suffix is made of the names of its two halves.  All suffixes of one name are an
interval of the suffix array with a common prefix of 2**k lines.  Suffixes whose
name is unique leave; the others go on to 2**(k + 1) lines, until none is left.
Only equality of prefixes is needed to find repeats, so names are hashes and
intervals are not put in order.

The longest common prefix of a suffix with any earlier one (smaller doc_id, then
line) is put together from the levels, longest first: the 2**k lines that follow
what is already matched are added if the longer prefix has an earlier member in
its interval, too.  A match that does not extend to the left is a later copy of
a maximal repeated run (``maximal_runs``).

A run qualifies if it has at least ``min_lines`` lines, or at least one line of
``min_line_words`` words.  Every line of a qualifying later copy is deleted;
the first copy stays.

Blank lines belong to no run and stay.  A common line is counted with map-side
partial sums and joined by its name with skewed partitions split.

Defined cases: NULL text has no lines and stays NULL; the empty text stays
empty.  NULL doc_ids come first.  Rows of equal doc_id follow a hash of their
text; rows equal in both are one document for finding repeats, and all get the
same deletions.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverflow.llm.common import table
from riverflow.session import stage

MIN_LINES = 3
MIN_LINE_WORDS = 20
KEY = ["d_", "t_"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d_"), F.xxhash64(text).alias("t_"))


def _name(*parts: Column) -> Column:
    """128-bit name of a sequence of names or strings."""
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def _repeated(named: DataFrame) -> DataFrame:
    """The rows of ``named`` whose name n occurs at several places."""
    twice = named.groupBy("n").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("n")
    return named.join(twice.hint("shuffle_hash"), "n")


def _levels(keyed: DataFrame, min_line_words: int) -> list[DataFrame]:
    """Per k the suffixes (d_, t_, seq) whose first 2**k lines are repeated, with
    their name n; next_long is the next long line's seq among repeated ones."""
    nonblank = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    lines = keyed.where("text is not null").select(*KEY, F.posexplode(nonblank).alias("seq", "x")).select(
        *KEY, "seq", _name(F.col("x")).alias("n"), (F.size(F.split(F.trim("x"), r"\s+")) >= min_line_words).alias("long"))
    again = _repeated(stage(lines, "lines")).repartition(*KEY).dropDuplicates([*KEY, "seq"])
    w = Window.partitionBy(*KEY).orderBy("seq")
    levels = [stage(again.select(*KEY, "seq", "n", F.min(F.when(F.col("long"), F.col("seq"))).over(
        w.rowsBetween(0, Window.unboundedFollowing)).alias("next_long")), "line_names")]
    while not levels[-1].isEmpty():
        span = 1 << len(levels) - 1
        longer = levels[-1].withColumn("o_", F.first("n").over(w.rangeBetween(span, span))).where("o_ is not null")
        levels.append(stage(_repeated(longer.select(*KEY, "seq", _name(F.col("n"), F.col("o_")).alias("n"), "next_long")),
                            "line_names"))
    return levels[:-1]


def _runs(keyed: DataFrame, min_line_words: int) -> DataFrame:
    """(d_, t_, seq, length, long): the later copies of maximal repeated runs, as
    numbers of nonblank lines; long: has a long line.

    A row says that ``length`` lines of a suffix, named p_, are matched.  Where
    a longer prefix has several members, all but the earliest go on to it; the
    earliest stays, for itself, and goes on as a witness, which is compared with
    but not matched.  No interval is left without its earliest member, and
    members that stay stand for those that went on, equal so far."""
    levels, found = _levels(keyed, min_line_words), None
    at, state = [*KEY, "seq"], ["p_", "length", "next_long", "witness"]
    start = F.struct(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    for k in range(len(levels) - 1, -1, -1):
        tried = levels[k].select(*at, start.alias("p_"), F.lit(0).alias("length"), "next_long", F.lit(False).alias("witness"),
                                 F.col("n").alias("n_"))
        if found is not None:
            ahead = levels[k].select(*KEY, F.col("seq").alias("to_"), F.col("n").alias("n_"))
            tried = found.withColumn("to_", F.col("seq") + F.col("length")).join(ahead, [*KEY, "to_"], "left").drop(
                "to_").unionByName(tried.join(found.where("not witness").select(*at), at, "left_anti"))
        # the longer prefix: its name, and its interval's earliest member
        tried = stage(tried.select(F.struct(*at).alias("at"), *state, F.when(
            F.col("n_").isNotNull(), _name(F.col("p_"), F.lit(k), F.col("n_"))).alias("q_")), "line_tries")
        first = tried.where("q_ is not null").groupBy("q_").agg(
            F.min("at").alias("first"), F.max(F.when(~F.col("witness"), F.col("at"))).alias("last")).where(
            "last > first").select("q_", "first")
        out = tried.where("q_ is not null").join(first.hint("shuffle_hash"), "q_", "left")
        stays = F.struct(*state)
        goes = F.struct(F.col("q_").alias("p_"), (F.col("length") + (1 << k)).alias("length"), F.col("next_long"),
                        (F.col("witness") | (F.col("at") == F.col("first"))).alias("witness"))
        out = out.select("at", F.explode(F.when(F.col("first").isNull(), F.array(stays)).when(
            F.col("at") == F.col("first"), F.array(stays, goes)).otherwise(F.array(goes))).alias("s_")).select("at.*", "s_.*")
        same = tried.where("q_ is null").select("at.*", *state)
        found = stage(out.unionByName(same).where("length > 0"), "line_matches")
    if found is None:
        return keyed.where(F.lit(False)).select(*KEY, F.lit(0).alias("seq"), F.lit(0).alias("length"), F.lit(True).alias("long"))
    # a match one line longer that starts one line before holds this one
    before = F.first("length").over(Window.partitionBy(*KEY).orderBy("seq").rangeBetween(-1, -1))
    return found.where("not witness").withColumn("before_", before).where("before_ is null or before_ <= length").select(
        *at, "length", F.coalesce(F.col("next_long") < F.col("seq") + F.col("length"), F.lit(False)).alias("long"))


def maximal_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """doc_id, seq (number of the first nonblank line), length, long: the later
    copies of maximal repeated line runs, one row per place; rows equal in
    doc_id and text count as one document."""
    found = _runs(_keyed(docs, id_col, text_col), min_line_words)
    return found.select(F.nullif("d_", F.lit(-(1 << 63))).alias("doc_id"), "seq", "length", "long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_lines: int = MIN_LINES, min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_removed, text (without the
    later copies of qualifying maximal runs)."""
    keyed = _keyed(docs, id_col, text_col)
    runs = _runs(keyed, min_line_words).where((F.col("length") >= min_lines) | F.col("long"))
    # a document's runs: bounded by its own lines
    runs = runs.groupBy(*KEY).agg(F.collect_list(F.struct("seq", "length")).alias("runs"))
    # one projection per column: a lambda would split the text anew for every line
    lines, numbers = F.col("lines"), F.col("numbers")
    out = keyed.join(runs, KEY, "left").withColumn("lines", F.split("text", "\n"))
    out = out.withColumn("numbers", F.when(F.col("runs").isNotNull(), F.sequence(F.lit(0), F.size(lines) - 1)))
    out = out.withColumn("nonblank", F.filter(numbers, lambda i: F.trim(F.element_at(lines, i + 1)) != ""))
    out = out.withColumn("gone", F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.slice("nonblank", r["seq"] + 1, r["length"])))))
    return out.select(
        "doc_id", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(
            F.transform(F.array_except(numbers, F.col("gone")), lambda i: F.element_at(lines, i + 1)), "\n")).alias("text"))


def op6_linedup(spark, sf_dir):
    """All documents without later copies of repeated line runs."""
    return dedup_lines(table(spark, sf_dir, "documents"))
