"""Landed API pages followed along their ``next`` links.

The source system fetches a first page and then the page each answer names,
until there is none or a page is missing.  Landed pages are followed the same
way, whatever order they landed in: each page's position is its distance from
the first one, found by pointer doubling (after k rounds every page knows its
2**k-th successor), so a chain of n pages takes about log2(n) rounds of joins
on page addresses and never a loop over pages.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverflow.session import stage

CHAIN, END, GAP, CYCLE, UNREACHABLE = "chain", "end", "gap", "cycle", "unreachable"


class Chain(NamedTuple):
    """``records``: the chain's records with their page's ``position``;
    ``report``: one row per landed page (page, next, position, status)."""
    records: DataFrame
    report: DataFrame


def one_landing(pages: DataFrame, page: str = "page", landed: str | None = None) -> DataFrame:
    """One row per page address: of several landings the one with the greatest
    ``landed`` value (without it, of a fixed hash of the content)."""
    content = F.xxhash64(*[F.col(c) for c in pages.columns if c != page])
    version = F.struct((F.col(landed) if landed else F.lit(0)).alias("at"), content.alias("content"))
    keyed = pages.withColumn("version_", version)
    best = keyed.groupBy(F.col(page).alias("page_")).agg(F.max("version_").alias("best_"))
    chosen = keyed.join(best, (F.col(page) == F.col("page_")) & (F.col("version_") == F.col("best_")))
    return chosen.select(*pages.columns).dropDuplicates([page])


def positions(links: DataFrame, first: str) -> DataFrame:
    """(page, position) of every page that ``links`` (page, next; one row per
    page) reaches from ``first``.  In a cycle a page has its first position."""
    landed = links.select("page")
    jumps = stage(links.select("page", F.col("next").alias("to")).join(
        landed.withColumnRenamed("page", "to"), "to", "left_semi").select("page", "to"), "jumps")
    reached = stage(landed.where(F.col("page") == F.lit(first)).distinct()
                    .select("page", F.lit(0).cast("bigint").alias("position")), "reached")
    far = 1
    while True:
        # all pages nearer than `far` are in `reached`, a union of one stored
        # table per round
        ahead = reached.join(jumps, "page").select(F.col("to").alias("page"), (F.col("position") + far).alias("position"))
        new = stage(ahead.join(reached.select("page"), "page", "left_anti").groupBy("page").agg(
            F.min("position").alias("position")), "reached")
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        then = jumps.select(F.col("page").alias("to"), F.col("to").alias("to2"))
        jumps = stage(jumps.join(then, "to").select("page", F.col("to2").alias("to")), "jumps")
        far *= 2


def first_page(links: DataFrame) -> str:
    """The one landed page that no other names as its next."""
    heads = links.select("page").join(links.select(F.col("next").alias("page")), "page", "left_anti").limit(2).collect()
    if len(heads) != 1:
        raise ValueError("the first page is not unique: name it")
    return heads[0][0]


def follow(pages: DataFrame, first: str | None = None, page: str = "page", next_col: str = "next",
           data: str = "data", landed: str | None = None) -> Chain:
    """Records of the chain of pages that starts at ``first``.

    The chain stops before the first page that did not land (status ``gap`` on
    the page that names it), after a page without a next one (``end``) or
    before a page it already holds (``cycle``).  Pages off the chain are
    ``unreachable`` and give no records.  NULL or empty ``next`` means none;
    rows without an address are on no chain and in no report.
    """
    named = pages.select(F.col(page).alias("page"), F.nullif(F.col(next_col), F.lit("")).alias("next"),
                         F.col(data).alias("data"), *([F.col(landed).alias("landed_")] if landed else []))
    once = stage(one_landing(named.where("page is not null"), "page", "landed_" if landed else None), "pages")
    links = once.select("page", "next")
    if first is None and not links.isEmpty():
        first = first_page(links)
    found = positions(links, first or "")
    after = found.select(F.col("page").alias("next"), F.lit(True).alias("again_"), F.col("position").alias("next_position_"))
    there = links.select(F.col("page").alias("next"), F.lit(True).alias("landed_"))
    report = links.join(found, "page", "left").join(after, "next", "left").join(there, "next", "left")
    back = F.col("again_") & (F.col("next_position_") <= F.col("position"))
    status: Column = (F.when(F.col("position").isNull(), UNREACHABLE).when(F.col("next").isNull(), END)
                      .when(F.col("landed_").isNull(), GAP).when(back, CYCLE).otherwise(CHAIN))
    records = once.join(found, "page").select("position", F.inline("data"))
    return Chain(records, report.select("page", "next", "position", status.alias("status")))
