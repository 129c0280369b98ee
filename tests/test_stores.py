"""Stored tables: page chains, rolling sketches, atomic versions, lookups by
file skipping, exact stream stores by day."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.operators import rolling
from riverflow.operators import serving
from riverflow.plans import pipelines as P
from riverflow.sources import layout, pages, versions
from riverflow.sources import readers as R
from riverflow.sources import writers as W
from riverflow.streaming import live_stream as S

from tests.conftest import SF_SMALL
from tests.test_streaming import same_rows


def scan_rows(df):
    """Rows that the file scans of ``df`` gave out when it ran, after row
    groups were skipped."""
    spark = df.sparkSession
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        leaves = plan.collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        return sum(x.metrics().apply("numOutputRows").value() for x in found if "Scan" in x.nodeName())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def data_files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


# --- page chains

PAGE = "page string, next string, data array<struct<v:int>>, at int"


def chain(spark, rows, first=None, landed=None):
    found = pages.follow(spark.createDataFrame([(p, n, [(v,) for v in d], a) for p, n, d, a in rows], PAGE), first, landed=landed)
    return ([r.v for r in found.records.orderBy("position", "v").collect()],
            {r.page: (r.position, r.status) for r in found.report.collect()})


def test_chain_follows_links_in_any_order(spark):
    rnd = random.Random(3)
    rows = [(f"p{i}", f"p{i + 1}" if i < 70 else "", [i], 0) for i in range(71)]
    rnd.shuffle(rows)
    records, report = chain(spark, rows)
    assert records == list(range(71))
    assert report == {f"p{i}": (i, "chain" if i < 70 else "end") for i in range(71)}


def test_chain_gap_cycle_and_strays(spark):
    records, report = chain(spark, [("a", "b", [1], 0), ("b", "lost", [2], 0), ("c", "d", [3], 0), ("d", None, [4], 0)], "a")
    assert records == [1, 2]
    assert report == {"a": (0, "chain"), "b": (1, "gap"), "c": (None, "unreachable"), "d": (None, "unreachable")}
    loop = [("a", "b", [1], 0), ("b", "c", [2], 0), ("c", "d", [3], 0), ("d", "b", [4], 0)]
    records, report = chain(spark, loop, "a")
    assert records == [1, 2, 3, 4] and report["d"] == (3, "cycle") and report["c"] == (2, "chain")
    assert chain(spark, [("x", "x", [9], 0)], "x") == ([9], {"x": (0, "cycle")})
    assert chain(spark, loop, "nowhere") == ([], {p: (None, "unreachable") for p in "abcd"})
    with pytest.raises(ValueError):
        chain(spark, [*loop, ("z", "", [5], 0)])     # two pages that none names
    assert chain(spark, []) == ([], {})


def test_chain_takes_one_landing_of_a_page(spark):
    rows = [("a", "b", [1], 1), ("a", "b", [7], 2), ("b", "", [2], 1), ("b", "", [2], 1), (None, "a", [5], 0)]
    records, report = chain(spark, rows, "a", landed="at")
    assert records == [2, 7] or records == [7, 2]
    assert report == {"a": (0, "chain"), "b": (1, "end")}


def test_landed_pages_are_named_by_field_or_file(spark, scratch):
    import json
    os.makedirs(f"{scratch}/pages")
    row = lambda i: {"code_station": f"S{i}", "resultat_obs": float(i)}
    for name, nxt, field in (("one", "two.json", None), ("two", "third", None), ("x", None, "third"), ("stray", "", None)):
        body = {"count": 1, "next": nxt, "data": [row(len(name))]} | ({"page": field} if field else {})
        with open(f"{scratch}/pages/{name}.json", "w") as f:
            f.write(json.dumps(body))
    found = R.read_page_chain(spark, f"{scratch}/pages", "one.json")
    assert [r.code_station for r in found.records.orderBy("position").collect()] == ["S3", "S3", "S1"]
    assert {r.page: r.status for r in found.report.collect()} == {
        "one.json": "chain", "two.json": "chain", "third": "end", "stray.json": "unreachable"}
    paths = P.Paths(f"{scratch}/tables")
    assert P.ingest_live(spark, f"{scratch}/pages", paths, first="one.json") == 3


# --- rolling quantiles

def test_cover_is_exact_and_small():
    rnd = random.Random(1)
    for _ in range(300):
        a = dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randint(0, 9000))
        b = a + dt.timedelta(days=rnd.randint(-1, 900))
        found = rolling.cover(a, b)
        days = [d for level, i in found for d in range(i << level, (i + 1) << level)]
        assert days == list(range((a - rolling.EPOCH).days, (b - rolling.EPOCH).days + 1))
        assert len(found) <= 2 * rolling.LEVELS + 2


def plain_windows(flat, as_of, days):
    """Exact rank bounds: (day, group) -> sorted values in the window."""
    out = {}
    for r in H.positive_measure(flat).select(*H.HIST_KEYS, "date_obs_elab", "resultat_obs_elab").collect():
        for d in as_of:
            if d - dt.timedelta(days=days - 1) <= r.date_obs_elab <= d:
                out.setdefault((d, *[r[k] for k in H.HIST_KEYS]), []).append(r.resultat_obs_elab)
    return {k: sorted(v) for k, v in out.items()}


def rank_error(values, x, fraction):
    n = len(values)
    lo, hi = sum(v < x for v in values), sum(v <= x for v in values)
    want = fraction * n
    return max(0.0, lo - want, want - hi) / n


@pytest.mark.parametrize("k,bound", [(2000, 0.0), (64, 0.06)])
def test_rolling_windows_within_rank_error(spark, scratch, k, bound):
    flat = fx.fx_hist_flat(spark, SF_SMALL).withColumn("code_station", F.lit("S1")).withColumns(
        {"latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    cut = F.col("json_file") < F.lit("obs_elab_QmJ_1998-01-01.json")
    assert rolling.refresh(spark, scratch, flat.where(cut), load=1, k=k) > 0
    late = flat.where(~cut)
    rolling.refresh(spark, scratch, late.where(F.month("date_obs_elab") > 3), load=2, k=k)
    rolling.refresh(spark, scratch, flat, load=3, k=k)      # days that came late
    assert rolling.refresh(spark, scratch, flat, load=4, k=k) == 0
    as_of = [dt.date(1996, 5, 5), dt.date(1998, 6, 30), dt.date(2000, 12, 31)]
    want = plain_windows(flat, as_of, 730)
    got = rolling.window_quantiles(spark, scratch, as_of, k=k).collect()
    assert len(got) == len(want) > 0
    for r in got:
        values = want[(r.as_of, *[r[c] for c in H.HIST_KEYS])]
        for f, c in zip(schemas.QUANTILE_FRACTIONS, schemas.QUANTILE_COLUMNS):
            assert rank_error(values, r[c], f) <= bound


def test_rolling_refresh_that_stops_is_not_seen(spark, scratch, monkeypatch):
    flat = fx.fx_hist_flat(spark, SF_SMALL)
    cut = F.col("json_file") < F.lit("obs_elab_QmJ_1998-01-01.json")
    rolling.refresh(spark, scratch, flat.where(cut), load=1)
    before = rolling.window_quantiles(spark, scratch, [dt.date(1999, 1, 1)]).collect()
    made = rolling._merged
    calls = []

    def stops(*args):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("stopped")
        return made(*args)

    monkeypatch.setattr(rolling, "_merged", stops)
    with pytest.raises(RuntimeError):
        rolling.refresh(spark, scratch, flat, load=2)
    monkeypatch.setattr(rolling, "_merged", made)
    key = lambda rows: sorted(map(str, rows))
    assert key(rolling.window_quantiles(spark, scratch, [dt.date(1999, 1, 1)]).collect()) == key(before)
    rolling.refresh(spark, scratch, flat, load=3)
    once = f"{scratch}/once"
    rolling.refresh(spark, once, flat, load=1)
    days = [dt.date(1999, 1, 1), dt.date(2000, 12, 31)]
    assert key(rolling.window_quantiles(spark, scratch, days).collect()) == key(rolling.window_quantiles(spark, once, days).collect())


def test_rolling_lists_are_broadcast_and_lone_sketches_kept(spark, scratch):
    day = dt.date(1999, 3, 1)
    rows = [("A", 1.0, 2.0, "QmJ", 5.0 + i, day + dt.timedelta(days=i), f"f{i}") for i in range(40)]
    rows += [("B", None, 2.0, "QmJ", 7.0, day, "f0")]
    flat = spark.createDataFrame(rows, "code_station string, latitude double, longitude double, grandeur_hydro_elab string, "
                                       "resultat_obs_elab double, date_obs_elab date, json_file string")
    rolling.refresh(spark, scratch, flat.where("json_file < 'f2'"), load=1)
    rolling.refresh(spark, scratch, flat, load=2)
    tree = rolling.nodes(spark, scratch)
    plan = tree._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert {r.level for r in tree.select("level").distinct().collect()} == set(rolling.STORED)
    lone = tree.where("code_station = 'B'").select("sketch", "latitude").distinct().collect()
    assert len(lone) == 1 and lone[0].latitude is None
    got = {r.code_station: r for r in rolling.window_quantiles(spark, scratch, [day + dt.timedelta(days=30)], days=20).collect()}
    assert set(got) == {"A"}
    assert (got["A"].minimum_date_window, got["A"].maximum_date_window) == (day + dt.timedelta(days=11), day + dt.timedelta(days=30))
    values = [r[4] for r in rows[11:31]]
    assert [got["A"][c] for c in schemas.QUANTILE_COLUMNS] == [
        values[max(1, math.ceil(round(f * 1000) * 20 / 1000)) - 1] for f in schemas.QUANTILE_FRACTIONS]


def test_stored_cover_holds_the_same_days():
    a, b = dt.date(1996, 2, 28), dt.date(1998, 2, 26)
    found = rolling.stored_cover(a, b)
    assert all(level in rolling.STORED for level, _ in found)
    assert sorted(d for level, i in found for d in range(i << level, (i + 1) << level)) == list(
        range((a - rolling.EPOCH).days, (b - rolling.EPOCH).days + 1))


# --- versions

def test_replacement_is_one_commit(spark, scratch, monkeypatch):
    name = "versions_" + os.path.basename(scratch).replace("-", "_").lower()
    old, new = spark.range(10).withColumn("v", F.lit("old")), spark.range(25).withColumn("v", F.lit("new"))
    assert versions.versions(spark, name) == [] and versions.current(spark, name) is None
    assert versions.replace(old, name, scratch) == 10
    monkeypatch.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        versions.replace(new, name, scratch)
    monkeypatch.undo()
    # written, not committed: readers have the old table, whole
    assert {r.v for r in spark.table(name).collect()} == {"old"} and spark.table(name).count() == 10
    reader = spark.table(name)
    assert versions.replace(spark.table(name).unionByName(new), name, scratch, cluster_by=["id"]) == 35
    assert spark.table(name).count() == 35 and reader.count() in (10, 35)
    assert versions.roll_back(spark, name) == versions.versions(spark, name)[-1]
    assert spark.table(name).count() == 10
    with pytest.raises(ValueError):
        versions.roll_back(spark, name)
    for _ in range(3):
        versions.replace(new, name, scratch)
    gone = versions.vacuum(spark, name, keep=2)
    assert len(gone) == 2 and not any(os.path.exists(g.removeprefix("file:")) for g in gone)
    assert len(versions.versions(spark, name)) == 2 and spark.table(name).count() == 25
    spark.sql(f"DROP TABLE {name}")


# --- lookups

def test_morton_interleaves_bits(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (65535, 0), (0, 65535), (43690, 21845)], "a int, b int")
    got = [r[0] for r in rows.select(layout.morton(F.col("a"), F.col("b"))).collect()]
    weave = lambda a, b: sum((a >> i & 1) << 2 * i | (b >> i & 1) << 2 * i + 1 for i in range(16))
    assert got == [weave(*r) for r in rows.collect()]


def test_lookups_open_a_small_share(spark, scratch):
    flat = spark.range(0, 120_000).select(
        F.concat(F.lit("S"), F.col("id") % 300).alias("code_station"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("id") / 300).cast("int") * 5).alias("date_obs_elab"),
        F.rand(3).alias("resultat_obs_elab"))
    W.append(layout.along_curve(flat, partitions=64), f"{scratch}/flat", blooms={"code_station": 300})
    stored = spark.read.parquet(f"{scratch}/flat")
    assert stored.count() == 120_000 and len(data_files(f"{scratch}/flat")) == 64
    one = serving.by_station(stored, "S17")
    assert one.count() == 400
    assert scan_rows(one) <= 120_000 / 4
    day = stored.where(F.col("date_obs_elab") == F.lit(dt.date(1996, 1, 1)))
    assert day.count() == 300 and scan_rows(day) <= 120_000 / 4
    assert serving.by_station(stored, "nowhere").count() == 0
    # a code that shares a stored hash is told apart by the Bloom filter
    assert scan_rows(stored.where(F.col("code_station") == "S99999")) <= 120_000 / 4
    nulls = flat.withColumn("code_station", F.lit(None).cast("string")).limit(3)
    assert layout.along_curve(nulls).select(layout.STATION_HASH).distinct().count() == 1


# --- exact stream stores

def raw_rows(spark, rows):
    """rows: (station, time, value) -> live raw frame."""
    df = spark.createDataFrame(rows, "code_station string, date_obs timestamp, resultat_obs double")
    cols = [F.col(f.name) if f.name in df.columns else F.lit("Q" if f.name == "grandeur_hydro" else None).cast(f.dataType).alias(f.name)
            for f in schemas.LIVE_RAW.fields]
    return df.select(*cols)


def test_late_row_opens_its_own_day_and_row_groups(spark, scratch):
    day = lambda d, m=0: dt.datetime(2024, 3, d, 12, m)
    rows = [(f"S{i % 5}", day(d, i % 60), float(i)) for d in range(1, 11) for i in range(100)]
    store = f"{scratch}/dedup"
    S.write_dedup_store(S.staged_batch(raw_rows(spark, rows + rows[:50])), W.load_path(store, "one"))
    assert spark.read.parquet(store).count() == 1000
    for f in data_files(store):
        if "obs_day=2024-03-04" not in f:
            with open(f, "wb") as out:
                out.write(b"not parquet")       # opening it would fail
    late = S.staged_batch(raw_rows(spark, [rows[310], ("S1", day(4, 7), -1.0)]))
    stored = S.read_dedup_store(spark, store)
    new = L.unseen_rows(late, stored)
    assert [r.resultat_obs for r in new.collect()] == [-1.0]
    # a row that the day does not hold: the Bloom filter skips its row groups
    probe = late.where("resultat_obs = -1").first()[L.ROW_HASH]
    alone = L.on_days(stored, [dt.date(2024, 3, 4)])
    assert scan_rows(alone.where(F.col(L.ROW_HASH).isin([probe]))) == 0
    assert scan_rows(alone) == 100


def test_indicator_store_equals_batch_over_many_batches(spark, scratch):
    rnd = random.Random(2)
    rows = [(rnd.choice(["S1", "S2", None]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 200)), rnd.choice([1.0, 2.0, None]))
            for _ in range(400)]
    raw = raw_rows(spark, rows)
    W.land_live(raw.repartition(6), f"{scratch}/landed")
    hist = W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), f"{scratch}/hist")
    for _ in range(2):      # the second start finds nothing new
        q = S.indicator_to_table(S.stream_live_raw(spark, f"{scratch}/landed", max_files_per_trigger=2), hist, f"{scratch}/out",
                                 name="store", checkpoint=f"{scratch}/ckpt")
        q.awaitTermination()
        assert q.exception() is None
    stored = S.read_dedup_store(spark, f"{scratch}/out/dedup").select(*schemas.LIVE_DEDUP_COLUMNS)
    assert same_rows(stored, L.live_dedup(raw))
    from riverflow.operators.indicator import indicator
    assert same_rows(spark.read.parquet(f"{scratch}/out/indicator").drop("load"), indicator(L.live_dedup(raw), hist))
