"""Literal edge cases of the pipeline's SQL semantics (NULLs, ties, bounds)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.functions import iso_utc, map_ratio, marker_radius, severity
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.operators import serving as V
from riverflow.operators.indicator import bbox_filter, indicator


def live_df(spark, rows):
    """Live frame with the full record schema from partial dicts."""
    names = [n for n, _ in schemas.LIVE_FIELDS]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                 schemas.LIVE_RECORD)


def hist_df(spark, rows):
    """hist_agg-shaped frame from dicts (missing quantiles default to q)."""
    out = []
    for r in rows:
        q = r.get("q")
        out.append((r["code_station"], r.get("latitude", 45.0), r.get("longitude", 2.0), "QmJ",
                    r.get("quantile_999", q), r.get("quantile_990", q), r.get("quantile_900", q),
                    r.get("quantile_100", q), r.get("quantile_010", q), r.get("quantile_001", q),
                    dt.date(2000, 1, 1), dt.date(2000, 12, 31)))
    return spark.createDataFrame(out, schemas.HIST_AGG)


def envelope(json_file, records):
    rec = [tuple(r.get(n) for n, _ in schemas.HIST_RECORD_FIELDS) for r in records] \
        if records is not None else None
    return (None, None, rec, None, None, None if rec is None else len(rec), json_file)


T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


# Q8: the inner unnest drops envelopes whose array is empty or NULL
def test_flatten_drops_empty_and_null_arrays(spark):
    raw = spark.createDataFrame([
        envelope("a.json", []),
        envelope("b.json", None),
        envelope("c.json", [{"code_station": "X", "resultat_obs_elab": 1.0},
                            {"code_station": "Y", "resultat_obs_elab": 2.0}]),
    ], schemas.HIST_RAW)
    flat = H.hist_flatten(raw)
    assert flat.columns == schemas.HIST_FLAT_COLUMNS
    rows = flat.collect()
    assert sorted(r.code_station for r in rows) == ["X", "Y"]
    assert {r.json_file for r in rows} == {"c.json"}


# Q7: NOT IN is null-aware
@pytest.fixture()
def files(spark):
    def mk(values):
        return spark.createDataFrame([(v,) for v in values], "json_file string")
    return mk


def test_not_in_null_source_dropped(files):
    src, tgt = files(["a", "b", None]), files(["a"])
    assert sorted(r.json_file for r in H.not_in_files(src, tgt).collect()) == ["b"]


def test_not_in_null_target_blocks_all(files):
    src, tgt = files(["a", "b", None]), files(["a", None])
    assert H.not_in_files(src, tgt).count() == 0
    # the scale form ignores NULLs on both sides
    assert [r.json_file for r in H.not_in_files(src, tgt, strict=False).collect()] == ["b"]


def test_not_in_empty_target_passes_all(files, spark):
    src = files(["a", "b", None])
    tgt = spark.createDataFrame([], "json_file string")
    assert H.not_in_files(src, tgt).count() == 3


def test_load_new_files_keeps_null_files(files):
    src, tgt = files(["a", "b", None]), files(["a"])
    assert sorted(H.load_new_files(src, tgt).collect(), key=str) == sorted(
        files(["b", None]).collect(), key=str)


# Q3: a revision at the same instant: the higher value is the latest
def test_latest_tie_break(spark):
    df = live_df(spark, [
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": 5.0},
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": 7.0},
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0 - dt.timedelta(hours=1),
         "resultat_obs": 9.0},
        {"code_station": None, "grandeur_hydro": None, "date_obs": T0, "resultat_obs": 1.0},
        {"code_station": None, "grandeur_hydro": None, "date_obs": None, "resultat_obs": 2.0},
    ])
    out = {(r.code_station, r.grandeur_hydro): r for r in L.latest(df).collect()}
    assert out[("S1", "Q")].resultat_obs == 7.0
    assert out[("S1", "Q")].row_num == 1
    # NULL keys form one group; a NULL time sorts last
    assert out[(None, None)].resultat_obs == 1.0
    assert len(out) == 2


# A3 / Q2: exact-row dedup, revisions survive
def test_dedup_ignores_ingestion_stamp(spark):
    base = {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": 5.0}
    rows = [dict(base), dict(base), dict(base, resultat_obs=6.0)]
    df = live_df(spark, rows)
    raw = df.withColumn("ingestion_timestamp", F.current_timestamp())
    assert L.live_dedup(raw).count() == 2


# Q4: a station with two coordinate pairs fans out
def test_indicator_fan_out(spark):
    live = live_df(spark, [{"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0,
                            "resultat_obs": 5.0, "latitude": 45.0, "longitude": 2.0}])
    hist = hist_df(spark, [
        {"code_station": "S1", "latitude": 45.0, "longitude": 2.0, "quantile_010": 1.0,
         "quantile_990": 9.0, "q": 4.0},
        {"code_station": "S1", "latitude": 46.0, "longitude": 3.0, "quantile_010": 1.0,
         "quantile_990": 9.0, "q": 4.0},
    ])
    out = indicator(live, hist).collect()
    assert len(out) == 2
    assert all(r.flood_indicateur == pytest.approx(0.5) for r in out)
    # with coordinates from history both pairs are reported
    coords = {(r.latitude, r.longitude) for r in indicator(live, hist, coords="history").collect()}
    assert coords == {(45.0, 2.0), (46.0, 3.0)}


# Q6: one-value history and a live value equal to it: 0/0 -> NULL, no error
def test_indicator_zero_width_history(spark):
    live = live_df(spark, [{"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0,
                            "resultat_obs": 4.0, "latitude": 45.0, "longitude": 2.0}])
    hist = hist_df(spark, [{"code_station": "S1", "q": 4.0}])
    [row] = indicator(live, hist).collect()
    assert row.flood_indicateur is None


# Branches and both ends of the linear part
@pytest.mark.parametrize("value,expected", [(20.0, 1.0), (0.5, 0.0), (9.0, 1.0), (1.0, 0.0),
                                            (5.0, 0.5)])
def test_flood_index_branches(spark, value, expected):
    live = live_df(spark, [{"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0,
                            "resultat_obs": value, "latitude": 45.0, "longitude": 2.0}])
    hist = hist_df(spark, [{"code_station": "S1", "quantile_010": 1.0, "quantile_990": 9.0,
                            "q": 3.0}])
    [row] = indicator(live, hist).collect()
    assert row.flood_indicateur == pytest.approx(expected)
    assert isinstance(row.flood_indicateur, float)


# Q11: inclusive bounds, NULL dropped
def test_bbox_bounds(spark):
    df = spark.createDataFrame(
        [(41.0, 0.0), (52.0, 0.0), (40.999, 0.0), (None, 0.0), (45.0, -5.0), (45.0, 9.0),
         (45.0, 9.001)], "latitude double, longitude double")
    kept = {(r.latitude, r.longitude) for r in bbox_filter(df).collect()}
    assert kept == {(41.0, 0.0), (52.0, 0.0), (45.0, -5.0), (45.0, 9.0)}


# Q20 / F8: NULL value -> NULL indicator, absent from the map
def test_null_value_indicator_and_map(spark):
    live = live_df(spark, [
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": None,
         "latitude": 45.0, "longitude": 2.0},
        {"code_station": "S2", "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": 3.0,
         "latitude": 45.0, "longitude": 2.0}])
    hist = hist_df(spark, [{"code_station": "S1", "q": 2.0}, {"code_station": "S2", "q": 2.0}])
    ind = indicator(live, hist)
    by = {r.code_station: r for r in ind.collect()}
    assert by["S1"].flood_indicateur is None
    m = V.map_stations(ind, as_of=T0).collect()
    assert [r.code_station for r in m] == ["S2"]
    assert m[0].map_ratio == pytest.approx(1.5)
    assert m[0].radius == pytest.approx(2 + 15 * 1.5)
    assert m[0].severity == pytest.approx(1.0)


def test_map_ratio_clip_and_null(spark):
    df = spark.createDataFrame([(None, 2.0), (-1.0, 2.0), (100.0, 2.0), (1.0, 2.0)],
                               "v double, q double")
    out = df.select(map_ratio("v", "q").alias("r")).collect()
    assert [r.r for r in out] == [None, 0.0, 5.0, 0.5]
    rad = df.select(marker_radius(map_ratio("v", "q")).alias("x"),
                    severity(map_ratio("v", "q")).alias("s")).collect()
    assert [r.x for r in rad] == [None, 2.0, 50.0, 9.5]
    assert [r.s for r in rad] == [None, 0.0, 1.0, 0.5]


# Q9: months of different years share one row
def test_live_avg_ignores_year(spark):
    df = live_df(spark, [
        {"code_station": "S1", "grandeur_hydro": "H", "date_obs": dt.datetime(2023, 1, 5),
         "resultat_obs": 1.0},
        {"code_station": "S1", "grandeur_hydro": "H", "date_obs": dt.datetime(2024, 1, 7),
         "resultat_obs": 3.0},
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": dt.datetime(2024, 1, 7),
         "resultat_obs": 100.0},
    ])
    [row] = L.live_avg(df).collect()
    assert (row.code_station, row.month, row.avg_resultat_obs) == ("S1", 1, 2.0)


# the lower bound of the recent window is inclusive
def test_recent_inclusive_bound(spark):
    df = live_df(spark, [
        {"code_station": "S1", "grandeur_hydro": "Q", "date_obs": T0 - dt.timedelta(hours=24)},
        {"code_station": "S1", "grandeur_hydro": "Q",
         "date_obs": T0 - dt.timedelta(hours=24, seconds=1)},
        {"code_station": None, "grandeur_hydro": "Q", "date_obs": T0},
    ])
    out = L.recent(df, as_of=T0).collect()
    assert [r.date_obs for r in out] == [T0 - dt.timedelta(hours=24)]


def test_stamp_truncates_to_seconds(spark):
    df = spark.range(1)
    [row] = L.stamp_ingestion(df, now=dt.datetime(2024, 1, 2, 3, 4, 5, 999999)).collect()
    assert row.ingestion_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_backfill_span_and_iso(spark):
    start, end = H.backfill_span(dt.date(2024, 12, 31))
    assert end == dt.date(2024, 12, 30)
    assert (end - start).days == 730
    [row] = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp") \
        .select(iso_utc("t").alias("s")).collect()
    assert row.s == "2024-01-02T03:04:05Z"


def test_backfill_days_skips_loaded(spark):
    loaded = spark.createDataFrame([("obs_elab_QmJ_2024-01-02.json",)], "json_file string")
    days = H.backfill_days(spark, loaded, dt.date(2024, 1, 1), dt.date(2024, 1, 3)).collect()
    assert sorted(r.json_file for r in days) == ["obs_elab_QmJ_2024-01-01.json",
                                                 "obs_elab_QmJ_2024-01-03.json"]


def test_top20_since(spark):
    rows = [{"code_station": f"S{i}", "grandeur_hydro": "Q", "code_site": "T",
             "date_obs": T0 + dt.timedelta(minutes=i), "resultat_obs": float(i)} for i in range(30)]
    latest = L.latest(live_df(spark, rows))
    top = V.live_top20(latest).collect()
    assert [r.code_station for r in top] == [f"S{i}" for i in range(29, 9, -1)]
    assert V.live_top20(latest, since=T0 + dt.timedelta(minutes=25)).count() == 4


def test_null_station_never_joins(spark):
    live = live_df(spark, [
        {"code_station": None, "grandeur_hydro": "Q", "date_obs": T0, "resultat_obs": 5.0,
         "latitude": 45.0, "longitude": 2.0}])
    hist = spark.createDataFrame(
        [(None, 45.0, 2.0, "QmJ") + (1.0,) * 6 + (dt.date(2000, 1, 1), dt.date(2000, 1, 2))],
        schemas.HIST_AGG)
    assert indicator(live, hist).count() == 0


def test_null_coordinates_form_their_own_group(spark):
    rows = [("S1", None, None, "QmJ", float(v), dt.date(2000, 1, v), "f") for v in (1, 2, 3)]
    rows += [("S1", 45.0, 2.0, "QmJ", float(v), dt.date(2000, 2, v), "f") for v in (7, 8)]
    flat = spark.createDataFrame(rows, "code_station string, latitude double, longitude double, "
                                       "grandeur_hydro_elab string, resultat_obs_elab double, "
                                       "date_obs_elab date, json_file string")
    for exact in (False, True):
        got = {(r.latitude, r.longitude): (r.quantile_001, r.quantile_999)
               for r in H.hist_agg(flat, exact=exact).collect()}
        assert got == {(None, None): (1.0, 3.0), (45.0, 2.0): (7.0, 8.0)}
